"""Keyed stream operators whose state has a life per key, kept in the state store.

``first_wins`` accepts a record unless one of its key was accepted less than a life before (or after, if it came late); ``latest``
keeps a key's latest record and the number of its versions. Records that can have no effect are counted away in the map
tasks, one Arrow batch at a time, so that what is shuffled of a hot key does not grow with its copies.

The watermark follows the arrivals at a distance of one life. A key is forgotten when the watermark is a life past its last
accepted record, so the state holds keys of three lives at most, whatever the age of the stream. Records that arrive more than a
life behind the newest one are not processed; the query's progress counts them (``numRowsDroppedByWatermark``).

The functions run in Python workers, so executors need this package (``--py-files``).

Defined results: null keys are one key, a null payload is an empty one, empty triggers give no rows, equal records (key, arrival and
payload) are copies of one. Arrivals are the source's own times and never null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LIFE = dt.timedelta(hours=24)
NO_VERSION = -(1 << 62)  # a record without a version is older than all others
ROWS = "key string, arrival_us long, payload string, n long, arrival_ts timestamp"
FIRST = "key string, arrival_us long, payload string, duplicates long"
LATEST = "key string, version_us long, payload string, versions long"


def _copies(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the records with one key and arrival only the first by payload can be accepted; the others are its duplicates."""
    for rows in pieces:
        rows = rows.sort_values(["key", "arrival_us", "payload"], kind="stable")
        at = ["key", "arrival_us"]
        n = rows.groupby(at, dropna=False, sort=False)["n"].transform("sum")
        yield rows.assign(n=n).drop_duplicates(at)


def _newest(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a key's records only the latest one matters, and how many they are. The piece's last arrival stands for all."""
    for rows in pieces:
        rows = rows.sort_values(["key", "version_us", "payload"], kind="stable")
        by = rows.groupby("key", dropna=False, sort=False)
        rows = rows.assign(n=by["n"].transform("sum"), arrival_us=by["arrival_us"].transform("max"),
                           arrival_ts=by["arrival_ts"].transform("max"))
        yield rows.drop_duplicates("key", keep="last")


def _forget_after(state: GroupState, last_us: int, life_us: int) -> None:
    state.setTimeoutTimestamp(max((last_us + life_us) // 1000, state.getCurrentWatermarkMs()) + 1)


def accept(arrivals: np.ndarray, seen: list[int], life_us: int) -> tuple[list[int], list[int]]:
    """Which of the ascending ``arrivals`` are accepted, by place, and all accepted times, ascending. Each step jumps to the
    first arrival that no accepted record covers, so the steps number the accepted records, not the arrivals."""
    seen, places, at = sorted(seen), [], 0
    while at < len(arrivals):
        t = int(arrivals[at])
        cover = [s for s in seen if abs(t - s) < life_us]
        if cover:
            at = int(np.searchsorted(arrivals, max(cover) + life_us, "left"))
        else:
            places.append(at)
            seen = sorted([*seen, t])
    return places, seen


def first_wins(records: DataFrame, life: dt.timedelta = LIFE) -> DataFrame:
    """Rows of ``FIRST`` from a stream of (key, arrival_ts, payload): the accepted records (``duplicates`` null), and for each key
    and trigger the number of its duplicates as a row without payload.

    A task holds those arrivals of a key in one trigger that no earlier trigger has made duplicates; a trigger's size is the
    source's to bound (``maxFilesPerTrigger`` and the like). Within a trigger records count in the order of arrival and payload.
    """
    life_us = int(life.total_seconds() * 1_000_000)

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen = list(state.get[0]) if state.exists else []
        dropped, open_ = 0, []
        for rows in pieces:
            t, covered = rows["arrival_us"].to_numpy(), np.zeros(len(rows), bool)
            for s in seen:
                covered |= np.abs(t - s) < life_us
            dropped += int(rows["n"].to_numpy()[covered].sum())
            open_.append(rows[~covered])
        rows = pd.concat(open_).sort_values(["arrival_us", "payload"], kind="stable")
        places, seen = accept(rows["arrival_us"].to_numpy(), seen, life_us)
        won = rows.iloc[places]
        dropped += int(rows["n"].sum()) - len(won)
        horizon = state.getCurrentWatermarkMs() * 1000 - life_us
        state.update(([s for s in seen if s > horizon] or seen[-1:],))
        _forget_after(state, seen[-1], life_us)
        yield won[["key", "arrival_us", "payload"]].assign(duplicates=pd.array([None] * len(won), "Int64"))
        if dropped:
            yield pd.DataFrame({"key": [key[0]], "arrival_us": pd.array([None], "Int64"), "payload": pd.Series([None], dtype=object),
                                "duplicates": pd.array([dropped], "Int64")})

    rows = records.select("key", F.unix_micros("arrival_ts").alias("arrival_us"), F.coalesce("payload", F.lit("")).alias("payload"),
                          F.lit(1).cast("long").alias("n"), "arrival_ts")
    return _watermarked(rows, _copies, ROWS, life).groupBy("key").applyInPandasWithState(
        step, FIRST, "seen array<long>", "append", GroupStateTimeout.EventTimeTimeout).withColumn(
        "arrival_ts", F.timestamp_micros("arrival_us")).drop("arrival_us")


def latest(records: DataFrame, life: dt.timedelta = LIFE) -> DataFrame:
    """Rows of ``LATEST`` from a stream of (key, version_ts, arrival_ts, payload): for each key and trigger with news the latest
    record known, by version and payload, and the number of records so far. One record of a key is held, however many arrive.

    Sinks take the last row of a key, as with any output in update mode. A key is forgotten a life after its last arrival.
    """
    life_us = int(life.total_seconds() * 1_000_000)

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, n, last = (tuple(state.get[:2]), state.get[2], state.get[3]) if state.exists else (None, 0, 0)
        for rows in pieces:
            n, last = n + int(rows["n"].sum()), max(last, int(rows["arrival_us"].max()))
            top = rows.sort_values(["version_us", "payload"], kind="stable").iloc[-1]
            found = (int(top["version_us"]), top["payload"])
            best = found if best is None else max(best, found)
        state.update((*best, n, last))
        _forget_after(state, last, life_us)
        yield pd.DataFrame({"key": [key[0]], "version_us": [best[0]], "payload": [best[1]], "versions": [n]})

    version = F.coalesce(F.unix_micros("version_ts"), F.lit(NO_VERSION))
    rows = records.select("key", F.unix_micros("arrival_ts").alias("arrival_us"), version.alias("version_us"),
                          F.coalesce("payload", F.lit("")).alias("payload"), F.lit(1).cast("long").alias("n"), "arrival_ts")
    schema = "key string, arrival_us long, version_us long, payload string, n long, arrival_ts timestamp"
    return _watermarked(rows, _newest, schema, life).groupBy("key").applyInPandasWithState(
        step, LATEST, "version_us long, payload string, versions long, last_us long", "update",
        GroupStateTimeout.EventTimeTimeout).withColumn(
        "version_ts", F.timestamp_micros(F.nullif("version_us", F.lit(NO_VERSION)))).drop("version_us")


def _watermarked(rows: DataFrame, combine, schema: str, life: dt.timedelta) -> DataFrame:
    """Combine in the map tasks; the watermark is declared on what the state sees."""
    return rows.mapInPandas(combine, schema).withWatermark("arrival_ts", f"{int(life.total_seconds())} seconds")
