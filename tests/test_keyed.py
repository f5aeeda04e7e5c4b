import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.sources import lake, payloads
from tillstream.streaming import ingest, jobs, keyed

T0 = dt.datetime(2024, 1, 6)
HOUR = dt.timedelta(hours=1)
LIFE_H = 24


def first_by_hand(triggers):
    """Accepted (key, hours, payload) and duplicates, record by record."""
    seen, won, gone = {}, [], {}
    for rows in triggers:
        for key, hours, payload in sorted(rows, key=lambda r: (r[1], r[2])):
            times = seen.setdefault(key, [])
            if any(abs(hours - s) < LIFE_H for s in times):
                gone[key] = gone.get(key, 0) + 1
            else:
                times.append(hours)
                won.append((key, hours, payload))
    return sorted(won, key=str), gone


def feed(spark, path, triggers, schema, row):
    """One file for each trigger, as a stream that reads them in turn."""
    for i, rows in enumerate(triggers):
        spark.createDataFrame([row(*r) for r in rows], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def drain(stream, path, name, mode):
    got = []
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).foreachBatch(
        lambda df, i: got.append((i, df.collect()))).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return got, q


def triggers_of(seed, n=4):
    """Hours that move on by a third of a day a trigger, with late rows of up to 20 hours, ties, copies and a hot key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rows = [(rng.choice(["a", "b", "c", None]), i * 9 - rng.randrange(0, 21) + 30, rng.choice(["x", "y"])) for _ in range(12)]
        out.append(rows + [("hot", i * 9 + 30 + h / 1000, "x") for h in range(300)] + rows[:3])
    return out


def test_first_wins_equals_the_rule_record_by_record(spark, tmp_path):
    triggers = triggers_of(5, 6)
    stream = feed(spark, tmp_path, triggers, "key string, arrival_ts timestamp, payload string",
                  lambda k, h, p: (k, T0 + h * HOUR, p))
    got, _ = drain(keyed.first_wins(stream), tmp_path, "first", "append")
    rows = [r for _, batch in got for r in batch]
    won = sorted([(r.key, (r.arrival_ts - T0) / HOUR, r.payload) for r in rows if r.duplicates is None], key=str)
    gone = {}
    for r in rows:
        if r.duplicates is not None:
            gone[r.key] = gone.get(r.key, 0) + r.duplicates
    want, want_gone = first_by_hand(triggers)
    assert [(k, p) for k, _, p in won] == [(k, p) for k, _, p in want]
    assert np.allclose([h for _, h, _ in won], [h for _, h, _ in want])
    assert gone == want_gone
    assert len(won) + sum(gone.values()) == sum(map(len, triggers))


def test_state_holds_no_more_than_living_keys(spark, tmp_path):
    triggers = [[(f"k{day}-{i}", day * 24, "x") for i in range(20)] for day in range(9)]
    stream = feed(spark, tmp_path, triggers, "key string, arrival_ts timestamp, payload string",
                  lambda k, h, p: (k, T0 + h * HOUR, p))
    got, q = drain(keyed.first_wins(stream), tmp_path, "first", "append")
    assert sum(len(b) for _, b in got) == 180
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 4 * 20
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) == 0


def test_latest_and_versions(spark, tmp_path):
    triggers = triggers_of(8)
    rng = random.Random(3)
    triggers = [[(k, h, None if rng.random() < 0.1 else rng.randrange(50), p) for k, h, p in rows] for rows in triggers]
    stream = feed(spark, tmp_path, triggers, "key string, arrival_ts timestamp, version_ts timestamp, payload string",
                  lambda k, h, v, p: (k, T0 + h * HOUR, None if v is None else T0 + v * HOUR, p))
    got, _ = drain(keyed.latest(stream), tmp_path, "latest", "update")
    state = {}
    for _, batch in got:
        for r in batch:
            state[r.key] = (None if r.version_ts is None else round((r.version_ts - T0) / HOUR), r.payload, r.versions)
    want = {}
    for key in {r[0] for rows in triggers for r in rows}:
        mine = [r for rows in triggers for r in rows if r[0] == key]
        top = max(mine, key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        want[key] = (top[2], top[3], len(mine))
    assert state == want


def test_accept_jumps_over_what_is_covered():
    rng = random.Random(1)
    for _ in range(300):
        arrivals = sorted(rng.randrange(60) for _ in range(rng.randrange(12)))
        seen, want, times = [rng.randrange(60) for _ in range(rng.randrange(2))], [], None
        times = list(seen)
        for i, t in enumerate(arrivals):
            if all(abs(t - s) >= 7 for s in times):
                times.append(t)
                want.append(i)
        assert keyed.accept(np.array(arrivals, dtype=np.int64), seen, 7) == (want, sorted(times))


@pytest.mark.parametrize("entity", ["payments"])
def test_keyed_ingest_equals_batch(spark, folder, tmp_path, entity):
    data = payloads.payloads(spark, folder, entity).filter("arrival_ts < timestamp'2024-01-03'")
    data.repartitionByRange(3, "arrival_ts").write.parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        q = jobs.start_keyed_ingest(jobs.payload_stream(spark, f"{tmp_path}/in", 1), entity, f"{tmp_path}/lake", f"{tmp_path}/cp")
        q.awaitTermination(300)
        assert q.exception() is None
    static = ingest.process(ingest.classify(data, entity), entity)
    got = lake.read_bronze(spark, f"{tmp_path}/lake", entity)
    assert sorted(r[0] for r in got.select("processing_id").collect()) == sorted(
        r[0] for r in static.accepted.select("processing_id").collect())
    names = ("total_records", "valid_records", "failed_records", "duplicate_records", "fraud_flagged")
    total = spark.read.parquet(f"{tmp_path}/lake/summaries/{entity}").agg(*[F.sum(c).alias(c) for c in names]).first()
    want = ingest.batch_summary(static, entity).first()
    assert tuple(total) == tuple(want[c] for c in names)
    assert jobs.read_letters(spark, f"{tmp_path}/lake", entity).count() == want.failed_records
    with pytest.raises(ValueError):
        jobs.start_keyed_ingest(jobs.payload_stream(spark, f"{tmp_path}/in"), "carts", f"{tmp_path}/lake", f"{tmp_path}/cp2")
