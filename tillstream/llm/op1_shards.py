"""Sharding by balanced label propagation, built-in functions only. Law: ``rows``, shard counts at most one apart.

Documents with equal texts are linked. A group larger than a shard fills as many whole shards as it can; all other linked
documents start dealt evenly over the rest. In each round every group looks where most of its members are, and members from
shards with no more of them ask to move there. What moves is bounded by quotas for each pair of shards: exchanges along rings
of shards (A to B, B to C, C to A), and what room B has left. So no shard ever has more linked documents than its share of all
documents. When nothing moves any more, groups look only at shards that have room, then at all again, until neither moves
anything; every move puts more pairs together, so this ends. Documents without links then fill the shards to their exact counts.

Ranks are taken within (key, hash bucket), with the totals of the buckets before; no window ever holds a whole shard or group.

Defined results: a null text has size 8 and the checksum of no bytes, and null texts are linked as equal; equal rows are
placed one by one; null ids take part; with fewer documents than shards some shards stay empty. Only the columns asked for are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.scratch import written

SHARDS = 24
BUCKET_ROWS = 50_000
GROUP = ["g1", "g2"]


def ranked(df: DataFrame, keys: list[str], rows: int, into: str) -> DataFrame:
    """``into``: gapless rank from 0 within ``keys``, in the order of a hash of ``uid``."""
    b, before = f"{into}_b", f"{into}_before"
    buckets = max(16, rows // BUCKET_ROWS)
    h = F.xxhash64("uid")
    placed = df.withColumn(b, F.pmod(h, F.lit(buckets)))
    totals = placed.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, b, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy(*keys, b).orderBy(h, "uid"))
    return placed.withColumn(into, inside).join(offsets, [*keys, b]).withColumn(
        into, F.col(into) + F.col(before) - 1).drop(b, before)


def quotas(moves: dict[tuple[int, int], int], room: list[int]) -> list[int]:
    """How many may move from A to B, at place A * shards + B: exchanges along rings of shards, which leave every count
    as it is, then what room is left."""
    shards, room = len(room), list(room)
    out = [0] * (shards * shards)
    left = {a: {b: n for (x, b), n in sorted(moves.items()) if x == a} for a in range(shards)}
    ended: set[int] = set()  # shards from which no ring goes on
    for start in range(shards):
        path = [start]
        while path and start not in ended:
            onward = next((b for b, n in left[path[-1]].items() if n and b not in ended), None)
            if onward is None:
                ended.add(path.pop())
            elif onward not in path:
                path.append(onward)
            else:
                ring = [*path[path.index(onward):], onward]
                least = min(left[a][b] for a, b in zip(ring, ring[1:]))
                for a, b in zip(ring, ring[1:]):
                    left[a][b] -= least
                    out[a * shards + b] += least
                path = [start]
    for a in range(shards):
        for b, n in left[a].items():
            more = min(n, room[b])
            room[b] -= more
            out[a * shards + b] += more
    return out


def at(values: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), index.cast("int"))


def whole_shards(groups: DataFrame, capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(g1, g2, first, end, shard): the shards that groups fill alone, with the ranks of the members that do."""
    if min(capacity) < 2:
        return []
    # fewer groups than twice the shards can be as large as a shard
    large = groups.where(F.col("group_rows") >= min(capacity)).orderBy(F.desc("group_rows"), *GROUP).limit(2 * len(capacity))
    out: list[tuple[int, int, int, int, int]] = []
    for g1, g2, n in large.select(*GROUP, "group_rows").collect():
        first = 0
        while len(out) < len(capacity) and n - first >= capacity[len(out)]:
            end = first + capacity[len(out)]
            out.append((g1, g2, first, end, len(out)))
            first = end
    return out


def propagated(linked: DataFrame, capacity: list[int], rounds: int | None = None) -> DataFrame:
    """(uid, group, shard) of the linked documents, once no round moves anything or after ``rounds`` rounds. What reaches
    the driver are the shards' counts and the moves asked for between each two shards."""
    shards = len(capacity)
    total = linked.count()
    free = [s for s, c in enumerate(capacity) if c] or [0]
    now = written(ranked(linked, ["all"], total, "r").select("uid", *GROUP, at(free, F.col("r") % len(free)).cast("int").alias("shard")),
                  "labels")
    loads = {r[0]: r[1] for r in now.groupBy("shard").count().collect()}
    done, still, roomy = 0, 0, False
    while still < 2 and (rounds is None or done < rounds):
        done += 1
        votes = written(now.groupBy(*GROUP, "shard").agg(F.count(F.lit(1)).alias("n")), "votes")
        room = [c - loads.get(s, 0) for s, c in enumerate(capacity)]
        looked = votes.where(F.col("shard").isin([s for s, r in enumerate(room) if r > 0])) if roomy else votes
        target = looked.groupBy(*GROUP).agg(F.max_by("shard", F.struct("n", F.xxhash64(*GROUP, "shard"))).alias("to"),
                                            F.max("n").alias("most"))
        asks = votes.join(target, GROUP).where("shard <> to and n <= most").select(*GROUP, "shard", "to", "n")
        asks = written(asks, "asks")
        moves = {(r[0], r[1]): r[2] for r in asks.groupBy("shard", "to").agg(F.sum("n")).collect()}
        allowed = quotas(moves, room)
        if not sum(allowed):
            still, roomy = still + 1, not roomy
            continue
        still = 0
        asked = written(now.join(asks.drop("n"), [*GROUP, "shard"], "left"), "asked")
        go = ranked(asked.where("to is not null").select("uid", *GROUP, "shard", "to"), ["shard", "to"], total, "r")
        go = go.select("uid", *GROUP, F.when(F.col("r") < at(allowed, F.col("shard") * shards + F.col("to")), F.col("to"))
                       .otherwise(F.col("shard")).alias("shard"))
        now = written(asked.where("to is null").select("uid", *GROUP, "shard").unionByName(go), "labels")
        for a in range(shards):
            for b in range(shards):
                loads[a] = loads.get(a, 0) - allowed[a * shards + b]
                loads[b] = loads.get(b, 0) + allowed[a * shards + b]
    return now


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
            rounds: int | None = None) -> DataFrame:
    """(doc, size, text_crc32, group_rows, shard, slot) for every row of ``docs``; slots are gapless within a shard."""
    text = F.col(text_col)
    base = written(docs.select(
        F.col(id_col).alias("doc"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit("second"), text, text).alias("g2"), F.monotonically_increasing_id().alias("uid"), F.lit(0).alias("all")),
        "base")
    rows = base.count()
    capacity = [rows // shards + (s < rows % shards) for s in range(shards)]

    groups = written(base.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1"), "groups")
    linked = written(base.join(groups, GROUP, "left_semi").select("uid", *GROUP, "all"), "linked")
    taken = whole_shards(groups, capacity)
    alone = linked.select("uid", F.lit(None).cast("int").alias("shard")).limit(0)
    if taken:  # at most as many as there are shards
        seats = docs.sparkSession.createDataFrame(taken, "g1 long, g2 long, first long, end long, shard int")
        large = ranked(linked.join(F.broadcast(seats.select(*GROUP).distinct()), GROUP, "left_semi"), GROUP, rows, "r")
        placed = written(large.join(F.broadcast(seats), GROUP).where("r >= first and r < end").select("uid", "shard"), "alone")
        alone, linked = placed, written(linked.join(placed, "uid", "left_anti"), "linked")
    left = [0 if s < len(taken) else c for s, c in enumerate(capacity)]
    linked = written(propagated(linked, left, rounds).select("uid", "shard").unionByName(alone), "together")
    loads = {r[0]: r[1] for r in linked.groupBy("shard").count().collect()}
    single = ranked(base.join(groups, GROUP, "left_anti").select("uid", "all"), ["all"], rows, "r")
    shard, end = F.lit(0), 0
    for s in range(shards - 1):
        end += capacity[s] - loads.get(s, 0)
        shard = shard + F.when(F.col("r") >= end, 1).otherwise(0)
    placed = written(linked.select("uid", "shard").unionByName(single.select("uid", shard.cast("int").alias("shard"))), "placed")

    whole = base.join(groups, GROUP, "left").join(placed, "uid")
    return ranked(whole, ["shard"], rows, "slot").select(
        "doc", "size", "text_crc32", F.coalesce("group_rows", F.lit(1)).alias("group_rows"), "shard",
        F.col("slot").cast("long").alias("slot"))
