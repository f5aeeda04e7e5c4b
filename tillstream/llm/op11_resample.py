"""Importance resampling towards a target distribution.

Features are runs of words, hashed into a fixed number of buckets. A bucket's gain is the logarithm of its smoothed share in
the target over its smoothed share in the corpus; a document's weight is the floored mean of its features' gains, and its
score adds a Gumbel variable that only its id decides, so the highest scores are a draw without replacement.

Weights are scored from arrays: a task reads many texts as one byte array, finds their words, hashes them all at once and
looks their gains up in one array of ``buckets`` entries, the only thing that is gathered from the corpus and sent back.

The cutoff is selected, not sorted for: every task returns the median of each chunk of its remaining keys. Their median,
weighted by the chunks' sizes, has at least a quarter of the remaining keys on either side, so each round discards a
quarter or more, until the cutoff key itself is the pivot. The driver sees two medians a chunk. Once an eighth is left it is
written anew, so all rounds together read a small multiple of the keys. Only the winners are sorted, by ranges.

Defined results: a null, empty or wordless text has no feature and weight 0; ids must be integers, a null id comes after
all others and draws by the empty id; rows of one id and score are ordered by a hash of their texts, and equal rows get
ranks of their own in any order. Only the columns asked for are read, whatever the others are called. A text is read whole
and alone if it is longer than a slice; memory follows the longest text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.scratch import discard, written

BUCKETS = 10_000
LONGEST = 1
SHARE = 10  # percent
LEAST_WORDS = 20
SEED = 2024
SLICE = 1 << 22  # bytes of text taken at a time
LONG_WORD = 64  # bytes; longer features are hashed one by one
CHUNK = 1 << 20  # keys of which one median is taken
REWRITE = 8
MAX_LONG = (1 << 63) - 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


CRC = _crc_table()


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every span, a byte of all of them at a time."""
    size = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(LONG_WORD):
        at = at[size[at] > k]
        if not len(at):
            break
        now = out[at]
        out[at] = CRC[(now ^ data[starts[at] + k]) & 255] ^ (now >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i]:ends[i]])
    return out


def spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; no word goes on beyond a cut."""
    inside = IS_WORD[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = ~inside[:-1]
    new[cuts] = True
    last = np.ones(len(data) + 1, bool)
    last[1:-1] = ~inside[1:]
    last[cuts] = True
    return np.flatnonzero(inside & new[:-1]), np.flatnonzero(inside & last[1:]) + 1


def features(data: np.ndarray, cuts: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature). Text i is data[cuts[i]:cuts[i + 1]]."""
    data = LOWER[data]
    starts, ends = spans(data, cuts)
    n_words = np.diff(np.searchsorted(starts, cuts))
    text = np.repeat(np.arange(len(n_words)), n_words)
    if longest > 1:  # words joined by one space, so that every run of words is one span
        size = ends - starts
        shift = np.repeat(np.arange(len(size)), size)
        joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
        joined[np.arange(len(shift)) + shift] = data[IS_WORD[data]]
        data, starts = joined, np.cumsum(size + 1) - size - 1
        ends = starts + size
    owners, hashes = [], []
    for n in range(1, longest + 1):
        m = len(starts) - n + 1
        if m <= 0:
            break
        one = text[:m] == text[n - 1:]
        owners.append(text[:m][one])
        hashes.append(crc32s(data, starts[:m][one], ends[n - 1:][one]))
    if not owners:
        return n_words, np.empty(0, np.int64), np.empty(0, np.int64)
    return n_words, np.concatenate(owners), np.concatenate(hashes).astype(np.int64) % buckets


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, cuts) of consecutive rows, SLICE bytes or a row at a time. A null has no bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE, "right")) - 1)
        yield a, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def bucket_counts(texts: DataFrame, text: Column, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket is hit by all features of all rows. A task returns at most ``buckets`` rows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, cuts in slices(batch.column(0)):
                total += np.bincount(features(data, cuts, buckets, longest)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select(text.alias("text")).mapInArrow(of, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket."""
    m = len(corpus)
    whole, aim = float(int(corpus.sum()) + m), float(int(target.sum()) + m)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * whole / ((float(s) + 1) * aim)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, id_col: str, text: Column, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(id, tie, n_words, n_features, weight) of every row."""
    buckets = len(gain)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, cuts in slices(batch.column(2)):
                n_words, owner, bucket = features(data, cuts, buckets, longest)
                n = np.bincount(owner, minlength=len(n_words))
                order = np.argsort(owner, kind="stable") if longest > 1 else slice(None)
                sums = np.concatenate(([0], np.cumsum(gain[bucket][order])))
                end = np.cumsum(n)
                total = sums[end] - sums[end - n]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), batch.column(1).slice(first, len(n)),
                     pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(total // np.maximum(n, 1))],
                    names=["id", "tie", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} is {kind}; ids must be integers")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")).mapInArrow(
        of, f"id {kind}, tie long, n_words long, n_features long, weight long")


def noise(id_col: str = "id", seed: int = SEED) -> Column:
    """floor(1000 x a Gumbel variable), decided by seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def keys_of() -> list[Column]:
    return [(-F.col("score")).alias("a"), F.coalesce(F.col("id").cast("long"), F.lit(MAX_LONG)).alias("b"), F.col("tie").alias("c")]


class Key(NamedTuple):
    """A place in the order of the draw, least first."""
    a: int
    b: int
    c: int


SIDE = "n_{0} long, {0}_a long, {0}_b long, {0}_c long"


def sides(keys: list[np.ndarray], pivot: Key) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are less, and which are greater, than the pivot."""
    less, same = np.zeros(len(keys[0]), bool), np.ones(len(keys[0]), bool)
    for values, p in zip(keys, pivot):
        less |= same & (values < p)
        same &= values == p
    return less, ~less & ~same


def medians(keys: DataFrame, low: Key | None, high: Key | None, pivot: Key | None) -> list:
    """For every chunk of the keys between low and high: size and median of those below and above the pivot, and how many
    are the pivot. Without a pivot all are below."""

    def median(keys: list[np.ndarray]) -> tuple:
        n = len(keys[0])
        if not n:
            return 0, None, None, None
        at = np.lexsort(keys[::-1])[(n - 1) // 2]
        return n, *(int(k[at]) for k in keys)

    def told(chunk: list[np.ndarray]) -> pa.RecordBatch:
        for bound, side in ((low, 1), (high, 0)):
            if bound is not None:
                inside = sides(chunk, bound)[side]
                chunk = [k[inside] for k in chunk]
        n = len(chunk[0])
        less, more = (np.ones(n, bool), np.zeros(n, bool)) if pivot is None else sides(chunk, pivot)
        row = *median([k[less] for k in chunk]), *median([k[more] for k in chunk]), int(n - less.sum() - more.sum())
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names=names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += len(batch)
            if n >= CHUNK:
                yield told([np.concatenate(c) for c in zip(*held)])
                held, n = [], 0
        if n:
            yield told([np.concatenate(c) for c in zip(*held)])

    layout = f"{SIDE.format('less')}, {SIDE.format('more')}, n_same long"
    names = [f.split()[0] for f in layout.split(", ")]
    for bound, wanted in ((low, F.col("a") >= F.lit(low.a)) if low else (None, None),
                          (high, F.col("a") <= F.lit(high.a)) if high else (None, None)):
        if bound is not None:
            keys = keys.where(wanted)  # reaches the scan; the exact bounds are applied in the task
    return keys.mapInArrow(of, layout).collect()  # a row a chunk


def weighted_median(found: list[tuple[Key, int]]) -> Key:
    found = sorted(found)
    half, passed = sum(n for _, n in found), 0
    for key, n in found:
        passed += 2 * n
        if passed >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int) -> Key:
    """The k-th least key (a, b, c) of a written table; k is at least 1 and at most its rows."""
    low = high = None
    table, need = keys, k
    side = lambda rows, s: [(Key(*r[s + 1:s + 4]), r[s]) for r in rows if r[s]]
    left = side(medians(keys, None, None, None), 0)
    of_table = sum(n for _, n in left)
    while True:
        pivot = weighted_median(left)
        rows = medians(table, low, high, pivot)
        less, more, same = side(rows, 0), side(rows, 4), sum(r[8] for r in rows)
        below = sum(n for _, n in less)
        if below < need <= below + same:
            if table is not keys:
                discard(table)
            return pivot
        if need <= below:
            high, left = pivot, less
        else:
            low, left, need = pivot, more, need - below - same
        if REWRITE * sum(n for _, n in left) < of_table and of_table > CHUNK:
            inside = F.lit(True)
            for bound, sign in ((low, 1), (high, -1)):
                if bound is not None:
                    here, there = F.struct("a", "b", "c"), F.struct(*[F.lit(v).cast("long") for v in bound])
                    inside = inside & (here > there if sign > 0 else here < there)
            rest = written(table.where(inside), "keys")
            if table is not keys:
                discard(table)
            table, low, high, of_table = rest, None, None, sum(n for _, n in left)


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` 1, 2, 3... in the order of their keys: sorted by ranges, ranges put one after another."""
    spot = F.monotonically_increasing_id()
    ordered = winners.repartitionByRange(*keys_of()).sortWithinPartitions(*keys_of())
    ordered = written(ordered.withColumn("spot", spot), "winners")
    part, place = F.shiftright("spot", 33), F.col("spot").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    known = ordered.sparkSession.createDataFrame(offsets, "part long, before long")
    ordered = ordered.withColumn("part", part).join(F.broadcast(known), "part")
    return ordered.withColumn("rank", F.col("before") + place + 1).drop("part", "before", "spot")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
              share: int = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
              seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null for what is not drawn."""
    text = F.col(text_col)
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, F.col(target_col), buckets, longest))
    scored = weighted(docs, id_col, text, gain, longest).withColumn("score", F.col("weight") + noise("id", seed))
    scored = written(scored, "scored")
    enough = F.col("n_words") >= least_words
    k = scored.where(enough).count() * share // 100
    columns = ["id", "n_words", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*columns, unranked)
    keys = written(scored.where(enough).select(*keys_of()), "keys")
    last = cutoff(keys, k)
    discard(keys)
    drawn = enough & (F.struct(*keys_of()) <= F.struct(*[F.lit(v).cast("long") for v in last]))
    winners = ranked(scored.where(drawn))
    winners = winners.select(*columns, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))  # of equal rows some may be too many
    return winners.unionByName(scored.where(~drawn).select(*columns, unranked))


def sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, as they are. Ids must be unique: of rows with a drawn id all are returned."""
    found = resampled(docs, target, id_col, text_col, **options).where("rank is not null").select(F.col("id").alias("__id"))
    return docs.join(found.distinct(), docs[id_col].eqNullSafe(F.col("__id")), "left_semi")
