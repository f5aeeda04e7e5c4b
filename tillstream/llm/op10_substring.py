"""Substring dedup: seed and extend.

A window is ``length`` consecutive words of one document. A word is removed if it lies in a window whose words also start
earlier (in a smaller document id, or earlier in the same document).

Seeds: of the ``anchor``-word grams inside a window, the one of least hash is the window's anchor (winnowing; of equal
ones the last). Equal windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so a
document has about one anchor for eight words. Join: anchors that occur once in the corpus cannot belong to a repeat and
go; counts are combined before the shuffle. Extend: an anchor and the windows it stands for, a *run*, reaches to both
sides of the anchor. Runs that agree as a whole form a class with one first occurrence, and all others are repeats.
Only where runs with one anchor differ (at the ends of a repeat) each class's first run is cut into single windows, which
are compared. Neither step pairs the members of a group: both compare with the first occurrence.

Defined results: a null text has no words; documents with fewer than ``length`` words stay whole; rows with equal id and
text are one document and get the same result; rows with one id but other texts are other documents, in the order of the
texts' crc32; a null id comes first. Only the columns asked for are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm import words
from tillstream.llm.scratch import written

LENGTH = 20
ANCHOR = 6
BATCH = 1 << 17  # rows in an Arrow batch
U64 = np.uint64


def arrow_batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def anchors(hashed: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the anchor, first window, windows) of every run of a document."""
    windows = len(hashed) - length + 1
    if windows <= 0:
        return (np.empty(0, np.int64),) * 3
    grams = words.ngrams(hashed, anchor)
    view = np.lib.stride_tricks.sliding_window_view(grams, length - anchor + 1)
    back = view.shape[1] - 1
    place = np.arange(windows) + back - np.argmin(view[:, ::-1], axis=1)  # the last of equal ones
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return place[first], first, np.diff(np.concatenate((first, [windows])))


def prefix(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(hashed)
    powers, inverses = words._powers(n)
    sums = np.zeros(n + 1, U64)
    np.cumsum(hashed * powers, out=sums[1:])
    return sums, inverses, powers


def run_rows(hashed: np.ndarray, length: int, anchor: int):
    """Anchor hash, hash of the whole run, first window and number of windows of every run of a document."""
    place, first, count = anchors(hashed, length, anchor)
    if not len(place):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    sums, inverses, _ = prefix(hashed)
    of = lambda a, n: words.mix((sums[a + n] - sums[a]) * inverses[a] + n.astype(U64))
    fixed = np.full(len(place), anchor)
    key = of(place, fixed)
    whole = words.mix(of(first, count + length - 1) + (place - first).astype(U64))
    return key.view(np.int64), whole.view(np.int64), first, count


def window_rows(hashed: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(which run, hash) of every single window of the runs given."""
    which = np.repeat(np.arange(len(first)), count)
    start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    sums, inverses, _ = prefix(hashed)
    return start, words.mix((sums[start + length] - sums[start]) * inverses[start]).view(np.int64), which


def numbered(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(doc, version, text): ``version`` tells apart texts that share an id."""
    return docs.select(F.col(id_col).alias("doc"),
                       F.shiftright(F.coalesce(F.crc32(text.cast("binary")), F.lit(0)), 1).alias("version"), text.alias("text"))


def runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(doc, at, anchor, whole, windows): every run of every document. ``at`` is the version and, in the low 32 bits, the
    first window, so it orders the runs of an id."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            parts, sizes, held, begin = [], [], 0, 0
            for i, t in enumerate(batch.column(2)):
                rows = run_rows(words.word_hashes(t.as_buffer() if t.is_valid else b""), length, anchor)
                parts.append(rows)
                sizes.append(len(rows[0]))
                held += len(rows[0])
                if held > BATCH or i == len(batch) - 1:
                    at = np.repeat(np.arange(begin, i + 1), sizes)
                    key, whole, first, count = (np.concatenate(c) for c in zip(*parts))
                    yield arrow_batch({
                        "doc": ids.take(pa.array(at)), "at": pa.array((versions[at] << 32) | first),
                        "anchor": pa.array(key), "whole": pa.array(whole), "windows": pa.array(count.astype(np.int32))})
                    parts, sizes, held, begin = [], [], 0, i + 1

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.select("doc", "version", "text").mapInArrow(
        of, f"doc {kind}, at long, anchor long, whole long, windows int")


def single_windows(docs: DataFrame, length: int) -> DataFrame:
    """(doc, at, anchor, hash) of each window of the runs in ``open``; ``docs`` is (doc, version, text, open)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            for i, (t, opened) in enumerate(zip(batch.column(2), batch.column(3))):
                first, count, key = (opened.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                hashed = words.word_hashes(t.as_buffer() if t.is_valid else b"")
                for a in range(0, len(first), BATCH // 16):
                    part = slice(a, a + BATCH // 16)
                    start, value, which = window_rows(hashed, first[part].astype(np.int64), count[part].astype(np.int64),
                                                      length)
                    yield arrow_batch({
                        "doc": ids.take(pa.array(np.full(len(start), i))), "at": pa.array((versions[i] << 32) | start),
                        "anchor": pa.array(key[part][which]), "hash": pa.array(value)})

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.select("doc", "version", "text", "open").mapInArrow(of, f"doc {kind}, at long, anchor long, hash long")


def matched(docs: DataFrame, info: DataFrame, how: str = "inner") -> DataFrame:
    """Documents with what is known of them."""
    info = info.withColumnsRenamed({"doc": "_doc", "version": "_version"})
    return docs.join(info, docs["doc"].eqNullSafe(info["_doc"]) & (docs["version"] == info["_version"]), how).drop(
        "_doc", "_version")


def spot(first: str, *more: str) -> Column:
    """Entry of a document's list: where windows start, and what else is known."""
    return F.struct(F.col(first).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("first"), *more)


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc, version, repeat array<struct<first, windows>>): the windows that also start earlier, for documents that have any.

    ``docs`` is (doc, version, text) as ``numbered`` makes it.
    """
    version = F.shiftright("at", 32).alias("version")
    place = F.struct("doc", "at")
    found = runs(docs, length, anchor)
    # the small side of each join is a table of its own: both sides are then shuffled for the join, and Spark may split hot keys
    twice = written(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "twice")
    seeds = written(found.join(twice, "anchor", "left_semi"), "seeds")

    classes = written(seeds.groupBy("anchor", "whole").agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("n")),
                      "classes")
    later = (seeds.join(classes.where("n > 1").select("anchor", "whole", "head"), ["anchor", "whole"])
             .where(~place.eqNullSafe(F.col("head"))))
    split = (classes.groupBy("anchor").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).where("a <> b")
             .select("anchor"))
    heads = (classes.join(split, "anchor", "left_semi")
             .select(F.col("head.doc").alias("_doc"), F.col("head.at").alias("_at")).distinct())
    opened = seeds.join(heads, seeds["doc"].eqNullSafe(heads["_doc"]) & (seeds["at"] == heads["_at"]), "left_semi")

    no_later = F.lit(None).cast("struct<first:int,windows:int>").alias("later")
    no_open = F.lit(None).cast("struct<first:int,windows:int,anchor:bigint>").alias("open")
    info = written(later.select("doc", version, spot("at", "windows").alias("later"), no_open)
                   .unionByName(opened.select("doc", version, no_later, spot("at", "windows", "anchor").alias("open")))
                   .groupBy("doc", "version").agg(F.collect_list("later").alias("later"), F.collect_list("open").alias("open")),
                   "runs")

    single = written(single_windows(matched(docs, info.where(F.size("open") > 0).select("doc", "version", "open")), length),
                     "windows")
    first = written(single.groupBy("anchor", "hash").agg(F.min(place).alias("head"), F.max(place).alias("last"))
                    .where("head <> last").select("anchor", "hash", "head"), "heads")
    more = (single.join(first, ["anchor", "hash"]).where(~place.eqNullSafe(F.col("head")))
            .select("doc", version, spot("at", F.lit(1).alias("windows")).alias("repeat")))
    known = info.select("doc", "version", F.explode("later").alias("repeat"))
    return written(known.unionByName(more).groupBy("doc", "version").agg(F.collect_list("repeat").alias("repeat")), "repeats")


def kept_words(text: bytes, repeat, length: int) -> tuple[int, np.ndarray]:
    """Number of words, and which stay. ``repeat``: first windows and their counts, or None."""
    starts, _ = words.spans(np.frombuffer(text, np.uint8))
    keep = np.ones(len(starts), bool)
    if repeat is not None:
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, repeat[0], 1)
        np.add.at(steps, repeat[0] + repeat[1] + length - 1, -1)
        keep = np.cumsum(steps[:-1]) == 0
    return len(starts), keep


def _lists(column: pa.Array) -> list:
    return [tuple(c.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            if c.is_valid and len(c.values) else None for c in column]


def digests(docs: DataFrame, repeat: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, n_words, n_removed, kept_sha256) for every row of ``docs``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, r in zip(batch.column(1), _lists(batch.column(2))):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                n, keep = kept_words(text, r, length)
                parts = text.split()
                if not keep.all():
                    parts = [parts[i] for i in np.flatnonzero(keep)]
                rows.append((n, n - len(parts), hashlib.sha256(b" ".join(parts)).hexdigest()))
            n, removed, digest = zip(*rows) if rows else ((), (), ())
            yield arrow_batch({"doc": batch.column(0), "n_words": pa.array(n, pa.int64()),
                               "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})

    kind = docs.schema["doc"].dataType.simpleString()
    return matched(docs, repeat, "left").select("doc", "text", "repeat").mapInArrow(
        of, f"doc {kind}, n_words long, n_removed long, kept_sha256 string")


def cut(text: Column, repeat: Column, length: int = LENGTH) -> Column:
    """The text without its repeated words. White space before a removed word goes with it; a text without repeats is
    returned as it is, a null stays null."""
    @F.pandas_udf("string")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, repeats_ in batches:
            out = []
            for t, r in zip(texts, repeats_):
                if t is None or r is None or not len(r):
                    out.append(t)
                    continue
                raw = t.encode()
                spots = np.array([(x["first"], x["windows"]) for x in r], np.int64).T
                _, keep = kept_words(raw, spots, length)
                _, ends = words.spans(np.frombuffer(raw, np.uint8))
                begins = np.concatenate(([0], ends[:-1]))
                out.append(b"".join(raw[begins[i]:ends[i]] for i in np.flatnonzero(keep)).decode())
            yield pd.Series(out, dtype=object)

    return of(text, repeat)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 anchor: int = ANCHOR) -> DataFrame:
    """The documents with their repeated words cut out of the text; other columns as they are."""
    own = numbered(docs, id_col, F.col(text_col))
    found = repeats(own, length, anchor).withColumnsRenamed({"doc": "__doc", "version": "__version", "repeat": "__repeat"})
    version = F.shiftright(F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)), 1)
    joined = docs.withColumn("__of", version)
    joined = joined.join(found, joined[id_col].eqNullSafe(F.col("__doc")) & (F.col("__of") == F.col("__version")), "left")
    return joined.withColumn(text_col, cut(F.col(text_col), F.col("__repeat"), length)).select(*docs.columns)
