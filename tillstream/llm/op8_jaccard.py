"""Exact n-gram Jaccard join with set-relation skipping.

The result is the connected components of "Jaccard similarity of at least ``percent``"; equal sets count as one set.

Index lists, skipped by block: two similar sets of sizes a <= b differ in at most (a + b)(100 - p)/(100 + p) shingles. A
set's shingles are dealt by hash to block positions, so many that nearly always more of them have shingles than may differ;
then two similar sets agree on a whole block that is not empty. (Sets of which that is not so index empty blocks too.) The index
is on whole blocks - (size window, block position, hash of the block's shingles) - and everything that agrees on no block, which
is most that merely shares common shingles, is skipped unseen. Entries go through one shuffle, 16 bytes each, packed by bucket,
and are written nowhere; those of one set alone end there. Lists of the same sets are one list.

Long lists are made by passages that many texts have. Two similar sets agree on more than one block: a set of which fewer blocks
are in long lists (over COMMON sets) leaves these, as it meets every similar set in a shorter one.

Lists are then refined: a set's profile counts its shingles by hash in about half to a quarter as many buckets as it has
shingles. Two sets differ in at least as many shingles as their profiles do in counts, so pairs whose profiles differ too
much cannot be similar, and unrelated texts that share a passage, and by it a block, part here. What is left of a list is
linked up (a tree, not all pairs). Lists that more than BIG sets cannot leave, which nearly always are copies, are linked up
unrefined.

Answers derived from a similar set: sets linked by lists form a family. Each member is compared once with the
family's pivot, and kept as its difference from it. The pivot's answer follows at once, and the overlap of any two members
follows from their differences: |x ^ y| = |dx| + |dy| - 2 |dx & dy|. Members that are similar to the pivot are linked
through it, so they need no comparison among each other. The others are compared in blocks of members ordered by distance
from the pivot, and blocks are skipped whose distances differ by more than similar sets may (triangle inequality).
A task gets two blocks and returns at most one link a member, so no group's pairs are ever written out.

Defined results: a null, empty or wordless text has no shingles, is linked with nothing and is its own component; fewer
than ``size`` words make one shingle; repeated rows get the same result; a null id takes part and is the smallest. Only the
columns asked for are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm import words
from tillstream.llm.components import components
from tillstream.llm.scratch import discard, written

SIZE = 3
PERCENT = 90
SPARE = 2
DEVIATIONS = 4  # by which a set's empty blocks may be more than expected
GROWTH = 1.4  # of the size windows
BLOCK = 512  # members (or that many times BLOCK_DIFFERENCES differing shingles) that are compared at a time
BLOCK_DIFFERENCES = 512
BATCH = 1 << 17
BIG = 4096  # sets of a list that are compared by profile, in one task
COMMON = 512  # sets of a list that others can do without
WINDOWS = 16  # size windows that an entry tells apart; more than a set has
PACK = 1 << 20  # entries that a task packs at a time
BUCKET = 1 << 19  # shingles in all, for each bucket of the index
U64 = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles' hashes, in order."""
    data = LOWER[np.frombuffer(text, np.uint8)]
    hashed = words.hashes(data, *words.spans(data))
    return np.unique(words.ngrams(hashed, min(size, len(hashed)))) if len(hashed) else hashed


def windows(largest: int, percent: int) -> list[int]:
    """First sizes of the size windows: up from the smallest set that can be similar to another than itself."""
    out = [-(-percent // (100 - percent))]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
    return out


def differing(smaller: int, percent: int) -> int:
    """The most shingles in which a set of this size and a larger similar one can differ."""
    return smaller * (100 - percent) // percent


@functools.cache
def positions(low: int, high: int, percent: int) -> int:
    """Block positions of the size window: so many that in nearly every set more of them have shingles than may differ."""
    out = differing(high - 1, percent) + 1 + SPARE
    for n in (low, high - 1):
        while True:
            empty = math.exp(-n / out)
            spread = math.sqrt(out * empty * (1 - (1 + n / out) * empty))
            if out * (1 - empty) - DEVIATIONS * spread > differing(n, percent):
                break
            out += max(1, out >> 10)
    return out


def dealt(grams: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(window, its first size, block of each shingle, blocks to index, slack): of the window of the set's size, where it is
    a smaller partner, and of the window below where it can be a larger one. A similar set of the same window agrees on
    ``slack`` of the set's blocks or more, and indexes them too."""
    n = len(grams)
    firsts = windows(n, percent)
    for i, (low, high) in enumerate(zip(firsts, firsts[1:])):
        if not low <= n <= (high - 1) * 100 // percent:
            continue
        blocks = positions(low, high, percent)
        block = (words.mix(grams ^ U64(0x5851F42D4C957F2D)) % U64(blocks)).astype(np.int64)
        filled = np.bincount(block, minlength=blocks) > 0
        slack = max(0, int(filled.sum()) - differing(min(n, high - 1), percent))
        if not slack:  # similar sets might agree on empty blocks alone
            filled[:] = True
        yield i % WINDOWS, low, block, filled, slack


def signatures(grams: np.ndarray, percent: int) -> np.ndarray:
    """The set's entries in the index, each with its window in the lowest bits."""
    out = []
    for window, low, block, filled, _ in dealt(grams, percent):
        sums = np.zeros(len(filled), U64)
        np.add.at(sums, block, words.mix(grams ^ U64(0x14057B7EF767814F)))
        salt = words.mix(np.arange(len(filled), dtype=U64) + U64(low) * U64(1 << 32))
        out.append(words.mix(sums + salt)[filled] // U64(WINDOWS) * U64(WINDOWS) + U64(window))
    return np.concatenate(out) if out else np.empty(0, U64)


def slacks(grams: np.ndarray, percent: int) -> list[int]:
    """The slack of each of the set's windows, times WINDOWS, with the window in the lowest bits."""
    return [slack * WINDOWS + window for window, _, _, _, slack in dealt(grams, percent)]


def profile(grams: np.ndarray) -> bytes:
    """Counts of the shingles by hash, at most 255, in a power of two of buckets that follows their number."""
    if not len(grams):
        return b""
    buckets = 1 << max(3, len(grams).bit_length() - 2)
    at = (words.mix(grams ^ U64(0x2545F4914F6CDD1D)) & U64(buckets - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=buckets), 255).astype(np.uint8).tobytes()


def folded(profiles: list[np.ndarray]) -> np.ndarray:
    """Profiles as rows of one length, that of the shortest; counts of buckets that fall together are added."""
    width = min(map(len, profiles))
    return np.stack([x if len(x) == width else np.minimum(x.reshape(-1, width).sum(0, np.int64), 255) for x in profiles]).astype(np.int16)


def tree(n: np.ndarray, profiles: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links, as few as connect what all pairs connect whose profiles do not rule similarity out."""
    rows, root, out = folded(profiles), np.arange(len(n)), []
    for i in range(len(n) - 1):
        other = i + 1 + np.flatnonzero(root[i + 1:] != root[i])
        if not len(other):
            continue
        least = np.abs(rows[other] - rows[i]).sum(1, np.int64)
        for j in other[similar(n[i], n[other], least, percent)].tolist():
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((i, j))
    return out


def refined(lists: DataFrame, percent: int) -> DataFrame:
    """(u, v): links within each list; ``lists`` is (list, k1, n, profile), a list in one partition and together."""

    def links(part: pa.Table) -> tuple[list[int], list[int]]:
        ids, keys, n = (part.column(c).to_numpy() for c in ("list", "k1", "n"))
        held = [np.frombuffer(x.as_buffer(), np.uint8) for c in part.column("profile").chunks for x in c]
        edges = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
        u, v = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for i, j in tree(n[a:b], held[a:b], percent) if b - a > 1 else ():
                u.append(int(keys[a + i]))
                v.append(int(keys[a + j]))
        return u, v

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            ids = table.column("list").to_numpy()
            cut = int(np.flatnonzero(ids != ids[-1:]).max(initial=-1)) + 1
            rest = table.slice(cut).combine_chunks()  # the last list may go on in the next batch
            if cut:
                u, v = links(table.slice(0, cut))
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        if rest is not None and len(rest):
            u, v = links(rest)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return lists.select("list", "k1", "n", "profile").mapInArrow(of, "u long, v long")


def key(grams: np.ndarray) -> U64:
    return words.mix(grams).sum(dtype=U64)


def packed(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, entries, keys): the index, dealt to buckets by entry. A row holds a batch's entries of one bucket and the k1 of
    the set of each, as bytes; nothing else is said of a set, and equal sets of a batch count once."""

    def rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        entries = np.concatenate(list(held.values()))
        keys = np.repeat(np.array(list(held), U64), [len(e) for e in held.values()])
        bucket = (words.mix(entries) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        numbers, begins = np.unique(bucket[order], return_index=True)
        ends = pa.array(np.append(begins, len(order)) * 8, pa.int32())
        data = [pa.Array.from_buffers(pa.binary(), len(numbers), [None, ends.buffers()[1], pa.py_buffer(x[order].tobytes())])
                for x in (entries, keys)]
        return pa.RecordBatch.from_arrays([pa.array(numbers), *data], names=["bucket", "entries", "keys"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        count = 0
        for batch in batches:
            for t in batch.column(0):
                grams = shingles(t.as_buffer() if t.is_valid else b"", size)
                if (k := int(key(grams))) not in held and len(entries := signatures(grams, percent)):
                    held[k] = entries
                    count += len(entries)
                    if count > PACK:
                        yield rows(held)
                        held, count = {}, 0
        if held:
            yield rows(held)

    return docs.select("text").mapInArrow(of, "bucket long, entries binary, keys binary")


def shared(part: pa.Table) -> pa.Table:
    """(list, k1, m, window) for the entries of a bucket that more than one set has: the list's name, made from its sets, and
    their number."""
    entry, key = (np.frombuffer(b"".join(x.as_buffer() for x in part[c]), np.int64) for c in ("entries", "keys"))
    order = np.lexsort((key, entry))
    entry, key = entry[order], key[order]
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (key[1:] != key[:-1])
    entry, key = entry[new], key[new]
    begin = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
    m = np.diff(np.append(begin, len(entry)))
    sets = words.mix(key.view(U64))
    name = words.mix(np.add.reduceat(sets, begin) + words.mix(np.bitwise_xor.reduceat(sets, begin)) + m.astype(U64))
    many = np.repeat(m > 1, m)
    of = np.repeat(np.arange(len(m)), m)[many]
    return pa.table({"list": name.view(np.int64)[of], "k1": key[many], "m": m[of], "window": entry[many] % WINDOWS})


def candidates(docs: DataFrame, every: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links between sets by k1. Similar sets are linked, directly or not; others may be.

    Of lists of more than COMMON sets, which a passage that many texts have makes, a set leaves those of a window if it has
    fewer entries in such lists there than similar sets agree on: every similar set then meets it in a shorter list."""
    total = every.agg(F.sum("n")).first()[0] or 0
    index = packed(docs, size, percent, 1 + total // BUCKET)
    known = index.groupBy("bucket").applyInArrow(shared, "list long, k1 long, m long, window long")
    known = written(known.groupBy("list", "k1", "window").agg(F.max("m").alias("m"), F.count(F.lit(1)).alias("entries")), "lists")
    profiles = written(every.where("n > 0").groupBy("k1").agg(F.max("n").alias("n"), F.max("profile").alias("profile"),
                                                              F.max("slacks").alias("slacks")), "profiles")
    common = known.where(F.col("m") > COMMON)
    slack = profiles.select("k1", F.explode("slacks").alias("slack")).select(
        "k1", F.pmod("slack", F.lit(WINDOWS)).alias("window"), F.floor(F.col("slack") / WINDOWS).alias("slack"))
    stay = (common.groupBy("k1", "window").agg(F.sum("entries").alias("entries")).join(slack, ["k1", "window"])
            .where(F.col("entries") >= F.col("slack")).select("k1", "window"))
    stayed = written(common.join(stay, ["k1", "window"]).select("list", "k1").distinct(), "stayed")
    of = stayed.groupBy("list").agg(F.min("k1").alias("lo"), F.count(F.lit(1)).alias("m")).where("m > 1")
    left = written(stayed.join(of, "list"), "left")
    short = known.where(F.col("m") <= COMMON).select("list", "k1").distinct().unionByName(
        left.where(F.col("m") <= BIG).select("list", "k1"))
    small = short.join(profiles.select("k1", "n", "profile"), "k1")
    found = refined(small.repartition("list").sortWithinPartitions("list"), percent)
    stars = left.where(F.col("m") > BIG).select(F.col("k1").alias("u"), F.col("lo").alias("v"))
    links = written(found.unionByName(stars).distinct(), "links")
    discard(known, profiles, stayed, left)
    return links


def sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc, version, n, k1, k2, profile, slacks): size, 128-bit identity, profile and slacks of every document's set."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, profiles, slack = [], [], [], []
            for t in batch.column(2):
                grams = shingles(t.as_buffer() if t.is_valid else b"", size)
                keys.append((key(grams), key(grams ^ U64(0x9E3779B97F4A7C15))))
                sizes.append(len(grams))
                profiles.append(profile(grams))
                slack.append(slacks(grams, percent))
            k = np.array(keys, U64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(k[:, 0].view(np.int64)),
                 pa.array(k[:, 1].view(np.int64)), pa.array(profiles, pa.binary()), pa.array(slack, pa.list_(pa.int64()))],
                names=["doc", "version", "n", "k1", "k2", "profile", "slacks"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.select("doc", "version", "text").mapInArrow(
        of, f"doc {kind}, version long, n long, k1 long, k2 long, profile binary, slacks array<long>")


def numbered(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(doc, version, text): ``version`` tells apart texts that share an id."""
    return docs.select(F.col(id_col).alias("doc"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("version"),
                       text.alias("text"))


def differences(members: DataFrame, size: int) -> DataFrame:
    """``members`` (family, rep, text, pivot_text) with ``pivot_n``, ``n``, and ``diff``, the shingles in one of both."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, pivot = None, np.empty(0, U64)
            begin, held, rows, diffs = 0, 0, [], []
            for i, (t, p) in enumerate(zip(batch.column(2), batch.column(3))):
                text = p.as_buffer().to_pybytes()
                if text != last:
                    last, pivot = text, shingles(text, size)
                own = shingles(t.as_buffer(), size)
                diffs.append(np.setxor1d(own, pivot, assume_unique=True))
                rows.append((len(own), len(pivot)))
                held += len(diffs[-1])
                if held > BATCH or i == len(batch) - 1:
                    n, m = zip(*rows)
                    ends = np.cumsum([0] + [len(d) for d in diffs]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begin, len(n)), batch.column(1).slice(begin, len(n)), pa.array(n, pa.int64()),
                         pa.array(m, pa.int64()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(diffs).view(np.int64)))],
                        names=["family", "rep", "n", "pivot_n", "diff"])
                    begin, held, rows, diffs = i + 1, 0, [], []

    rep = members.schema["rep"].dataType.simpleString()
    return members.select("family", "rep", "text", "pivot_text").mapInArrow(
        of, f"family long, rep {rep}, n long, pivot_n long, diff array<long>")


def similar(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that differ in so many shingles are similar: 100 (s - d) >= percent (s + d)."""
    return (100 - percent) * (n + m) >= (100 + percent) * differ


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Number of values that each of ``a`` and each of ``b`` have in common."""
    left, right = np.concatenate(a), np.concatenate(b)
    shared, of = np.unique(np.intersect1d(left, right)), np.zeros((len(a), len(b)), np.float32)
    owner_a, owner_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    keep_a, keep_b = np.isin(left, shared), np.isin(right, shared)
    at_a, at_b = np.searchsorted(shared, left[keep_a]), np.searchsorted(shared, right[keep_b])
    owner_a, owner_b = owner_a[keep_a], owner_b[keep_b]
    for low in range(0, len(shared), 4096):
        x, y = np.zeros((len(a), 4096), np.float32), np.zeros((len(b), 4096), np.float32)
        for matrix, owner, at in ((x, owner_a, at_a), (y, owner_b, at_b)):
            inside = (at >= low) & (at < low + 4096)
            matrix[owner[inside], at[inside] - low] = 1
        of += x @ y.T
    return of.astype(np.int64)


def forest(links: np.ndarray) -> tuple[list[int], list[int]]:
    """Rows and columns of as many of the links as are needed to connect what all of them connect."""
    rows, _ = links.shape
    group = list(range(sum(links.shape)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    out: tuple[list[int], list[int]] = ([], [])
    for i, j in zip(*(x.tolist() for x in np.nonzero(links))):
        a, b = root(i), root(rows + j)
        if a != b:
            group[a] = b
            out[0].append(i)
            out[1].append(j)
    return out


def block_links(percent: int):
    """Links of a task's probing members with its listed ones, as a forest."""

    def of(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_probe = table["probe"].to_numpy()
        sides = [table.filter(pa.array(m)).combine_chunks() for m in (is_probe, ~is_probe)]
        picked: tuple[list[int], list[int]] = ([], [])
        if all(len(side) for side in sides):
            sizes = [side["n"].to_numpy() for side in sides]
            diffs = [[d.values.to_numpy() for d in side["diff"]] for side in sides]
            far = [np.array([len(d) for d in ds], np.int64) for ds in diffs]
            differ = far[0][:, None] + far[1] - 2 * common(*diffs)
            picked = forest(similar(sizes[0][:, None], sizes[1], differ, percent))
        u, v = (side["rep"].take(pa.array(p, pa.int64())) for side, p in zip(sides, picked))
        return pa.table({"u": u, "v": v})

    return of


def family_links(diffs: DataFrame, percent: int) -> DataFrame:
    """(u, v): links that give the families' components. ``diffs`` is (family, rep, pivot, n, pivot_n, diff)."""
    to_pivot = (100 - percent) * (F.col("n") + F.col("pivot_n")) >= (100 + percent) * F.size("diff")
    known = diffs.withColumns({"linked": to_pivot, "far": F.size("diff").cast("long"),
                               "weight": F.lit(1) + F.floor(F.size("diff") / BLOCK_DIFFERENCES)})
    star = known.where("linked").select(F.col("rep").alias("u"), F.col("pivot").alias("v"))

    # members in order of distance, cut into blocks; members that are as far share their blocks by hash
    ladder = known.groupBy("family", "far").agg(F.sum("weight").alias("w"), F.max("n").alias("n"),
                                                F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("open"))
    upto = Window.partitionBy("family").orderBy("far")
    whole = Window.partitionBy("family")
    ladder = (ladder.withColumns({"end": F.sum("w").over(upto), "open": F.sum("open").over(whole),
                                  "most": F.floor(F.max("n").over(whole) * (2 * (100 - percent)) / (100 + percent))})
              .where("open > 0")
              .select("family", "far", F.floor((F.col("end") - F.col("w")) / BLOCK).alias("b0"),
                      F.floor((F.col("end") - 1) / BLOCK).alias("b1"),
                      F.floor(F.col("far") * 1000 / F.greatest("most", F.lit(1))).alias("scaled")))
    # the blocks a probe has to meet: those with members at most ``most`` nearer to the pivot or farther
    near = Window.partitionBy("family").orderBy("scaled").rangeBetween(-1001, 1001)
    ladder = ladder.withColumns({"lo": F.min("b0").over(near), "hi": F.max("b1").over(near)})
    placed = (known.join(written(ladder.drop("scaled"), "ladder"), ["family", "far"])
              .withColumn("block", F.col("b0") + F.pmod(F.xxhash64("rep"), F.col("b1") - F.col("b0") + 1)))
    placed = written(placed.select("family", "rep", "n", "diff", "linked", "block", "lo", "hi"), "placed")
    probe_blocks = written(placed.where(~F.col("linked")).groupBy("family", "block")
                           .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "probes")
    tasks = written(probe_blocks.select("family", F.col("block").alias("p"), F.explode(F.sequence("lo", "hi")).alias("block")),
                    "tasks")
    probing = (placed.where(~F.col("linked")).withColumnRenamed("block", "p").join(tasks, ["family", "p"])
               .select("family", "p", "block", "rep", "n", "diff", F.lit(True).alias("probe")))
    listing = (placed.join(tasks, ["family", "block"])
               .select("family", "p", "block", "rep", "n", "diff", F.lit(False).alias("probe")))
    rep = diffs.schema["rep"].dataType.simpleString()
    found = probing.unionByName(listing).groupBy("family", "p", "block").applyInArrow(block_links(percent), f"u {rep}, v {rep}")
    return star.unionByName(found)


def rooted(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc, version, n, root) for every row of ``docs``, which is (doc, version, text) as ``numbered`` makes it. ``root`` is the
    least (doc, version) that is linked, directly or not; a set without shingles has none."""
    every = written(sets(docs, size, percent), "sets")
    rep = F.struct("doc", "version")
    classes = written(every.where("n > 0").groupBy("k1", "k2").agg(F.min(rep).alias("rep"), F.count(F.lit(1)).alias("copies")),
                      "classes")

    links = candidates(docs, every, size, percent)
    near = components(links)
    families = near.select(F.col("u").alias("k1"), F.col("v").alias("family")).unionByName(
        near.select(F.col("v").alias("k1"), F.col("v").alias("family")).distinct())

    members = written(classes.join(families, "k1"), "members")
    discard(links, near)
    pivots = members.groupBy("family").agg(F.min_by("rep", F.struct(-F.col("copies"), F.col("rep"))).alias("pivot"))
    pivots = written(pivots, "pivots")
    chosen = members.join(pivots, "family").select("family", "rep", "pivot")
    texts = written(docs.join(chosen, docs["doc"].eqNullSafe(chosen["rep.doc"]) & (docs["version"] == chosen["rep.version"]))
                    .groupBy("family", "rep", "pivot").agg(F.min("text").alias("text")), "texts")
    pivot_texts = written(texts.where("rep = pivot").select("family", F.col("text").alias("pivot_text")), "pivot_texts")
    diffs = differences(texts.join(pivot_texts, "family"), size)
    diffs = written(diffs.join(members.join(pivots, "family").select("rep", "pivot"), "rep"), "diffs")
    discard(texts, pivot_texts, members, pivots)
    same = components(family_links(diffs, percent))
    roots = same.select(F.col("u").alias("rep"), F.col("v").alias("root"))

    found = classes.join(roots, "rep", "left").select("k1", "k2", F.coalesce("root", "rep").alias("root"))
    found = written(found, "roots")
    discard(classes, diffs, same)
    return every.join(found, ["k1", "k2"], "left").select("doc", "version", "n", "root")


def joined(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc, n_shingles, component_id) for every row of ``docs``, which is (doc, version, text) as ``numbered`` makes it."""
    return rooted(docs, size, percent).select(
        "doc", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root.doc")).otherwise(F.col("doc")).alias("component_id"))


def one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
             percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked texts: that of the least id, and under one id of the least crc32 of its text. Decided
    for each text, so another text under the same id stays. Of rows of equal id and text one stays, chosen by a hash of its
    columns; all rows without shingles stay. A null id is the smallest."""
    own = numbered(docs, id_col, F.col(text_col))
    found = rooted(own, size, percent).select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), "n", "root").distinct()
    least = F.col("root.doc").eqNullSafe(F.col("__doc")) & (F.col("root.version") == F.col("__version"))
    found = found.where((F.col("n") == 0) | least).select("__doc", "__version", (F.col("n") == 0).alias("__empty"))
    marked = docs.withColumn("__of", F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)))
    kept = marked.join(found, marked[id_col].eqNullSafe(F.col("__doc")) & (F.col("__of") == F.col("__version")))
    order = [F.xxhash64(*[c for c, t in docs.dtypes if not t.startswith("map")])]
    first = F.row_number().over(Window.partitionBy(id_col, "__of").orderBy(*order))
    single = kept.where("not __empty").withColumn("__first", first).where("__first = 1")
    return single.select(*docs.columns).unionByName(kept.where("__empty").select(*docs.columns))
