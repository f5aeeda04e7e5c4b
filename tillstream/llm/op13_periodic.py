"""Periodic run detection: Lyndon words by Baier's grouping, extended into runs.

A run is a stretch of consecutive words with smallest period q and a length of at least twice q (and ``least`` words) that
no neighbouring word extends.

Grouping (phase one of Baier's suffix sorter): positions start in a group for each word. Groups are taken from the
highest down. For each of a group's positions the nearest position before it that is in a lower group is found; such
positions are moved to a group of their own right above their old one, whose context is the old context followed by as
many copies of the taken group's. When a position's group is taken, its context is the longest Lyndon word that starts
there, so the Lyndon array falls out of this phase directly. It is done under the order of the words and under the reverse.

Every run contains one of these Lyndon words, as long as its period (Bannai et al.). So each is extended both ways, by the
longest common extension of the positions a period apart: a binary search on prefix sums of word hashes, for all positions
at once. Equal stretches have equal sums, so no extension is too short; every run is then compared word by word and, should
a hash have lied, measured by comparing.

Only words that can lie in a run are grouped: two stretches of half of ``least`` words, a period apart, are equal in every
run and cover it, so words that no repeated stretch covers end a segment. Segments are narrowed a few times; this only
saves work, and whole words, not hashes, are compared after it.

Defined results: a null, empty or wordless text has no word and no run; repeated rows and equal ids get results of their own;
of runs of greatest length the one of the least start, then period, is told. A text is one task's work and is read whole,
memory follows the longest. Only the columns asked for are read, whatever the others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm import words

LEAST = 12
NARROW = 4
U64 = np.uint64


def lyndon_array(x: list[int], letters: int) -> list[int]:
    """Length of the longest Lyndon word that starts at each place. Letters are 0 to ``letters`` - 1, all of which occur;
    the end of ``x`` is less than any of them."""
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, letter in enumerate(x):
        members[letter].append(i)
    size, below = [1] * letters, list(range(-1, letters - 1))
    above = list(range(1, letters)) + [-1]
    group, before, done = list(x), [-1] * len(x), [False] * len(x)
    out = [0] * len(x)
    now = letters - 1
    while now >= 0:
        here, width = [i for i in members[now] if group[i] == now], size[now]
        times: dict[int, int] = {}
        for i in here:
            done[i] = True
            out[i] = width
        for i in here:  # in order, so the places before it that are done know theirs
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            k = i - 1
            while k > j:  # the same answer holds for all that were passed
                before[k], k = j, before[k]
            before[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, n in times.items():
            moves.setdefault((n, group[j]), []).append(j)
        for n, old in sorted(moves, reverse=True):  # more copies stand higher: each new group goes right above the old one
            moved, new = moves[n, old], len(members)
            members.append(moved)
            size.append(size[old] + n * width)
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
            for j in moved:
                group[j] = new
        now = below[now]
    return out


def extensions(hashed: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from a and b on (a < b), and how many before them, are pairwise equal."""
    n = len(hashed)
    powers, inverses = words._powers(n)
    sums = np.zeros(n + 1, U64)
    np.cumsum(hashed * powers, out=sums[1:])

    def same(p: np.ndarray, q: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (sums[p + length] - sums[p]) * inverses[p] == (sums[q + length] - sums[q]) * inverses[q]

    def search(most: np.ndarray, back: bool) -> np.ndarray:
        low, step = np.zeros(len(a), np.int64), 1
        while step <= most.max(initial=0):
            step *= 2
        while step := step // 2:
            at = np.flatnonzero(low + step <= most)
            if len(at):
                length = low[at] + step
                p, q = (a[at] - length, b[at] - length) if back else (a[at], b[at])
                low[at[same(np.minimum(p, n - 1), np.minimum(q, n - 1), length)]] += step
        return low

    return search(n - b, False), search(a, True)


def segments(hashed: np.ndarray, least: int) -> np.ndarray:
    """Marks the places that may lie in a run: those which repeated stretches cover, within one segment."""
    stretch = (least + 1) // 2
    kept = np.ones(len(hashed), bool)
    grams = words.ngrams(hashed, stretch)
    for _ in range(NARROW):
        segment = np.cumsum(np.concatenate(([True], kept[1:] != kept[:-1])))
        start = np.flatnonzero(kept[:len(grams)] & (segment[:len(grams)] == segment[stretch - 1:]))
        here = words.mix(grams[start] + segment[start].astype(U64) * U64(0xD6E8FEB86659FD93))
        found = np.zeros(len(grams), bool)
        found[start] = words.repeated(here)
        new = words.covered(found, stretch, len(hashed))
        if new.sum() == kept.sum():
            break
        kept = new
        if not kept.any():
            break
    return kept


def measured(x: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """First word and length of the stretch around ``start`` in which words a period apart are equal, by comparing."""
    end = start + period
    while end < len(x) and x[end] == x[end - period]:
        end += 1
    while start > 0 and x[start - 1] == x[start - 1 + period]:
        start -= 1
    return start, end - start


def runs(parts: list[bytes], hashed: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of these words, in order. ``hashed`` holds a hash of each."""
    if len(parts) < max(least, 2):
        return []
    kept = segments(hashed, least) if least > 2 else np.ones(len(parts), bool)
    if not kept.any():
        return []
    place = np.flatnonzero(kept)
    edge = np.flatnonzero(np.diff(place) > 1) + 1  # words left out between segments become one word that occurs once
    place = np.insert(place, edge, -1 - np.arange(len(edge)))
    ids: dict[bytes | int, int] = {}
    x = np.array([ids.setdefault(parts[i] if i >= 0 else i, len(ids)) for i in place.tolist()], np.int64)
    value = words.mix(x.astype(U64) + U64(1))
    found = set()
    for order in (x, len(ids) - 1 - x):
        period = np.array(lyndon_array(order.tolist(), len(ids)), np.int64)
        at = np.flatnonzero(np.arange(len(x)) + period <= len(x))
        a, period = at, period[at]
        ahead, back = extensions(value, a, a + period)
        far = ahead + back >= np.maximum(period, least - period)
        found |= set(zip((a - back)[far].tolist(), (period + ahead + back)[far].tolist(), period[far].tolist(),
                         strict=True))
    out = set()
    for start, length, period in found:
        stretch = x[start:start + length]
        if not np.array_equal(stretch[period:], stretch[:-period]):
            start, length = measured(x, start, period)
        if length >= max(least, 2 * period):
            out.add((int(place[start]), length, period))
    return sorted(out)


def periodic(n: int, at: int, period: int) -> np.ndarray:
    """Places of n words of which those from ``at`` on repeat the first ``period`` of them."""
    i = np.arange(n)
    return np.where(i < at, i, at + (i - at) % period)


def planted(n: int, seed: int) -> np.ndarray | None:
    """Where each of n words comes from in a tenth of all documents, whose tails are made periodic for the measurement."""
    if seed % 10 or not n:
        return None
    g = seed // 10
    at = g % n
    return periodic(n, at, 1 + (n - at) // (3 + g % 8))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


LAYOUT = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def analysed(docs: DataFrame, id_col: str, text: Column, seed: Column | None = None, least: int = LEAST,
             whole: bool = True) -> DataFrame:
    """(id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs, collapsed) of every
    row: all runs, the one of greatest length, and the kept words joined by one space. ``runs`` and ``collapsed`` are null
    if not ``whole``. ``seed`` says which texts are made periodic first (``planted``); a null leaves a text as it is."""
    fields = LAYOUT.split(", ")
    kinds = {"long": pa.int64(), "string": pa.string(),
             "array<struct<start:long,length:long,period:long>>":
                 pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))}
    names, types = zip(*((f.split()[0], kinds[f.split()[1]]) for f in fields))

    def one(text: bytes, seed: int | None) -> tuple:
        parts, hashed = text.split(), words.word_hashes(text)
        source = None if seed is None else planted(len(parts), seed)
        if source is not None:
            parts, hashed = [parts[i] for i in source.tolist()], hashed[source]
        found = runs(parts, hashed, least)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        left = parts if not found else [parts[i] for i in np.flatnonzero(kept_words(len(parts), found))]
        told, collapsed = "".join(f"{s},{n},{p}\n" for s, n, p in found), b" ".join(left)
        return (len(parts), len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
                hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(),
                [dict(zip(("start", "length", "period"), r)) for r in found] if whole else None,
                collapsed.decode() if whole else None)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.slice(a, 200)
                rows = [one(t.as_buffer().to_pybytes() if t.is_valid else b"", s.as_py())
                        for t, s in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    seed = F.lit(None) if seed is None else seed
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), seed.cast("long").alias("seed")).mapInArrow(
        of, f"id {kind}, {LAYOUT}")


def collapsed(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The documents with each run cut down to its first period, words joined by one space; texts without a run, and all
    other columns, stay as they are."""
    @F.pandas_udf("string")
    def of(texts):
        def cut(t):
            if t is None:
                return None
            raw = t.encode()
            parts = raw.split()
            found = runs(parts, words.word_hashes(raw), least)
            return t if not found else b" ".join(parts[i] for i in np.flatnonzero(kept_words(len(parts), found))).decode()

        return texts.map(cut).astype(object)

    return docs.withColumn(text_col, of(F.col(text_col)))
