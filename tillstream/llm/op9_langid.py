"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point alone. A letter trigram is the product of its
letters' vectors, each rotated by its place (binding); a text is the sum of its trigrams' vectors (bundling); a language
is the sum of its training texts' unit vectors, taken relative to the mean over languages. A text belongs to
the language whose prototype has the largest cosine with it.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is any text if nothing could be learned;
equal cosines go to the first language in alphabetical order; repeated rows count as often as they are there. Long
texts go through in pieces of PIECE characters.

A row without an id is not learned from; rows that share an id are chosen or left together.

Training reads at most ``fit_rows`` labelled texts a language (those of the smallest hash of their id), and every learned
language; prediction reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 1024
FIT_ROWS = 2000  # labelled texts of each language to learn from
MAX_LANGUAGES = 4096  # prototypes are sent to every executor
PIECE = 1 << 20
BLOCK_CHARS = 1 << 18  # texts are bundled together up to this many characters
UNKNOWN = "und"

_LETTERS: dict[int, np.ndarray] = {}
_IS_LETTER = np.array([chr(c).isalpha() for c in range(0x30000)])


def letter(code: int) -> np.ndarray:
    """The vector of a letter."""
    known = _LETTERS.get(code)
    if known is None:
        if len(_LETTERS) > 20_000:
            _LETTERS.clear()
        bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, np.int8)
        known = _LETTERS[code] = bits * np.int8(2) - np.int8(1)
    return known


def trigrams(text: str) -> np.ndarray:
    """Codes of the letter trigrams of a text; words are padded with one space on either side."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _IS_LETTER[np.minimum(codes, len(_IS_LETTER) - 1)]
    codes = np.where(is_letter, codes, 32).astype(np.int64)
    codes = np.concatenate(([32], codes, [32]))
    keep = (codes != 32) | np.concatenate(([True], codes[:-1] != 32))
    codes = codes[keep]
    grams = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    return grams[codes[1:-1] != 32]  # a space in the middle joins two words


def bundles(counts: list[np.ndarray]) -> np.ndarray:
    """The vector of each text, given its trigrams."""
    owner = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    grams, at = np.unique(np.concatenate(counts), return_inverse=True)
    table = np.bincount(owner * len(grams) + at, minlength=len(counts) * len(grams)).astype(np.float32)
    places = [(grams >> 42), (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF]
    alphabet, which = np.unique(np.concatenate(places), return_inverse=True)
    vectors = np.stack([letter(int(c)) for c in alphabet])
    a, b, c = which.reshape(3, -1)
    bound = np.roll(vectors, 2, axis=1)[a] * np.roll(vectors, 1, axis=1)[b] * vectors[c]
    return table.reshape(len(counts), -1) @ bound.astype(np.float32)


def text_vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A vector for each text, and whether it has a letter."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    has = np.zeros(len(texts), bool)
    rows: list[int] = []
    held: list[np.ndarray] = []

    def empty_out() -> None:
        if held:
            np.add.at(out, rows, bundles(held))
        rows.clear()
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        for k in range(0, len(t or ""), PIECE):
            # pieces overlap by two letters, so no trigram of a long text is lost
            g = trigrams(t[max(0, k - 2):k + PIECE])
            if len(g):
                has[i] = True
                rows.append(i)
                held.append(g)
                size += len(g)
                if size > BLOCK_CHARS:
                    empty_out()
                    size = 0
    empty_out()
    return out, has


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, id_col: str, text: str, lang: str, learn_from: Column,
        fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes. Each task bundles its rows, a sum joins the tasks: what reaches the driver
    is one vector a language."""
    rows = docs.where(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_col).isNotNull()).select(
        F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # the rows of smallest hash; a bound on the hash that leaves about twice as many of each language comes first, so that no
    # window holds a whole language
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    found = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = docs.sparkSession.createDataFrame(found, counts.schema)
    share = F.least(F.lit(1.0), F.lit(2.0 * fit_rows) / F.col("rows"))
    few = rows.select("lang", "h", "id").join(F.broadcast(counts), "lang").where(F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= share)
    of_language = Window.partitionBy("lang").orderBy("h", "id")
    chosen = few.withColumn("n", F.row_number().over(of_language)).where(F.col("n") <= fit_rows)
    # texts stay where they are read: they are held against the last chosen row of their language, at most one row a language
    last = chosen.groupBy("lang").agg(F.max(F.struct("h", "id")).alias("last")).collect()
    bounds = docs.sparkSession.createDataFrame(last, chosen.select("lang", F.struct("h", "id").alias("last")).schema)
    sample = rows.join(F.broadcast(bounds), "lang").where(F.struct("h", "id") <= F.col("last")).select("lang", "text")

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            of = batch.column(0).to_pylist()
            for k in range(0, len(of), 256):
                vectors, _ = text_vectors(batch.column(1).slice(k, 256).to_pylist())
                for name, v in zip(of[k:k + 256], unit(vectors)):
                    sums[name] = sums.get(name, 0) + v.astype(np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([sums[n].tolist() for n in names], pa.list_(pa.float64()))],
            names=["lang", "v"])

    parts = sample.mapInArrow(bundled, "lang string, v array<double>").select("lang", F.posexplode("v").alias("k", "x"))
    sums = parts.groupBy("lang", "k").agg(F.round(F.sum("x"), 9).alias("x"))
    whole = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v"))
    got = {r["lang"]: np.array([k["x"] for k in r["v"]]) for r in whole.select("lang", "v").collect()}  # one vector a language
    names = sorted(got)
    if not names:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    prototypes = unit(np.array([got[n] for n in names]))
    if len(names) > 1:
        prototypes = unit(prototypes - prototypes.mean(axis=0))
    return names, prototypes.astype(np.float32)


def predict(docs: DataFrame, text: Column, names: list[str], prototypes: np.ndarray, into: str = "language") -> DataFrame:
    """All columns, and a struct ``into`` of ``lang_pred`` and ``score``: the cosine, moved from -1..1 to 0..1."""
    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores = [], []
            for k in range(0, len(batch), 256):
                vectors, has = text_vectors(batch.iloc[k:k + 256].tolist())
                cosines = unit(vectors) @ prototypes.T if names else np.zeros((len(has), 1), np.float32)
                best = cosines.argmax(axis=1)
                ok = has & bool(names)
                langs += [names[b] if good else UNKNOWN for b, good in zip(best, ok)]
                scores += np.where(ok, np.clip((1 + cosines[np.arange(len(best)), best]) / 2, 0, 1), 0.0).tolist()
            yield pd.DataFrame({"lang_pred": langs, "score": np.array(scores, np.float64)})

    return docs.withColumn(into, of(text))
