"""Quality rules by repetition coverage.

Rolling hashes of n-grams of several lengths, in numpy, find the n-grams that occur twice or more in a text; the measure
is the share of the text's characters (those in words) inside such n-grams, and inside lines that repeat an earlier line.

Defined results: a null or empty text has no words and fails; repeated rows are judged one by one; an empty table gives
no rows; of other columns only those asked for are read. Very long texts are held one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm import words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
# fixed values: largest share of characters in repeated n-grams, by n-gram length, as published for MassiveText
MAX_COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_LINE_COVERAGE = 0.20

IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars long, " + ", ".join(f"dup_{n}gram_chars long" for n in MAX_COVERAGE))


def measure(text: str | None) -> tuple[int, ...]:
    """The numbers of FIELDS for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    starts, ends = words.spans(data)
    n = len(starts)
    if not n:
        return (0, 0, int(IS_SYMBOL[data].sum()), 0, 0, 0) + (0,) * len(MAX_COVERAGE)
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.STARTS_CHARACTER[data], out=upto[1:])
    chars = upto[ends] - upto[starts]

    lines, line_chars = 0, 0
    seen: set[bytes] = set()
    for line in raw.split(b"\n"):
        if line in seen:
            inside = b"".join(line.split())
            lines += bool(inside)
            line_chars += int(words.STARTS_CHARACTER[np.frombuffer(inside, np.uint8)].sum())
        else:
            seen.add(line)

    hashed = words.hashes(data, starts, ends)
    repeat_words, by_length = 0, []
    for length in MAX_COVERAGE:
        marked = words.repeated(words.ngrams(hashed, length))
        if not marked.any():  # then no longer n-gram repeats either
            break
        inside = words.covered(marked, length, n)
        if length == WINDOW:
            repeat_words = int(inside.sum())
        by_length.append(int(chars[inside].sum()))
    by_length += [0] * (len(MAX_COVERAGE) - len(by_length))
    return (n, int(chars.sum()), int(IS_SYMBOL[data].sum()), lines, repeat_words, line_chars, *by_length)


def measures(text: Column) -> Column:
    """A struct of FIELDS."""

    @F.pandas_udf(FIELDS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for batch in batches:
            rows = np.array([measure(t) for t in batch], np.int64).reshape(-1, len(names))
            yield pd.DataFrame(rows, columns=names)

    return of(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def too_repetitive(m: Column) -> Column:
    """The verdict of the method: some n-gram length, or the lines, cover more than their share."""
    over = m["dup_line_chars"] > MAX_LINE_COVERAGE * m["word_chars"]
    for length, share in MAX_COVERAGE.items():
        over = over | (m[f"dup_{length}gram_chars"] > share * m["word_chars"])
    return over


def judged(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """All columns, and a struct ``into`` of the measures and ``base_failed`` and ``kept``."""
    with_measures = docs.withColumn(into, measures(F.col(text)))
    m = F.col(into)
    return with_measures.withColumn(into, F.struct(
        m.alias("measures"), base_failed(m).alias("base_failed"),
        (~base_failed(m) & ~too_repetitive(m)).alias("kept")))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents the rules keep, with their own columns."""
    into = "__quality"
    return judged(docs, text, into).where(F.col(into)["kept"]).drop(into)
