"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Each piece of text that the pattern matches is encoded by itself. Its bytes, as Latin-1 characters, run once through an
Aho-Corasick automaton of the reversed tokens (pyahocorasick), which gives the longest token that starts at each
byte. Tokens are then laid from left to right: the longest first, a shorter one where it does not go with the
token before, one step back where none does. Two tokens go together if merging their bytes by rank gives just these two;
that is memoised, and as a sequence is the exact merge result just if all neighbours go together, and no
position is tried again once it has failed, the work is linear in the piece.

Defined results: null and empty texts have no tokens; every row is encoded by itself; only the columns asked for are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAX_VOCABULARY_BYTES = 64 << 20  # what may be sent to every executor
KEPT_PIECES = 200_000  # memoised pieces and neighbours in a worker; when full, they start anew
KEPT_PIECE_CHARS = 48
FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Bpe:
    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.find = regex.compile(pattern).findall
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        # tokens that their own bytes do not merge to can appear only as a whole piece
        made = {t: r for t, r in self.ranks.items() if len(t) == 1 or self.merged(t) == [r]}
        self.automaton = ahocorasick.Automaton()
        for token, rank in made.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        for token, rank in made.items():
            cut = next((token[:k] for k in range(len(token) - 1, 0, -1) if token[:k] in made), None)
            self.shorter[rank] = None if cut is None else made[cut]

    def merged(self, data: bytes) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, as long as there are any."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def go_together(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= KEPT_PIECES:
                self.fits.clear()
            known = self.fits[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size = len(data)
        longest: list[int | None] = [None] * (size + 1)
        for end, rank in self.automaton.iter(data[::-1].decode("latin-1")):
            if longest[size - 1 - end] is None:  # the longest match at an end comes first
                longest[size - 1 - end] = rank
        open_ = bytearray(b"\1") * (size + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token is not None:
                end = at + len(self.bytes_of[token])
                if open_[end] and (not ids or self.go_together(ids[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:  # nothing goes on from here: take the last token back and never come here again
                open_[at] = 0
                token = ids.pop()
                at -= len(self.bytes_of[token])
                token = self.shorter[token]
            else:
                ids.append(token)
                at, token = end, longest[end]
        return ids

    def encode(self, text: str) -> list[int]:
        found = self.find(text)
        known = self.pieces
        try:
            return list(chain.from_iterable(map(known.__getitem__, found)))
        except KeyError:
            pass
        ids: list[int] = []
        for p in found:
            of = known.get(p)
            if of is None:
                of = self.piece(p.encode())
                if len(p) <= KEPT_PIECE_CHARS:
                    if len(known) >= KEPT_PIECES:
                        known.clear()
                    known[p] = of
            ids += of
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_READY: dict[tuple[str, str], Bpe] = {}


def ready(rank_file: bytes, pattern: str) -> Bpe:
    """The tables, built once in a worker."""
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Bpe(rank_file, pattern)
    return _READY[key]


def vocabulary(spark: SparkSession, path: str):
    """The rank file, read by the driver and sent to the executors; its size is checked."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def token_ids(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """The ids of a text, as an array."""
    sent = vocabulary(spark, path)

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ready(sent.value, pattern)
        for batch in batches:
            yield pd.Series([bpe.encode(t or "") for t in batch], dtype=object)

    return of(text)


def decoded(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """The bytes of a list of ids."""
    sent = vocabulary(spark, path)

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = ready(sent.value, pattern)
        for batch in batches:
            yield pd.Series([bpe.decode([] if i is None else list(i)) for i in batch], dtype=object)

    return of(ids)


def digests(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """A struct of FIELDS: encode and decode in one pass, and keep only what identifies the results."""
    sent = vocabulary(spark, path)

    @F.pandas_udf(FIELDS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = ready(sent.value, pattern)
        for batch in batches:
            rows = []
            for text in batch:
                ids = bpe.encode(text or "")
                written = " ".join(map(bpe.text_of.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return of(text)
