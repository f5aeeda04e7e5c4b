"""Chat formatting: roles of a plain transcript by a hidden Markov model, then canonical turns.

States are a role and whether a line begins a turn or goes on with one. A line shows a speaker marker (or none) and line
features: whether the line before is blank, whether it ends as a question, and its length. Transition and emission probabilities are counts over
labelled transcripts, taken by Spark over the whole table; Viterbi finds the most probable states of a transcript's lines.

A transcript comes in parts (consecutive pieces of whole lines). Up to SPAN parts are put together by one shuffle and decoded
together. Parts of a longer transcript are numbered gaplessly by ranks within ranges of rows, and it is decoded span by span: each span gives the best scores from
every state before it to every state at its end, these are multiplied SPAN at a time up to the whole transcript, and the most probable
states at the cuts follow on the way down. So the cuts change no role, and no task holds an unbounded transcript, but for
the text of a turn, which is put together from its spans' pieces.

Defined results: a null part is an empty line; parts with one number are taken in the order of their text; equally probable states: the first one wins, in the order of ROLES; a transcript
without parts does not exist; without labelled rows every state is as likely; a line with an unknown role's marker is judged
by its other features. Only the columns asked for are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.scratch import written

ROLES = ("system", "user", "assistant")
SPAN = 512
# fixed values: words that introduce a speaker
SPEAKERS = {"system": ("system", "instructions", "context"), "user": ("user", "human", "q", "question", "prompter"),
            "assistant": ("assistant", "ai", "bot", "a", "answer", "model")}
MARKERS = len(ROLES) + 1
FEATURES = MARKERS * 2 * 2 * 4
MARKER = regex.compile(r"^\s*(?:#+\s*|<\|?|\[|\*\*)?\s*(%s)\s*(?:\|?>|\]|\*\*)?\s*(?::|(?<=[>\]*])|$)[ \t]*" % "|".join(
    w for words in SPEAKERS.values() for w in words), regex.I)
ROLE_OF = {w: r for r, (_, words) in enumerate(SPEAKERS.items()) for w in words}


def features(line: str, after_blank: bool) -> tuple[int, str]:
    """The observed symbol of a line, and the line without its marker."""
    found = MARKER.match(line)
    rest = line[found.end():] if found else line
    marker = 1 + ROLE_OF[found.group(1).lower()] if found else 0
    bare = rest.strip()
    length = 0 if not bare else 1 if len(bare) < 40 else 2 if len(bare) < 200 else 3
    return ((marker * 2 + after_blank) * 2 + bare.endswith("?")) * 4 + length, rest


def observed(text: str | None, after_blank: bool) -> list[tuple[int, str]]:
    out = []
    for line in (text or "").split("\n"):
        out.append(features(line, after_blank))
        after_blank = not line.strip()
    return out


class Model:
    """Log probabilities of states 2 * role (begins) and 2 * role + 1 (goes on)."""

    def __init__(self, starts: np.ndarray, moves: np.ndarray, shows: np.ndarray):
        smooth = lambda c, by: np.log((c + by) / (c + by).sum(axis=-1, keepdims=True))
        self.start = smooth(starts, 0.5)
        self.start[1::2] = -np.inf  # the first line begins a turn
        self.move = smooth(moves, 0.05)
        for r in range(len(ROLES)):
            others = [s for s in range(1, 2 * len(ROLES), 2) if s != 2 * r + 1]
            self.move[2 * r:2 * r + 2, others] = -np.inf  # only one's own turn goes on
        self.show = smooth(shows, 0.05)

    def states(self, symbols: list[int], before: int | None = None, last: int | None = None) -> np.ndarray:
        """The most probable states, after the state ``before`` and up to the state ``last`` where these are given."""
        seen = self.show[:, symbols].T
        score, back = (self.start if before is None else self.move[before]) + seen[0], np.zeros(seen.shape, np.int64)
        for t in range(1, len(seen)):
            ways = score[:, None] + self.move
            back[t] = ways.argmax(axis=0)
            score = ways.max(axis=0) + seen[t]
        out = np.empty(len(seen), np.int64)
        out[-1] = score.argmax() if last is None else last
        for t in range(len(seen) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def passage(self, symbols: list[int], first: bool) -> np.ndarray:
        """Best scores of the lines from each state before them to each state of the last one; before a first line all are one."""
        score = (np.tile(self.start, (len(self.start), 1)) if first else self.move) + self.show[:, symbols[0]]
        for s in symbols[1:]:
            score = (score[:, :, None] + self.move).max(axis=1) + self.show[:, s]
        return score


def fit(turns: DataFrame) -> Model:
    """``turns`` is (conv, part, role, text): labelled parts, each a turn with its marker, if it has one."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for role, before, many, blank, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if role not in ROLES:
                    continue
                state = 2 * ROLES.index(role)
                last = 2 * ROLES.index(before) + bool(many) if before in ROLES else -1
                for i, (symbol, _) in enumerate(observed(text, bool(blank))):
                    now = state + (i > 0)
                    for key in (("show", now, symbol), ("start", now, 0) if last < 0 else ("move", last, now)):
                        n[key] = n.get(key, 0) + 1
                    last = now
        kinds, a, b = zip(*n) if n else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                          pa.array(list(n.values()), pa.int64())], names=["kind", "a", "b", "n"])

    # the turn before is looked up by its number, so that no window has to hold a conversation
    previous = turns.groupBy("conv", (F.col("part") + 1).alias("part")).agg(
        F.min("role").alias("before"), F.max(F.col("text").contains("\n")).alias("many"),
        F.max(F.col("text").endswith("\n")).alias("blank"))
    rows = turns.join(previous, ["conv", "part"], "left").select("role", "before", "many", "blank", "text")
    counts = rows.mapInArrow(counted, "kind string, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    tables = {"start": np.zeros(2 * len(ROLES)), "move": np.zeros((2 * len(ROLES),) * 2), "show": np.zeros((2 * len(ROLES), FEATURES))}
    for kind, a, b, n in counts.collect():  # as many as the model has parameters
        tables[kind][(a,) if kind == "start" else (a, b)] += n
    return Model(*tables.values())


def rendered(role: str, lines: list[str]) -> str:
    return f"<|{role}|>\n" + "\n".join(lines).strip() + "\n<|end|>\n"


def pieces(parts: list[str | None], model: Model, after_blank: bool = False, before: int | None = None,
           last: int | None = None) -> list[tuple[str, bool, list[str]]]:
    """(role, begins, lines) of each turn, or part of one, of a span's parts."""
    lines = observed("\n".join(p or "" for p in parts), after_blank)
    out: list[tuple[str, bool, list[str]]] = []
    for state, (_, rest) in zip(model.states([s for s, _ in lines], before, last), lines):
        if state % 2 == 0 or not out:
            out.append((ROLES[state // 2], state % 2 == 0, []))
        out[-1][2].append(rest)
    return out


def turns_of(parts: list[str | None], model: Model) -> list[tuple[str, int, str]]:
    """(role, lines, canonical text) of each turn of a transcript."""
    return [(role, len(of), rendered(role, of)) for role, _, of in pieces(parts, model)]


def same(a: DataFrame, b: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Join on ``columns``, where nulls are equal; the columns of ``a`` stay."""
    b = b.withColumnsRenamed({c: f"__{c}" for c in columns})
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return a.join(b, on, how).drop(*[f"__{c}" for c in columns])


def numbered(transcripts: DataFrame, span: int) -> DataFrame:
    """(conv, span, r, text): rank of every part in its transcript from 0, taken within ranges of rows of about one size, with
    the counts of the ranges before."""
    ranges = int(transcripts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("part", "text", "uid")
    rows = transcripts.select("conv", "part", "text", F.monotonically_increasing_id().alias("uid"))
    rows = written(rows.repartitionByRange(ranges, "conv", *order).withColumn("range", F.spark_partition_id()), "ranges")
    upto = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    inside = rows.withColumn("r", F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order)))
    placed = same(inside, counts, "conv", "range").withColumn("r", F.col("r") + F.col("offset") - 1)
    return placed.select("conv", F.floor(F.col("r") / span).alias("span"), "r", "text")


def ends(nodes: DataFrame, kind: str, span: int) -> DataFrame:
    """(conv, k, before, last): the most probable states before and at the end of every span, from ``nodes`` (conv, k, m)."""
    size = 2 * len(ROLES)

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for members in batch.column(2).to_pylist():
                m = np.array(members[0]["m"]).reshape(size, size)
                for x in members[1:]:
                    m = (m[:, :, None] + np.array(x["m"]).reshape(size, size)).max(axis=1)
                out.append(m.ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))],
                                             names=["conv", "k", "m"])

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ks, befores, lasts = [], [], [], []
            for i, (members, before, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))):
                ms = [np.array(x["m"]).reshape(size, size) for x in members]
                score, back = ms[0][before], []
                for m in ms[1:]:
                    ways = score[:, None] + m
                    back.append(ways.argmax(axis=0))
                    score = ways.max(axis=0)
                states = [last]
                for b in reversed(back):
                    states.append(int(b[states[-1]]))
                states = [before, *reversed(states)]
                at += [i] * len(ms)
                ks += [x["k"] for x in members]
                befores += states[:-1]
                lasts += states[1:]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(ks, pa.int64()),
                                              pa.array(befores, pa.int32()), pa.array(lasts, pa.int32())],
                                             names=["conv", "k", "before", "last"])

    def grouped(df: DataFrame) -> DataFrame:
        return df.groupBy("conv", F.floor(F.col("k") / span).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("k", "m"))).alias("members")).select("conv", F.col("up").alias("k"), "members")

    levels = [nodes]
    while not levels[-1].where("k > 0").isEmpty():
        levels.append(written(grouped(levels[-1]).mapInArrow(product, f"conv {kind}, k long, m array<double>"), "product"))
    row = F.slice("m", 1, size)
    found = levels[-1].select("conv", "k", F.lit(0).alias("before"),
                              (F.array_position(row, F.array_max(row)) - 1).cast("int").alias("last"))
    for level in reversed(levels[:-1]):
        found = written(same(grouped(level), found, "conv", "k").select("conv", "k", "members", "before", "last")
                        .mapInArrow(inner, f"conv {kind}, k long, before int, last int"), "ends")
    return found


def parsed(transcripts: DataFrame, model: Model, span: int = SPAN) -> DataFrame:
    """(conv, turn, role, n_lines, canonical) of every recovered turn. ``transcripts`` is (conv, part, text)."""
    kind = transcripts.schema["conv"].dataType.simpleString()
    sizes = transcripts.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > span)
    over = written(sizes.select("conv"), "long")
    any_long = not over.isEmpty()
    short = same(transcripts.select("conv", "part", "text"), over, "conv", how="left_anti") if any_long else transcripts
    whole = short.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts")).select(
        "conv", F.lit(0).cast("long").alias("span"), F.transform("parts", lambda p: p["text"]).alias("texts"),
        *[F.lit(None).cast(t).alias(n) for n, t in (("line", "string"), ("before", "int"), ("last", "int"))])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, texts, line in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                lines = observed("\n".join(p or "" for p in texts.as_py()), line is not None and not line.strip())
                out.append(model.passage([s for s, _ in lines], k == 0).ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))],
                                             names=["conv", "k", "m"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            known = zip(*(batch.column(c).to_pylist() for c in (1, 3, 4, 5)))
            for i, (texts, (number, line, state, last)) in enumerate(zip(batch.column(2), known)):
                blank = line is not None and not line.strip()
                for k, (role, begins, lines) in enumerate(pieces(texts.as_py(), model, blank, state if number else None, last)):
                    for column, value in zip(columns, (i, k, role, begins, len(lines), "\n".join(lines))):
                        column.append(value)
            at = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at)] + [pa.array(c, t) for c, t in zip(
                    columns[1:], (pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.string()))],
                names=["conv", "span", "turn", "role", "begins", "n_lines", "text"])

    def canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rendered(r, t.split("\n")) for r, t in zip(*(batch.column(c).to_pylist() for c in (3, 5)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(5)), pa.array(texts, pa.string())],
                                             names=["conv", "span", "turn", "role", "n_lines", "canonical"])

    shape = f"conv {kind}, span long, turn long, role string, begins boolean, n_lines int, text string"
    found = whole.mapInArrow(of, shape).drop("begins")
    if any_long:
        parts = written(numbered(same(transcripts, over, "conv", how="left_semi"), span), "parts")
        before = parts.where((F.col("r") + 1) % span == 0).select(
            "conv", (F.col("span") + 1).alias("span"), F.substring_index(F.coalesce("text", F.lit("")), "\n", -1).alias("line"))
        spans = (parts.groupBy("conv", "span").agg(F.sort_array(F.collect_list(F.struct("r", "text"))).alias("parts"))
                 .select("conv", "span", F.transform("parts", lambda p: p["text"]).alias("texts")))
        large = written(same(spans, before, "conv", "span", how="left").select("conv", "span", "texts", "line"), "spans")
        nodes = written(large.mapInArrow(matrices, f"conv {kind}, k long, m array<double>"), "nodes")
        cuts = ends(nodes, kind, span).withColumnRenamed("k", "span")
        cut = same(large, cuts, "conv", "span").select("conv", "span", "texts", "line", "before", "last")
        found = found.unionByName(joined(written(cut.mapInArrow(of, shape), "pieces"), span))
    found = found.select("conv", "span", "turn", "role", "n_lines", "text").mapInArrow(
        canonical, f"conv {kind}, span long, turn long, role string, n_lines int, canonical string")
    # turns are numbered within a span; a span has fewer than 2**40 lines
    return found.select("conv", (F.col("span") * (1 << 40) + F.col("turn")).alias("turn"), "role", "n_lines", "canonical")


def joined(found: DataFrame, span: int) -> DataFrame:
    """``found`` with what goes on with a turn of an earlier span put to that turn."""
    opened = found.groupBy("conv", "span").agg(F.max(F.when(F.col("begins"), F.struct("span", "turn"))).alias("own"))
    opened = opened.withColumn("block", F.floor(F.col("span") / span))
    blocks = opened.groupBy("conv", "block").agg(F.max("own").alias("own"))
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", F.max("own").over(upto).alias("earlier"))
    inside = Window.partitionBy("conv", "block").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    owners = same(opened.withColumn("near", F.max("own").over(inside)), blocks, "conv", "block").select(
        "conv", "span", F.coalesce("near", "earlier").alias("owner"))
    at = same(found, written(owners, "owners"), "conv", "span", how="left").withColumn(
        "owner", F.when(F.col("begins"), F.struct("span", "turn")).otherwise(F.col("owner")))
    whole = at.groupBy("conv", "owner").agg(F.first("role").alias("role"), F.sum("n_lines").cast("int").alias("n_lines"),
                                            F.sort_array(F.collect_list(F.struct("span", "text"))).alias("texts"))
    return whole.select("conv", "owner.span", "owner.turn", "role", "n_lines",
                        F.array_join(F.transform("texts", lambda t: t["text"]), "\n").alias("text"))


def transcript_part(conv: Column, part: Column, role: Column, text: Column) -> Column:
    """A turn as transcripts have them: each conversation has one style of markers, one turn in six has none, and
    a blank line follows every turn."""
    style = F.pmod(F.xxhash64(conv), F.lit(4))
    user, bot, system = role == "user", role == "assistant", role == "system"
    name = (F.when(user, F.element_at(F.array(*map(F.lit, ("User: ", "Human: ", "Q: ", "### User:\n"))), style.cast("int") + 1))
            .when(bot, F.element_at(F.array(*map(F.lit, ("Assistant: ", "AI: ", "A: ", "### Assistant:\n"))), style.cast("int") + 1))
            .when(system, F.element_at(F.array(*map(F.lit, ("System: ", "Instructions: ", "Context: ", "### System:\n"))),
                                       style.cast("int") + 1)).otherwise(""))
    bare = F.pmod(F.xxhash64(conv, part), F.lit(6)) == 0
    return F.concat(F.when(bare, "").otherwise(name), F.coalesce(text, F.lit("")), F.lit("\n"))
