"""Importance resampling, exact dedup and periodic runs, held against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import BASE, LONG, PASSAGE, SCHEMA, TEXTS, docs, none, rows  # noqa: F401

from tillstream.llm import op11_resample, op12_exact, op13_periodic, words
from tillstream.llm.scratch import ship

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def grams(text, longest):
    w = [x.encode() for x in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER).decode())]
    return len(w), [zlib.crc32(b" ".join(w[k:k + n])) for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


def draw(texts, target, share, least, buckets=10_000, longest=1):
    """id, n_words, n_features, weight, score of every row, and the ids and texts that are drawn, in order."""
    s, t = (collections.Counter(f % buckets for x in c for f in grams(x, longest)[1]) for c in ([x for _, x in texts], target))
    every = (sum(s.values()) + buckets, sum(t.values()) + buckets)
    out = []
    for i, x in texts:
        n, fs = grams(x, longest)
        gain = [math.floor(1000 * math.log((t[f % buckets] + 1) * every[0] / ((s[f % buckets] + 1) * every[1]))) for f in fs]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32))), x))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[:share * len(able) // 100]


@pytest.mark.parametrize("share,longest,least,buckets", [(10, 1, 20, 10_000), (50, 3, 0, 97), (100, 2, 1, 1000), (0, 1, 20, 10)])
def test_draw(spark, docs, none, share, longest, least, buckets):  # noqa: F811
    target = [PASSAGE, None, "", "one two", "Überall 中文 1 2 3"]
    aims = spark.createDataFrame([(t, "x") for t in target], "text string, rank string")
    got = op11_resample.resampled(docs, aims, share=share, longest=longest, least_words=least, buckets=buckets).collect()
    want, drawn = draw(TEXTS, target, share, least, buckets, longest)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted((r[:5] for r in want), key=repr)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["score"], r["id"]) for r in ranked] == [(r[4], r[0]) for r in drawn]
    assert not op11_resample.resampled(none, aims, share=share).collect()
    assert len(op11_resample.resampled(docs, none.limit(0), share=share).collect()) == len(TEXTS)


def test_draw_returns_rows(spark, docs):  # noqa: F811
    some = op11_resample.sample(docs, docs, share=30)
    assert some.columns == docs.columns and 0 < some.count() < len(TEXTS)
    with pytest.raises(TypeError, match="integers"):
        op11_resample.resampled(docs, docs, id_col="text")


def test_crc_of_spans():
    data = np.frombuffer("a bc déf ".encode() + b"x" * 500 + b" y", np.uint8)
    edges = [(0, 1), (2, 4), (5, 9), (10, 510), (3, 3), (10, 74), (10, 75)]
    a, b = (np.array(c) for c in zip(*edges))
    assert op11_resample.crc32s(data, a, b).tolist() == [zlib.crc32(data[i:j].tobytes()) for i, j in edges]


@pytest.mark.parametrize("n,values", [(1, 1), (700, 5), (5000, 10 ** 6), (3000, 1)])
def test_cutoff(spark, monkeypatch, n, values):
    """Few values: many equal keys. Chunks and the sizes at which keys are written anew are made small."""
    monkeypatch.setattr(op11_resample, "CHUNK", 50)
    rng = random.Random(n)
    keys = [(rng.randrange(values) - values // 2, rng.randrange(values), rng.randrange(3)) for _ in range(n)]
    table = spark.createDataFrame(keys, "a long, b long, c long").repartition(5)
    for k in {1, n, n // 2 or 1, max(1, n // 10)}:
        assert tuple(op11_resample.cutoff(table, k)) == sorted(keys)[k - 1]


def test_a_round_discards_a_quarter():
    rng = random.Random(7)
    for _ in range(200):
        chunks = [sorted((rng.randrange(50), 0, 0) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 9))]
        pivot = op11_resample.weighted_median([(op11_resample.Key(*c[(len(c) - 1) // 2]), len(c)) for c in chunks])
        every = sorted(k for c in chunks for k in c)
        assert 4 * sum(k <= pivot for k in every) >= len(every) and 4 * sum(k >= pivot for k in every) >= len(every)


COPIES = [*TEXTS, (30, LONG.upper()), (31, LONG[:-1] + "é"), (32, "a" * 4096), (33, "a" * 4096), (34, "a" * 4097), (35, "a" * 8192),
          (36, "A" * 8192), (37, "ab" * 2048 + "a" * 4096), (38, "É" * 10), (39, "é" * 10), (40, "\x00"), (None, ""), (41, BASE[:64])]


@pytest.mark.parametrize("size", [1, 64, 4096])
def test_exact_dedup(spark, size):
    cases = [(i, t[:200] if t and size == 1 else t) for i, t in COPIES]
    table = spark.createDataFrame([(i, t, None, "n", "s", "d", "v", "q") for i, t in cases], SCHEMA).repartition(3)
    same = collections.defaultdict(list)
    for i, t in cases:
        same[(t or "").encode().translate(LOWER)].append(i)
    got = op12_exact.decided(table, size=size).collect()
    want = []
    for text, ids in same.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(text).hexdigest()) for i in ids]
    pick = lambda r: (r["id"], r["keep_id"], r["group_size"], r["text_sha256"])
    assert sorted(map(pick, got), key=repr) == sorted(want, key=repr)
    assert collections.Counter((r["id"], r["text_sha256"]) for r in got if r["kept"]) == collections.Counter(
        (max((i for i in ids if i is not None), default=None), hashlib.sha256(t).hexdigest()) for t, ids in same.items())
    kept = op12_exact.deduplicated(table, size=size)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], (r["text"] or "").encode().translate(LOWER)) for r in kept.collect() if r["doc_id"]) == sorted(
        (max(i for i in ids if i is not None), t) for t, ids in same.items() if any(ids))


def test_exact_dedup_of_nothing_and_of_one_group(spark, none):  # noqa: F811
    assert not op12_exact.decided(none).collect() and not op12_exact.deduplicated(none).collect()
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"))
    got = op12_exact.decided(hot).agg(F.min("group_size"), F.max("keep_id"), F.sum(F.col("kept").cast("int")), F.count("id")).first()
    assert tuple(got) == (3000, 2999, 1, 3000)


def test_exact_dedup_stays_in_the_jvm(spark, docs):  # noqa: F811
    plan = op12_exact.decided(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def all_runs(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if i > s and n >= max(least, 2 * q) and not any(w[s + r:s + n] == w[s:s + n - r] for r in range(1, q)):
                out.append((s, n, q))
            i += i == s
    return sorted(out)


def test_lyndon_words():
    rng = random.Random(3)
    for _ in range(300):
        x = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(1, 24))]
        x = [sorted(set(x)).index(v) for v in x]
        want = [max(n for n in range(1, len(x) - i + 1) if all(x[i:i + n] < x[i + k:i + n] for k in range(1, n))) for i in range(len(x))]
        assert op13_periodic.lyndon_array(x, max(x) + 1) == want


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(300):
        w = []
        while len(w) < rng.randint(1, 100):
            unit = [rng.choice("abc"[:rng.randint(1, 3)]).encode() for _ in range(rng.randint(1, 9))]
            w += unit * rng.randint(1, 5) + [b"z%d" % rng.randrange(30)] * rng.randint(0, 2)
        for least in (2, 5, 12):
            assert op13_periodic.runs(w, words.word_hashes(b" ".join(w)), least) == all_runs(w, least)
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 500:
        a, b = b, b + a
    assert op13_periodic.runs(b, words.word_hashes(b" ".join(b))) == all_runs(b, 12)
    every = np.zeros(len(b), np.uint64)  # hashes that lie: everything seems equal
    assert set(op13_periodic.runs([b"x", b"y"] * 20, every[:40])) <= {(0, 40, 2)}


def test_periodic_runs(spark, docs, none):  # noqa: F811
    ship(spark)
    loop = "go round and round again " * 30
    texts = [*TEXTS, *((i, f"{loop}{i} words {PASSAGE} {loop}") for i in range(50, 90)), (90, "a b " * 20_000), (91, "x " * 11), (92, "x " * 12)]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(3)
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = op13_periodic.analysed(table, "doc_id", F.col("text"), seed).collect()
    want, changed = [], 0
    for i, t in texts:
        w = (t or "").encode().split()
        h = None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w, changed = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))], changed + 1
        found = all_runs(w, 12) if len(w) < 9000 else [(0, len(w), 2)] if i == 90 else []
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
                     hashlib.sha256(left).hexdigest(), found, left.decode()))
    assert changed > 2
    assert sorted(((*tuple(r)[:-2], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr) == sorted(want, key=repr)
    cut = op13_periodic.collapsed(docs.unionByName(table, allowMissingColumns=True).drop("start"))
    assert cut.columns == docs.columns and cut.where("doc_id = 90").first()["text"] == "a b"
    assert not op13_periodic.analysed(none, "doc_id", F.col("text")).collect()
