"""Each operator on one small table of awkward rows, held against a plain version."""

import base64
import collections
import hashlib
import time
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm import (op1_shards, op2_bpe, op3_chat, op4_decontaminate, op5_quality, op6_licences, op7_warc,
                            op8_jaccard, op9_langid, op10_substring)
from tillstream.llm.components import components
from tillstream.llm.scratch import ship

LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(12_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
BASE = " ".join(f"base{i}" for i in range(120))
TEXTS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " tail"), (4, BASE.replace("base60", "other")), (5, BASE.upper()),
    (6, None), (None, "a text without an id " + PASSAGE), (7, ""), (8, " \t\n\x0b\x0c\r "), (9, "one two"), (10, "one two"),
    (11, "spam spam spam spam " * 40), (12, LONG), (13, "start here " + PASSAGE + " end here"), (14, PASSAGE), (15, LONG),
    (16, "Ünïcödé 中文 \U0001f600 d'été # * $ %\nline\nline\n\nline"), (17, "x" * 5000), (18, PASSAGE.replace("shared30", "changed")),
    (19, "Licensed under the Apache License, Version 2.0.\nplain words of a text"), (20, "1 2 3 4 5"),
]
SCHEMA = "doc_id long, text string, lang string, n_words string, shard string, doc string, version string, quality string"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "en" if t and t[0] in "bs" else None, "clash", None, "d", "v", "q") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    return (text or "").encode().split()


def test_quality_counts(docs, none):
    got = {(r["doc_id"], r["text"]): r["quality"] for r in op5_quality.judged(docs).collect()}
    for i, t in TEXTS:
        w = words(t)
        windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        n = collections.Counter(windows)
        inside = {k + d for k, x in enumerate(windows) if n[x] > 1 for d in range(5)}
        lines = (t or "").split("\n")
        dup = sum(1 for k, x in enumerate(lines) if x.encode().split() and x in lines[:k])
        m = got[i, t]["measures"]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == (
            len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), dup, len(inside)), t
        for length in op5_quality.MAX_COVERAGE:
            grams = [tuple(w[k:k + length]) for k in range(len(w) - length + 1)]
            c = collections.Counter(grams)
            marked = {k + d for k, x in enumerate(grams) if c[x] > 1 for d in range(length)}
            assert m[f"dup_{length}gram_chars"] == sum(len(w[k].decode()) for k in marked)
        assert got[i, t]["base_failed"] == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
    assert op5_quality.clean(docs).columns == docs.columns
    assert not op5_quality.judged(none).collect()


def test_bpe_is_exact(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = op2_bpe.token_ids(spark, F.col("text"), path, public_tokenizers.PATTERN)
    back = op2_bpe.decoded(spark, F.col("ids"), path, public_tokenizers.PATTERN)
    for r in docs.select("text", ids.alias("ids")).withColumn("back", back).collect():
        assert r["ids"] == known.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()
    digest = op2_bpe.digests(spark, F.col("text"), path, public_tokenizers.PATTERN)
    assert docs.select(digest.alias("d")).where("d.n_tokens = 0").count() == 2
    assert not none.select(digest.alias("d")).collect()


def test_bpe_backtracks_as_merges_do():
    """A vocabulary in which the longest match is often wrong."""
    ranks = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"ca", b"bca", b"cab", b"aa", b"aab"]
    bpe = op2_bpe.Bpe(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(ranks)), r"\S+")
    for n in range(1, 3 ** 7):
        text = "".join("abc"[n // 3 ** k % 3] for k in range(7))
        whole = bpe.ranks.get(text.encode())
        assert bpe.piece(text.encode()) == ([whole] if whole is not None else bpe.merged(text.encode()))


def test_jaccard_components(docs, none):
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for i, t in TEXTS:
        w = (t or "").encode().translate(table).split()
        sets.append((i, frozenset(tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()))
    least = {k: k for k in range(len(sets))}
    order = lambda k: (sets[k][0] is not None, sets[k][0] or 0)
    for _ in sets:
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and 100 * len(x & y) >= 90 * len(x | y):
                    least[a] = min(least[a], least[b], key=order)
    want = sorted(((i, len(s), sets[least[k]][0]) for k, (i, s) in enumerate(sets)), key=repr)
    numbered = op8_jaccard.numbered(docs, "doc_id", F.col("text"))
    assert rows(op8_jaccard.joined(numbered)) == want
    assert not op8_jaccard.joined(op8_jaccard.numbered(none, "doc_id", F.col("text"))).collect()
    kept = op8_jaccard.one_each(docs)
    assert kept.columns == docs.columns and {r[0] for r in kept.select("doc_id").collect()} >= {1, 6, 7, 8, None}


def test_near_duplicates_stage(spark):
    import corpus_pipeline

    def edited(name, n, at):
        return " ".join(f"{name}{k}" if k not in at else f"edit{name}{k}" for k in range(n))

    texts = {}
    for name, n in (("a", 200), ("b", 120), ("c", 60), ("d", 400)):
        for edits in range(8):  # isolated edits, and runs of edits
            texts[len(texts)] = edited(name, n, set(range(7, 7 * edits + 1, 7)))
            texts[len(texts)] = edited(name, n, set(range(20, 20 + 2 * edits)))
    texts |= {100: "q r s t u v w x", 101: "Q R S T U V W X Y", 102: "q r s", 103: "q r s t", 104: "q r s", 105: None, 106: ""}
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in texts}
    for _ in texts:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    least[a] = min(least[a], least[b])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert rows(kept) == sorted(((i, t) for i, t in texts.items() if least[i] == i), key=repr)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (7, 7)], "u long, v long")
    assert rows(components(edges)) == sorted([(k, 0) for k in range(1, 51)] + [(101, 100)], key=repr)


def test_substring_dedup(docs, none):
    seen, want = set(), []
    once = sorted(set(TEXTS), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in once:
        w, gone = words(t), set()
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            if key in seen:
                gone |= set(range(k, k + 20))
            seen.add(key)
        left = [x for k, x in enumerate(w) if k not in gone]
        want += [(i, len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest())] * TEXTS.count((i, t))
    numbered = op10_substring.numbered(docs, "doc_id", F.col("text"))
    assert rows(op10_substring.digests(numbered, op10_substring.repeats(numbered))) == sorted(want, key=repr)
    cut = op10_substring.deduplicated(docs)
    assert cut.columns == docs.columns and cut.count() == len(TEXTS)
    empty = op10_substring.numbered(none, "doc_id", F.col("text"))
    assert not op10_substring.digests(empty, op10_substring.repeats(empty)).collect()


def test_shards_are_even_and_keep_groups(docs, none):
    got = op1_shards.sharded(docs, shards=4).collect()
    assert len(got) == len(TEXTS)
    count = collections.Counter(r["shard"] for r in got)
    assert max(count.values()) - min(count.values()) <= 1 and set(count) == set(range(4))
    for s in count:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))
    texts = collections.Counter((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    assert collections.Counter((r["size"], r["text_crc32"]) for r in got) == texts
    assert not op1_shards.sharded(none).collect()


def test_propagation_joins_groups(spark):
    many = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 700).cast("string").alias("text"))
    got = op1_shards.sharded(many, shards=8).collect()
    homes = collections.defaultdict(set)
    for r in got:
        homes[r["text_crc32"]].add(r["shard"])
    assert sum(len(h) == 1 for h in homes.values()) > 0.8 * len(homes)


@pytest.mark.parametrize("limit", [op4_decontaminate.LIMIT, 0])
def test_decontamination(spark, docs, none, limit):
    items = spark.createDataFrame([(1, PASSAGE), (2, " ".join(PASSAGE.split()[:25])), (3, None), (4, ""), (5, "one two"),
                                   (5, "one two"), (6, "nowhere " * 9 + "to be found")], "item_id long, text string")
    got = {(r["doc_id"], r["item"]) for r in op4_decontaminate.contaminated(docs, items, ["doc_id"], limit=limit).collect()}
    assert got == {(i, k) for i in (None, 13, 14, 18) for k in (1, 2)} | {(9, 5), (10, 5)}
    kept = op4_decontaminate.clean(docs, items, limit=limit)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 6
    assert not op4_decontaminate.contaminated(none, items, ["doc_id"], limit=limit).collect()
    assert not op4_decontaminate.contaminated(docs, items.limit(0), ["doc_id"], limit=limit).collect()


def test_languages(spark, folder, docs, none):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    names, prototypes = op9_langid.fit(table, "doc_id", "text", "lang", ~held)
    tested = op9_langid.predict(table.where(held), F.col("text"), names, prototypes)
    right = tested.agg(F.avg((F.col("language.lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97
    odd = op9_langid.predict(docs, F.col("text"), names, prototypes)
    assert {r["doc_id"] for r in odd.where("language.lang_pred = 'und'").collect()} == {6, 7, 8, 20}
    assert odd.where("language.score not between 0 and 1").count() == 0
    nothing, zero = op9_langid.fit(none, "doc_id", "text", "lang", F.lit(True))
    assert not nothing
    assert {r[0] for r in op9_langid.predict(docs, F.col("text"), nothing, zero).select("language.lang_pred").collect()} == {"und"}


def test_long_texts_lose_no_trigram():
    whole = op9_langid.text_vectors([LONG])[0]
    op9_langid.PIECE, before = 1000, op9_langid.PIECE
    try:
        pieces = op9_langid.text_vectors([LONG])[0]
    finally:
        op9_langid.PIECE = before
    assert (op9_langid.unit(whole) * op9_langid.unit(pieces)).sum() > 0.999


def test_shards_of_a_group_larger_than_one(spark):
    # a third of the rows are one text, a third are pairs, a third have no copy
    many = spark.range(2400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "large").when(
        F.col("id") % 3 == 1, F.concat(F.lit("pair"), F.floor(F.col("id") / 6))).otherwise(F.concat(F.lit("one"), "id")).alias("text"))
    got = op1_shards.sharded(many).collect()
    assert set(collections.Counter(r["shard"] for r in got).values()) == {100}
    large = collections.Counter(r["shard"] for r in got if r["group_rows"] == 800)
    assert sum(n * (n - 1) for n in large.values()) == 8 * 100 * 99  # 12.5 percent of its pairs
    homes = collections.defaultdict(set)
    for r in got:
        if r["group_rows"] == 2:
            homes[r["text_crc32"]].add(r["shard"])
    assert len(homes) == 400 and sum(len(h) == 1 for h in homes.values()) == 400


def test_chat_recovers_turns(spark, folder, none):
    ship(spark)
    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    part = op3_chat.transcript_part(*(F.col(c) for c in ("conv_id", "turn", "role", "text")))
    parts = talk.select(F.col("conv_id").alias("conv"), F.col("turn").alias("part"), "role", part.alias("text"))
    model = op3_chat.fit(parts)
    got = {(r["conv"], r["role"], r["canonical"]) for r in op3_chat.parsed(parts.drop("role"), model).collect()}
    want = {(r["conv_id"], r["role"], op3_chat.rendered(r["role"], r["text"].split("\n"))) for r in talk.collect()}
    assert len(got & want) > 0.95 * len(want)
    odd = spark.createDataFrame([(None, 0, "User: hi"), (1, None, None), (1, 0, ""), (2, 0, "Assistant: a"), (2, 0, "Assistant: a"),
                                 (2, 1, "narrator: b")], "conv long, part long, text string")
    found = op3_chat.parsed(odd, model).collect()
    assert sum(r["n_lines"] for r in found) == 6 and {r["conv"] for r in found} == {None, 1, 2}
    empty = spark.createDataFrame([], "conv long, part long, role string, text string")
    assert not op3_chat.parsed(empty.drop("role"), op3_chat.fit(empty)).collect()


def test_chat_cuts_change_nothing(spark, folder):
    ship(spark)
    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    part = op3_chat.transcript_part(*(F.col(c) for c in ("conv_id", "turn", "role", "text")))
    model = op3_chat.fit(talk.select(F.col("conv_id").alias("conv"), F.col("turn").alias("part"), "role", part.alias("text")))
    lines = ["User: what is this?\n", "it is a thing\n", "plain", None, "Assistant: yes\n", "more\nof it\n", "and more", "", "so?\n", "no\n"]
    parts = [(1, k, lines[k * 7 % 10]) for k in range(150)] + [(None, None, lines[k % 10]) for k in range(60)]
    parts += [(2, 5, "User: a\n")] * 9 + [(3, k + 1000, "goes on") for k in range(40)] + [(4, 0, "Assistant: b")]
    want = []
    for conv in (1, None, 2, 3, 4):
        own = sorted((p for p in parts if p[0] == conv), key=lambda p: (p[1] or 0, p[2] is not None, p[2] or ""))
        want += [(conv, *t) for t in op3_chat.turns_of([p[2] for p in own], model)]
    table = spark.createDataFrame(parts, "conv long, part long, text string").repartition(3)
    for span in (4, 512):
        got = op3_chat.parsed(table, model, span).orderBy("conv", "turn").collect()
        assert [tuple(r)[:1] + tuple(r)[2:] for r in got] == sorted(want, key=lambda t: (t[0] is not None, t[0] or 0)), span


def test_licences(spark, docs, none):
    model = op6_licences.fit(docs)
    got = {(r["doc_id"], r["text"]): r["licence"] for r in op6_licences.scan(docs, model).collect()}
    assert got[19, TEXTS[-2][1]]["licence"] == "Apache" and got[19, TEXTS[-2][1]]["n_paragraphs"] == 1
    assert all(v["licence"] == "none" for (i, _), v in got.items() if i != 19)
    for family, texts in op6_licences.TEMPLATES.items():
        for t in texts:
            assert model.judge(t)[0] == family, t
    assert model.judge("Licensed under the Foo Public License, version 9.")[0] in ("unknown", "none", "GPL", "LGPL", "MPL")
    assert not op6_licences.scan(none, op6_licences.fit(none)).collect()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""


def test_licences_in_long_paragraphs(spark, docs):
    model = op6_licences.fit(docs)
    mit, bsd = MIT.replace("\n", " "), BSD.replace("\n", " ")
    assert model.judge(mit)[0] == "MIT" and model.judge(bsd)[0] == "BSD"
    assert model.judge(mit[:mit.index(": The above")])[0] == "MIT"
    assert model.judge(bsd[bsd.index("Redistributions of"):bsd.index(" 2. ")])[0] == "BSD"
    plain = [f"plain{k}" for k in range(3000)]
    for family, texts in op6_licences.TEMPLATES.items():
        for t in texts:
            assert model.judge(" ".join([*plain[:21], t, *plain[21:]]))[0] == family, t
    for t, family in (("This project is distributed under the terms of the MIT License, see the file.", "MIT"),
                      ("The code is made available under the Apache License, version 2.0 by its authors.", "Apache"),
                      ("All texts are released under a Creative Commons Attribution 4.0 International licence.", "CC-BY")):
        assert model.judge(t)[0] == family, t
    both = " ".join([*plain[:9], "Licensed under the MIT license.", *plain[9:99], "Licensed under the BSD license."])
    got = op6_licences.scan(spark.createDataFrame([(both,)], "text string"), model).first()["licence"]
    assert got["families"] == ["MIT", "BSD"] and got["n_paragraphs"] == 1 and got["n_unknown"] == 0
    assert not model.found("The museum is open to the public at the end of the day, in the hope that it will be useful to all of the town.")
    assert not model.found(" ".join(plain))


def test_warc_derivatives(spark):
    ship(spark)
    page = ("<html><head><title>A &amp; B</title><script>x<p></script></head><body><!-- c --><p>One <b>two</b></p>"
            "<a href='/x'>three</a></body></html>")
    pages = spark.createDataFrame([(1, "http://a/", page), (2, None, None), (2, None, None), (None, "http://b/\r\nX: y", "")],
                                  "page_id long, url string, html string")
    got = op7_warc.derived(op7_warc.responses(pages, "page_id", F.col("url"), F.col("html"))).collect()
    assert len(got) == 8
    one = {r["warc_type"]: r for r in got if r["source"] == 1}
    text, notes = one["conversion"], one["metadata"]
    assert text["block"] == "A & B\nOne two\nthree"
    assert text["refers_to"] == notes["refers_to"] and notes["conversion_id"] == text["record_id"]
    assert text["payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(page.encode()).digest()).decode()
    assert f"source-payload-digest: {text['payload_digest']}" in notes["block"] and "outlinks: 1" in notes["block"]
    for r in got:
        block = r["block"].encode()
        assert r["content_length"] == len(block) and r["block_digest"] == op7_warc.digest(block)
        assert f"WARC-Refers-To: {r['refers_to']}\r\n" in r["headers"] and "\r\nX: y" not in r["headers"]
    empty = spark.createDataFrame([], pages.schema)
    assert not op7_warc.derived(op7_warc.responses(empty, "page_id", F.col("url"), F.col("html"))).collect()


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    last = corpus_pipeline.run(spark, folder)
    kept = {r["doc_id"] for r in last.collect()}
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0.7 * docs.count() < len(kept) < docs.count()
    assert isinstance(docs.schema["doc_id"].dataType, T.LongType)


@pytest.mark.parametrize("piece", ["<a ", "<p ", "<title>", "<script>", "<!--", "<", "<a href", "</script ", "<script></script ", "<title>x</title ",
                                   "<a href='x'>", "&amp", "<a href=   ", "<!-- --"])
def test_hostile_pages_take_linear_time(piece):
    start = time.process_time()
    op7_warc.derivatives("r", "u", "d", None, piece * (1_000_000 // len(piece)))
    assert time.process_time() - start < 3


def test_reading_a_page():
    page = ("<!doctype html><TITLE lang=x>A &lt; B\n C</title ><style>p{}</style><p>one<b>two</b> &amp; 3<br/>four<!-- <a href=q> x -->five"
            "<a name=x>six</a><A class=y HREF = 'z'>seven</A><script>if (a<b) '</p>'</script >eight<title>second</title><li>nine <x")
    assert op7_warc.reading(page) == ("A < B\nC\nonetwo & 3\nfour fivesixseven eight\nsecond\nnine", "A < B\n C", 1)
    assert op7_warc.reading("<title>never closed <p>text") == ("never closed\ntext", None, 0)
    assert op7_warc.reading("") == ("", None, 0) and op7_warc.reading("a > b") == ("a > b", None, 0)


def test_one_row_of_each_group_by_text(spark):
    far = "wholly different words " + " ".join(f"far{i}" for i in range(60))
    rows_ = [(2, BASE, "a"), (2, far, "a"), (1, BASE, "b"), (1, BASE, "c"), (None, BASE + " x", "d"), (None, far, "e"), (5, "", "f"), (5, "", "f")]
    table = spark.createDataFrame(rows_, "doc_id long, text string, version string").repartition(3)
    kept = op8_jaccard.one_each(table)
    assert kept.columns == table.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([(None, BASE + " x", "d"), (None, far, "e"), (5, "", "f"), (5, "", "f")], key=repr)
    kept = op8_jaccard.one_each(table.where("doc_id is not null"))
    assert sorted((r[0], r[1]) for r in kept.collect()) == sorted([(1, BASE), (2, far), (5, ""), (5, "")])


def test_profiles_never_rule_out_similar_sets():
    """Every pair that is similar is linked by the tree of a list that holds it, whatever else the list holds."""
    import numpy as np

    rng = np.random.default_rng(4)
    for percent in (80, 90):
        base = [rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (12, 60, 300, 2000)]
        sets = [np.unique(np.concatenate([b[rng.random(len(b)) > cut], rng.integers(0, 2 ** 63, int(len(b) * cut), dtype=np.uint64)]))
                for b in base for cut in (0, 0.02, 0.05, 0.1, 0.2, 0.5)]
        n = np.array([len(x) for x in sets])
        links = op8_jaccard.tree(n, [np.frombuffer(op8_jaccard.profile(x), np.uint8) for x in sets], percent)
        root = list(range(len(sets)))
        for i, j in links:
            root = [root[i] if r == root[j] else r for r in root]
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= percent * (n[i] + n[j] - both):
                    assert root[i] == root[j]
        assert len({root[i] for i in range(len(sets))}) >= len(base)


def test_index_lists_do_not_grow_with_unrelated_sets():
    """Unrelated sets share no entry, not even that of an empty block; similar ones share one, and as many as their slack says."""
    import numpy as np

    rng = np.random.default_rng(5)
    new = lambda n: rng.integers(0, 2 ** 63, n, dtype=np.uint64)
    for percent in (80, 90):
        for n in (12, 40, 150, 600, 3000):
            entries = np.concatenate([op8_jaccard.signatures(np.unique(new(n)), percent) for _ in range(300)])
            assert len(np.unique(entries)) == len(entries)
        for n in (4, 5, 9, 10, 21, 57, 58, 113, 500, 2000):
            for _ in range(40):
                a, most = new(n), op8_jaccard.differing(n, percent)
                gone = int(rng.integers(0, most // 2 + 1))
                b = np.concatenate([a[gone:], new(int(rng.integers(0, most - 2 * gone + 1)) + gone)])
                pair = sorted((np.unique(a), np.unique(b)), key=len)
                both = len(np.intersect1d(*pair))
                if 100 * both < percent * (len(pair[0]) + len(pair[1]) - both):
                    continue
                shared = np.intersect1d(*(op8_jaccard.signatures(x, percent) for x in pair)) % np.uint64(op8_jaccard.WINDOWS)
                windows = [{s % op8_jaccard.WINDOWS: s // op8_jaccard.WINDOWS for s in op8_jaccard.slacks(x, percent)} for x in pair]
                least = [i for i, (low, high) in enumerate(zip(op8_jaccard.windows(n, percent), op8_jaccard.windows(n, percent)[1:]))
                         if low <= len(pair[0]) < high]
                for w in (i % op8_jaccard.WINDOWS for i in least):
                    assert (shared == w).sum() >= max(1, *(x[w] for x in windows))


def test_long_lists_link_what_is_similar_alone(spark, monkeypatch):
    """A passage in all texts makes lists of all of them: texts leave these, their near copies are found all the same, and
    large clusters of near copies stay whole."""
    import numpy as np

    ship(spark)
    monkeypatch.setattr(op8_jaccard, "COMMON", 6)
    monkeypatch.setattr(op8_jaccard, "BIG", 8)
    monkeypatch.setattr(op8_jaccard, "BUCKET", 500)
    rng = np.random.default_rng(6)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = []
    for i in range(40):
        own = [f"t{i}w{k}" for k in range(int(rng.integers(60, 200)))]
        texts.append(" ".join(own) + " " + passage)
        if i % 3 == 0:
            texts.append(" ".join("new" if k == 9 else x for k, x in enumerate(own)) + " " + passage)
    texts += [" ".join("edit" if k == 5 + 3 * c else f"m{k}" for k in range(150)) for c in range(30)]
    texts += [passage, passage + " x", passage + " x y", "q r s t u v w x", "q r s t u v w x y"] * 2
    sets = [frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for w in (t.split() for t in texts)]
    least = list(range(len(sets)))
    for _ in range(3):
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    least[a] = least[b] = min(least[a], least[b])
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    numbered = op8_jaccard.numbered(table, "doc_id", F.col("text"))
    assert rows(op8_jaccard.joined(numbered, 5, 80)) == sorted(((i, len(s), least[i]) for i, s in enumerate(sets)), key=repr)
    every = op8_jaccard.sets(numbered, 5, 80).cache()
    of = {r.k1: r.doc for r in every.collect()}
    linked = {(of[r.u], of[r.v]) for r in op8_jaccard.candidates(numbered, every, 5, 80).collect()}
    every.unpersist()
    unrelated = [p for p in linked if least[p[0]] != least[p[1]]]
    assert not unrelated, (unrelated, len(linked))
