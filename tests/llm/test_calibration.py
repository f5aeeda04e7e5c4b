"""Models held against data they were not fitted on."""

import random

import numpy as np
from pyspark.sql import functions as F

from tillstream.llm import op3_chat, op6_licences, op9_langid
from tillstream.llm.scratch import ship

WORDS = ("the of to and in under law office shall grant applicant rights conditions act museum river stone permission notice copy work "
         "public terms use years council software water house").split()
PLAIN = [[random.Random(n).choice(WORDS) for _ in range(5 + n % 60)] for n in range(600)]
# fixed values: notices of licences that are no template's family
OTHERS = ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
          "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0."]


def test_temperature_is_that_of_least_log_loss():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(4000, len(op6_licences.CLASSES)))
    p = np.exp(scores / 2) / np.exp(scores / 2).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(len(q), p=q) for q in p])
    assert 1.6 < op6_licences.calibrated(scores, labels) < 2.5
    sharp = scores.copy()
    sharp[np.arange(len(labels)), labels] += 50
    assert op6_licences.calibrated(sharp, labels) < 0.3


def test_licence_classifier_on_text_like_licences(monkeypatch):
    model = op6_licences.Classifier(PLAIN)
    for text in OTHERS:
        assert model.judge(text)[0] in ("unknown", "none") and not {f for f, _ in model.found(text)} - {"unknown"}
    assert "unknown" in {model.judge(t)[0] for t in OTHERS}
    assert model.judge("The patent office shall grant the applicant any rights under the law, subject to the conditions of the act as "
                       "amended from time to time by the council.") == ("none", 1.0)
    # a family of which nothing is known must not be taken for another one
    for family in ("MPL", "BSD"):
        rest = [f for f in op6_licences.FAMILIES if f != family]
        known = [k for k in op6_licences.KNOWN if k[0] != family]
        has, own = op6_licences.by_pair(known)
        with monkeypatch.context() as m:
            for name, value in (("FAMILIES", rest), ("CLASSES", [*rest, "none"]), ("KNOWN", known), ("HAS", has),
                                ("OWN", own)):
                m.setattr(op6_licences, name, value)
            left = op6_licences.Classifier(PLAIN)
            for t in op6_licences.TEMPLATES[family]:
                named = {f for f, _ in left.found(t)} - {"unknown"}
                assert not named, (t, named)


def test_learning_takes_whole_paragraphs_without_templates(spark):
    rows = ["The rules of the house apply under the law of the river.\n" + "long " * 40, "Licensed under the MIT license.", None, "", " \n"]
    seen = []

    class Noted(op6_licences.Classifier):
        def __init__(self, plain):
            seen.extend(plain)

    before, op6_licences.Classifier = op6_licences.Classifier, Noted
    try:
        op6_licences.fit(spark.createDataFrame([(r,) for r in rows], "text string"), sample_chars=100)
    finally:
        op6_licences.Classifier = before
    assert seen == [op6_licences.words_of(rows[0].split("\n")[0])]


def test_chat_roles_of_conversations_not_learned_from(spark, folder):
    ship(spark)
    talk = spark.read.parquet(f"{folder}/conversations.parquet")
    part = op3_chat.transcript_part(*(F.col(c) for c in ("conv_id", "turn", "role", "text")))
    parts = talk.select(F.col("conv_id").alias("conv"), F.col("turn").alias("part"), "role", part.alias("text"))
    held = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    unseen = parts.where(held)
    found = op3_chat.parsed(unseen.drop("role"), op3_chat.fit(parts.where(~held)))
    got = [(r["conv"], r["role"], r["canonical"]) for r in found.collect()]
    want = {(r["conv_id"], r["role"], op3_chat.rendered(r["role"], r["text"].split("\n")))
            for r in talk.withColumnRenamed("conv_id", "conv").where(held).withColumnRenamed("conv", "conv_id").collect()}
    assert want and len(set(got) & want) > 0.9 * len(want)


def test_language_is_learned_without_moving_texts(spark, folder):
    """Only the smallest hashes of each language are learned from, and no shuffle holds a text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    few, _ = op9_langid.fit(docs, "doc_id", "text", "lang", F.lit(True), fit_rows=3)
    names, prototypes = op9_langid.fit(docs, "doc_id", "text", "lang", F.lit(True), fit_rows=40)
    assert few == names == sorted(r[0] for r in docs.select("lang").where("lang is not null").distinct().collect())
    told = op9_langid.predict(docs.where("lang is not null"), F.col("text"), names, prototypes).where("language.lang_pred <> 'und'")
    assert told.where("language.lang_pred = lang").count() > 0.95 * told.count()
