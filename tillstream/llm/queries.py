"""The operators' queries with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (op1_shards, op2_bpe, op3_chat, op4_decontaminate, op5_quality, op6_licences, op7_warc,
                            op8_jaccard, op9_langid, op10_substring, op11_resample, op12_exact, op13_periodic)
from tillstream.llm.scratch import ship

RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op1_shards.sharded(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "group_rows")


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    of = op2_bpe.digests(spark, F.col("text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return docs.select("doc_id", of.alias("d")).select("doc_id", "d.*")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learned from the conversations that are not held out; all are parsed."""
    rows = table(spark, sf_dir, "conversations")
    part = op3_chat.transcript_part(*(F.col(c) for c in ("conv_id", "turn", "role", "text")))
    parts = rows.select(F.col("conv_id").alias("conv"), F.col("turn").alias("part"), "role", part.alias("text"))
    held_out = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = op3_chat.parsed(parts.drop("role"), op3_chat.fit(parts.where(~held_out)))
    return found.withColumn("held_out", held_out).withColumnRenamed("conv", "conv_id")


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return op4_decontaminate.contaminated(docs, items, ["doc_id"]).withColumnRenamed("item", "item_id")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = op5_quality.judged(docs).select("doc_id", "quality.*")
    return m.select("doc_id", *[f"measures.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                          "n_repeat_words")], "base_failed", "kept")


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op6_licences.scan(docs, op6_licences.fit(docs)).select("doc_id", "licence.*")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = op7_warc.responses(table(spark, sf_dir, "pages"), "page_id", F.col("url"), F.col("html"))
    return op7_warc.derived(pages).withColumnRenamed("source", "page_id")


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = op8_jaccard.numbered(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return op8_jaccard.joined(docs).withColumnRenamed("doc", "doc_id")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    names, prototypes = op9_langid.fit(docs, "doc_id", "text", "lang", ~held_out)
    found = op9_langid.predict(docs.select("doc_id", "text"), F.col("text"), names, prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = op10_substring.numbered(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    found = op10_substring.digests(docs, op10_substring.repeats(docs))
    return found.withColumnRenamed("doc", "doc_id")


def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = op11_resample.resampled(docs, target).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op12_exact.decided(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = op13_periodic.analysed(docs, "doc_id", F.col("text"), seed, whole=False).withColumnRenamed("id", "doc_id")
    return found.drop("runs", "collapsed")


QUERIES = {
    "op1_shards": shards,
    "op2_bpe": bpe,
    "op3_chat": chat,
    "op4_decontaminate": decontaminate,
    "op5_quality": quality,
    "op6_licences": licences,
    "op7_warc": warc,
    "op8_jaccard": jaccard,
    "op9_language": language,
    "op10_substring": substring,
    "op11_resample": resample,
    "op12_exact": exact,
    "op13_periodic": periodic,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_LETTERS = r"'[\p{L}\p{N}]+'"


def _runs(w: str, n: str) -> str:
    """Every run of ``n`` words of a list, joined by a space, which no word holds."""
    return f"list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string({w}[i:i + {n} - 1], ' '))"


# plain definitions, for ids that are unique as in the given tables
SQL: dict[str, str] = {
    "op4_decontaminate": f"""
        WITH items AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), {_LETTERS}) AS w FROM benchmark),
             sized AS (SELECT *, least(len(w), 5) AS n FROM items WHERE len(w) > 0),
             sets AS (SELECT item_id, w, n, list_distinct({_runs('w', 'n')}) AS s FROM sized),
             wanted AS (SELECT item_id, w, n, len(s) AS n_item, unnest(s) AS g FROM sets),
             docs AS (SELECT doc_id, regexp_extract_all(lower(text), {_LETTERS}) AS w FROM documents),
             grams AS (SELECT doc_id, n, unnest(list_distinct({_runs('w', 'n')})) AS g
                       FROM docs, (SELECT DISTINCT n FROM sized))
        SELECT doc_id, item_id, CAST(n_item AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_common
        FROM grams JOIN wanted USING (n, g) GROUP BY doc_id, item_id, w, n_item HAVING 100 * count(*) >= 80 * n_item""",
    "op8_jaccard": f"""
        WITH RECURSIVE
             own AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS w FROM documents),
             sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct({_runs('w', '3')}) END AS s FROM own),
             grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
             links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
                       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
             reach AS (SELECT doc_id AS d, doc_id AS c FROM sets
                       UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.c = links.a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(c) FROM reach WHERE d = doc_id) AS component_id
        FROM sets""",
    "op10_substring": f"""
        WITH own AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
             wins AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS place, unnest({_runs('w', '20')}) AS win FROM own),
             nth AS (SELECT doc_id, place, row_number() OVER (PARTITION BY win ORDER BY doc_id, place) AS n FROM wins),
             gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS j FROM nth WHERE n > 1),
             spread AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM own),
             rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
                      FROM spread ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM own LEFT JOIN rest USING (doc_id)""",
    "op12_exact": """
        WITH own AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                     AS same FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(same) AS text_sha256
        FROM own WINDOW g AS (PARTITION BY same)""",
}
