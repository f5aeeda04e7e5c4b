"""Benchmark decontamination: size-partitioned MinHash containment search, built-in functions only.

A document contains an item if it has at least ``PERCENT`` of the item's distinct shingles of five words (lower-cased runs of
letters and digits). Items are partitioned by size, doubling from partition to partition. An item's sketch is
its bottom-k MinHash, with k from the largest size u of its partition: more than u (100 - PERCENT) / 100 of the shingles. A
document that lacks all of them lacks too many to contain the item, so no item is missed, however long the document. (Sketching
the documents too, as for sets of like size, would lose a test item of thirty shingles in a text of twenty
thousand.) Documents are searched with all their shingles; what shares a sketch is verified by exact containment.

If the benchmark's sketches and shingles are few (counted first, see LIMIT), each document is searched and verified within its
row, without a shuffle. Beyond that, sketches and shingles are joined.

Defined results: an item with fewer than five words is one shingle of all its words; items and documents without words
match nothing; null ids are returned as such; repeated rows of a document or an item give their pairs once for each row of the
document and each different text of the item. Only the columns asked for are read.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.scratch import written

SIZE = 5
PERCENT = 80
LIMIT = 4096  # sketch entries that are put into the plan; the items' shingles may be 16 times as many


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words; an empty array if there are fewer."""
    runs = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))
    return F.slice(runs, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)))


def item_shingles(items: DataFrame, item_col: str, text: Column, size: int, percent: int) -> DataFrame:
    """(item, length, grams, sketch): distinct items with words."""
    w = F.col("w")
    short = reduce(lambda rest, n: F.when(F.size(w) == n, shingles(w, n)).otherwise(rest), range(1, size), shingles(w, size))
    rows = items.select(F.col(item_col).alias("item"), words_of(text).alias("w")).where(F.size("w") > 0).distinct()
    rows = rows.select("item", F.least(F.size("w"), F.lit(size)).alias("length"), F.array_distinct(short).alias("grams"))
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("grams"))) + 1) - 1  # of its partition
    k = (F.floor(largest * (100 - percent) / 100) + 1).cast("int")
    ordered = F.array_sort(F.transform("grams", lambda g: F.struct(F.xxhash64(g, F.lit("order")).alias("r"), g.alias("g"))))
    return rows.withColumn("sketch", F.transform(F.slice(ordered, F.lit(1), k), lambda x: x["g"]))


def contains(common: Column, of: Column, percent: int) -> Column:
    return 100 * common >= percent * of


def contaminated(docs: DataFrame, items: DataFrame, id_cols: list[str], text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", size: int = SIZE, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """(id_cols, item, n_item, n_common): every document row with every item it contains."""
    known = written(item_shingles(items, item_col, F.col(item_text), size, percent), "items")
    totals = known.agg(F.sum(F.size("sketch")).alias("s"), F.sum(F.size("grams")).alias("g"),
                       F.collect_set("length").alias("lengths")).first()
    lengths = sorted({size, *totals["lengths"]})
    w = F.col("w")
    grams = docs.select(*id_cols, words_of(F.col(text_col)).alias("w"))
    grams = grams.withColumn("grams", F.concat(*[shingles(w, n) for n in lengths])).drop("w")
    few = (totals["s"] or 0) <= limit and (totals["g"] or 0) <= 16 * limit
    return within_rows(grams, known, id_cols, percent) if few else by_joins(grams, known, id_cols, percent)


def within_rows(grams: DataFrame, known: DataFrame, id_cols: list[str], percent: int) -> DataFrame:
    """No filter comes before the last step: pushed below, it would put the shingles' expression, and with it the
    splitting of the text, inside its own lambda."""
    items = known.select("item", "grams", "sketch").collect()  # bounded: counted before
    item = known.schema["item"].dataType.simpleString()
    every = F.from_json(F.lit(json.dumps(sorted({g for i in items for g in i["sketch"]}))), "array<bigint>")
    listed = F.from_json(F.lit(json.dumps([{"item": i["item"], "of": i["grams"], "sketch": i["sketch"]} for i in items])),
                         f"array<struct<item:{item},of:array<bigint>,sketch:array<bigint>>>")
    found = grams.withColumn("hits", F.array_intersect(every, "grams"))
    candidates = F.when(F.size("hits") > 0, F.filter(listed, lambda i: F.arrays_overlap(i["sketch"], F.col("hits"))))
    pairs = (found.select(*id_cols, "grams", F.explode_outer(candidates).alias("i"))
             .select(*id_cols, F.col("i.item").alias("item"), F.size("i.of").alias("n_item"),
                     F.size(F.array_intersect("i.of", "grams")).alias("n_common")))
    return pairs.where((F.col("n_item") > 0) & contains(F.col("n_common"), F.col("n_item"), percent))


def by_joins(grams: DataFrame, known: DataFrame, id_cols: list[str], percent: int) -> DataFrame:
    """The same for a benchmark of any size. ``row`` tells equal rows apart."""
    rows = written(grams.select(*id_cols, F.monotonically_increasing_id().alias("row"), F.array_distinct("grams").alias("grams")),
                   "rows")
    items = written(known.select("item", F.monotonically_increasing_id().alias("at"), "grams", "sketch"), "numbered")
    single = rows.select("row", F.explode("grams").alias("g"))
    candidates = written(single.join(written(items.select("at", F.explode("sketch").alias("g")), "sketches"), "g")
                         .select("row", "at").distinct(), "candidates")
    wanted = candidates.join(items.select("at", F.explode("grams").alias("g")), "at")
    common = wanted.join(single, ["row", "g"]).groupBy("row", "at").agg(F.count(F.lit(1)).cast("int").alias("n_common"))
    pairs = common.join(items.select("at", "item", F.size("grams").alias("n_item")), "at")
    pairs = pairs.where(contains(F.col("n_common"), F.col("n_item"), percent))
    return rows.select(*id_cols, "row").join(pairs, "row").select(*id_cols, "item", "n_item", "n_common")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          size: int = SIZE, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """The documents that contain no item, with their own columns."""
    row = "__row"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = contaminated(numbered, items, [row], text_col, item_col, item_text, size, percent, limit)
    found = written(found.select(row).distinct(), "contaminated")
    return numbered.join(found, row, "left_anti").select(*docs.columns)
