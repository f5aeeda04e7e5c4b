"""Exact dedup by deterministic block naming, in built-in functions.

A normalised text (A-Z in lower case) is cut into blocks of a fixed number of bytes. The distinct blocks are sorted, and a
block's place in that order is its name. Then adjacent names are paired, the distinct pairs are named the same way, and so
on: after k rounds a name stands for 2**k blocks, and in the end every document has one name. Names are equal only where
the bytes are equal; no fingerprint takes part, so no collision can.

Blocks and pairs that occur once in the corpus get no name: a document with one of them has no copy and is done. So the
contents of all blocks go through two shuffles, one that counts and one that joins, and the rounds of pairs handle
only documents that are made of repeated blocks, sixteen bytes a pair. Counts are combined before the shuffle, and the
joins have a shuffle on either side, which lets Spark split the copies of one block over several tasks.

Defined results: a null text counts as empty; equal ids do not make documents equal; of rows with equal text the one of the
largest id stays, a null id is the smallest, and of repeated rows with that id one stays. Texts of any length are read
whole. Only the columns asked for are read, whatever the others are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.scratch import discard, written

BLOCK = 4096  # bytes


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; a null is empty."""
    text = F.coalesce(text, F.lit(""))
    # in pure ASCII the built-in lower() changes A-Z only, and is much faster
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def blocks(docs: DataFrame, text: Column, size: int, *more: Column) -> DataFrame:
    """(blocks, pos, block, more...): every block of every row. ``more`` is worked out before the text is cut."""
    whole = docs.select(normalised(text).cast("binary").alias("whole"), *more)
    whole = whole.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("whole") / size)).cast("int"))
    cut = whole.withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.withColumn("block", F.substring(F.col("whole"), F.col("pos") * size + 1, F.lit(size))).drop("whole")


def names(parts: DataFrame, name: str) -> DataFrame:
    """The distinct rows that occur twice or more, each with an integer ``name``: its place in the sorted rows of its
    partition, after those of the partitions before."""
    key = parts.columns
    several = parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    return written(several.sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id()), name)


def identities(docs: DataFrame, id_col: str, text: Column, size: int = BLOCK) -> DataFrame:
    """(row, id, text_sha256, blocks, name): a row for every row of ``docs``, numbered by ``row``. Rows have equal texts if
    and only if they have equal ``blocks`` and ``name``; no ``name`` means that there is no copy."""
    repeated = names(blocks(docs, text, size).select("block"), "blocks")
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("sha")
    first = F.col("pos") == 0  # the row's own columns go with its first block
    found = blocks(whole, F.col("text"), size, F.col("row"), F.col("id"), sha).select(
        "row", F.when(first, F.col("id")).alias("id"), F.when(first, F.col("sha")).alias("text_sha256"), "blocks", "pos", "block")
    level = written(found.join(repeated, "block", "left").drop("block"), "level")
    discard(repeated)

    final = level.where("blocks = 1 and name is not null").select("row", "name")
    most = level.agg(F.max("blocks")).first()[0] or 1
    left, used = level.where("blocks > 1 and name is not null").select("row", F.col("blocks").alias("m"), "pos", "name"), []
    while most > 1:
        at = F.col("pos") % 2 == 0
        pairs = (left.groupBy("row", "m", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max(F.when(at, F.col("name"))).alias("a"), F.max(F.when(~at, F.col("name"))).alias("b"))
                 .where(F.col("a").isNotNull() & (F.col("b").isNotNull() | (F.col("pos") * 2 + 1 == F.col("m"))))
                 .select("row", F.ceil(F.col("m") / 2).cast("int").alias("m"), "pos", "a", F.coalesce("b", F.lit(-1)).alias("b")))
        pairs = written(pairs, "pairs")
        known = names(pairs.select("a", "b"), "names")
        named = written(pairs.join(known, ["a", "b"]).select("row", "m", "pos", "name"), "level")
        discard(pairs, known)
        used.append(named)
        final = final.unionByName(named.where("m = 1").select("row", "name"))
        left = named.where("m > 1")
        most = -(-most // 2)
    rows = written(level.where("pos = 0").select("row", "id", "text_sha256", "blocks").join(final, "row", "left"), "identities")
    discard(level, *used)
    return rows


def decided(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """(row, id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    rows = identities(docs, id_col, F.col(text_col), size)
    copies = rows.where("name is not null")
    groups = copies.groupBy("blocks", "name").agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    columns = ["row", "id", "keep_id", "group_size", "kept", "text_sha256"]
    # the groups are a table of their own: both sides are then shuffled for the join, and Spark may split a hot group
    grouped = copies.join(written(groups, "groups"), ["blocks", "name"]).withColumns(
        {"keep_id": F.col("keep.id"), "kept": F.col("row") == F.col("keep.row")})
    single = rows.where("name is null").withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    return grouped.select(*columns).unionByName(single.select(*columns))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, as they are."""
    kept = decided(docs, id_col, text_col, size).where("kept").select(F.col("id").alias("__id"), F.col("text_sha256").alias("__sha"))
    found = docs.withColumn("__of", F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    found = found.join(kept, found[id_col].eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__sha")), "left_semi")
    return found.dropDuplicates([id_col, "__of"]).select(*docs.columns)
