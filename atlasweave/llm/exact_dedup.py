"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Rows are merged in three steps, each of which groups by digest *and* full content:
inside a task (the map side of the first aggregation), inside a salt of map tasks,
and over the salts. However many copies a text has, no task receives more rows of
it than there are map tasks in a salt, and then no more than there are salts.

Groups of one need nothing further; the winners of larger groups are written to the
shared scratch folder and joined back to (doc_id, digest) rows, a join of narrow
rows that adaptive execution splits where a digest is hot.

Defined cases: null text counts as empty. Null doc_id is never smaller than another;
a group of null ids only has a null keep_id. Rows that repeat both doc_id and text
are one document each: exactly one of them is kept. An empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.llm.catalog import query, table
from atlasweave.session import scratch_path


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty.

    Single spaces, nearly all of the runs, are left alone by the pattern.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def text_digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def winners(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, body, keep_id, n, texts) of every group of ``rows`` (doc_id, digest, body).

    ``texts`` is the number of different contents under the digest: 1, unless it collides.
    """
    salted = rows.groupBy("digest", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), "body").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    merged = salted.repartition("digest").groupBy("digest", "body").agg(
        F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    return merged.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("digest")))


def exact_duplicates(docs: DataFrame, salts: int = 32, digest=text_digest) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    ``digest`` maps the normalised text to a grouping key; any function gives right
    results, since contents are compared wherever keys meet.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", normalised(F.col("text")).alias("body")).select(
        "doc_id", digest(F.col("body")).alias("digest"), "body")
    path = scratch_path(spark, "exact-groups")
    winners(rows, salts).where("n > 1").select(
        F.col("digest").alias("g_digest"), F.when(F.col("texts") > 1, F.col("body")).alias("g_body"),
        F.col("keep_id").alias("g_keep"), F.col("n").alias("g_n"),
    ).write.parquet(path)
    groups = spark.read.parquet(path)
    narrow = rows.select("doc_id", "digest")
    clashing = groups.where("g_body IS NOT NULL")
    on_digest = F.col("digest") == F.col("g_digest")
    if clashing.isEmpty():
        found = narrow.join(groups, on_digest, "left")
    else:
        keys = clashing.select("g_digest").distinct()
        by_body = rows.join(keys, on_digest, "left_semi").join(
            clashing, on_digest & (F.col("body") == F.col("g_body")), "left").drop("body")
        found = rows.join(keys, on_digest, "left_anti").drop("body").join(
            groups.where("g_body IS NULL"), on_digest, "left").unionByName(by_body)
    found = found.select(
        "doc_id", "digest", F.when(F.col("g_n").isNull(), F.col("doc_id")).otherwise(F.col("g_keep")).alias("keep_id"),
        F.coalesce("g_n", F.lit(1)).alias("group_size"))
    # Only rows that carry the winning id of a larger group can repeat it.
    candidate = (F.col("group_size") > 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    numbered = found.withColumn(
        "slot", F.when(candidate, F.hex("digest")).otherwise(F.monotonically_increasing_id().cast("string")))
    first = F.row_number().over(Window.partitionBy("slot", "keep_id").orderBy("doc_id")) == 1
    return numbered.withColumn("first", first).select(
        "doc_id", "keep_id", "group_size", ((F.col("group_size") == 1) | (candidate & F.col("first"))).alias("kept"), "digest")


def deduplicated(docs: DataFrame, salts: int = 32) -> DataFrame:
    """``docs`` without exact duplicates, all columns kept.

    Of rows that repeat both doc_id and text, one stays.
    """
    kept = exact_duplicates(docs, salts).where("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("digest").alias("__kept_digest"))
    keyed = docs.withColumn("__digest", text_digest(normalised(F.col("text"))))
    return keyed.join(
        kept, keyed["doc_id"].eqNullSafe(kept["__kept_id"]) & (keyed["__digest"] == kept["__kept_digest"]), "left_semi",
    ).dropDuplicates(["doc_id", "__digest"]).drop("__digest")


@query("op7_exact_dedup", sql=r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
    g AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest doc_id of its equal texts."""
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
