"""Exact deduplication with a split for heavy hitters, in DataFrame functions only.

Texts are equal when their digests are, taken after deleting white space. A
frequent-items summary of the Misra-Gries kind (``approx_top_k``: a bounded set
of counters, decremented together when full) names the digests that may hold a
large share of the rows. An exact pass verifies their winners; that table is
bounded by ``HEAVY`` rows, so it is broadcast and settles those rows on the map
side. All other digests are settled in one ordinary shuffle of light rows.

Null texts count as empty, null ids sort last, rows equal in text and id are
separate rows of which one stays, further columns are carried by
``deduplicated`` and ignored by ``decisions``. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.llm.common import SPACES, carried, staged, text_hash, whole_text

#: Digests at most that are settled on the map side, and counters of the summary.
HEAVY = 256
COUNTERS = 4096
#: Summaries are merged in this many groups first, so that no task merges all.
MERGE_GROUPS = 64


def digest_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without white space."""
    return F.sha2(F.encode(F.translate(text, SPACES, ""), "UTF-8"), 256)


def heavy_digests(light: DataFrame) -> DataFrame:
    """At most ``HEAVY`` digests that may be frequent, by a mergeable summary of bounded counters."""
    parts = light.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {COUNTERS})").alias("s")
    )
    # Merged as a group, not as a whole table: empty partitions then have no summary.
    top = (
        parts.groupBy(F.lit("all").alias("all"))
        .agg(F.expr(f"approx_top_k_combine(s, {COUNTERS})").alias("s"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(s, {HEAVY})")).alias("t"))
    )
    return top.where("t.count > 1 AND t.item IS NOT NULL").select(
        F.col("t.item").alias("text_sha256")
    ).limit(HEAVY)


def decisions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_hash."""
    text = whole_text()
    light = staged(
        docs.select("doc_id", text.alias("text"))
        .select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            text_hash().alias("text_hash"),
            digest_of(F.col("text")).alias("text_sha256"),
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "digests",
    ).select(
        "*",
        F.struct(
            (-F.col("n_chars")).alias("shorter"),
            F.col("doc_id").isNull().alias("no_id"),
            "doc_id",
            "text_hash",
            "row",
        ).alias("rank"),
    )
    heavy = staged(
        light.join(F.broadcast(heavy_digests(light)), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("group_size")),
        "heavy",
    )
    marked = light.join(F.broadcast(heavy), "text_sha256", "left")
    same = Window.partitionBy("text_sha256")
    by_shuffle = (
        marked.where(F.col("first").isNull())
        .withColumn("first", F.min("rank").over(same))
        .withColumn("group_size", F.count(F.lit(1)).over(same))
    )
    settled = marked.where(F.col("first").isNotNull()).unionByName(by_shuffle)
    return settled.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_sha256",
        "text_hash",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    chosen = (
        staged(decisions(docs), "decisions")
        .groupBy("doc_id", "text_hash")
        .agg(F.max(F.col("kept").cast("int")).alias("copies"), F.count(F.lit(1)).alias("rows"))
    )
    return carried(docs, chosen)
