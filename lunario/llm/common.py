"""Small pieces shared by the text operators: reading, words, staging, row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.session import stage_table

#: The white space of every word rule here: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Stands for a missing id where ids are ordered or joined: before all others.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between runs of white space, as an array; none for a blank text."""
    return F.filter(F.split(text, SPACE_RUN, -1), lambda word: word != "")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small driver-made table, for statistics of bounded size."""
    return spark.createDataFrame(rows, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again."""
    return stage_table(df, f"llm-{label}")


def with_next(keys: DataFrame, key: str) -> DataFrame:
    """Adds ``next_key``: the next larger value of the unique column ``key``, the smallest after the last.

    Ranges of the key are dealt to partitions, the follower is found inside
    each range, and the last row of a range takes the first key of the next
    range, from a table of one row per range. No task sees all keys.
    """
    spark = keys.sparkSession
    ranged = staged(
        keys.repartitionByRange(shuffle_width(spark), key).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranges",
    )
    inside = Window.partitionBy("_range").orderBy(key)
    firsts = ranged.groupBy("_range").agg(F.min(key).alias("_first"))
    order = Window.partitionBy(F.lit(0)).orderBy("_range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = firsts.select(
        "_range",
        F.coalesce(F.lead("_first").over(order), F.min("_first").over(whole)).alias("_after"),
    )
    return (
        ranged.withColumn("_inside", F.lead(key).over(inside))
        .join(starts, "_range")
        .withColumn("next_key", F.coalesce("_inside", "_after"))
        .drop("_range", "_inside", "_after")
    )


def text_hash() -> Column:
    """Tells rows of one id apart; a null text hashes as the empty one."""
    return F.xxhash64(whole_text())


def _row_hash(docs: DataFrame) -> Column:
    """Tells rows apart by all their columns; a null counts by its place."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def carried(docs: DataFrame, chosen: DataFrame, *also: str) -> DataFrame:
    """Rows of ``docs`` with all their columns, as often as ``chosen`` says.

    ``chosen`` has ``doc_id, text_hash, copies, rows`` and the columns ``also``:
    the copies that all ``rows`` rows of one id and text (and equal in ``also``)
    get together. Each row gets its even share; what is left over goes to the
    rows of least hash of all columns, so the result does not follow partitions.
    Whole rows are shuffled once; only rows that share a rest meet in an aggregate.
    """
    named = chosen.where("copies > 0").select(
        F.col("doc_id").alias("_id"),
        F.col("text_hash").alias("_hash"),
        *[F.col(c).alias(f"_named_{c}") for c in also],
        F.expr("int(copies div rows)").alias("_each"),
        F.expr("int(copies % rows)").alias("_rest"),
    )
    own = [f"_own_{c}" for c in also]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col("doc_id").alias("_key"),
        text_hash().alias("_text"),
        *[F.col(c).alias(o) for c, o in zip(also, own, strict=True)],
        _row_hash(docs).alias("_row"),
    )
    same = keyed["_key"].eqNullSafe(named["_id"]) & (keyed["_text"] == named["_hash"])
    for c, o in zip(also, own, strict=True):
        same = same & keyed[o].eqNullSafe(named[f"_named_{c}"])
    found = keyed.join(named, same)
    group = ["_key", "_text", *own]
    even = found.where("_each > 0").select("_doc", F.col("_each").alias("_copies"))
    one = (
        found.where("_rest = 1")
        .groupBy(*group)
        .agg(F.min_by("_doc", "_row").alias("_doc"))
        .select("_doc", F.lit(1).alias("_copies"))
    )
    # Full repeats are counted first, so a window holds the different rows only.
    ahead = Window.partitionBy(*group).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    several = (
        found.where("_rest > 1")
        .groupBy(*group, "_row")
        .agg(F.first("_doc").alias("_doc"), F.count(F.lit(1)).alias("_n"), F.first("_rest").alias("_rest"))
        .withColumn("_left", F.col("_rest") - F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        .where("_left > 0")
        .select("_doc", F.least("_n", "_left").cast("int").alias("_copies"))
    )
    dealt = even.unionByName(one).unionByName(several)
    times = F.explode(F.sequence(F.lit(1), "_copies"))
    return dealt.select("_doc", times.alias("_time")).select("_doc.*")
