"""Distribution profiles of training features, and how far new data has moved from them.

A profile has one row per feature: the exact inner quantile edges of the training
values, how many values lie between them and how many are missing, and a quantile
sketch. Counts on the same edges add up and sketches merge, so profiles of several
months or regions combine without the data. A comparison counts the new values at the
stored edges, in one pass whatever the number of features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lunario.operators.information import BINS, bin_edges

#: Stands for an empty bin in the stability index, so that its logarithm exists.
SMOOTHING = 0.5


def _unpivoted(df: DataFrame, features: list[str]) -> DataFrame:
    values = [
        F.struct(F.lit(i).alias("position"), F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias("x"))
        for i, c in enumerate(features)
    ]
    return df.select(F.inline(F.array(*values)))


def _counts(bins: int) -> Column:
    """Rows per bin, in single precision as the edges are, and of the missing values at the end."""
    x = F.col("x").cast("float")
    place = F.size(F.filter("edges", lambda edge: edge < x))
    per_bin = [F.count(F.when(F.col("x").isNotNull() & (place == b), 1)) for b in range(bins)]
    return F.array(*per_bin, F.count(F.when(F.col("x").isNull(), 1)))


def profile(df: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """(position, feature, edges, counts, sketch) of each feature; ``df`` is read a few times."""
    edges = bin_edges(df, features, bins)
    table = df.sparkSession.createDataFrame(
        [(i, c, edges[c]) for i, c in enumerate(features)],
        "position int, feature string, edges array<float>",
    )
    # One row per feature, whatever the data size.
    values = _unpivoted(df, features).join(F.broadcast(table), "position")
    return values.groupBy("position", "feature", "edges").agg(
        _counts(bins).alias("counts"), F.kll_sketch_agg_double("x").alias("sketch")
    )


def merge_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """One profile of two on the same features and edges."""
    keys = ["position", "feature", "edges"]
    both = left.unionByName(right)
    added = F.transform(
        F.sequence(F.lit(0), F.size(F.get("all", F.lit(0))) - 1),
        lambda b: F.aggregate("all", F.lit(0).cast("bigint"), lambda total, counts: total + F.get(counts, b)),
    )
    merged = both.groupBy(*keys).agg(
        F.collect_list("counts").alias("all"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(*keys, added.alias("counts"), "sketch")


def drift(stored: DataFrame, df: DataFrame) -> DataFrame:
    """(position, feature, n_before, n_now, psi, ks) of new data against a stored profile.

    ``psi`` is the population stability index over the bins and the missing values,
    ``ks`` the largest difference of the two shares below an edge. A feature without
    new values has no ``ks``.
    """
    rows = stored.orderBy("position").collect()
    features = [r["feature"] for r in rows]
    bins = len(rows[0]["edges"]) + 1
    table = stored.select("position", "feature", "edges", F.col("counts").alias("before"))
    now = (
        _unpivoted(df, features)
        .join(F.broadcast(table), "position")
        .groupBy("position", "feature", "edges", "before")
        .agg(_counts(bins).alias("now"))
    )

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda sum_, n: sum_ + n)

    def share(n: Column, whole: Column) -> Column:
        return (n + SMOOTHING) / (whole + SMOOTHING * (bins + 1))

    def index(old: Column, new: Column) -> Column:
        p, q = share(old, F.col("n_before")), share(new, F.col("n_now"))
        return (p - q) * F.log(p / q)

    def below(counts: str, edge: Column) -> Column:
        seen = total(F.slice(counts, 1, bins))
        return F.try_divide(total(F.slice(counts, F.lit(1), edge)).cast("double"), seen)

    steps = F.sequence(F.lit(1), F.lit(bins - 1))
    terms = F.zip_with("before", "now", index)
    counted = now.withColumn("n_before", total(F.col("before"))).withColumn("n_now", total(F.col("now")))
    return counted.select(
        "position",
        "feature",
        "n_before",
        "n_now",
        F.aggregate(terms, F.lit(0.0), lambda sum_, term: sum_ + term).alias("psi"),
        F.array_max(F.transform(steps, lambda i: F.abs(below("before", i) - below("now", i)))).alias("ks"),
    )
