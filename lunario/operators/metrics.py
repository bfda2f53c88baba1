"""Model quality measures, column statistics and closed-form one-feature ridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """One row: n, mse, rmse, r2, in a single pass.

    ``mse`` is the figure that some reports label RMSE; ``rmse`` is its root.
    """
    pairs = df.select(actual.cast("double").alias("y"), predicted.cast("double").alias("p"))
    squared = F.pow(F.col("y") - F.col("p"), F.lit(2.0))
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(squared).alias("mse"),
        F.var_pop("y").alias("variance"),
    )
    return sums.select(
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "variance")).alias("r2"),
    )


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: mean and population deviation, all columns in one pass."""
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.avg(F.col(c).cast("double")).alias(f"m{i}"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"),
        ]
    entries = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std")
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def ridge_line(df: DataFrame, x: str, y: str, alpha: float) -> DataFrame:
    """Slope and intercept of one-feature ridge from a single pass of moments."""
    moments = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop(x, y).alias("cov"),
        F.var_pop(x).alias("var"),
        F.avg(x).alias("mx"),
        F.avg(y).alias("my"),
    )
    slope = F.col("cov") * F.col("n") / (F.col("var") * F.col("n") + F.lit(float(alpha)))
    return moments.select(slope.alias("slope"), "mx", "my").select(
        "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept")
    )


def promotion_gate(metrics: DataFrame) -> DataFrame:
    """The metrics row with a verdict: error and r2 must both be positive."""
    passed = (F.col("mse") > 0) & (F.col("r2") > 0)
    return metrics.withColumn("promoted", F.coalesce(passed, F.lit(False)))
