"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_nonempty(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: row count, column count and whether both are positive."""
    reports = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            ((F.col("n_rows") > 0) & F.lit(len(df.columns) > 0)).alias("valid"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def require_nonempty(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself, or an error when it has no columns or no rows (reads one row)."""
    if not df.columns or df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df
