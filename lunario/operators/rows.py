"""Row-level operators: null drop, keep-first dedupe, projections."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating-point columns, so that null rules cover both."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    chosen = [c for c in (columns or df.columns) if c in floating]
    if not chosen:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in chosen})


def complete(df: DataFrame, columns: list[str] | None = None) -> Column:
    """No NULL and no NaN in ``columns`` (default: all).

    One conjunct per column: each reaches the scan by itself, and the planner's
    constraint inference stays linear where columns are renamed further up.
    """
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    tests = []
    for c in columns or df.columns:
        tests.append(F.col(c).isNotNull())
        if c in floating:
            tests.append(~F.isnan(c))
    return reduce(and_, tests)


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any of ``columns`` (default: all)."""
    return df.where(complete(df, columns))


def keep_first(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """One row per key: the one with the smallest ``order``; NULL keys form one group.

    ``min_by`` combines on the map side, so a key that fills a third of the table
    shrinks to one row per task before the shuffle. ``order`` must not be NULL.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), order)
    return (
        df.groupBy(*keys)
        .agg(first.alias("__first"))
        .select(*[F.col(c) if c in keys else F.col("__first")[c].alias(c) for c in df.columns])
    )


def take_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    if not columns:
        raise ValueError("give at least one column")
    return df.select(*[c for c in columns if c in df.columns])
