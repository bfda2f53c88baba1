"""Join of the collected sources and the labelled, feature and training tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import FULL, Layout
from lunario.functions import gdp_number, index_number, period_label
from lunario.operators.rows import drop_incomplete, take_columns
from lunario.operators.windows import over_series, rolling


_REPAIRED = "__repaired"


def join_periods(left: DataFrame, right: DataFrame, series: list[str] = []) -> DataFrame:
    """Inner join on series and month. NULL keys match nothing; repeated months multiply."""
    return left.join(right, [*series, *schema.TIME_COLS], "inner")


def merge_sources(
    price: DataFrame,
    rain: DataFrame,
    bank: DataFrame,
    series: list[str] = [],
    *,
    layout: Layout = FULL,
    tie_break: list[str] = [],
    include_open_period: bool = False,
    **scale,
) -> DataFrame:
    """Three-source table, one row per observed month, with the next row's price as label.

    Incomplete rows are dropped. The newest month of a series has no label yet;
    it is kept, unlabelled, only with ``include_open_period``. Where a month can
    repeat within a series, ``tie_break`` columns settle the row order.
    """
    joined = join_periods(join_periods(price, rain, series), bank, series)
    labelled = over_series(
        joined,
        series,
        [*schema.TIME_COLS, *tie_break],
        {
            schema.TARGET: lambda w: F.lead(layout.price, 1).over(w),
            "__newest": lambda w: F.lead(F.lit(1), 1).over(w).isNull(),
        },
        after=1,
        **scale,
    )
    complete = drop_incomplete(labelled, layout.merged)
    labelled_row = F.col(schema.TARGET).isNotNull() & ~F.isnan(schema.TARGET)
    wanted = labelled_row | F.col("__newest") if include_open_period else labelled_row
    return complete.where(wanted).select(*series, *tie_break, *layout.merged, schema.TARGET)


def repair_numbers(
    df: DataFrame, columns: Iterable[str], kind: str, strict: bool = True
) -> DataFrame:
    """Repair the listed columns that exist and are text; ``kind`` is ``gdp`` or ``index``.

    The columns are repaired as one array, so that the repair stands in the plan
    once and wide tables stay within generated code.
    """
    repair = {"gdp": gdp_number, "index": index_number}[kind]
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    chosen = [c for c in dict.fromkeys(columns) if c in text]
    if not chosen:
        return df
    cells = F.array(*[F.col(f"`{c}`") for c in chosen])
    repaired = df.withColumn(_REPAIRED, F.transform(cells, lambda cell: repair(cell, strict)))
    return repaired.withColumns(
        {c: F.col(_REPAIRED)[i] for i, c in enumerate(chosen)}
    ).drop(_REPAIRED)


def monthly_features(
    merged: DataFrame,
    series: list[str] = [],
    *,
    layout: Layout = FULL,
    tie_break: list[str] = [],
    **scale,
) -> DataFrame:
    """Repair, rolling mean and deviation, then the feature columns, keyed by period label."""
    repaired = repair_numbers(merged, layout.gdp, "gdp")
    repaired = repair_numbers(repaired, layout.index, "index")
    order = [*schema.TIME_COLS, *tie_break]
    rolled = rolling(repaired, series, order, layout.values, ["mean", "std"], **scale)
    keyed = rolled.withColumn(schema.PERIOD, period_label(F.col("anio"), F.col("mes")))
    keep = [*series, schema.PERIOD, schema.TARGET, *layout.features]
    return take_columns(keyed, keep)


def training_table(features: DataFrame) -> DataFrame:
    """Complete labelled rows: the first row of each series goes, its deviation is unknown."""
    return drop_incomplete(features)


def feature_store(features: DataFrame, include_open_period: bool = False) -> DataFrame:
    """Scoring rows without the label; the open month only on request."""
    required = [c for c in features.columns if c != schema.TARGET or not include_open_period]
    return drop_incomplete(features, required).drop(schema.TARGET)
