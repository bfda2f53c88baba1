"""From raw source rows to the three collected monthly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import FULL, Layout
from lunario.functions import lenient_timestamp, month_of_abbreviation, strict_date
from lunario.operators.rows import drop_incomplete, keep_first, nan_to_null


def collect_price(
    raw: DataFrame, series: list[str] = [], layout: Layout = FULL, keep: list[str] = []
) -> DataFrame:
    """Price rows with the month name turned into a number; ``keep`` names further columns."""
    return (
        raw.withColumnsRenamed({"Anio": "anio", "Mes": "mes"})
        .withColumn("mes", month_of_abbreviation(F.col("mes")))
        .select(*series, *layout.price_table, *keep)
    )


def collect_rain(
    raw: DataFrame, series: list[str] = [], layout: Layout = FULL, keep: list[str] = []
) -> DataFrame:
    """Rainfall rows with year and month of their ISO date; repeated months stay."""
    day = strict_date(F.col("date"))
    dated = raw.withColumns({"mes": F.month(day), "anio": F.year(day)})
    return nan_to_null(dated.select(*series, *layout.rain_table, *keep))


def collect_bank(
    raw: DataFrame,
    series: list[str] = [],
    source_order: str = "source_order",
    layout: Layout = FULL,
) -> DataFrame:
    """Bank rows, first row per parsed timestamp, complete rows only.

    The first row wins before incomplete rows are dropped: a month whose first
    row is incomplete is lost. All unreadable dates count as one timestamp.
    """
    parsed = raw.withColumn(schema.PERIOD, lenient_timestamp(F.col(schema.PERIOD)))
    first = keep_first(parsed, [*series, schema.PERIOD], source_order)
    dated = first.withColumns(
        {"anio": F.year(schema.PERIOD), "mes": F.month(schema.PERIOD)}
    )
    projected = dated.select(*series, *layout.bank_table)
    return drop_incomplete(projected, layout.bank_table)
