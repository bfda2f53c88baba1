"""The three raw sources, rebuilt from the driver's star-schema tables.

A series is a nation. Orders give the price, line items the rainfall and the
bank figures. The facts are scanned once, column-pruned, joined to the dimension
that carries the nation and summed per nation and month with map-side partial
sums; what is left has the size nations x months. Whole-number sums keep the
result independent of row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import Layout
from lunario.session import stage_table
from lunario.sources.collectors import collect_bank, collect_price, collect_rain

SERIES = ["series"]

# The driver tables feed a narrower layout than the full 47 value columns.
LAYOUT = Layout(
    rain=tuple(schema.RAIN_COLS[:3]),
    gdp=tuple(schema.GDP_COLS[:4]),
    index=tuple(schema.INDEX_COLS[:3]),
)

MONTH_NAMES = "Ene Feb Mar Abr May Jun Jul Ago Sep Oct Nov Dic".split()

# Weights that make each derived figure its own mix of the month's line items.
GDP_MODULUS = 29
INDEX_MODULUS = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, Anio, Mes, price): mean order total per nation and month, in whole cents."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(
            F.col("c_nationkey").alias("series"),
            F.year("o_orderdate").alias("Anio"),
            F.month("o_orderdate").alias("month"),
        )
        .agg(F.sum(cents).alias("cents"), F.count(F.lit(1)).alias("n"))
        .select(
            "series",
            "Anio",
            month_name(F.col("month")).alias("Mes"),
            (F.expr("cents div n") / 100.0).alias(schema.PRICE),
        )
    )


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), month)


def dotted(number: Column, from_left: Column) -> Column:
    """Digits of a whole number in dot-separated threes, counted from the left or the right."""
    digits = number.cast("string")
    return F.when(from_left, F.regexp_replace(digits, r"(\d{3})(?=\d)", "$1.")).otherwise(
        F.regexp_replace(digits, r"(\d)(?=(\d{3})+$)", "$1.")
    )


def line_sums(layout: Layout = LAYOUT) -> dict[str, Column]:
    """Monthly line-item figures: rainfall per line number, weighted sums for the bank."""
    whole = F.floor("l_extendedprice").cast("bigint")
    regions = len(layout.rain)

    def weighted(i: int, modulus: int) -> Column:
        return F.sum(whole * ((F.col("l_partkey") + i) % modulus + 1))

    sums = {
        c: F.sum(F.when(F.col("l_linenumber") % regions == i, F.col("l_quantity")).otherwise(0.0))
        for i, c in enumerate(layout.rain)
    }
    sums |= {c: weighted(i, GDP_MODULUS) for i, c in enumerate(layout.gdp)}
    sums |= {c: weighted(i, INDEX_MODULUS) for i, c in enumerate(layout.index)}
    return sums


def line_months(spark: SparkSession, sf_dir: str, layout: Layout = LAYOUT) -> DataFrame:
    """Every line-item figure per nation and month, staged: two sources read it."""
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    monthly = (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .groupBy(
            F.col("s_nationkey").alias("series"),
            F.year("l_shipdate").alias("anio"),
            F.month("l_shipdate").alias("mes"),
        )
        .agg(*[total.alias(c) for c, total in line_sums(layout).items()])
    )
    return stage_table(monthly, "line-months")


def raw_rain(months: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """(series, date, regions)."""
    date = F.format_string("%d-%02d-01", "anio", "mes")
    return months.select("series", date.alias("date"), *layout.rain)


def raw_bank(months: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """(series, source_order, Periodo, texts) with unreadable dates and repeated months.

    Every fifth month comes twice; in every tenth the first copy is incomplete,
    so that month is lost. Dates come in three layouts.
    """
    key = F.expr("anio * 12 + mes + series")
    layouts = (
        F.when(key % 17 == 0, F.format_string("%d-13-01", "anio"))
        .when(key % 3 == 0, F.format_string("%d-%02d-01 00:00:00 UTC", "anio", "mes"))
        .when(key % 3 == 1, F.format_string("%d/%02d/01", "anio", "mes"))
        .otherwise(F.format_string("%d-%02d-01", "anio", "mes"))
    )
    copies = F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    first, *others = layout.texts
    from_left = F.col("mes") % 2 == 0
    copied = months.withColumn("copy", F.explode(copies))
    return copied.select(
        "series",
        (F.expr("(anio * 12 + mes) * 2") + F.col("copy")).alias("source_order"),
        layouts.alias(schema.PERIOD),
        F.when(F.col("copy") == 1, F.lit("7.777.777"))
        .when(key % 10 != 0, dotted(F.col(first), from_left))
        .alias(first),
        *[dotted(F.col(c), from_left).alias(c) for c in others],
    )


def collected(
    spark: SparkSession, sf_dir: str, layout: Layout = LAYOUT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Collected price, rainfall and bank tables."""
    months = line_months(spark, sf_dir, layout)
    return (
        collect_price(raw_price(spark, sf_dir), SERIES, layout),
        collect_rain(raw_rain(months, layout), SERIES, layout),
        collect_bank(raw_bank(months, layout), SERIES, layout=layout),
    )
