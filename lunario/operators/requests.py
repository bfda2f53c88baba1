"""Multi-month scoring requests and period lookups.

A request carries its own few months, so its features are row-local: its cells
form a small matrix, months by columns, and one expression over arrays repairs
them and rolls the window over the months. The plan names each column once,
whatever the number of months and features, so wide layouts neither outgrow
generated code nor planning. Scoring needs no explode, no shuffle and no state,
and the same code runs on a batch and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import FULL, Layout
from lunario.functions import gdp_number, index_number, normalise_period_part
from lunario.operators.rows import keep_first
from lunario.sources.requests import with_request_ids


HEADER = "position int, name string"


def required_columns(merged: DataFrame, keys: list[str] = []) -> list[str]:
    """What a request must carry: every column of the merged table but the label and the ``keys``."""
    return [c for c in merged.columns if c not in (schema.TARGET, *keys)]


def write_header(merged: DataFrame, path: str, keys: list[str] = []) -> None:
    """Save the required columns, in order, for whoever scores requests."""
    rows = list(enumerate(required_columns(merged, keys)))
    header = merged.sparkSession.createDataFrame(rows, HEADER)
    header.coalesce(1).write.mode("overwrite").json(path)


def read_header(spark: SparkSession, path: str) -> Layout:
    """The layout that the saved header asks of requests."""
    rows = spark.read.schema(HEADER).json(path).orderBy("position").collect()
    return Layout.of_header([r["name"] for r in rows])


def check_requests(
    requests: DataFrame,
    layout: Layout = FULL,
    months: int = schema.REQUEST_MONTHS,
) -> DataFrame:
    """Add ``valid`` and, for bad requests, ``reason``: the first required column of wrong length."""
    sent = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.array_size(f"data.`{c}`").alias("size"))
            for c in layout.required
        ]
    )
    wrong = F.filter(sent, lambda column: ~column["size"].eqNullSafe(F.lit(months)))
    described = F.transform(
        wrong,
        lambda column: F.when(column["size"].isNull(), F.concat(F.lit("missing "), column["name"]))
        .otherwise(F.concat(F.lit("length of "), column["name"], F.lit(" is "), column["size"])),
    )
    faults = [F.get(described, F.lit(0))]
    for c in schema.TIME_COLS:
        # A year or month that is no integer cannot be logged; one such cell rejects its request.
        fits = F.forall(f"data.{c}", lambda cell: cell.isNull() | cell.try_cast("int").isNotNull())
        faults.append(F.when(~fits, F.lit(f"{c} is no integer")))
    return requests.withColumn("reason", F.coalesce(*faults)).withColumn(
        "valid", F.col("reason").isNull()
    )


def request_months(
    requests: DataFrame,
    layout: Layout = FULL,
    months: int = schema.REQUEST_MONTHS,
    sort_months: bool = False,
) -> DataFrame:
    """Replace ``data`` by ``months``: a struct (pos, month) per array position.

    The first ``months`` positions count; ``sort_months`` puts them in time
    order, the position settles equal months.
    """
    zipped = F.slice(F.arrays_zip(*[f"data.{c}" for c in layout.merged]), 1, months)
    array = F.transform(zipped, lambda m, i: F.struct(i.alias("pos"), m.alias("month")))
    if sort_months:
        keyed = F.transform(
            array,
            lambda m: F.struct(
                *[m["month"][c].alias(c) for c in schema.TIME_COLS], m["pos"], m.alias("month")
            ),
        )
        array = F.transform(F.sort_array(keyed), lambda m: m["month"])
    return requests.select(
        *[c for c in requests.columns if c != "data"], array.alias("months")
    )


def request_rows(requests: DataFrame, layout: Layout = FULL) -> DataFrame:
    """One row per request month, in the columns of ``months``; numbers sent for texts in plain notation."""
    months = requests.schema["months"].dataType.elementType
    columns = months["month"].dataType.names

    def written(cell: Column) -> Column:
        plain = cell["number"].try_cast("decimal(38,10)").cast("string")
        return F.coalesce(plain, cell["text"])

    def row(m: Column) -> Column:
        month = m["month"]
        cells = [(written(month[c]) if c in layout.texts else month[c]).alias(c) for c in columns]
        return F.struct(*cells, m["pos"].alias("pos"))

    return requests.select(
        *[c for c in requests.columns if c != "months"], F.inline(F.transform("months", row))
    )


def _matrix(layout: Layout) -> Column:
    """Months by columns, in the order of ``layout.values``; what is broken or no number is NULL."""

    def repaired(cells: list[Column], repair: Callable[[Column], Column]) -> Column:
        def number(cell: Column) -> Column:
            return F.coalesce(cell["number"], repair(cell["text"]).cast("double"))

        return F.transform(F.array(*cells), number)

    def row(m: Column) -> Column:
        month = m["month"]
        numbers = F.array(*[month[c].cast("double") for c in (layout.price, *layout.rain)])
        parts = [F.transform(numbers, lambda x: F.nanvl(x, F.lit(None).cast("double")))]
        for columns, repair in ((layout.gdp, gdp_number), (layout.index, index_number)):
            if columns:
                parts.append(
                    repaired([month[c] for c in columns], lambda text: repair(text, strict=False))
                )
        return F.concat(*parts)

    return F.transform("months", row)


def _month_features(matrix: Column, columns: int, month: Column) -> Column:
    """Rolling means, rolling deviations and values of one month, in the order of the features."""
    window = schema.ROLLING_WINDOW
    first = F.greatest(month - window + 2, F.lit(1))
    rows = F.slice(matrix, first, month - first + 2)
    each = F.sequence(F.lit(0), F.lit(columns - 1))
    zero = F.lit(0.0)

    def seen(j: Column) -> Column:
        return F.filter(F.transform(rows, lambda row: row[j]), lambda x: x.isNotNull())

    def mean(values: Column) -> Column:
        return F.try_divide(F.aggregate(values, zero, lambda total, x: total + x), F.size(values))

    def deviation(values: Column) -> Column:
        # One value in an array, so that the mean is worked out once.
        centred = F.flatten(
            F.transform(
                F.array(mean(values)), lambda m: F.transform(values, lambda x: (x - m) * (x - m))
            )
        )
        total = F.aggregate(centred, zero, lambda total, x: total + x)
        return F.sqrt(F.try_divide(total, F.size(values) - 1))

    windows = F.transform(each, seen)
    return F.concat(
        F.transform(windows, mean), F.transform(windows, deviation), F.element_at(matrix, month + 1)
    )


def request_features(
    requests: DataFrame, layout: Layout = FULL, months: int = schema.REQUEST_MONTHS
) -> DataFrame:
    """Features of the last complete month of each request.

    Same numbers as the monthly table gives: only cells sent as text are
    repaired, numbers count as they are; broken text counts as missing, the
    first month has no deviation, incomplete months are skipped. A request
    without a complete month gives no row.
    """
    columns = [F.col(f"`{c}`") for c in requests.columns]
    typed = requests.select(*columns, _matrix(layout).alias("__matrix"))
    # Month 0 has no deviation, so only the later ones can be complete.
    newest_first = F.sequence(F.lit(months - 1), F.lit(1), F.lit(-1))
    features = F.transform(
        newest_first, lambda i: _month_features(F.col("__matrix"), len(layout.values), i)
    )
    complete = F.filter(features, lambda values: F.forall(values, lambda x: x.isNotNull()))
    # A generator gives no row for no month, and is worked out once for all features.
    newest = typed.select(*columns, F.explode(F.slice(complete, 1, 1)).alias("__features"))
    return newest.select(
        *columns, *[F.col("__features")[j].alias(c) for j, c in enumerate(layout.features)]
    )


def score_requests(
    requests: DataFrame,
    model: PipelineModel,
    layout: Layout = FULL,
    sort_months: bool = False,
) -> DataFrame:
    """(request_id, months, pred) of valid requests; one prediction per request."""
    checked = check_requests(with_request_ids(requests), layout)
    valid = checked.where("valid").select("request_id", "data")
    months = request_months(valid, layout, sort_months=sort_months)
    features = request_features(months, layout)
    return model.transform(features).select("request_id", "months", F.col("preds").alias("pred"))


def rejected_requests(requests: DataFrame, layout: Layout = FULL) -> DataFrame:
    """(request_id, reason) of requests that cannot be scored as sent."""
    checked = check_requests(with_request_ids(requests), layout)
    return checked.where(~F.col("valid")).select("request_id", "reason")


def log_rows(scored: DataFrame, layout: Layout = FULL) -> DataFrame:
    """One log row per request month; all months of a request share its prediction."""
    rows = request_rows(scored, layout)
    return rows.select(
        "request_id",
        "pos",
        *[F.col(c).try_cast("int").alias(c) for c in schema.TIME_COLS],
        *layout.values,
        "pred",
    )


def lookup_predictions(
    lookups: DataFrame,
    predictions: DataFrame,
    series: list[str] = [],
    first_by: str | None = None,
) -> DataFrame:
    """Prediction for each (year, month) text pair, with a status in place of an error.

    Zero-padded arguments are understood. ``first_by`` orders predictions that
    repeat a key; without it keys must be unique.
    """
    keys = [*series, schema.PERIOD]
    answers = predictions.select(*keys, "preds", *([first_by] if first_by else []))
    if first_by:
        answers = keep_first(answers, keys, first_by)
    answers = answers.select(*keys, F.col("preds").alias("prediction"), F.lit(1).alias("__found"))
    year, month = normalise_period_part(F.col("year")), normalise_period_part(F.col("month"))
    asked = lookups.withColumn(schema.PERIOD, F.concat(year, F.lit("-"), month))
    return (
        asked.join(answers, keys, "left")
        .withColumn(
            "status",
            F.when(F.col(schema.PERIOD).isNull(), "missing argument")
            .when(F.col("__found").isNull(), "invalid period")
            .otherwise("ok"),
        )
        .select(*lookups.columns, "prediction", "status")
    )
