"""The registered queries: every operator over the driver's whole tables.

Monthly queries work on the nation series of ``standins``; row-level queries
take a fact table as it is. Results are rounded where two engines may add
floating-point numbers in a different order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from lunario import schema
from lunario.functions import (
    gdp_number,
    index_number,
    lenient_timestamp,
    month_of_abbreviation,
    period_label,
)
from lunario.model import forecast, grid
from lunario.model.estimators import PopScaler, Ridge
from lunario.model.stages import DropIncomplete, TakeColumns
from lunario.operators import drift, information, merge, metrics, neighbours, quality, requests, rows, splits, windows
from lunario.plans.standins import (
    LAYOUT,
    SERIES,
    collected,
    dotted,
    month_name,
    raw_price,
    table,
)
from lunario.schema import FULL, Layout
from lunario.session import fresh_path, stage_table
from lunario.sources import files
from lunario.sources import requests as request_files
from lunario.sources.collectors import collect_price
from lunario.streaming.score import stream_log_and_rejects, stream_score

# Decimals kept per column kind, some six significant digits.
DIGITS = {FULL.price: 4} | dict.fromkeys(FULL.rain, 4) | dict.fromkeys(FULL.gdp, 0)
DIGITS |= dict.fromkeys(FULL.index, 5)
MODEL = {"selector__k": 2, "poly__degree": 1, "model__alpha": 0.2}
SMALL_GRID = {"selector__k": [1, 2, 3], "poly__degree": [1, 2], "model__alpha": [1, 0.2, 0.01]}
LINEAR_GRID = {"selector__k": [1, 2], "poly__degree": [1], "model__alpha": [1, 0.2, 0.01]}
SQUARE_GRID = {"selector__k": [1], "poly__degree": [1, 2], "model__alpha": [1, 0.2, 0.01]}
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORDER_LINES = (
    StructType().add("o_orderkey", LongType()).add("o_totalprice", DoubleType()).add("o_custkey", LongType())
)
#: A tenth of the rows may be broken; about three in a hundred are.
BAD_SHARE = 0.1
#: A request column that only the saved header names.
HEADER_ONLY = "Otros"

# Orders and events have few, long series: the row order is cut by day or minute.
ORDER_SERIES, ORDER_KEY = ["o_orderpriority"], ["o_orderdate", "o_orderkey"]
EVENT_SERIES, EVENT_KEY = ["event_type"], ["ts", "event_id"]


def _order_unit() -> Column:
    return F.col("o_orderdate")


def _event_unit() -> Column:
    return F.date_trunc("minute", "ts")


def _rounded(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Select ``columns`` with the floating-point value and feature columns rounded."""
    kinds = {schema.TARGET: DIGITS[LAYOUT.price]}
    for c, digits in DIGITS.items():
        for name in (c, schema.rolling_name(c, "mean"), schema.rolling_name(c, "std")):
            kinds[name] = digits
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(
        *[
            F.round(c, kinds[c]).alias(c) if c in floating and c in kinds else F.col(c)
            for c in columns or df.columns
        ]
    )


def _merged(spark: SparkSession, sf: str, layout: Layout = LAYOUT) -> DataFrame:
    return merge.merge_sources(*collected(spark, sf, layout), SERIES, layout=layout)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return merge.monthly_features(_merged(spark, sf), SERIES, layout=LAYOUT)


def _staged_merge(spark: SparkSession, sf: str, layout: Layout = LAYOUT) -> DataFrame:
    """The merged table, built once for queries that need both a model and requests."""
    return stage_table(_merged(spark, sf, layout), "merged")


def _training(
    spark: SparkSession, sf: str, merged: DataFrame | None = None, layout: Layout = LAYOUT
) -> DataFrame:
    """Split training table, staged because every model step reads it."""
    merged = _merged(spark, sf, layout) if merged is None else merged
    features = merge.monthly_features(merged, SERIES, layout=layout)
    complete = stage_table(merge.training_table(features), "training")
    return splits.train_test_split(complete, [*SERIES, schema.PERIOD])


def _model(training: DataFrame, layout: Layout = LAYOUT) -> PipelineModel:
    return forecast.fit_model(training.where(~F.col("is_test")), MODEL, layout.features)


def _scored(model: PipelineModel, features: DataFrame) -> DataFrame:
    keys = [*SERIES, schema.PERIOD]
    return forecast.predict(model, features, keys).withColumn("preds", F.round("preds", 1))


# Sources and sinks


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    path = fresh_path(spark, "csv")
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


def csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as lines of which some are broken: the good rows beside the put-aside ones."""
    key = F.col("o_orderkey")
    price = F.when(key % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    more = F.when(key % 89 == 0, F.lit(",x")).otherwise(F.lit(""))
    line = F.when(key % 83 == 0, key.cast("string")).otherwise(
        F.concat(F.concat_ws(",", key, price, "o_custkey"), more)
    )
    path = fresh_path(spark, "broken-csv")
    table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    good, bad = files.read_checked_csv(
        spark, path, ORDER_LINES, header=False, bad_share=BAD_SHARE
    )
    put_aside = F.get(F.split("line", ","), F.lit(0)).cast("bigint")
    return good.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), F.lit("ok").alias("reason")).unionByName(
        bad.select(put_aside.alias("o_orderkey"), F.lit(-1.0).alias("o_totalprice"), "reason")
    )


def collect_price_query(spark: SparkSession, sf: str) -> DataFrame:
    price = collect_price(raw_price(spark, sf), SERIES, LAYOUT)
    return _rounded(price)


def collect_weather(spark: SparkSession, sf: str) -> DataFrame:
    return collected(spark, sf)[1]


def collect_finance(spark: SparkSession, sf: str) -> DataFrame:
    return collected(spark, sf)[2]


def metrics_json(spark: SparkSession, sf: str) -> DataFrame:
    report = eval_mse_rmse_r2(spark, sf)
    path = fresh_path(spark, "metrics")
    forecast.write_object(report, path)
    return forecast.read_object(spark, path, report)


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf)
    path = fresh_path(spark, "model")
    forecast.save_model(_model(training), path)
    return _scored(forecast.load_model(path), training.where("is_test"))


# Projections and filters


def project_strict(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").drop(
        "o_orderstatus"
    )


def take_columns(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["o_totalprice", "no_such_column", "o_orderkey", "o_orderpriority"]
    return TakeColumns(columns=wanted).transform(table(spark, sf, "orders"))


def dropna_any(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_returnflag") != "A", F.col("l_discount"))
        .otherwise(F.lit(float("nan")))
        .alias("l_discount"),
    )
    return DropIncomplete(columns=["l_extendedprice", "l_discount"]).transform(lines)


# Joins


def join_two(spark: SparkSession, sf: str) -> DataFrame:
    price, rain, _ = collected(spark, sf)
    joined = merge.join_periods(price, rain, SERIES)
    return _rounded(joined)


def join_three(spark: SparkSession, sf: str) -> DataFrame:
    price, rain, bank = collected(spark, sf)
    joined = merge.join_periods(merge.join_periods(price, rain, SERIES), bank, SERIES)
    return _rounded(joined)


def merge_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_merged(spark, sf))


def period_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every order asks for the smoothed price of its customer's nation and month."""
    price = collect_price(raw_price(spark, sf), SERIES, LAYOUT)
    smoothed = windows.rolling(price, SERIES, schema.TIME_COLS, [LAYOUT.price], ["mean"])
    predictions = smoothed.select(
        *SERIES,
        period_label(F.col("anio"), F.col("mes")).alias(schema.PERIOD),
        F.col(schema.rolling_name(LAYOUT.price, "mean")).alias("preds"),
    )
    # Every month of every third nation is predicted twice; the first line answers.
    lines = F.when(F.col("series") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    predictions = predictions.withColumn("line", F.explode(lines)).withColumn(
        "preds", F.col("preds") + F.col("line")
    )
    # Stored, as the batch job stores it: its file size decides how the join runs.
    predictions = stage_table(predictions, "predictions")
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    month = F.month("o_orderdate").cast("string")
    key = F.col("o_orderkey")
    lookups = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        key.alias("request_id"),
        F.col("c_nationkey").alias("series"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(key % 50 == 0, "")
        .when(key % 51 == 0, "13")
        .when(key % 4 == 0, F.lpad(month, 2, "0"))
        .when(key % 4 == 1, F.concat(F.lit(" "), month))
        .otherwise(month)
        .alias("month"),
    )
    found = requests.lookup_predictions(lookups, predictions, SERIES, first_by="line")
    return found.select(
        "request_id", F.coalesce(F.round("prediction", 4), F.lit(-1.0)).alias("prediction"), "status"
    )


# Aggregations


def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """First order per day; a third of all rows has an unreadable day and is one group."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf, "orders").select(
        lenient_timestamp(F.when(F.col("o_orderkey") % 3 != 0, day).otherwise("n/a")).alias("day"),
        "o_orderkey",
        "o_totalprice",
    )
    first = rows.keep_first(orders, ["day"], "o_orderkey")
    text = F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("none"))
    return first.withColumn("day", text)


def validate_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    features = stage_table(_features(spark, sf), "features")
    return quality.validate_nonempty(
        {
            "train": merge.training_table(features).drop(*SERIES, schema.PERIOD),
            "feature_store": merge.feature_store(features).drop(*SERIES),
        }
    )


def eval_mse_rmse_r2(spark: SparkSession, sf: str) -> DataFrame:
    """Line price predicted as quantity times the part's list price."""
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    pairs = lines.join(part, lines.l_partkey == part.p_partkey)
    report = metrics.regression_metrics(
        pairs, F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice")
    )
    return report.select(
        "n",
        F.round("mse", 1).alias("mse"),
        F.round("rmse", 4).alias("rmse"),
        F.round("r2", 8).alias("r2"),
    )


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    """How far the held-out rows of every feature lie from the stored profile of the training rows."""
    training = _training(spark, sf)
    path = fresh_path(spark, "profile")
    files.write_table(drift.profile(training.where(~F.col("is_test")), LAYOUT.features), path)
    report = drift.drift(files.read_table(spark, path), training.where("is_test"))
    return report.select(
        "position", "feature", "n_before", "n_now", F.round("psi", 7).alias("psi"), F.round("ks", 7).alias("ks")
    )


def promotion_gate(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.promotion_gate(eval_mse_rmse_r2(spark, sf))


def scaler_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = metrics.column_statistics(table(spark, sf, "lineitem"), LINE_NUMBERS)
    return stats.select(
        "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


def mi_scores(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf).where(~F.col("is_test"))
    scores = information.mutual_information(training, LAYOUT.features, schema.TARGET)
    return scores.select("position", "feature", F.round("score", 7).alias("score"))


def mi_scores_lines(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_partkey"]
    return information.mutual_information(lineitem, features, "l_extendedprice").select(
        "position", "feature", F.round("score", 7).alias("score")
    )


def mi_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.neighbour_information(
        table(spark, sf, "part"), ["p_size", "p_partkey"], "p_retailprice"
    ).select("position", "feature", F.round("score", 7).alias("score"))


def mi_neighbours_lines(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_partkey"]
    return neighbours.neighbour_information(lineitem, features, "l_extendedprice").select(
        "position", "feature", F.round("score", 7).alias("score")
    )


def select_k_best(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf).where(~F.col("is_test"))
    scores = information.mutual_information(training, LAYOUT.features, schema.TARGET)
    return information.best_features(scores, 7).select("rank", "feature")


def ridge_1d(spark: SparkSession, sf: str) -> DataFrame:
    line = metrics.ridge_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 0.2)
    return line.select(
        F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept")
    )


# Windows


def lag_label(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*ORDER_SERIES, *ORDER_KEY, "o_totalprice")
    labelled = windows.lead_label(
        orders,
        ORDER_SERIES,
        ORDER_KEY,
        "o_totalprice",
        unit=_order_unit(),
    )
    complete = rows.drop_incomplete(labelled, [schema.TARGET])
    return complete.select(*ORDER_SERIES, "o_orderkey", "o_totalprice", schema.TARGET)


def lag_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        *ORDER_SERIES, *ORDER_KEY, "o_totalprice", F.col("o_custkey").alias("previous_customer")
    )
    lagged = windows.lag_columns(
        orders,
        ORDER_SERIES,
        ORDER_KEY,
        ["o_totalprice", "previous_customer"],
        unit=_order_unit(),
    )
    complete = rows.drop_incomplete(lagged, ["o_totalprice"])
    return complete.select(*ORDER_SERIES, "o_orderkey", "o_totalprice", "previous_customer")


def _rolled_orders(spark: SparkSession, sf: str, method: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*ORDER_SERIES, *ORDER_KEY, "o_totalprice")
    rolled = windows.rolling(
        orders,
        ORDER_SERIES,
        ORDER_KEY,
        ["o_totalprice"],
        [method],
        unit=_order_unit(),
    )
    name = schema.rolling_name("o_totalprice", method)
    return rolled.select(
        *ORDER_SERIES, "o_orderkey", F.coalesce(F.round(name, 3), F.lit(-1.0)).alias(name)
    )


def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled_orders(spark, sf, "mean")


def rolling_std(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled_orders(spark, sf, "std")


def rolling_window_n(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(*EVENT_SERIES, *EVENT_KEY, "value")
    rolled = windows.rolling(
        events,
        EVENT_SERIES,
        EVENT_KEY,
        ["value", "no_such_column"],
        ["mean", "std"],
        window=6,
        unit=_event_unit(),
    )
    mean, std = (schema.rolling_name("value", m, 6) for m in ("mean", "std"))
    return rolled.select(
        "event_type",
        "event_id",
        F.round(mean, 5).alias(mean),
        F.coalesce(F.round(std, 5), F.lit(-1.0)).alias(std),
    )


def series_position(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(*ORDER_SERIES, *ORDER_KEY)
    placed = windows.series_position(
        orders, ORDER_SERIES, ORDER_KEY, unit=_order_unit()
    )
    return placed.select(*ORDER_SERIES, "o_orderkey", "position")


def lag_rolling_fused(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling price and rainfall of the three months before each month, in one window."""
    price, rain, _ = collected(spark, sf)
    joined = merge.join_periods(price, rain, SERIES)
    columns = [LAYOUT.price, *LAYOUT.rain]
    fused = windows.rolling(joined, SERIES, schema.TIME_COLS, columns, ["mean", "std"], shift=1)
    names = [schema.rolling_name(c, m) for m in ("mean", "std") for c in columns]
    complete = rows.drop_incomplete(fused, names)
    return _rounded(complete, [*SERIES, *schema.TIME_COLS, LAYOUT.price, *names])


# Splits


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    split = splits.train_test_split(orders, ["o_orderkey"])
    return split.withColumn("is_test", F.col("is_test").cast("int"))


def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    train = splits.train_test_split(orders, ["o_orderkey"]).where(~F.col("is_test"))
    return splits.kfold(train, ["o_orderkey"]).select("o_orderkey", "fold")


def time_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes")
    )
    split = splits.time_split(orders, schema.TIME_COLS)
    return split.select("o_orderkey", F.col("is_test").cast("int").alias("is_test"))


def ordered_split(spark: SparkSession, sf: str) -> DataFrame:
    """The newest fifth of all events, cut by their timestamps and then their ids."""
    events = table(spark, sf, "events").select("event_id", "ts")
    split = splits.time_split(events, ["ts", "event_id"])
    return split.select("event_id", F.col("is_test").cast("int").alias("is_test"))


# Scalar functions


def parse_month_es(spark: SparkSession, sf: str) -> DataFrame:
    name = month_name(F.month("o_orderdate"))
    written = (
        F.when(F.col("o_orderkey") % 3 == 0, F.upper(name))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(" "), F.lower(name)))
        .otherwise(name)
    )
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", month_of_abbreviation(written).alias("mes"))


def parse_date_lenient(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("l_shipdate")
    kind = F.col("l_orderkey") % 8
    written = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00 UTC")))
        .when(kind == 2, F.date_format(day, "yyyy/MM/dd"))
        .when(kind == 3, F.date_format(day, "yyyyMMdd"))
        .when(kind == 4, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 5, F.date_format(day, "dd-MM-yyyy"))
        .when(kind == 6, F.concat(F.date_format(day, "yyyy"), F.lit("-13-01")))
        .when(F.col("l_linenumber") == 1, F.date_format(day, "yyyy/MM/dd HH:mm:ss"))
        .when(F.col("l_linenumber") == 2, F.date_format(day, "MM/dd/yyyy HH:mm"))
        .when(F.col("l_linenumber") == 3, F.date_format(day, "dd.MM.yyyy"))
        .when(F.col("l_linenumber") == 4, F.date_format(day, "d MMM yyyy"))
        .when(F.col("l_linenumber") == 5, F.date_format(day, "MMM yyyy"))
        .otherwise("garbage")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", lenient_timestamp(written).alias("parsed")
    )
    text = F.coalesce(F.date_format("parsed", "yyyy-MM-dd"), F.lit("none"))
    return lines.select("l_orderkey", "l_linenumber", text.alias("day"))


def period_label_query(spark: SparkSession, sf: str) -> DataFrame:
    label = period_label(F.year("o_orderdate").cast("double"), F.month("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", label.alias(schema.PERIOD))


def _written_prices(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        dotted(cents, F.col("l_linenumber") % 2 == 0).alias("written"),
    )


def fix_gdp_string(spark: SparkSession, sf: str) -> DataFrame:
    return _written_prices(spark, sf).withColumn("number", gdp_number(F.col("written")))


def fix_index_string(spark: SparkSession, sf: str) -> DataFrame:
    return _written_prices(spark, sf).withColumn("number", index_number(F.col("written")))


def standardize(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    scaled = PopScaler(inputCols=LINE_NUMBERS).fit(lines).transform(lines)
    return scaled.select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in LINE_NUMBERS]
    )


def poly_degree2(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )
    vectors = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="pair")
    expansion = PolynomialExpansion(degree=2, inputCol="pair", outputCol="terms")
    terms = expansion.transform(vectors.transform(lines)).withColumn(
        "terms", vector_to_array("terms")
    )
    names = ["q", "qq", "d", "qd", "dd"]
    return terms.select(
        "l_orderkey",
        "l_linenumber",
        *[F.round(F.col("terms")[i], 6).alias(n) for i, n in enumerate(names)],
    )


# Requests


def _sent_requests(
    spark: SparkSession, sf: str, merged: DataFrame | None = None, layout: Layout = LAYOUT
) -> str:
    """Folder of JSON requests: every three consecutive months of a nation, some of them broken.

    In every seventh request the first bank columns come as JSON numbers, so that
    a repair of them would show.
    """
    merged = _merged(spark, sf, layout) if merged is None else merged
    months = schema.REQUEST_MONTHS

    def history(column: str, dtype: str) -> windows.Output:
        value = F.col(column).cast(dtype)
        return lambda w: F.array(*[F.lag(value, i).over(w) for i in reversed(range(months))])

    numbers = {*schema.TIME_COLS, layout.price, *layout.rain}
    outputs = {
        f"h_{c}": history(c, "double" if c in numbers else "string") for c in layout.merged
    }
    outputs["h_rank"] = lambda w: F.row_number().over(w)
    whole = windows.over_series(merged, SERIES, schema.TIME_COLS, outputs, before=months - 1)
    key = F.col("anio") * 12 + F.col("mes") + F.col("series")
    first_rain, first_gdp = layout.rain[0], layout.gdp[0]
    arrays = {c: F.col(f"h_{c}") for c in layout.merged}
    for c, repair in ((first_gdp, gdp_number), (layout.index[0], index_number)):

        def sent_cell(text: Column) -> Column:
            number = repair(text).cast("double").cast("variant")
            return F.when(key % 7 == 0, number).otherwise(text.cast("variant"))

        arrays[c] = F.transform(arrays[c], sent_cell)
    arrays[first_rain] = F.when(key % 11 != 0, arrays[first_rain])
    arrays[first_gdp] = (
        F.when(key % 13 == 0, F.slice(arrays[first_gdp], 1, 2))
        .when(key % 17 == 0, F.concat(arrays[first_gdp], F.array(F.lit("1").cast("variant"))))
        .otherwise(arrays[first_gdp])
    )
    # A column that only some queries ask for; the others ignore it.
    spare = F.when(key % 5 != 0, F.array(*[F.lit(i) for i in range(months)]))
    sent = whole.where(F.col("h_rank") >= months).select(
        F.concat_ws("|", "series", period_label(F.col("anio"), F.col("mes"))).alias("request_id"),
        F.struct(
            *[a.alias(c) for c, a in arrays.items()],
            spare.alias(HEADER_ONLY),
            F.array(F.lit(1)).alias("extra"),
        ).alias("data"),
    )
    path = fresh_path(spark, "requests")
    request_files.write_requests(sent, path)
    return path


def _requests(
    spark: SparkSession, sf: str, merged: DataFrame | None = None, layout: Layout = LAYOUT
) -> DataFrame:
    return request_files.read_requests(spark, _sent_requests(spark, sf, merged, layout), layout)


def validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    checked = requests.check_requests(_requests(spark, sf), LAYOUT)
    return checked.select(
        "request_id",
        F.col("valid").cast("int").alias("valid"),
        F.coalesce("reason", F.lit("ok")).alias("reason"),
    )


def validate_requests_header(spark: SparkSession, sf: str) -> DataFrame:
    """Requests checked against the saved header of a merged table that has a further column."""
    merged = _staged_merge(spark, sf)
    path = fresh_path(spark, "header")
    requests.write_header(merged.withColumn(HEADER_ONLY, F.lit(1.0)), path, SERIES)
    layout = requests.read_header(spark, path)
    sent = _sent_requests(spark, sf, merged)
    checked = requests.check_requests(request_files.read_requests(spark, sent, layout), layout)
    return checked.select(
        "request_id",
        F.col("valid").cast("int").alias("valid"),
        F.coalesce("reason", F.lit("ok")).alias("reason"),
    )


def request_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Requests sent without an id get one; per request the id is counted after two readings."""
    merged = _staged_merge(spark, sf)
    sent = _requests(spark, sf, merged)
    named = F.col("request_id")
    bare = sent.withColumn("sent_as", named).withColumn(
        "request_id", F.when(F.xxhash64(named) % 2 == 0, named)
    )
    first, again = (request_files.with_request_ids(bare) for _ in range(2))
    ids = first.unionByName(again).groupBy("sent_as").agg(
        F.count_distinct("request_id").alias("ids"), F.min("request_id").alias("request_id")
    )
    return ids.groupBy("ids").agg(
        F.count(F.lit(1)).alias("requests"), F.count_distinct("request_id").alias("different")
    )


def request_rows(spark: SparkSession, sf: str) -> DataFrame:
    valid = requests.check_requests(_requests(spark, sf), LAYOUT).where("valid")
    months = requests.request_months(valid.select("request_id", "data"), LAYOUT)
    return _rounded(requests.request_rows(months, LAYOUT), ["request_id", "pos", *LAYOUT.merged])


def score_requests(spark: SparkSession, sf: str) -> DataFrame:
    merged = _staged_merge(spark, sf)
    model = _model(_training(spark, sf, merged))
    scored = requests.score_requests(_requests(spark, sf, merged), model, LAYOUT)
    return scored.select("request_id", F.round("pred", 1).alias("pred"))


def _log_view(log: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    columns = ["request_id", "pos", *schema.TIME_COLS, layout.price, *layout.texts, "pred"]
    return _rounded(log.withColumn("pred", F.round("pred", 1)), columns)


def _logged(spark: SparkSession, sf: str, layout: Layout = LAYOUT) -> DataFrame:
    merged = _staged_merge(spark, sf, layout)
    model = _model(_training(spark, sf, merged, layout), layout)
    scored = requests.score_requests(_requests(spark, sf, merged, layout), model, layout)
    path = fresh_path(spark, "request-log")
    request_files.append_log(requests.log_rows(scored, layout), path, "0")
    return request_files.read_log(spark, path)


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log_view(_logged(spark, sf))


def request_log_full(spark: SparkSession, sf: str) -> DataFrame:
    """Requests over all 47 columns, scored by a model of all 141 features."""
    return _log_view(_logged(spark, sf, FULL), FULL)


def request_log_head(spark: SparkSession, sf: str) -> DataFrame:
    return _log_view(request_files.log_head(_logged(spark, sf), 100))


def stream_score_query(spark: SparkSession, sf: str) -> DataFrame:
    merged = _staged_merge(spark, sf)
    model = _model(_training(spark, sf, merged))
    inbox = _sent_requests(spark, sf, merged)
    log = fresh_path(spark, "stream-log")
    stream = request_files.stream_requests(spark, inbox, LAYOUT)
    query = stream_score(
        stream, model, log, fresh_path(spark, "stream-state"), once=True, layout=LAYOUT
    )
    query.awaitTermination()
    return _log_view(files.read_table(spark, log))


def stream_log_and_rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows and rejects of one stream, side by side."""
    merged = _staged_merge(spark, sf)
    model = _model(_training(spark, sf, merged))
    stream = request_files.stream_requests(spark, _sent_requests(spark, sf, merged), LAYOUT)
    log, rejects = fresh_path(spark, "stream-log"), fresh_path(spark, "stream-rejects")
    state = fresh_path(spark, "stream-state")
    query = stream_log_and_rejects(stream, model, log, rejects, state, once=True, layout=LAYOUT)
    query.awaitTermination()
    logged = request_files.read_log(spark, log).select(
        "request_id", "pos", F.round("pred", 1).alias("pred"), F.lit("ok").alias("reason")
    )
    refused = request_files.read_log(spark, rejects).select(
        "request_id", F.lit(-1).alias("pos"), F.lit(-1.0).alias("pred"), "reason"
    )
    return logged.unionByName(refused)


# Features and model


def monthly_features(spark: SparkSession, sf: str) -> DataFrame:
    stages = forecast.data_stages(SERIES, layout=LAYOUT)
    merged = _merged(spark, sf)
    features = forecast.apply_data_stages(forecast.fit_data_stages(stages, merged), merged)
    return _rounded(features)


def training_table(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf)
    return _rounded(training.withColumn("is_test", F.col("is_test").cast("int")))


def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(merge.feature_store(_features(spark, sf)))


def ridge_fit(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    names = ["l_quantity", "l_discount"]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(lines)
    fitted = Ridge(labelCol="l_extendedprice", alpha=50.0).fit(vectors)
    weights = [*zip(names, map(float, fitted.coefficients)), ("intercept", float(fitted.intercept))]
    table_rows = spark.createDataFrame(weights, "term string, weight double")
    return table_rows.withColumn("weight", F.round("weight", 4))


def _searched(spark: SparkSession, sf: str, space: dict[str, list]) -> DataFrame:
    train = _training(spark, sf).where(~F.col("is_test"))
    folded = splits.kfold(train, [*SERIES, schema.PERIOD])
    scores = grid.grid_search(folded, grid=space, features=LAYOUT.features)
    best = grid.best_parameters(scores)
    chosen = reduce(lambda a, b: a & b, [F.col(n) == v for n, v in best.items()])
    return scores.select(
        "grid_position",
        "model__alpha",
        "poly__degree",
        "selector__k",
        F.round("mean_r2", 6).alias("mean_r2"),
        chosen.cast("int").alias("best"),
    )


def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    return _searched(spark, sf, SMALL_GRID)


def grid_search_square(spark: SparkSession, sf: str) -> DataFrame:
    return _searched(spark, sf, SQUARE_GRID)


def grid_search_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _searched(spark, sf, LINEAR_GRID)


def model_fit_predict(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf)
    return _scored(_model(training), training.where("is_test"))


def batch_predict(spark: SparkSession, sf: str) -> DataFrame:
    training = _training(spark, sf)
    return _scored(_model(training), merge.feature_store(training.drop("is_test")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_roundtrip": csv_roundtrip,
        "csv_quarantine": csv_quarantine,
        "collect_price": collect_price_query,
        "collect_weather": collect_weather,
        "collect_finance": collect_finance,
        "metrics_json": metrics_json,
        "model_roundtrip": model_roundtrip,
        "project_strict": project_strict,
        "take_columns": take_columns,
        "dropna_any": dropna_any,
        "join_two": join_two,
        "join_three": join_three,
        "merge_sources": merge_sources,
        "period_lookup": period_lookup,
        "dedupe_first": dedupe_first,
        "validate_nonempty": validate_nonempty,
        "eval_mse_rmse_r2": eval_mse_rmse_r2,
        "promotion_gate": promotion_gate,
        "drift_report": drift_report,
        "scaler_stats": scaler_stats,
        "mi_scores": mi_scores,
        "mi_scores_lines": mi_scores_lines,
        "mi_neighbours": mi_neighbours,
        "mi_neighbours_lines": mi_neighbours_lines,
        "select_k_best": select_k_best,
        "ridge_1d": ridge_1d,
        "lag_label": lag_label,
        "lag_rows": lag_rows,
        "rolling_mean": rolling_mean,
        "rolling_std": rolling_std,
        "rolling_window_n": rolling_window_n,
        "series_position": series_position,
        "lag_rolling_fused": lag_rolling_fused,
        "train_test_split": train_test_split,
        "kfold_assign": kfold_assign,
        "time_split": time_split,
        "ordered_split": ordered_split,
        "parse_month_es": parse_month_es,
        "parse_date_lenient": parse_date_lenient,
        "period_label": period_label_query,
        "fix_gdp_string": fix_gdp_string,
        "fix_index_string": fix_index_string,
        "standardize": standardize,
        "poly_degree2": poly_degree2,
        "validate_requests": validate_requests,
        "validate_requests_header": validate_requests_header,
        "request_ids": request_ids,
        "request_rows": request_rows,
        "score_requests": score_requests,
        "request_log": request_log,
        "request_log_full": request_log_full,
        "request_log_head": request_log_head,
        "stream_score": stream_score_query,
        "stream_log_and_rejects": stream_log_and_rejects_query,
        "monthly_features": monthly_features,
        "training_table": training_table,
        "feature_store": feature_store,
        "ridge_fit": ridge_fit,
        "grid_search": grid_search,
        "grid_search_linear": grid_search_linear,
        "grid_search_square": grid_search_square,
        "model_fit_predict": model_fit_predict,
        "batch_predict": batch_predict,
    }
