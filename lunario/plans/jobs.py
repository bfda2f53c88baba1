"""The training and the prediction job over folders of raw CSV files.

Each run writes below its own run folder, so two jobs never share outputs.
Steps hand over Parquet tables; every step can be rerun from its inputs.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lunario import schema
from lunario.model import forecast, grid
from lunario.operators import drift, merge, quality, requests, splits
from lunario.schema import FULL, Layout
from lunario.sources import files
from lunario.sources.collectors import collect_bank, collect_price, collect_rain

TRAIN, TEST = "train", "test"
MONTH_NUMBER = "anio * 12 + mes"
#: Where rows stood in their files: settles the order of months that repeat in a series.
FILE_ORDER = ["price_order", "rain_order"]
COPY = "copy"


@dataclass(frozen=True)
class Run:
    """Where one run reads and writes; ``series`` names extra key columns in the raw files."""

    raw: str
    out: str
    price_file: str = "precio_leche.csv"
    rain_file: str = "precipitaciones.csv"
    bank_file: str = "banco_central.csv"
    layout: Layout = FULL
    series: tuple[tuple[str, T.DataType], ...] = ()
    #: Share of malformed raw rows that a file may have; they are put aside with file and reason.
    bad_share: float = 0.0
    #: Stability index above which new features stop the prediction; none only reports.
    drift_limit: float | None = None

    @property
    def keys(self) -> list[str]:
        return [name for name, _ in self.series]

    def path(self, *parts: str) -> str:
        return os.path.join(self.out, *parts)

    def raw_path(self, name: str) -> str:
        return os.path.join(self.raw, name)


def gather(spark: SparkSession, run: Run) -> None:
    """Collect the three raw files into stage tables; malformed rows go to ``quarantine``."""
    keyed = dict(run.series)

    def raw(name: str, columns: T.StructType, order: str) -> DataFrame:
        whole = schema.with_series(columns, keyed)
        path = run.raw_path(name)
        good, bad = files.read_checked_csv(spark, path, whole, order, bad_share=run.bad_share)
        files.write_table(bad, run.path("quarantine", name))
        return good

    layout, keys = run.layout, run.keys
    by_price, by_rain = FILE_ORDER
    price = collect_price(raw(run.price_file, layout.raw_price(), by_price), keys, layout, [by_price])
    rain = collect_rain(raw(run.rain_file, layout.raw_rain(), by_rain), keys, layout, [by_rain])
    bank = collect_bank(
        raw(run.bank_file, layout.raw_bank(), "source_order"), keys, "source_order", layout
    )
    for name, table in (("price", price), ("rain", rain), ("bank", bank)):
        files.write_table(table, run.path("interm", name))


def merge_step(spark: SparkSession, run: Run, include_open_period: bool = False) -> None:
    """Join the stage tables into the labelled monthly table; repeated months keep their file order."""
    price, rain, bank = (
        files.read_table(spark, run.path("interm", name)) for name in ("price", "rain", "bank")
    )
    merged = merge.merge_sources(
        price,
        rain,
        bank,
        run.keys,
        layout=run.layout,
        tie_break=FILE_ORDER,
        include_open_period=include_open_period,
        unit=F.expr(MONTH_NUMBER),
    )
    files.write_table(merged, run.path("interm", "merged"))


def preprocess(spark: SparkSession, run: Run, seed: int = 42) -> None:
    """Feature table, exact random split, the frozen data pipeline, profile and header."""
    merged = files.read_table(spark, run.path("interm", "merged"))
    stages = forecast.data_stages(
        run.keys, layout=run.layout, unit=MONTH_NUMBER, tie_break=FILE_ORDER
    )
    fitted = forecast.fit_data_stages(stages, merged)
    complete = forecast.apply_data_stages(fitted, merged)
    # Repeated months are told apart by their number, not by where their files lie.
    same = Window.partitionBy(*run.keys, schema.PERIOD).orderBy(*FILE_ORDER)
    numbered = complete.withColumn(COPY, F.row_number().over(same)).drop(*FILE_ORDER)
    files.write_table(numbered, run.path("interm", "features"))
    features = files.read_table(spark, run.path("interm", "features"))
    split = splits.train_test_split(features, _row_keys(run), seed=seed)
    sided = split.withColumn("side", F.when(F.col("is_test"), TEST).otherwise(TRAIN))
    # One pass writes both sides; reading one side prunes the other's folder.
    files.write_table(sided.drop("is_test"), run.path("preprocessed"), ["side"])
    forecast.save_model(fitted, run.path("artifacts", "data_stages"))
    requests.write_header(
        merged, run.path("artifacts", "required_columns"), [*run.keys, *FILE_ORDER]
    )
    learned = drift.profile(_side(spark, run, TRAIN), run.layout.features)
    files.write_table(learned, run.path("artifacts", "profile"))


def _row_keys(run: Run) -> list[str]:
    """What tells feature rows apart, repeated months included."""
    return [*run.keys, schema.PERIOD, COPY]


def _side(spark: SparkSession, run: Run, side: str) -> DataFrame:
    return files.read_table(spark, run.path("preprocessed")).where(F.col("side") == side).drop("side")


def validate_data(spark: SparkSession, run: Run) -> None:
    quality.require_nonempty(_side(spark, run, TRAIN), "training table")


def hypertune(spark: SparkSession, run: Run, params: dict = grid.PARAM_GRID) -> dict:
    """Three-fold grid search on the training side; keeps the best parameters."""
    folded = splits.kfold(_side(spark, run, TRAIN), _row_keys(run))
    scores = grid.grid_search(folded, grid=params, features=run.layout.features)
    files.write_table(scores, run.path("artifacts", "grid_scores"))
    best = grid.best_parameters(scores)
    forecast.write_object(
        forecast.params_row(spark, best), run.path("artifacts", "best_params")
    )
    return best


def train(spark: SparkSession, run: Run) -> DataFrame:
    """Fit with the best parameters, store test metrics and the staging model."""
    like = forecast.params_row(spark, forecast.BEST_PARAMS)
    best = forecast.read_object(spark, run.path("artifacts", "best_params"), like).first()
    model = forecast.fit_model(_side(spark, run, TRAIN), best.asDict(), run.layout.features)
    report = forecast.evaluate(model, _side(spark, run, TEST))
    forecast.write_object(report, run.path("artifacts", "model_metrics"))
    forecast.save_model(model, run.path("artifacts", "model_staging"))
    return forecast.read_object(spark, run.path("artifacts", "model_metrics"), report)


def training_job(spark: SparkSession, run: Run, params: dict = grid.PARAM_GRID) -> DataFrame:
    """Gather, merge, preprocess, validate, tune, train, gate and promote."""
    gather(spark, run)
    merge_step(spark, run)
    preprocess(spark, run)
    validate_data(spark, run)
    hypertune(spark, run, params)
    report = train(spark, run)
    return forecast.promote(
        report, run.path("artifacts", "model_staging"), run.path("artifacts", "model_prod")
    )


def preprocess_batch(
    spark: SparkSession, run: Run, artifacts: str, include_open_period: bool = False
) -> None:
    """Feature store of the merged table with the saved data pipeline."""
    merged = files.read_table(spark, run.path("interm", "merged"))
    stages = forecast.load_model(os.path.join(artifacts, "data_stages"))
    features = merge.feature_store(stages.transform(merged), include_open_period)
    features = features.drop(*FILE_ORDER)
    files.write_table(features, run.path("feature_store"))


def validate_prediction_data(spark: SparkSession, run: Run, artifacts: str) -> None:
    """The feature store has rows, and how far they are from the training rows is on record."""
    features = quality.require_nonempty(
        files.read_table(spark, run.path("feature_store")), "feature store"
    )
    learned = files.read_table(spark, os.path.join(artifacts, "profile"))
    files.write_table(drift.drift(learned, features), run.path("drift"))
    if run.drift_limit is not None:
        moved = files.read_table(spark, run.path("drift")).where(F.col("psi") > run.drift_limit)
        names = [r["feature"] for r in moved.orderBy(F.desc("psi")).collect()]
        if names:
            raise ValueError(f"features moved beyond {run.drift_limit}: {names}")


def batch_prediction(spark: SparkSession, run: Run, artifacts: str) -> DataFrame:
    """Score the feature store with the production model and store (keys, period, preds)."""
    features = files.read_table(spark, run.path("feature_store"))
    model = forecast.load_promoted(spark, os.path.join(artifacts, "model_prod"))
    files.write_table(
        forecast.predict(model, features, [*run.keys, schema.PERIOD]), run.path("predictions")
    )
    return files.read_table(spark, run.path("predictions"))


def prediction_job(
    spark: SparkSession, run: Run, artifacts: str, include_open_period: bool = False
) -> DataFrame:
    """Gather, merge, preprocess, validate and score with the artifacts of a training run."""
    gather(spark, run)
    merge_step(spark, run, include_open_period)
    preprocess_batch(spark, run, artifacts, include_open_period)
    validate_prediction_data(spark, run, artifacts)
    return batch_prediction(spark, run, artifacts)
