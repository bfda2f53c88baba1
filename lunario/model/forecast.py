"""The data pipeline, the model pipeline and their training, gate and scoring steps."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lunario import schema
from lunario.schema import FULL, Layout
from lunario.model.estimators import MutualInfoSelector, PopScaler, Ridge
from lunario.model.stages import PeriodLabel, RepairNumbers, RollingFeatures, TakeColumns
from lunario.operators.metrics import promotion_gate, regression_metrics
from lunario.operators.rows import drop_incomplete

# The parameters found by the published search.
BEST_PARAMS = {"selector__k": 7, "poly__degree": 1, "model__alpha": 0.2}


def data_stages(
    series: list[str] = [],
    *,
    layout: Layout = FULL,
    keys: list[str] = [],
    unit: str = "",
    tie_break: list[str] = [],
) -> Pipeline:
    """Number repair, rolling mean and deviation, feature columns.

    ``tie_break`` columns order repeated months of a series and are kept.
    """
    return Pipeline(
        stages=[
            RepairNumbers(columns=list(layout.gdp), kind="gdp"),
            RepairNumbers(columns=list(layout.index), kind="index"),
            RollingFeatures(
                columns=layout.values,
                methods=["mean", "std"],
                series=list(series),
                order=[*schema.TIME_COLS, *tie_break],
                unit=unit,
            ),
            PeriodLabel(),
            TakeColumns(
                columns=layout.features,
                keys=[*series, schema.PERIOD, schema.TARGET, *tie_break, *keys],
            ),
        ]
    )


def model_stages(
    params: dict = BEST_PARAMS,
    features: list[str] = FULL.features,
    label: str = schema.TARGET,
) -> Pipeline:
    """Standardise, select by mutual information, expand, ridge."""
    return Pipeline(
        stages=[
            PopScaler(inputCols=list(features)),
            MutualInfoSelector(
                inputCols=list(features),
                labelCol=label,
                outputCol="selected",
                k=params["selector__k"],
            ),
            PolynomialExpansion(
                degree=params["poly__degree"], inputCol="selected", outputCol="expanded"
            ),
            Ridge(
                featuresCol="expanded",
                labelCol=label,
                predictionCol="preds",
                alpha=float(params["model__alpha"]),
            ),
        ]
    )


def fit_model(
    train: DataFrame,
    params: dict = BEST_PARAMS,
    features: list[str] = FULL.features,
    label: str = schema.TARGET,
) -> PipelineModel:
    return model_stages(params, features, label).fit(train)


def evaluate(model: PipelineModel, test: DataFrame, label: str = schema.TARGET) -> DataFrame:
    """One metrics row for the model's predictions on ``test``."""
    return regression_metrics(model.transform(test), F.col(label), F.col("preds"))


def predict(model: PipelineModel, features: DataFrame, keys: list[str]) -> DataFrame:
    """Prediction per complete feature row, with its keys."""
    scored = model.transform(features)
    return scored.select(*keys, "preds")


def fit_data_stages(pipeline: Pipeline, sample: DataFrame) -> PipelineModel:
    """The data pipeline learns nothing; fitting only freezes it for saving."""
    return pipeline.fit(sample)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


POINTER = "seq bigint, version string"


def _newest_pointer(spark: SparkSession, prod_path: str) -> tuple[int, str] | None:
    """(seq, version) of the last promotion that was completed."""
    pointers = os.path.join(prod_path, "pointers")
    try:
        # Files of a write that did not end are hidden in its temporary folder.
        found = spark.read.schema(POINTER).option("recursiveFileLookup", True).json(pointers)
        newest = found.orderBy(F.desc("seq")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (newest["seq"], newest["version"]) if newest else None


def load_promoted(spark: SparkSession, prod_path: str) -> PipelineModel:
    """The model of the last completed promotion."""
    newest = _newest_pointer(spark, prod_path)
    if newest is None:
        raise ValueError(f"no model was promoted to {prod_path}")
    return load_model(os.path.join(prod_path, "versions", newest[1]))


def promote(metrics: DataFrame, staging_path: str, prod_path: str) -> DataFrame:
    """Make the staged model the live one if the gate passes, otherwise raise.

    A promotion writes a new version folder and then a pointer to it, of one row;
    nothing is overwritten or deleted. Whoever loads the model follows the last
    complete pointer, so a promotion that fails at any point leaves the old
    model live, and an older one is live again once its pointer is the last.
    """
    verdict = promotion_gate(metrics)
    row = verdict.first()
    if not row["promoted"]:
        raise ValueError(f"model rejected: mse={row['mse']}, r2={row['r2']}")
    spark = metrics.sparkSession
    newest = _newest_pointer(spark, prod_path)
    version = uuid.uuid4().hex
    save_model(load_model(staging_path), os.path.join(prod_path, "versions", version))
    _point(spark, prod_path, newest[0] + 1 if newest else 0, version)
    return verdict


def _point(spark: SparkSession, prod_path: str, seq: int, version: str) -> None:
    pointer = spark.createDataFrame([(seq, version)], POINTER).coalesce(1)
    pointer.write.json(os.path.join(prod_path, "pointers", version))


def apply_data_stages(pipeline: PipelineModel, merged: DataFrame) -> DataFrame:
    """Features of the merged table, complete rows only."""
    return drop_incomplete(pipeline.transform(merged))


def write_object(df: DataFrame, path: str) -> None:
    """Write a one-row table as a JSON object; any other number of rows is an error."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"one row makes an object, not {len(rows) or 'none'}")
    one = df.sparkSession.createDataFrame(rows, df.schema)
    one.coalesce(1).write.mode("overwrite").json(path)


def read_object(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a JSON object back with the schema of ``like``."""
    return spark.read.schema(like.schema).json(path)


def params_row(spark: SparkSession, params: dict) -> DataFrame:
    """Model parameters as a one-row table."""
    return spark.createDataFrame(
        [(params["model__alpha"], params["poly__degree"], params["selector__k"])],
        "model__alpha double, poly__degree int, selector__k int",
    )
