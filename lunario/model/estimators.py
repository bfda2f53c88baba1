"""Standardisation, feature selection and ridge as Spark ML estimators.

Features stay ordinary columns until the selector has picked its few; only
those enter a vector. Scoring therefore reads and computes just the selected
columns: the rest is pruned from the scan.
"""

from __future__ import annotations

from math import sqrt

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario import schema
from lunario.operators.information import BINS, best_features, mutual_information

# The normal-equation solver of Spark ML accepts at most this many features.
NORMAL_SOLVER_LIMIT = 4096
#: Steps of the iterative fit of wider expansions; one that needs more is refused.
MAX_STEPS = 1000


class PopScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learn mean and population deviation of each column in one pass over complete rows."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PopScalerModel:
        columns = self.getInputCols()
        vectors = VectorAssembler(inputCols=columns, outputCol="__row").transform(dataset)
        measures = Summarizer.metrics("count", "mean", "variance").summary(F.col("__row"))
        stats = vectors.select(measures.alias("s")).select("s.*").first()
        # The summarizer divides by n - 1, the scaler by n.
        shrink = (stats["count"] - 1) / stats["count"]
        return PopScalerModel(
            inputCols=columns,
            means=[float(m) for m in stats["mean"]],
            deviations=[sqrt(v * shrink) for v in stats["variance"]],
        )


class PopScalerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Replace each column by (x - mean) / deviation; a constant column is only centred."""

    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    deviations = Param(
        Params._dummy(), "deviations", "population deviations", TypeConverters.toListFloat
    )

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, deviations=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(
            self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations)
        )
        return dataset.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)
                for c, mean, deviation in fitted
            }
        )


class _SelectorParams(HasInputCols, HasLabelCol, HasOutputCol):
    k = Param(Params._dummy(), "k", "number of features to keep", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "quantile bins per column", TypeConverters.toInt)


class MutualInfoSelector(
    Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable
):
    """Keep the k columns with the highest mutual information with the label."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, outputCol=None, k=None, bins=None):
        super().__init__()
        self._setDefault(k=10, bins=BINS, labelCol=schema.TARGET, outputCol="selected")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MutualInfoSelectorModel:
        columns = self.getInputCols()
        scores = mutual_information(
            dataset, columns, self.getLabelCol(), self.getOrDefault(self.bins)
        )
        ranked = best_features(scores, self.getOrDefault(self.k)).orderBy("rank").collect()
        return MutualInfoSelectorModel(
            inputCols=columns,
            outputCol=self.getOutputCol(),
            ranking=[r["feature"] for r in ranked],
        )


class MutualInfoSelectorModel(
    Model, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Assemble the kept columns, in their input order, into one vector."""

    ranking = Param(
        Params._dummy(), "ranking", "kept features, best first", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, ranking=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def selected(self) -> list[str]:
        kept = set(self.getOrDefault(self.ranking))
        return [c for c in self.getInputCols() if c in kept]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        assembler = VectorAssembler(inputCols=self.selected(), outputCol=self.getOutputCol())
        return assembler.transform(dataset)


class Ridge(Estimator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares plus ``alpha`` times the squared weights; the intercept is free.

    Spark ML divides the loss by the row count and scales the label, so the
    penalty it needs depends on the rows at hand; it is worked out in each fit.
    """

    featuresCol = Param(
        Params._dummy(), "featuresCol", "feature vector column", TypeConverters.toString
    )
    predictionCol = Param(
        Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString
    )
    alpha = Param(Params._dummy(), "alpha", "penalty weight", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol=None, labelCol=None, predictionCol=None, alpha=None):
        super().__init__()
        self._setDefault(
            featuresCol="features", labelCol=schema.TARGET, predictionCol="preds", alpha=1.0
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        features, label = self.getOrDefault(self.featuresCol), self.getLabelCol()
        stats = dataset.agg(
            F.count(F.lit(1)).alias("n"),
            F.stddev_pop(label).alias("pop"),
            F.stddev_samp(label).alias("samp"),
        ).first()
        width = len(dataset.select(features).first()[0])
        normal = width <= NORMAL_SOLVER_LIMIT
        deviation = stats["pop"] if normal else stats["samp"]
        model = LinearRegression(
            featuresCol=features,
            labelCol=label,
            predictionCol=self.getOrDefault(self.predictionCol),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal" if normal else "l-bfgs",
            regParam=self.getOrDefault(self.alpha) * (deviation or 0.0) / stats["n"],
            maxIter=MAX_STEPS,
            tol=1e-12,
        ).fit(dataset)
        if not normal and model.summary.totalIterations >= MAX_STEPS:
            raise RuntimeError(f"{width} terms: the fit did not settle in {MAX_STEPS} steps")
        return model
