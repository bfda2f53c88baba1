"""The feature steps as Spark ML transformers, so that they persist in one pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario import schema
from lunario.functions import period_label
from lunario.operators import merge, rows, windows


class _HasColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.toListString)

    def getColumns(self) -> list[str]:
        return self.getOrDefault(self.columns)


class TakeColumns(Transformer, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the listed columns that exist, in list order, after any key columns."""

    keys = Param(Params._dummy(), "keys", "key columns to carry along", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None, keys=None):
        super().__init__()
        self._setDefault(keys=[])
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if "columns" in given and not given["columns"]:
            raise ValueError("give at least one column")
        self._set(**given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return rows.take_columns(dataset, [*self.getOrDefault(self.keys), *self.getColumns()])


class DropIncomplete(Transformer, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Drop rows with a missing value in the listed columns; no list means all columns."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(columns=list(self._input_kwargs.get("columns") or []))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return rows.drop_incomplete(dataset, self.getColumns())


class RepairNumbers(Transformer, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Repair text numbers; absent and non-text columns pass through."""

    kind = Param(Params._dummy(), "kind", "gdp or index", TypeConverters.toString)
    strict = Param(Params._dummy(), "strict", "raise on broken text", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, kind=None, strict=None):
        super().__init__()
        self._setDefault(strict=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return merge.repair_numbers(
            dataset, self.getColumns(), self.getOrDefault(self.kind), self.getOrDefault(self.strict)
        )


class RollingFeatures(Transformer, _HasColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Append trailing-window statistics named ``{column}_rolling{window}_{method}``.

    ``unit`` is an SQL expression for the steps that long series may be cut at.
    """

    methods = Param(Params._dummy(), "methods", "mean and/or std", TypeConverters.toListString)
    window = Param(Params._dummy(), "window", "rows in the window", TypeConverters.toInt)
    series = Param(Params._dummy(), "series", "series key columns", TypeConverters.toListString)
    order = Param(Params._dummy(), "order", "row order columns", TypeConverters.toListString)
    unit = Param(Params._dummy(), "unit", "step of the row order", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, columns=None, methods=None, window=None, series=None, order=None, unit=None
    ):
        super().__init__()
        self._setDefault(
            methods=["mean"],
            window=schema.ROLLING_WINDOW,
            series=[],
            order=list(schema.TIME_COLS),
            unit="",
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        unit = self.getOrDefault(self.unit)
        return windows.rolling(
            dataset,
            self.getOrDefault(self.series),
            self.getOrDefault(self.order),
            self.getColumns(),
            self.getOrDefault(self.methods),
            self.getOrDefault(self.window),
            unit=F.expr(unit) if unit else None,
        )


class PeriodLabel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add the period label of the year and month columns."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(schema.PERIOD, period_label(F.col("anio"), F.col("mes")))
