"""Scoring requests from JSON files and the append-only request log.

A cell of a text column is read as a struct ``(text, number)``: ``number`` is set
where the client sent a JSON number, which needs no repair.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lunario.schema import FULL, Layout


NUMBER_KINDS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _cell(sent: Column) -> Column:
    """(text, number) of one cell; a number too large for a double is none."""
    number = F.when(
        F.schema_of_variant(sent).rlike(NUMBER_KINDS), F.try_variant_get(sent, "$", "double")
    )
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    return F.struct(
        F.try_variant_get(sent, "$", "string").alias("text"), finite.alias("number")
    )


def _with_cells(sent: DataFrame, layout: Layout) -> DataFrame:
    columns = [
        F.transform(f"data.{c}", _cell).alias(c) if c in layout.texts else F.col(f"data.{c}")
        for c in layout.required
    ]
    return sent.withColumn("data", F.struct(*columns))


def read_requests(
    spark: SparkSession, path: str, layout: Layout = FULL
) -> DataFrame:
    """One request per JSON line; keys outside the schema are ignored."""
    return _with_cells(spark.read.schema(layout.request()).json(path), layout)


def stream_requests(
    spark: SparkSession,
    path: str,
    layout: Layout = FULL,
    files_per_batch: int = 1000,
) -> DataFrame:
    """The same as a stream over a folder that receives request files."""
    stream = spark.readStream.schema(layout.request())
    return _with_cells(stream.option("maxFilesPerTrigger", files_per_batch).json(path), layout)


def write_requests(requests: DataFrame, path: str) -> None:
    requests.write.mode("overwrite").json(path)


def with_request_ids(requests: DataFrame) -> DataFrame:
    """Fill a missing id with a digest of the request, so that a retry gives the same id."""
    digest = F.sha2(F.to_json("data"), 256)
    return requests.withColumn("request_id", F.coalesce("request_id", digest))


def append_log(log: DataFrame, path: str, batch: str) -> None:
    """Add one batch of log rows; writing the same batch again replaces it."""
    log.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch}"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch")


def log_head(log: DataFrame, limit: int = 100) -> DataFrame:
    """The first ``limit`` log rows in request and month order."""
    return log.orderBy("request_id", "pos").limit(limit)
