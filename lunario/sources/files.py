"""Table files: CSV with a declared schema, Parquet stage tables, file row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lunario.session import stage_table

_LINE, _ORDER = "__line", "__order"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, source_order: str | None = None
) -> DataFrame:
    """CSV with a header row; malformed rows stop the job, empty cells are NULL.

    Columns are found by header name, extra file columns are ignored and a
    missing one is an error. All files of a folder must have one header: another
    column order stops the job instead of being read by position. ``source_order``
    adds a sortable column that follows file and line order.
    """
    reader = (
        spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    )
    header = reader.csv(path)
    missing = [f.name for f in schema.fields if f.name not in header.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    wanted = {f.name: f for f in schema.fields}
    whole = T.StructType(
        [wanted.get(c, T.StructField(c, T.StringType())) for c in header.columns]
    )
    rows = reader.schema(whole).csv(path)
    if source_order is None:
        return rows.select(*schema.names)
    return with_source_order(rows, source_order).select(*schema.names, source_order)


def read_checked_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source_order: str | None = None,
    *,
    header: bool = True,
    bad_share: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """Good rows of a CSV folder, and its malformed rows as (file, line, reason).

    A row is malformed if it has too few or too many cells, or a cell that is no
    value of its column's type; the first fault is the reason. The files are read
    once. More malformed rows than ``bad_share`` of all stop the job, as do a
    missing column and files of different headers. Without ``header`` columns go
    by position.
    """
    reader = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not header)
        .option("columnNameOfCorruptRecord", _LINE)
    )
    names = reader.csv(path).columns if header else schema.names
    missing = [c for c in schema.names if c not in names]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    cells = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _LINE]])
    rows = with_source_order(reader.schema(cells).csv(path), _ORDER)
    faults = [F.when(F.col(_LINE).isNotNull(), F.lit("wrong number of cells"))]
    typed = []
    for field in schema.fields:
        cell = F.col(f"`{field.name}`")
        value = cell.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        said = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), cell)
        faults.append(F.when(cell.isNotNull() & value.isNull(), said))
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    checked = stage_table(
        rows.select(
            *typed,
            F.col(_ORDER),
            F.coalesce(*faults).alias("__reason"),
            line.alias(_LINE),
        ),
        "checked-csv",
    )
    bad = checked.where("__reason IS NOT NULL").select(
        F.col(f"{_ORDER}.file").alias("file"), F.col(_LINE).alias("line"), F.col("__reason").alias("reason")
    )
    counts = checked.agg(F.count(F.lit(1)).alias("rows"), F.count("__reason").alias("bad")).first()
    if counts["bad"] > bad_share * counts["rows"]:
        raise ValueError(
            f"{counts['bad']} of {counts['rows']} rows in {path} are malformed: {bad.first()['reason']}"
        )
    good = checked.where("__reason IS NULL")
    if source_order is None:
        return good.select(*schema.names), bad
    return good.select(*schema.names, F.col(_ORDER).alias(source_order)), bad


def with_source_order(rows: DataFrame, name: str = "source_order") -> DataFrame:
    """Add a struct that sorts rows of a file scan by file, block and line."""
    return rows.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] = []) -> None:
    """Replace a Parquet table; dynamic sizes are left to adaptive execution."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
