"""Session settings for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "lunario") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local path would not be visible to the executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    shared = tempfile.mkdtemp(prefix="lunario-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the scratch root."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage so that several consumers do not recompute ``df``, survives the
    loss of executors, and gives the planner the true file size, so a join
    against the result is broadcast only when it is below the session's
    threshold.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
