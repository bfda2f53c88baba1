"""Windows over split series: the same rows as the plain window, one partition per cut."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lunario.operators import splits, windows
from lunario.sources import files


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(600).select(
        F.col("id").alias("t"),
        # Ids fall and rise while time goes on.
        F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("e"),
        (F.col("id") % 3 == 0).cast("int").alias("s"),
        (F.pmod(F.xxhash64("id"), F.lit(97)) / 7).alias("x"),
    )
    return rows.cache()


@pytest.mark.parametrize("target", [1, 3, 40])
@pytest.mark.parametrize("step", [2, 25])
def test_split_equals_plain(events, target, step):
    outputs = {
        "mean": lambda w: F.avg("x").over(w.rowsBetween(-5, 0)),
        "next": lambda w: F.lead("x", 2).over(w),
    }
    unit = F.floor(F.col("t") / step)
    split = windows.over_series(
        events, ["s"], ["t", "e"], outputs, before=5, after=2, unit=unit, target_rows=target
    )
    plain = windows.over_series(events, ["s"], ["t", "e"], outputs, before=5, after=2)
    assert split.count() == 600
    assert plain.exceptAll(split).isEmpty()
    numbered = windows.series_position(events, ["s"], ["t", "e"], unit=unit, target_rows=target)
    whole = Window.partitionBy("s").orderBy("t", "e")
    wrong = numbered.withColumn("want", F.row_number().over(whole) - 1).where("want <> position")
    assert wrong.isEmpty()


def test_no_window_of_a_whole_series(events):
    outputs = {"next": lambda w: F.lead("x").over(w)}
    split = windows.over_series(
        events, ["s"], ["t"], outputs, after=1, unit=F.floor(F.col("t") / 10), target_rows=20
    )
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    kinds = [line for line in plan.splitlines() if "windowspecdefinition" in line.lower()]
    assert kinds and all("__run" in line or "__cut" in line for line in kinds)


@pytest.mark.parametrize("series", [[], ["s"]])
def test_a_unit_that_holds_all_rows_is_split(events, series):
    outputs = {
        "mean": lambda w: F.avg("x").over(w.rowsBetween(-3, 0)),
        "next": lambda w: F.lead("x", 2).over(w),
    }
    scale = {"unit": F.lit("one minute"), "target_rows": 40}
    split = windows.over_series(events, series, ["t", "e"], outputs, before=3, after=2, **scale)
    plain = windows.over_series(events, series, ["t", "e"], outputs, before=3, after=2)
    assert split.count() == 600 and plain.exceptAll(split).isEmpty()
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    kinds = [line for line in plan.splitlines() if "windowspecdefinition" in line.lower()]
    assert kinds and all("__run" in line or "__cut" in line for line in kinds)

    tagged, runs = windows._runs_of_long_series(events, series, target_rows=40, unit=scale["unit"], order=["t", "e"])
    assert tagged.where("__unit IS NULL").isEmpty()
    sizes = windows._attach_runs(tagged, runs, series).groupBy(*series, "__run").count()
    largest = sizes.agg(F.max("count")).first()[0]
    assert sizes.count() >= 10 and largest <= 3 * 40

    numbered = windows.series_position(events, series, ["t", "e"], **scale)
    whole = Window.partitionBy(*series).orderBy("t", "e")
    assert numbered.withColumn("want", F.row_number().over(whole) - 1).where("want <> position").isEmpty()


def test_null_series_and_units_are_split_as_well(events):
    rows = events.withColumn("s", F.when(F.col("s") == 1, 1)).withColumn("u", F.when(F.col("t") >= 200, F.col("t")))
    outputs = {"last": lambda w: F.lag("x", 1).over(w)}
    split = windows.over_series(rows, ["s"], ["t"], outputs, before=1, unit=F.col("u"), target_rows=30)
    plain = windows.over_series(rows, ["s"], ["t"], outputs, before=1)
    assert plain.exceptAll(split).isEmpty() and split.count() == 600


def test_overlapping_units_are_refused(events):
    with pytest.raises(ValueError, match="overlap"):
        windows.lead_label(
            events, ["s"], ["t"], "x", unit=F.floor(F.col("e") / 10), target_rows=10
        )


def test_null_keys_do_not_collide(spark):
    rows = spark.createDataFrame([(1, None), (None, 1), (None, None), (2, 2), (3, None),
                                  (None, 3), (4, 4), (5, None), (None, 5), (6, 6)], "a int, b int")
    split = splits.train_test_split(rows, ["a", "b"], 0.1)
    assert split.where("is_test").count() == 1


def test_another_header_stops_the_read(spark, tmp_path):
    (tmp_path / "1.csv").write_text("x,y\n1,2\n")
    (tmp_path / "2.csv").write_text("y,x\n20,10\n")
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), wanted).collect()
