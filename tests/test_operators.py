import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lunario.model.stages import DropIncomplete, RepairNumbers, RollingFeatures, TakeColumns
from lunario.operators import information, merge, metrics, quality, rows, splits, windows
from lunario.schema import Layout
from lunario.sources.collectors import collect_bank, collect_price, collect_rain

SMALL = Layout(rain=("Maule",), gdp=("PIB",), index=("Imacec_minero",))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def long_series(n=900, seed=3):
    """One series with most rows, several short ones, gaps and repeated days."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        series = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        value = None if rnd.random() < 0.1 else round(rnd.uniform(0, 100), 2)
        out.append((series, rnd.randrange(40), i, value))
    return out


def expected_windows(data, window=3):
    frame = pd.DataFrame(data, columns=["s", "day", "id", "v"]).sort_values(["day", "id"])
    frame["s"] = frame["s"].fillna("none")
    grouped = frame.groupby("s")["v"]
    frame["mean"] = grouped.transform(lambda v: v.rolling(window, min_periods=1).mean())
    frame["std"] = grouped.transform(lambda v: v.rolling(window, min_periods=1).std())
    frame["lead"] = grouped.shift(-1)
    frame["lag"] = grouped.shift(2)
    frame["pos"] = frame.groupby("s").cumcount()
    return frame.set_index("id")


STEPS = {
    "day": lambda: F.col("day"),
    "day and key": lambda: F.struct("day", F.floor(F.col("id") / 90)),
}


@pytest.mark.parametrize(
    "step, target_rows", [("day", 1), ("day", 100), ("day and key", 7), ("day", 10_000)]
)
def test_split_windows_equal_plain_windows(spark, step, target_rows):
    data = long_series()
    want = expected_windows(data)
    df = spark.createDataFrame(data, "s string, day int, id int, v double").repartition(5)
    scale = {"unit": STEPS[step](), "target_rows": target_rows}
    order = ["day", "id"]
    rolled = windows.rolling(df, ["s"], order, ["v"], ["mean", "std"], **scale)
    both = windows.lead_label(rolled, ["s"], order, "v", "lead", **scale)
    both = windows.series_position(both, ["s"], order, "pos", **scale)
    got = both.toPandas().set_index("id").sort_index()
    assert len(got) == len(data)
    want = want.sort_index()
    np.testing.assert_allclose(got["v_rolling3_mean"], want["mean"], rtol=1e-9)
    np.testing.assert_allclose(got["v_rolling3_std"], want["std"], rtol=1e-7, atol=1e-7)
    np.testing.assert_allclose(got["lead"], want["lead"])
    assert (got["pos"] == want["pos"]).all()
    lagged = windows.lag_columns(df, ["s"], order, ["v"], 2, **scale).toPandas()
    np.testing.assert_allclose(lagged.set_index("id").sort_index()["v"], want["lag"])


def test_split_windows_without_a_series_key(spark):
    df = spark.range(500).select((F.col("id") * 1.0).alias("v"), "id")
    scale = {"unit": F.floor(F.col("id") / 10), "target_rows": 50}
    rolled = windows.rolling(df, [], ["id"], ["v"], ["mean"], 4, **scale)
    got = {r["id"]: r["v_rolling4_mean"] for r in rolled.collect()}
    assert got == {i: np.mean(range(max(0, i - 3), i + 1)) for i in range(500)}


def test_split_windows_shuffle_the_data_once(spark):
    df = spark.createDataFrame(long_series(), "s string, day int, id int, v double")
    rolled = windows.rolling(
        df, ["s"], ["day", "id"], ["v"], ["mean"], unit=F.col("day"), target_rows=50
    )
    rolled.collect()
    assert plan(rolled).count("ReusedExchange") >= 1


def test_rolling_skips_missing_values(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, float("nan")), (3, 4.0), (4, None)], "t int, x double"
    )
    got = windows.rolling(df, [], ["t"], ["x"], ["mean", "std"]).orderBy("t").collect()
    assert [r["x_rolling3_mean"] for r in got] == [1.0, 1.0, 2.5, 4.0]
    assert [r["x_rolling3_std"] for r in got] == [None, None, pytest.approx(2.1213203435596424), None]


def test_rolling_arguments(spark):
    df = spark.createDataFrame([(1, 1.0)], "t int, x double")
    assert windows.rolling(df, [], ["t"], ["absent"], ["mean"]).columns == ["t", "x"]
    assert RollingFeatures(columns=["absent"], methods=["shift"], order=["t"]).transform(df).columns == [
        "t",
        "x",
    ]
    with pytest.raises(NotImplementedError):
        RollingFeatures(columns=["x"], methods=["shift"], order=["t"]).transform(df)


def test_means_and_deviations_share_one_window(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "s int, t int, x double")
    rolled = windows.rolling(df, ["s"], ["t"], ["x"], ["mean", "std"])
    assert plan(rolled).count("Window [") == 1
    assert "SinglePartition" not in plan(rolled)
    assert "Python" not in plan(rolled)


def test_keep_first_before_dropping_incomplete_rows(spark):
    data = [
        (0, "2013-01-01", None),
        (1, "2013-01-01 00:00:00 UTC", 5),
        (2, "2013-02-01", 6),
        (3, "broken", 7),
        (4, "2020-13-01", 8),
    ]
    raw = spark.createDataFrame(
        [(i, p, None if x is None else f"1.{x}", f"9{i}.500") for i, p, x in data],
        "source_order long, Periodo string, PIB string, Imacec_minero string",
    )
    got = collect_bank(raw, layout=SMALL).collect()
    assert [(r["anio"], r["mes"], r["PIB"]) for r in got] == [(2013, 2, "1.6")]


def test_keep_first_with_one_key_holding_most_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (3000 - F.col("id")).alias("pos"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"),
    )
    first = rows.keep_first(df, ["k"], "pos")
    got = {r["k"]: (r["pos"], r["x"]) for r in first.collect()}
    assert len(got) == 1001
    assert got["hot"] == (1, None)
    assert "partial_min_by" in plan(first)


def test_collected_price_pairs(spark):
    raw = spark.createDataFrame(
        [(1979, "Ene", 3.85), (1979, "Jul", 8.10), (2014, "Mar", 227.45), (2021, "Feb", 295.24)],
        "Anio int, Mes string, Precio_leche double",
    )
    got = [tuple(r) for r in collect_price(raw).orderBy("anio", "mes").collect()]
    assert got == [(1979, 1, 3.85), (1979, 7, 8.1), (2014, 3, 227.45), (2021, 2, 295.24)]


def test_collected_rain_keeps_repeats(spark):
    raw = spark.createDataFrame(
        [("2014-02-01", 1.0), ("2014-02-11", float("nan"))], "date string, Maule double"
    )
    got = [tuple(r) for r in collect_rain(raw, layout=SMALL).orderBy("Maule").collect()]
    assert got == [(2014, 2, None), (2014, 2, 1.0)]


def three_sources(spark, months, prices):
    price = spark.createDataFrame(
        [(a, m, p) for (a, m), p in zip(months, prices)], "anio int, mes int, Precio_leche double"
    )
    rain = spark.createDataFrame([(a, m, 1.0 * m) for a, m in months], "anio int, mes int, Maule double")
    bank = spark.createDataFrame(
        [(a, m, f"{m}.000.000", "98.765.432") for a, m in months],
        "anio int, mes int, PIB string, Imacec_minero string",
    )
    return price, rain, bank


def test_label_is_the_next_row_and_gaps_do_not_count(spark):
    months, prices = [(2014, 11), (2014, 12), (2015, 1)], [10.0, 11.0, 13.0]

    def labelled(keep, **options):
        chosen = [months[i] for i in keep], [prices[i] for i in keep]
        merged = merge.merge_sources(*three_sources(spark, *chosen), layout=SMALL, **options)
        return [
            (r["anio"], r["mes"], r["Precio_leche"], r["target"])
            for r in merged.orderBy("anio", "mes").collect()
        ]

    assert labelled([0, 1, 2]) == [(2014, 11, 10.0, 11.0), (2014, 12, 11.0, 13.0)]
    assert labelled([0, 2]) == [(2014, 11, 10.0, 13.0)]
    assert labelled([0, 2], include_open_period=True)[-1] == (2015, 1, 13.0, None)


def test_label_equals_shifting_every_column(spark):
    """The published rule: move all columns down a row, drop incomplete rows."""
    rnd = random.Random(5)
    data = [(i // 12 + 2000, i % 12 + 1, rnd.choice([None, 1.0 * i, 2.0 * i])) for i in range(60)]
    df = spark.createDataFrame(data, "anio int, mes int, p double")
    frame = pd.DataFrame(data, columns=["anio", "mes", "p"])
    frame["target"] = frame["p"]
    frame[["anio", "mes", "p"]] = frame[["anio", "mes", "p"]].shift(1)
    want = [tuple(r) for r in frame.dropna().itertuples(index=False)]
    lead = windows.lead_label(df, [], ["anio", "mes"], "p")
    got = rows.drop_incomplete(lead).orderBy("anio", "mes")
    assert [tuple(r) for r in got.collect()] == want


def test_fused_lag_and_rolling(spark):
    df = spark.createDataFrame([(1, t, float(t * t % 7)) for t in range(30)], "s int, t int, x double")
    fused = windows.rolling(df, ["s"], ["t"], ["x"], ["mean", "std"], shift=1)
    lagged = windows.lag_columns(df, ["s"], ["t"], ["x"])
    chained = windows.rolling(rows.drop_incomplete(lagged), ["s"], ["t"], ["x"], ["mean", "std"])
    names = ["t", "x_rolling3_mean", "x_rolling3_std"]
    a = [tuple(r) for r in fused.where("t > 0").select(names).orderBy("t").collect()]
    b = [tuple(r) for r in chained.select(names).orderBy("t").collect()]
    assert a == b


def test_transformers_tolerate_absent_columns(spark):
    df = spark.createDataFrame([(1, "1.000", 2.0), (2, None, None)], "a int, g string, v double")
    assert TakeColumns(columns=["v", "zz", "a"]).transform(df).columns == ["v", "a"]
    with pytest.raises(ValueError):
        TakeColumns(columns=[])
    assert DropIncomplete().transform(df).count() == 1
    assert DropIncomplete(columns=["a"]).transform(df).count() == 2
    fixed = RepairNumbers(columns=["g", "a", "zz"], kind="gdp").transform(df)
    assert [r["g"] for r in fixed.orderBy("a").collect()] == [1000, None]
    assert dict(fixed.dtypes)["a"] == "int"


@pytest.mark.parametrize("n, test", [(74, 15), (10, 2), (11, 3), (1, 1), (5, 1)])
def test_split_sizes(spark, n, test):
    split = splits.train_test_split(spark.range(n), ["id"])
    assert split.where("is_test").count() == test
    assert split.count() == n


def test_split_does_not_depend_on_partitioning_and_does_not_shuffle(spark):
    one = splits.train_test_split(spark.range(1000).repartition(1), ["id"])
    seven = splits.train_test_split(spark.range(1000).repartition(7), ["id"])
    chosen = [{r["id"] for r in s.where("is_test").collect()} for s in (one, seven)]
    assert chosen[0] == chosen[1] and len(chosen[0]) == 200
    other = splits.train_test_split(spark.range(1000), ["id"], seed=7)
    assert {r["id"] for r in other.where("is_test").collect()} != chosen[0]
    assert "Exchange" not in plan(other)


def test_folds_are_even_and_disjoint(spark):
    sizes = splits.kfold(spark.range(101), ["id"]).groupBy("fold").count().collect()
    assert {r["fold"]: r["count"] for r in sizes} == {0: 34, 1: 34, 2: 33}


def test_time_split_keeps_months_whole(spark):
    df = spark.range(100).select(
        (F.col("id") / 10).cast("int").alias("anio"), F.lit(1).alias("mes"), "id"
    )
    split = splits.time_split(df, ["anio", "mes"], 0.15)
    assert {r["id"] for r in split.where("is_test").collect()} == set(range(80, 100))


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    row = metrics.regression_metrics(df, F.col("y"), F.col("p")).first()
    assert row["mse"] == pytest.approx(2 / 3)
    assert row["rmse"] == pytest.approx(math.sqrt(2 / 3))
    assert row["r2"] == pytest.approx(1 - 2 / (1 + 4 + 16 - 49 / 3))
    gate = metrics.promotion_gate(metrics.regression_metrics(df, F.col("y"), F.col("p")))
    assert gate.first()["promoted"]
    constant = metrics.regression_metrics(df, F.lit(1.0), F.col("p"))
    assert not metrics.promotion_gate(constant).first()["promoted"]


def test_split_sizes_are_exact_at_every_prefix_step(spark, monkeypatch):
    df = spark.range(700).withColumnRenamed("id", "key")
    want = {r["key"] for r in splits.train_test_split(df, ["key"], 0.2).where("is_test").collect()}
    ranked = df.select("key", splits.split_hash(["key"], 42).alias("h")).orderBy("h").limit(140)
    assert want == {r["key"] for r in ranked.collect()}
    for chars, few in ((1, 2), (3, 1)):
        monkeypatch.setattr(splits, "PREFIX_CHARS", chars)
        monkeypatch.setattr(splits, "FEW", few)
        got = splits.train_test_split(df, ["key"], 0.2).where("is_test").collect()
        assert {r["key"] for r in got} == want
        sizes = splits.kfold(df, ["key"], 3).groupBy("fold").count().collect()
        assert sorted((r["fold"], r["count"]) for r in sizes) == [(0, 234), (1, 233), (2, 233)]


def test_edges_are_exact_at_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(information, "STEPS", 8)
    monkeypatch.setattr(information, "SKETCH_ACCURACY", 50)
    rng = np.random.default_rng(4)
    spread = rng.normal(0, 1000, 3000).astype("float32")
    tied = np.where(rng.random(3000) < 0.35, 7.0, rng.integers(0, 40, 3000)).astype("float32")
    gaps = [None if i % 3 == 0 else float(v) for i, v in enumerate(spread)]
    rows = [(float(a), float(b), c) for a, b, c in zip(spread, tied, gaps)]
    df = spark.createDataFrame(rows, "spread double, tied double, gaps double")
    want = {}
    for name, values in (("spread", spread), ("tied", tied), ("gaps", [g for g in gaps if g is not None])):
        values = np.sort(np.asarray(values, dtype="float32"))
        want[name] = [float(values[int(np.ceil(i / 10 * len(values))) - 1]) for i in range(1, 10)]
    for parts in (1, 5):
        assert information.bin_edges(df.repartition(parts), list(want), accuracy=50) == want


def test_mutual_information_against_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=400)
    noise = rnd.normal(size=400)
    flat = np.repeat([0.0, 1.0], 200)
    y = x + 0.1 * rnd.normal(size=400)
    df = spark.createDataFrame(
        pd.DataFrame({"x": x, "noise": noise, "flat": flat, "twin": x, "y": y})
    )
    names = ["x", "noise", "flat", "twin"]
    got = {r["feature"]: r["score"] for r in information.mutual_information(df, names, "y").collect()}

    def bins(v):
        v = v.astype(np.float32)
        edges = [np.sort(v)[math.ceil(i / 10 * len(v)) - 1] for i in range(1, 10)]
        return np.sum([v > e for e in edges], axis=0)

    for name, v in (("x", x), ("noise", noise), ("flat", flat)):
        joint = pd.crosstab(bins(v), bins(y)).to_numpy() / 400
        outer = np.outer(joint.sum(1), joint.sum(0))
        mask = joint > 0
        assert got[name] == pytest.approx((joint[mask] * np.log(joint[mask] / outer[mask])).sum(), abs=1e-8)
    joined = plan(information.mutual_information(df, names, "y"))
    assert "BuildRight" in joined and "SortMergeJoin" not in joined
    best = information.best_features(information.mutual_information(df, names, "y"), 2)
    assert [r["feature"] for r in best.orderBy("rank").collect()] == ["twin", "x"]


def test_quality_report(spark):
    report = quality.validate_nonempty({"full": spark.range(3), "empty": spark.range(0)})
    assert {r["table_name"]: r["valid"] for r in report.collect()} == {"full": True, "empty": False}
    with pytest.raises(ValueError):
        quality.require_nonempty(spark.range(0), "empty")
