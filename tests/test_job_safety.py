"""Promotion, replayed batches, malformed rows, saved headers, drift and ordered splits."""

import datetime
import json
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lunario.model import forecast
from lunario.operators import drift, requests, splits
from lunario.schema import Layout
from lunario.sources import files
from lunario.sources import requests as request_files
from lunario.streaming import score as streaming

SMALL = Layout(rain=("Coquimbo",), gdp=("PIB_Pesca",), index=("Imacec_comercio",))


def fitted(spark, slope):
    rnd = random.Random(3)
    rows = [(float(i % 17), rnd.random(), slope * (i % 17) + rnd.random()) for i in range(60)]
    train = spark.createDataFrame(rows, ["a", "b", "target"])
    return forecast.fit_model(train, {"selector__k": 1, "poly__degree": 1, "model__alpha": 0.1}, ["a", "b"])


def predicted(spark, model):
    return round(model.transform(spark.createDataFrame([(10.0, 0.5)], ["a", "b"])).first()["preds"])


@pytest.fixture()
def staged_models(spark, tmp_path):
    metrics = spark.createDataFrame([(60, 1.0, 1.0, 0.9)], "n long, mse double, rmse double, r2 double")
    for name, slope in (("old", 1.0), ("new", 5.0)):
        forecast.save_model(fitted(spark, slope), str(tmp_path / name))
    return metrics, str(tmp_path / "old"), str(tmp_path / "new"), str(tmp_path / "prod")


def test_the_newest_promotion_is_live(spark, staged_models):
    metrics, old, new, prod = staged_models
    with pytest.raises(ValueError, match="no model"):
        forecast.load_promoted(spark, prod)
    for staging, want in ((old, 10), (new, 50), (old, 10)):
        forecast.promote(metrics, staging, prod)
        assert abs(predicted(spark, forecast.load_promoted(spark, prod)) - want) <= 1
    assert len(os.listdir(os.path.join(prod, "versions"))) == 3


@pytest.mark.parametrize("step", ["model", "half a model", "pointer", "half a pointer"])
def test_a_promotion_that_fails_leaves_the_old_model_live(spark, staged_models, monkeypatch, step):
    metrics, old, new, prod = staged_models
    forecast.promote(metrics, old, prod)
    save = forecast.save_model

    def broken_save(model, path):
        if step == "half a model":
            save(model, path)
            os.remove(os.path.join(path, "metadata", "_SUCCESS"))
        raise OSError("executor lost")

    def broken_point(spark, prod_path, seq, version):
        if step == "half a pointer":
            # What a write that did not end leaves behind.
            left = os.path.join(prod_path, "pointers", version, "_temporary", "0")
            os.makedirs(left)
            with open(os.path.join(left, "part-0.json"), "w") as file:
                json.dump({"seq": seq, "version": version}, file)
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        if "model" in step:
            patch.setattr(forecast, "save_model", broken_save)
        else:
            patch.setattr(forecast, "_point", broken_point)
        with pytest.raises(OSError):
            forecast.promote(metrics, new, prod)
    assert abs(predicted(spark, forecast.load_promoted(spark, prod)) - 10) <= 1
    forecast.promote(metrics, new, prod)
    assert abs(predicted(spark, forecast.load_promoted(spark, prod)) - 50) <= 1


def test_a_rejected_model_is_not_promoted(spark, staged_models):
    metrics, old, new, prod = staged_models
    forecast.promote(metrics, old, prod)
    with pytest.raises(ValueError, match="rejected"):
        forecast.promote(metrics.withColumn("r2", F.lit(-1.0)), new, prod)
    assert abs(predicted(spark, forecast.load_promoted(spark, prod)) - 10) <= 1


def body(price, months=3):
    return {"anio": [2014.0] * months, "mes": [1.0, 2.0, 3.0][:months], "Precio_leche": [price, 210.0, 220.0],
            "Coquimbo": [3.5, 1.7, 2.2], "PIB_Pesca": ["449.097.098", "530.628.153", "107.007.804"],
            "Imacec_comercio": ["103.244.622", "102.175.861", "11.737.952"]}


def small_model(spark):
    rnd = random.Random(2)
    rows = [tuple(rnd.uniform(0, 100) for _ in [*SMALL.features, "y"]) for _ in range(60)]
    train = spark.createDataFrame(rows, [*SMALL.features, "target"])
    return forecast.fit_model(train, {"selector__k": 3, "poly__degree": 1, "model__alpha": 0.2}, SMALL.features)


def test_a_replayed_batch_leaves_the_same_rows(spark, tmp_path, monkeypatch):
    inbox, model = tmp_path / "inbox", small_model(spark)
    inbox.mkdir()
    bodies = [{"request_id": f"r{i}", "data": body(200.0 + i)} for i in range(9)]
    bodies += [{"request_id": "bad", "data": body(1.0, months=1)}, {"data": body(300.0)}]
    (inbox / "a.json").write_text("\n".join(map(json.dumps, bodies)))
    log, rejects, state = (str(tmp_path / n) for n in ("log", "rejects", "state"))

    def run():
        stream = request_files.stream_requests(spark, str(inbox), SMALL)
        streaming.stream_log_and_rejects(
            stream, model, log, rejects, state, once=True, layout=SMALL
        ).awaitTermination()

    append, failed = streaming.append_log, []

    def fails_between_the_sinks(rows, path, batch):
        if path == rejects and not failed:
            failed.append(batch)
            raise OSError("executor lost")
        append(rows, path, batch)

    monkeypatch.setattr(streaming, "append_log", fails_between_the_sinks)
    with pytest.raises(Exception, match="executor lost"):
        run()
    # The log of the batch stands already, the batch runs again as a whole.
    assert failed == ["0"] and len(os.listdir(log)) == 1
    run()
    rows = request_files.read_log(spark, log).collect()
    assert len(rows) == 30 and len({(r["request_id"], r["pos"]) for r in rows}) == 30
    assert all(r["request_id"] for r in rows)
    assert [tuple(r) for r in request_files.read_log(spark, rejects).collect()] == [("bad", "length of anio is 1")]
    (inbox / "b.json").write_text(json.dumps({"request_id": "late", "data": body(250.0)}))
    run()
    assert request_files.read_log(spark, log).count() == 33


LINES = T.StructType().add("n", T.IntegerType()).add("x", T.DoubleType()).add("day", T.DateType())


def test_malformed_rows_are_put_aside(spark, tmp_path):
    (tmp_path / "1.csv").write_text("x,n,other,day\n1.5,1,a,2020-01-01\noops,2,b,2020-01-02\n2.5,3\n,4,,\n")
    (tmp_path / "2.csv").write_text("x,n,other,day\n3.5,5.5,c,2020-01-03\n4.5,6,d,soon\n5.5,7,e,2020-01-04,9\n6,8,,2020-02-01\n")
    good, bad = files.read_checked_csv(spark, str(tmp_path), LINES, "place", bad_share=0.7)
    assert sorted((r["n"], r["x"], str(r["day"])) for r in good.collect()) == [
        (1, 1.5, "2020-01-01"), (4, None, "None"), (8, 6.0, "2020-02-01"),
    ]
    assert good.orderBy("place").first()["n"] in (1, 8) and good.columns == ["n", "x", "day", "place"]
    found = {(r["file"].rsplit("/", 1)[1], r["reason"]) for r in bad.collect()}
    assert found == {
        ("1.csv", "x is no double: oops"), ("1.csv", "wrong number of cells"), ("2.csv", "n is no int: 5.5"),
        ("2.csv", "day is no date: soon"), ("2.csv", "wrong number of cells"),
    }
    assert "2.5,3" in {r["line"] for r in bad.collect()}
    with pytest.raises(ValueError, match="5 of 8 rows"):
        files.read_checked_csv(spark, str(tmp_path), LINES, bad_share=0.5)
    with pytest.raises(ValueError, match="missing"):
        files.read_checked_csv(spark, str(tmp_path), T.StructType([*LINES.fields, T.StructField("z", T.StringType())]))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "1.csv").write_text("x,n,day\n")
    good, bad = files.read_checked_csv(spark, str(tmp_path / "empty"), LINES)
    assert good.isEmpty() and bad.isEmpty()


def test_a_column_known_from_the_header_alone_is_required(spark, tmp_path):
    merged = spark.createDataFrame(
        [], "region string, anio int, mes int, Precio_leche double, Coquimbo double, PIB_Pesca string, "
        "Imacec_comercio string, Otros double, target double"
    )
    assert requests.required_columns(merged, ["region"])[-1] == "Otros"
    path = str(tmp_path / "header")
    requests.write_header(merged, path, ["region"])
    layout = requests.read_header(spark, path)
    assert layout == Layout(SMALL.rain, SMALL.gdp, SMALL.index, extra=("Otros",))
    bodies = {"with": {**body(1.0), "Otros": [1, "x", None]}, "without": body(1.0), "short": {**body(1.0), "Otros": [1]}}
    lines = [json.dumps({"request_id": k, "data": v}) for k, v in bodies.items()]
    (tmp_path / "r.json").write_text("\n".join(lines))
    sent = request_files.read_requests(spark, str(tmp_path / "r.json"), layout)
    checked = {r["request_id"]: r["reason"] for r in requests.check_requests(sent, layout).collect()}
    assert checked == {"with": None, "without": "missing Otros", "short": "length of Otros is 1"}
    scored = requests.score_requests(sent, small_model(spark), layout)
    assert [r["request_id"] for r in scored.collect()] == ["with"]
    with pytest.raises(ValueError, match="header"):
        Layout.of_header(["anio", "mes"])


def brute_drift(edges, old, new):
    def counts(values):
        found = [0] * (len(edges) + 2)
        for v in values:
            found[-1 if v is None or math.isnan(v) else sum(np.float32(v) > np.float32(e) for e in edges)] += 1
        return found

    b, c = counts(old), counts(new)
    share = lambda n: [(x + 0.5) / (sum(n) + 0.5 * len(n)) for x in n]
    psi = sum((p - q) * math.log(p / q) for p, q in zip(share(b), share(c)))
    nb, nc = sum(b[:-1]), sum(c[:-1])
    ks = max(abs(sum(b[:i]) / nb - sum(c[:i]) / nc) for i in range(1, len(edges) + 1)) if nb and nc else None
    return psi, ks


def test_drift_equals_brute_force_and_profiles_merge(spark):
    rnd = random.Random(6)
    old = [(float(rnd.randint(0, 40)), rnd.gauss(0, 1) if i % 9 else None, float("nan") if i % 5 == 0 else 1.0) for i in range(500)]
    new = [(float(rnd.randint(20, 60)), rnd.gauss(0, 1), None) for _ in range(300)]
    columns = "a double, b double, c double"
    before, now = spark.createDataFrame(old, columns).repartition(3), spark.createDataFrame(new, columns)
    stored = drift.profile(before, ["a", "b", "c"])
    report = drift.drift(stored, now).orderBy("position").collect()
    edges = {r["feature"]: r["edges"] for r in stored.collect()}
    for i, r in enumerate(report):
        # The edges are single precision, and so are the values beside them.
        psi, ks = brute_drift(edges[r["feature"]], [x[i] for x in old], [x[i] for x in new])
        assert r["psi"] == pytest.approx(psi, rel=1e-6)
        assert r["ks"] is None if ks is None else r["ks"] == pytest.approx(ks)
        assert (r["n_before"], r["n_now"]) == (500, 300)
    same = drift.drift(stored, before).collect()
    assert all(r["psi"] == 0 and r["ks"] == 0 for r in same)
    # Counts on the same edges add up: twice the data, the same shares.
    twice = drift.merge_profiles(stored, stored)
    counts = {r["feature"]: r["counts"] for r in stored.collect()}
    assert all(r["counts"] == [2 * n for n in counts[r["feature"]]] for r in twice.collect())
    rows = {r["feature"]: r["n"] for r in twice.select("feature", F.kll_sketch_get_n_double("sketch").alias("n")).collect()}
    assert rows["a"] == 1000
    assert all(r["n_before"] == 1000 for r in drift.drift(twice, now).collect())


TIMES = {
    "bigint": lambda n: n * 10**15 - 5 * 10**17,
    "int": lambda n: n - 500,
    "date": lambda n: datetime.date(1960, 1, 1) + datetime.timedelta(n),
    "timestamp": lambda n: datetime.datetime(1969, 12, 31) + datetime.timedelta(microseconds=n * 7919),
    "timestamp_ntz": lambda n: datetime.datetime(2024, 3, 31, 1) + datetime.timedelta(seconds=n * 11),
}


@pytest.mark.parametrize("kind", list(TIMES))
@pytest.mark.parametrize("share", [0.0, 0.013, 0.2, 1.0])
def test_ordered_split_equals_ranking(spark, monkeypatch, kind, share):
    monkeypatch.setattr(splits, "PARTS", 8)
    rnd = random.Random(5)
    draws = [rnd.randrange(300) for _ in range(500)]
    rows = [(i, TIMES[kind](n), n % 3) for i, n in enumerate(draws)]
    table = spark.createDataFrame(rows, f"id int, t {kind}, u int").repartition(4)
    for columns in (["t"], ["u", "t"]):
        got = {r["id"] for r in splits.time_split(table, columns, share).where("is_test").collect()}
        key = (lambda r: r[1]) if columns == ["t"] else (lambda r: (r[2], r[1]))
        wanted, want = math.ceil(share * len(rows)), set()
        for edge in sorted({key(r) for r in rows}, reverse=True):
            if len(want) >= wanted:
                break
            want |= {r[0] for r in rows if key(r) == edge}
        assert got == want


def test_ordered_split_of_odd_tables(spark):
    empty = spark.createDataFrame([], "t timestamp")
    assert splits.time_split(empty, ["t"]).isEmpty()
    some = spark.createDataFrame([(None,), (None,), (3,), (3,), (5,)], "t int")
    count = lambda share: splits.time_split(some, ["t"], share).where("is_test").count()
    assert [count(s) for s in (0.2, 0.4, 0.6, 0.8)] == [1, 3, 3, 5]
    wide = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "t bigint")
    assert [r["t"] for r in splits.time_split(wide, ["t"], 0.3).where("is_test").collect()] == [2**63 - 1]
    with pytest.raises(TypeError, match="string"):
        splits.time_split(spark.createDataFrame([("a",)], "t string"), ["t"])
