import random

import pytest
from pyspark.sql import functions as F

from lunario import schema
from lunario.model import forecast
from lunario.operators import merge, requests
from lunario.plans import jobs
from lunario.schema import Layout
from lunario.sources import requests as request_files
from lunario.streaming.score import stream_rejects, stream_score

SMALL = Layout(rain=("Coquimbo",), gdp=("PIB_Pesca",), index=("Imacec_comercio",))

# The published sample request, cut to the columns of SMALL.
SAMPLE = {
    "anio": [2014.0, 2014.0, 2014.0],
    "mes": [1.0, 2.0, 3.0],
    "Precio_leche": [213.02, 219.03, 227.45],
    "Coquimbo": [3.52467320647237, 1.68885621159928, 2.23720261467365],
    "PIB_Pesca": ["449.097.098", "530.628.153", "107.007.804"],
    "Imacec_comercio": ["103.244.622", "102.175.861", "11.737.952"],
}


def request_frame(spark, tmp_path, bodies):
    import json

    path = tmp_path / "requests.json"
    lines = [json.dumps({"request_id": k, "data": v}) for k, v in bodies.items()]
    path.write_text("\n".join(lines))
    return request_files.read_requests(spark, str(path), SMALL)


def variant(**changes):
    return {**{k: v for k, v in SAMPLE.items() if k not in changes}, **{
        k: v for k, v in changes.items() if v is not None
    }}


def test_request_checks(spark, tmp_path):
    bodies = {
        "good": SAMPLE,
        "extra": variant(other=[1, 2]),
        "missing": variant(Coquimbo=None),
        "short": variant(PIB_Pesca=["1.0", "2.0"]),
        "long": variant(mes=[1.0, 2.0, 3.0, 4.0]),
    }
    checked = requests.check_requests(request_frame(spark, tmp_path, bodies), SMALL).collect()
    assert {r["request_id"]: r["reason"] for r in checked} == {
        "good": None,
        "extra": None,
        "missing": "missing Coquimbo",
        "short": "length of PIB_Pesca is 2",
        "long": "length of mes is 4",
    }
    assert {r["request_id"] for r in checked if r["valid"]} == {"good", "extra"}


def merged_sample(spark):
    rows = [
        tuple(int(v[i]) if c in schema.TIME_COLS else v[i] for c, v in SAMPLE.items())
        for i in range(3)
    ]
    types = "anio int, mes int, Precio_leche double, Coquimbo double, PIB_Pesca string, Imacec_comercio string"
    return spark.createDataFrame(rows, types).withColumn("target", F.lit(1.0))


def test_online_features_equal_batch_features(spark, tmp_path):
    months = requests.request_months(request_frame(spark, tmp_path, {"a": SAMPLE}), SMALL)
    online = requests.request_features(months, SMALL).first().asDict()
    batch = merge.monthly_features(merged_sample(spark), layout=SMALL)
    row = batch.where("Periodo = '2014-3'").first().asDict()
    for name in SMALL.features:
        assert online[name] == pytest.approx(row[name], rel=1e-12), name
    assert row["PIB_Pesca"] == 107007804 and row["Imacec_comercio"] == 117.37


def wide_merged(spark, months=9):
    """Months of the full layout, as the merged table holds them."""
    full, rnd = schema.FULL, random.Random(4)
    rows = []
    for i in range(months):
        numbers = [rnd.uniform(0, 300) for _ in (full.price, *full.rain)]
        texts = [f"{rnd.randint(100, 999)}.{rnd.randint(100, 999)}.{rnd.randint(100, 999)}" for _ in full.texts]
        rows.append((2014, i + 1, *numbers, *texts, 1.0))
    kinds = ["int", "int"] + ["double"] * (1 + len(full.rain)) + ["string"] * len(full.texts) + ["double"]
    names = [*full.merged, schema.TARGET]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def test_all_47_columns_score_within_generated_code(spark, tmp_path):
    import json

    full, merged = schema.FULL, wide_merged(spark)
    sent = merged.orderBy("mes").collect()
    bodies = [
        {"request_id": str(i), "data": {c: [r[c] for r in sent[i : i + 3]] for c in full.merged}}
        for i in range(len(sent) - 2)
    ]
    (tmp_path / "wide.json").write_text("\n".join(map(json.dumps, bodies)))
    frame = request_files.read_requests(spark, str(tmp_path / "wide.json"))
    online = requests.request_features(requests.request_months(frame))
    assert len(full.merged) == 49 and len(full.features) == 141
    batch = {r["Periodo"]: r for r in merge.monthly_features(merged).collect()}
    got = online.drop("months").collect()
    assert len(got) == 7
    for r in got:
        want = batch[f"2014-{int(r['request_id']) + 3}"]
        for name in full.features:
            assert r[name] == pytest.approx(want[name], rel=1e-12), name

    rnd = random.Random(8)
    names = [*full.features, "target"]
    train = spark.createDataFrame([[rnd.uniform(0, 100) for _ in names] for _ in range(40)], names)
    model = forecast.fit_model(train, {"selector__k": 3, "poly__degree": 2, "model__alpha": 0.2})
    scored = requests.log_rows(requests.score_requests(frame, model))
    assert scored.count() == 21
    # Every stage compiles: a method above the limit of 64 KB would have been left out.
    plan = scored._jdf.queryExecution().executedPlan()
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and all(0 < size < 1 << 16 for size in sizes)


def test_last_complete_month_is_used(spark, tmp_path):
    broken_last = variant(PIB_Pesca=["449.097.098", "530.628.153", "oops"])
    broken_middle = variant(Coquimbo=[1.0, None, 3.0])
    hopeless = variant(Imacec_comercio=["103.244.622", "1", None])
    bodies = {"last": broken_last, "middle": broken_middle, "none": hopeless}
    months = requests.request_months(request_frame(spark, tmp_path, bodies), SMALL)
    got = {r["request_id"]: r for r in requests.request_features(months, SMALL).collect()}
    assert set(got) == {"last", "middle"}
    assert got["last"]["Precio_leche"] == 219.03
    assert got["middle"]["Precio_leche"] == 227.45
    assert got["middle"]["Coquimbo_rolling3_mean"] == 2.0


def test_only_text_cells_are_repaired(spark, tmp_path):
    numbers = variant(
        PIB_Pesca=["449.097.098", 5.5, 123456.0], Imacec_comercio=[100.25, "102.175.861", 976.1]
    )
    frame = request_frame(spark, tmp_path, {"a": numbers, "huge": variant(PIB_Pesca=["1", "2", 1e308])})
    months = requests.request_months(frame, SMALL)
    got = {r["request_id"]: r for r in requests.request_features(months, SMALL).collect()}
    assert got["a"]["PIB_Pesca"] == 123456.0 and got["a"]["Imacec_comercio"] == 976.1
    assert got["a"]["PIB_Pesca_rolling3_mean"] == pytest.approx((449097098 + 5.5 + 123456) / 3)
    assert got["huge"]["PIB_Pesca"] == 1e308
    rows = requests.request_rows(months.where("request_id = 'a'"), SMALL).orderBy("pos").collect()
    assert [r["PIB_Pesca"] for r in rows] == ["449.097.098", "5.5000000000", "123456.0000000000"]
    assert [r["Imacec_comercio"] for r in rows] == ["100.2500000000", "102.175.861", "976.1000000000"]


def test_months_can_be_sorted(spark, tmp_path):
    mixed = {c: [v[2], v[0], v[1]] for c, v in SAMPLE.items()}
    frame = request_frame(spark, tmp_path, {"a": mixed})
    as_sent = requests.request_rows(requests.request_months(frame, SMALL)).collect()
    in_order = requests.request_rows(
        requests.request_months(frame, SMALL, sort_months=True)
    ).collect()
    assert [r["mes"] for r in as_sent] == [3.0, 1.0, 2.0]
    assert [r["mes"] for r in in_order] == [1.0, 2.0, 3.0]
    assert [r["pos"] for r in in_order] == [1, 2, 0]


def test_ids_are_repeatable(spark, tmp_path):
    frame = request_frame(spark, tmp_path, {"a": SAMPLE}).withColumn(
        "request_id", F.lit(None).cast("string")
    )
    ids = {request_files.with_request_ids(frame).first()["request_id"] for _ in range(2)}
    assert len(ids) == 1 and None not in ids


def random_model(spark):
    rnd = random.Random(2)
    rows = [
        tuple(rnd.uniform(0, 100) for _ in SMALL.features) + (rnd.uniform(0, 300),)
        for _ in range(60)
    ]
    train = spark.createDataFrame(rows, [*SMALL.features, "target"])
    params = {"selector__k": 3, "poly__degree": 1, "model__alpha": 0.2}
    return forecast.fit_model(train, params, SMALL.features)


def test_stream_equals_batch_and_log_is_idempotent(spark, tmp_path):
    model = random_model(spark)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    bodies = {f"r{i}": variant(Precio_leche=[200.0 + i, 210.0, 220.0 + i]) for i in range(12)}
    bodies["bad"] = variant(mes=[1.0])
    frame = request_frame(spark, inbox, bodies)
    scored = requests.score_requests(frame, model, SMALL)
    log = requests.log_rows(scored, SMALL)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert [f.name for f in log.schema] == [f.name for f in SMALL.request_log()]

    path = str(tmp_path / "log")
    for _ in range(2):
        request_files.append_log(log, path, "7")
    batch = sorted(map(tuple, request_files.read_log(spark, path).collect()))
    assert len(batch) == 36
    head = request_files.log_head(request_files.read_log(spark, path), 5).collect()
    assert [tuple(r) for r in head] == batch[:5]

    out, state = str(tmp_path / "stream"), str(tmp_path / "state")
    for _ in range(2):  # the second run finds nothing new
        stream = request_files.stream_requests(spark, str(inbox), SMALL)
        stream_score(stream, model, out, state, once=True, layout=SMALL).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == batch

    rejects, state = str(tmp_path / "rejects"), str(tmp_path / "reject-state")
    stream = request_files.stream_requests(spark, str(inbox), SMALL)
    stream_rejects(stream, rejects, state, once=True, layout=SMALL).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(rejects).collect()] == [("bad", "length of mes is 1")]


def test_lookup_statuses(spark):
    predictions = spark.createDataFrame(
        [("2014-2", 219.6, 0), ("2014-10", 219.7651880819884, 1), ("2014-10", 1.0, 2)],
        "Periodo string, preds double, line int",
    )
    asked = [
        (1, "2014", "10"),
        (2, "2014", "02"),
        (3, "2014", ""),
        (4, None, "3"),
        (5, "2031", "1"),
        (6, "2014", "x"),
    ]
    lookups = spark.createDataFrame(asked, "request_id int, year string, month string")
    found = requests.lookup_predictions(lookups, predictions, first_by="line")
    assert {r["request_id"]: (r["prediction"], r["status"]) for r in found.collect()} == {
        1: (219.7651880819884, "ok"),
        2: (219.6, "ok"),
        3: (None, "missing argument"),
        4: (None, "missing argument"),
        5: (None, "invalid period"),
        6: (None, "invalid period"),
    }


def raw_files(folder, months=40):
    """Raw CSV files in the published layouts: CRLF, month names, broken dates, extra columns."""
    names = "Ene Feb Mar Abr May Jun Jul Ago Sep Oct Nov Dic".split()
    rnd = random.Random(9)
    periods = [(2014 + i // 12, i % 12 + 1) for i in range(months)]
    price = ["Anio,Mes,Precio_leche"] + [
        f"{a},{names[m - 1]},{200 + i + rnd.uniform(0, 9):.2f}" for i, (a, m) in enumerate(periods)
    ]
    rain = ["date,Other,Coquimbo"] + [f"{a}-{m:02d}-01,x,{rnd.uniform(0, 9):.3f}" for a, m in periods]
    bank = ["Periodo,PIB_Pesca,Imacec_comercio,Other"]
    for i, (a, m) in enumerate(periods):
        number = f"{400 + i}.{rnd.randrange(100, 999)}.{rnd.randrange(100, 999)}"
        index = f"10{i % 9}.{rnd.randrange(100, 999)}.{rnd.randrange(100, 999)}"
        bank.append(f"{a}-{m:02d}-01 00:00:00 UTC,{number},{index},x")
        if i == 20:
            bank.append(f"{a}-{m:02d}-01,1.1,100.1,second copy loses")
    bank.append("2099-13-01,1.1,100.1,x")
    for name, lines in (
        ("precio_leche.csv", price),
        ("precipitaciones.csv", rain),
        ("banco_central.csv", bank),
    ):
        (folder / name).write_bytes("\r\n".join(lines).encode())
    return periods


def test_jobs_from_raw_files_to_predictions(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    periods = raw_files(raw)
    training = jobs.Run(str(raw), str(tmp_path / "train"), layout=SMALL)
    space = {"selector__k": [1, 2], "poly__degree": [1], "model__alpha": [1, 0.2]}
    verdict = jobs.training_job(spark, training, space).first()
    assert verdict["promoted"] and verdict["mse"] > 0
    merged = spark.read.parquet(training.path("interm", "merged"))
    assert merged.count() == len(periods) - 1
    features = spark.read.parquet(training.path("interm", "features"))
    assert features.count() == len(periods) - 2
    test = spark.read.parquet(training.path("preprocessed")).where("side = 'test'").count()
    assert test == -(-features.count() // 5)

    scoring = jobs.Run(str(raw), str(tmp_path / "score"), layout=SMALL)
    artifacts = training.path("artifacts")
    closed = jobs.prediction_job(spark, scoring, artifacts)
    labels = {r["Periodo"] for r in closed.collect()}
    assert labels == {f"{a}-{m}" for a, m in periods[1:-1]}
    open_month = jobs.prediction_job(spark, scoring, artifacts, include_open_period=True)
    last = "{}-{}".format(*periods[-1])
    assert {r["Periodo"] for r in open_month.collect()} == labels | {last}
