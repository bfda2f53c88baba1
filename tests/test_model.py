import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lunario.model import estimators, forecast, grid
from lunario.operators import splits


@pytest.fixture(scope="module")
def sample(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(240, 4)) * [1, 10, 100, 0] + [0, 5, -50, 3]
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 0.01 * x[:, 2] + rnd.normal(size=240) * 0.2
    frame = pd.DataFrame(x, columns=list("abcd")).assign(target=y, id=range(240))
    return frame, spark.createDataFrame(frame).persist()


def closed_form(x, y, alpha):
    centred = x - x.mean(0)
    weights = np.linalg.solve(
        centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean())
    )
    return weights, y.mean() - x.mean(0) @ weights


@pytest.mark.parametrize("alpha", [0.01, 1.0, 50.0])
def test_ridge_equals_closed_form(sample, alpha):
    frame, df = sample
    vectors = VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df)
    fitted = estimators.Ridge(alpha=alpha).fit(vectors)
    weights, intercept = closed_form(
        frame[list("abc")].to_numpy(), frame["target"].to_numpy(), alpha
    )
    np.testing.assert_allclose(fitted.coefficients.toArray(), weights, rtol=1e-9)
    assert fitted.intercept == pytest.approx(intercept, rel=1e-9)


def test_iterative_ridge_equals_closed_form(sample, monkeypatch):
    monkeypatch.setattr(estimators, "NORMAL_SOLVER_LIMIT", 0)
    frame, df = sample
    vectors = VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df)
    fitted = estimators.Ridge(alpha=2.0).fit(vectors)
    weights, _ = closed_form(frame[list("abc")].to_numpy(), frame["target"].to_numpy(), 2.0)
    np.testing.assert_allclose(fitted.coefficients.toArray(), weights, rtol=1e-4)


def test_scaler_uses_population_deviation(sample):
    frame, df = sample
    names = list("abcd")
    scaled = estimators.PopScaler(inputCols=names).fit(df).transform(df).toPandas()
    x = frame[names].to_numpy()
    deviation = x.std(0)
    deviation[3] = 1
    want = (x - x.mean(0)) / deviation
    np.testing.assert_allclose(scaled.sort_values("id")[names].to_numpy(), want, atol=1e-9)


def test_model_survives_saving(spark, sample, tmp_path):
    _, df = sample
    params = {"selector__k": 2, "poly__degree": 2, "model__alpha": 0.2}
    model = forecast.fit_model(df, params, list("abcd"))
    forecast.save_model(model, str(tmp_path / "model"))
    loaded = forecast.load_model(str(tmp_path / "model"))
    a = forecast.predict(model, df, ["id"]).orderBy("id").collect()
    b = forecast.predict(loaded, df, ["id"]).orderBy("id").collect()
    assert a == b
    chosen = model.stages[1]
    assert len(chosen.selected()) == 2 and chosen.getOrDefault(chosen.ranking)[0] == "b"
    # Only the selected features are read for scoring.
    path = str(tmp_path / "features")
    df.write.parquet(path)
    scan = forecast.predict(loaded, spark.read.parquet(path), ["id"])
    text = scan._jdf.queryExecution().executedPlan().toString()
    unused = next(c for c in "abcd" if c not in chosen.selected())
    assert f"{unused}:double" not in text[text.index("ReadSchema") :]


def test_grid_search_equals_separate_fits(sample):
    _, df = sample
    folded = splits.kfold(df, ["id"])
    space = {"selector__k": [1, 2], "poly__degree": [1, 2], "model__alpha": [1, 0.1]}
    scores = grid.grid_search(folded, grid=space, features=list("abcd"))
    got = scores.orderBy("grid_position").collect()
    assert [(r["model__alpha"], r["poly__degree"], r["selector__k"]) for r in got] == [
        (a, d, k) for a in (1, 0.1) for d in (1, 2) for k in (1, 2)
    ]
    params = {"selector__k": 2, "poly__degree": 2, "model__alpha": 0.1}
    r2 = []
    for fold in range(3):
        model = forecast.fit_model(folded.where(F.col("fold") != fold), params, list("abcd"))
        r2.append(forecast.evaluate(model, folded.where(F.col("fold") == fold)).first()["r2"])
    assert got[-1]["mean_r2"] == pytest.approx(np.mean(r2), rel=1e-7)
    best = grid.best_parameters(scores)
    top = max(got, key=lambda r: (r["mean_r2"], -r["grid_position"]))
    assert best == {k: top[k] for k in best}


def test_grid_search_falls_back_for_wide_expansions(sample, monkeypatch):
    _, df = sample
    folded = splits.kfold(df, ["id"])
    space = {"selector__k": [2], "poly__degree": [1], "model__alpha": [1]}
    exact = grid.grid_search(folded, grid=space, features=list("abcd")).first()["mean_r2"]
    monkeypatch.setattr(grid, "NORMAL_SOLVER_LIMIT", 0)
    wide = grid.grid_search(folded, grid=space, features=list("abcd")).first()["mean_r2"]
    assert wide == pytest.approx(exact, rel=1e-6)


def brute_r2(rows, folds, columns, degree, alpha):
    """Mean validation r2 of dense ridge fits on all monomials of the scaled columns."""
    from itertools import combinations_with_replacement as combos

    found = []
    for held in sorted(set(folds)):
        fit, out = folds != held, folds == held
        x, y = rows[:, columns[held]], rows[:, -1]
        z = (x - x[fit].mean(axis=0)) / x[fit].std(axis=0)
        terms = [np.prod(z[:, list(c)], axis=1) for d in range(1, degree + 1) for c in combos(range(z.shape[1]), d)]
        e = np.array(terms).T
        centre, mean = e[fit].mean(axis=0), y[fit].mean()
        # The dual form: as many unknowns as rows, whatever the width.
        a = e[fit] - centre
        dual = np.linalg.solve(a @ a.T + alpha * np.eye(len(a)), y[fit] - mean)
        error = y[out] - mean - (e[out] - centre) @ (a.T @ dual)
        found.append(1 - (error**2).sum() / ((y[out] - y[out].mean()) ** 2).sum())
    return np.mean(found)


@pytest.fixture(scope="module")
def cubic(spark):
    draw = np.random.default_rng(12)
    x = draw.normal(size=(90, 10))
    y = x[:, 0] - x[:, 1] ** 2 + 0.5 * x[:, 2] * x[:, 0] + 0.1 * draw.normal(size=90)
    rows = np.column_stack([x, y])
    names = [*"abcdefghij", "target"]
    table = spark.createDataFrame([(int(i % 3), *map(float, r)) for i, r in enumerate(rows)], ["fold", *names])
    return rows, np.arange(90) % 3, table.repartition(4)


@pytest.mark.parametrize("limit", [1024, 4])
def test_every_set_of_the_grid_equals_a_dense_fit(cubic, monkeypatch, limit):
    rows, folds, table = cubic
    monkeypatch.setattr(grid, "NORMAL_SOLVER_LIMIT", limit)
    monkeypatch.setattr(grid, "BLOCK", 5)
    monkeypatch.setattr(grid, "BATCH", 400)
    space = {"selector__k": [1, 3], "poly__degree": [1, 2, 3], "model__alpha": [1, 0.05]}
    names = list("abcdefghij")
    learned = grid._learned(table, "fold", names, "target", 3)
    columns = {f.held: [names.index(c) for c in f.columns] for f in learned}
    for r in grid.grid_search(table, grid=space, features=names).collect():
        chosen = {held: some[: r["selector__k"]] for held, some in columns.items()}
        want = brute_r2(rows, folds, chosen, r["poly__degree"], r["model__alpha"])
        assert r["mean_r2"] == pytest.approx(want, rel=1e-6, abs=1e-8)


def test_the_widest_published_expansion_is_fitted(cubic):
    """19,447 terms for all penalties in one Krylov space per fold."""
    rows, folds, table = cubic
    names = list("abcdefghij")
    few = table.where("a > 0.2").coalesce(2)
    space = {"selector__k": [10], "poly__degree": [7], "model__alpha": [1, 0.01]}
    kept = rows[:, 0] > 0.2
    learned = {f.held: [names.index(c) for c in f.columns] for f in grid._learned(few, "fold", names, "target", 10)}
    for r in grid.grid_search(few, grid=space, features=names).collect():
        want = brute_r2(rows[kept], folds[kept], learned, 7, r["model__alpha"])
        assert r["mean_r2"] == pytest.approx(want, rel=1e-4)


def test_wide_fits_that_do_not_settle_are_refused(cubic, monkeypatch):
    monkeypatch.setattr(grid, "NORMAL_SOLVER_LIMIT", 4)
    monkeypatch.setattr(grid, "MAX_STEPS", 2)
    space = {"selector__k": [3], "poly__degree": [3], "model__alpha": [0.01]}
    with pytest.raises(RuntimeError, match="settle"):
        grid.grid_search(cubic[2], grid=space, features=list("abcdefghij"))


def test_equal_scores_prefer_the_earlier_set(spark):
    scores = spark.createDataFrame(
        [(0, 1.0, 1, 3, 0.5), (1, 1.0, 1, 4, 0.7), (2, 0.1, 1, 3, 0.7)],
        "grid_position int, model__alpha double, poly__degree int, selector__k int, mean_r2 double",
    )
    assert grid.best_parameters(scores)["selector__k"] == 4


def test_published_grid_size():
    sizes = [len(v) for v in grid.PARAM_GRID.values()]
    assert np.prod(sizes) == 210
    assert grid.expansion_width(10, 7) == 19447
