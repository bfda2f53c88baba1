"""Nearest-neighbour information against all pairs, on continuous, tied and mixed columns."""

import math
import random

import numpy as np
import pytest

from lunario.operators import neighbours

K = neighbours.NEIGHBOURS


def psi(n):
    return -neighbours.EULER + sum(1.0 / j for j in range(1, n))


def brute(x, y):
    keep = [i for i in range(len(x)) if x[i] is not None and y[i] is not None and x[i] == x[i] and y[i] == y[i]]
    x, y = (np.array([v[i] for i in keep], dtype=float) for v in (x, y))
    n = len(x)
    if n <= K or not x.std() or not y.std():
        return 0.0
    x, y = x / x.std(), y / y.std()
    dx, dy = (np.abs(v[:, None] - v[None, :]) for v in (x, y))
    d = np.maximum(dx, dy)
    total = 0.0
    for i in range(n):
        r = np.sort(np.delete(d[i], i))[K - 1]
        inner = [max(r - neighbours.ROUNDING * (abs(v[i]) + r), 0) for v in (x, y)]
        near = K if r > 0 else int((d[i] == 0).sum()) - 1
        total += psi(near) + psi(n) - psi(int((dx[i] <= inner[0]).sum())) - psi(int((dy[i] <= inner[1]).sum()))
    return max(0.0, total / n)


def columns(n, seed=4):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        y = rnd.gauss(0, 1)
        out.append((
            y + rnd.gauss(0, 0.3), rnd.gauss(0, 1), float(rnd.randint(0, 4)), float(int(3 * y)),
            None if i % 7 == 0 else y * y, 1.0, float("nan") if i % 3 else y, y,
        ))
    return out


NAMES = ["linear", "noise", "digit", "step", "square", "constant", "holes", "y"]


@pytest.mark.parametrize("sizes", [(20_000, 128), (60, 16)])
def test_scores_equal_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(neighbours, "CELL", sizes[0])
    monkeypatch.setattr(neighbours, "BLOCK", sizes[1])
    rows = columns(700)
    table = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES))
    got = {
        parts: {r["feature"]: r["score"] for r in neighbours.neighbour_information(table.repartition(parts), NAMES[:-1], "y").collect()}
        for parts in (1, 16)
    }
    assert got[1] == got[16]
    y = [r[-1] for r in rows]
    for i, name in enumerate(NAMES[:-1]):
        assert got[1][name] == pytest.approx(brute([r[i] for r in rows], y), abs=1e-8), name
    assert got[1]["linear"] > 0.8 > 0.1 > got[1]["noise"] and got[1]["constant"] == 0


def test_a_label_of_ties_and_hot_points(spark):
    rnd = random.Random(9)
    rows = [(0.0, 0.0)] * 200 + [(float(rnd.randint(0, 3)), float(rnd.randint(0, 3))) for _ in range(200)]
    rows += [(rnd.random(), 1.0) for _ in range(100)]
    table = spark.createDataFrame(rows, "a double, y double")
    got = neighbours.neighbour_information(table, ["a"], "y").first()["score"]
    assert got == pytest.approx(brute([r[0] for r in rows], [r[1] for r in rows]), abs=1e-8)
    # Equal points are one row, however many there are.
    points = neighbours._points(table, ["a"], "y")
    assert points.count() == len(set(rows)) and points.agg({"w": "max"}).first()[0] >= 200


def test_ranks_are_summed_where_they_are_counted(spark, monkeypatch):
    staged = {}

    def stage(df, label, real=neighbours.stage_table):
        staged[label] = real(df, label)
        return staged[label]

    monkeypatch.setattr(neighbours, "stage_table", stage)
    monkeypatch.setattr(neighbours, "RANGE", 400)
    monkeypatch.setattr(neighbours, "CELL", 300)
    rnd = random.Random(12)
    rows = []
    for i in range(1600):
        y = rnd.gauss(0, 1)
        # Half of the points ask about one hot value, more than a task answers at once.
        rows.append((0.0 if i % 2 else y + rnd.gauss(0, 0.5), y))
    table = spark.createDataFrame(rows, "a double, y double")
    got = neighbours.neighbour_information(table, ["a"], "y").first()["score"]
    assert got == pytest.approx(brute([r[0] for r in rows], [r[1] for r in rows]), abs=1e-8)
    # Most points leave their counting task within one sum, not as rows of values and questions.
    assert staged["neighbour-ranks"].count() < len(rows)
    # Points whose squares stay inside their cell keep no lists.
    assert 0 < staged["neighbour-cells"].where("open").count() < len(rows)
    assert staged["neighbour-cells"].where("NOT open AND distances IS NOT NULL").count() == 0


def test_digamma_of_whole_numbers():
    assert neighbours.digamma(np.arange(1, 60)) == pytest.approx([psi(n) for n in range(1, 60)], abs=1e-10)


def test_gaussian_information_is_found(spark):
    draw = np.random.default_rng(2)
    a = draw.normal(size=4000)
    rows = [(float(x), float(0.8 * x + 0.6 * z)) for x, z in zip(a, draw.normal(size=4000))]
    table = spark.createDataFrame(rows, "a double, y double").repartition(5)
    score = neighbours.neighbour_information(table, ["a"], "y").first()["score"]
    assert score == pytest.approx(-0.5 * math.log(1 - 0.64), abs=0.05)


def test_few_rows_score_zero(spark):
    for rows in ([], [(1.0, 2.0)], [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], [(None, 1.0)] * 9):
        table = spark.createDataFrame(rows, "a double, y double")
        assert [r["score"] for r in neighbours.neighbour_information(table, ["a"], "y").collect()] == [0.0]


def test_squares_reach_every_cell_that_holds_a_near_point():
    draw = np.random.default_rng(8)
    points = np.round(draw.normal(size=(500, 2)), 1)
    cells = neighbours.Cells(points, 4)
    own = cells.of(points)
    assert len(np.unique(own)) > 10
    radius = draw.random(500)
    touched = {(cell, i) for cell, places in cells.touched(points, radius) for i in places}
    distance = neighbours._distances(points, points)
    for i, j in zip(*np.nonzero(distance <= radius[:, None])):
        assert (own[j], i) in touched
