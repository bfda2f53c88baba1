"""Packed points, strips, and columns that tasks hold or ask, against all pairs."""

import random

import numpy as np
import pytest
from test_neighbours import brute, psi

from lunario.operators import neighbours

K = neighbours.NEIGHBOURS


def cloud(n, seed=21):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = round(rnd.gauss(0, 1), 2)
        rows.append((y + rnd.gauss(0, 0.4), float(rnd.randint(0, 30)), y if rnd.random() < 0.8 else None, y))
    return rows


SCHEMA = "a double, b double, c double, y double"


def scores(table, k=K):
    return [r["score"] for r in neighbours.neighbour_information(table, ["a", "b", "c"], "y", k).collect()]


def test_many_points_travel_in_a_row(spark, monkeypatch):
    staged = {}

    def stage(df, label, real=neighbours.stage_table):
        staged[label] = real(df, label)
        return staged[label]

    monkeypatch.setattr(neighbours, "stage_table", stage)
    monkeypatch.setattr(neighbours, "CELL", 400)
    rnd = random.Random(5)
    rows = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(4000)]
    table = spark.createDataFrame(rows, "a double, y double")
    got = neighbours.neighbour_information(table, ["a"], "y").first()["score"]
    assert got == pytest.approx(brute(*map(list, zip(*rows))), abs=1e-8)
    # Neither finished points nor those that ask other cells are rows of their own.
    assert 20 * sum(df.count() for df in staged.values()) < len(rows)


@pytest.mark.parametrize("held", [0, 4])
def test_columns_held_and_asked_equal_all_pairs(spark, monkeypatch, held):
    # Many ranges, so that ends lie in different ones; many batches, whose equal points meet in the cell.
    for name, value in {"HELD": held, "RANGE": 60, "CELL": 90, "PACK": 50, "DEALT": 200}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows = cloud(600) + [(0.0, 7.0, 0.0, 0.5)] * 40
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = [brute([r[i] for r in rows], [r[3] for r in rows]) for i in range(3)]
    assert scores(table) == pytest.approx(want, abs=1e-8)


def test_equal_points_are_joined_with_their_weights():
    points = np.array([[1.0, 2.0], [0.0, 5.0], [1.0, 2.0], [1.0, 3.0], [1.0, 2.0]]).view(np.complex128)[:, 0]
    found, weight = neighbours._different(points, np.array([1, 4, 1, 1, 2]), np.argsort(points))
    assert found.tolist() == [5j, 1 + 2j, 1 + 3j] and weight.tolist() == [4, 4, 1]


def shapes(n):
    draw = np.random.default_rng(17)
    u, g, t = draw.random((n, 2)), draw.normal(size=(n, 2)), draw.random(n)
    yield u
    yield np.c_[t, np.sin(40 * t)]
    yield np.round(u * 12)
    yield np.c_[np.where(t < 0.5, 0, g[:, 0]), g[:, 1]]
    yield np.c_[g[:, 0], draw.integers(0, 5, n)]
    yield np.exp(4 * g)
    yield draw.random((9, 2))[draw.integers(0, 9, n)] + 1e-9 * g
    yield np.r_[u[:-1], [[1e9, 1e9]]]


@pytest.mark.parametrize("k", [1, 3, 9])
@pytest.mark.parametrize("n", [1, 2, 80, 500])
def test_strips_find_the_nearest_of_all_pairs(k, n):
    draw = np.random.default_rng(3)
    for points in shapes(n):
        wanted = draw.random(len(points)) < 0.8
        distance = neighbours._distances(points, points)
        np.fill_diagonal(distance, np.inf)
        padding = ((0, 0), (0, k))
        want = np.sort(np.pad(distance, padding, constant_values=np.inf), axis=1)[wanted, :k]
        assert np.array_equal(neighbours.Strips(points).others(k, wanted), want)
        asking = points[:40] + draw.normal(size=(min(n, 40), 2))
        within = np.where(draw.random(len(asking)) < 0.3, np.inf, draw.random(len(asking)))
        near = np.minimum(neighbours._distances(asking, points), within[:, None])
        want = np.sort(np.hstack([near, np.repeat(within[:, None], k, axis=1)]), axis=1)[:, :k]
        assert np.array_equal(neighbours.Strips(points).asked(asking, within, k), want)


def test_infinite_values_leave_no_distances(spark):
    n = 90
    rows = [(float(i) if i else float("inf"), float("-inf") if i == 3 else float(i % 7), float(i % 30)) for i in range(n)]
    table = spark.createDataFrame(rows, "a double, b double, y double")
    got = {r["feature"]: r["score"] for r in neighbours.neighbour_information(table, ["a", "b", "y"], "y").collect()}
    # Three rows share each label, which is no more than k.
    assert got["a"] == pytest.approx(psi(n) + psi(2), abs=1e-8)
    assert got["b"] == got["a"] and got["y"] == pytest.approx(brute(*[[r[2] for r in rows]] * 2), abs=1e-8)
    label = neighbours.neighbour_information(table, ["y", "b"], "b").collect()
    # Their equal points: one and the same value of the feature, or all rows.
    assert label[0]["score"] == pytest.approx(psi(n) + psi(2), abs=1e-8)
    assert label[1]["score"] == pytest.approx(psi(n) + psi(n - 1), abs=1e-8)
