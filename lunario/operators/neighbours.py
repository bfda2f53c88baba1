"""Mutual information from nearest neighbours, for columns that bins describe badly.

Each (feature, label) pair of columns is a cloud of points, scaled by the columns'
deviations. A point's contribution compares the distance to its k-th neighbour, in
the larger of both differences, with the points that lie within that distance along
each column alone (Kraskov, Stögbauer and Grassberger's first estimator). Where k or
more others coincide with a point, the distance is zero; their number then stands for
k, and equal values are counted along the columns (the rule for discrete and
continuous mixtures), so tied data needs no random jitter.

Points travel packed, many to a row, so that Spark moves and sorts few rows:

- The plane is cut into cells of about ``CELL`` different points by a tree of medians, taken
  from a bounded sample; the sample only balances the cells. Rows are read into cells,
  equal points of a batch joined; the cell joins the rest and gives them a weight.
- In a cell the points lie in strips along one column, each sorted by the other. A point
  looks along its strip and the next ones for as long as something nearer can follow.
- A point whose square crosses its cell asks the other cells that the square touches, so
  the distances are exact; of a cell, only the points near its border are asked, unless a
  question reaches deeper.
- Counts along a column are differences of ranks among its different values, cut into ranges.
  Columns of few different values are held by every task, which counts at once. Along the
  others a point's question goes to the range that holds both ends of its distance, or to
  the two ranges that hold one each, with the sums of the ranges before. Ranges that many
  points ask are answered by several tasks.

Rows with a missing feature or label do not count for that feature. A feature, or label,
of fewer than two values, or of ``k`` points or fewer, scores zero. Scores are in nats.
The input is read by four passes over these columns, one of them a feature at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario.operators.information import SCORE_DIGITS
from lunario.session import stage_table

NEIGHBOURS = 3
#: Points per cell, about; sets of so few points are compared pair by pair.
CELL, BLOCK = 20_000, 64
#: Sampled points per cell that place the cuts, and cells per feature at most.
SAMPLED, CELLS = 40, 4096
#: Points to a range when ranks are counted, and questions that a task answers at once, about.
RANGE = 1_000_000
#: Columns of up to so many ranges' values, together, are held by every task.
HELD = 4
#: Rows that a task packs at once, and points to a partition of cells, about.
PACK, DEALT = 1 << 20, 2_000_000
#: Steps along a strip that all its points take.
STEPS = 6

EULER = 0.5772156649015329
#: Share of a value's size that its sums and differences may be off by.
ROUNDING = 4e-15


class Cells:
    """A tree of cuts: node n continues in 2n + 1 below its cut and in 2n + 2 from it on; leaves are cells."""

    def __init__(self, points: np.ndarray, depth: int):
        size = 2**depth - 1
        self.depth, self.dim, self.cut = depth, np.zeros(size, np.int8), np.full(size, np.inf)
        held = {0: points}
        for node in range(size):
            mine = held.pop(node)
            below = np.zeros(len(mine), bool)
            spread = np.ptp(mine, axis=0) if len(mine) else np.zeros(2)
            for dim in np.argsort(-spread):
                # A cut must leave points on both sides; half of them where ties allow.
                values = np.unique(mine[:, dim]) if len(mine) else mine[:, dim]
                if len(values) > 1:
                    middle = np.sort(mine[:, dim])[len(mine) // 2]
                    upper = max(1, int(np.searchsorted(values, middle)))
                    # Halfway, so that a value of many points is not itself a border.
                    cut = (values[upper - 1] + values[upper]) / 2
                    cut = cut if cut > values[upper - 1] else values[upper]
                    self.dim[node], self.cut[node] = dim, cut
                    below = mine[:, dim] < cut
                    break
            else:
                below[:] = True
            held[2 * node + 1], held[2 * node + 2] = mine[below], mine[~below]
        self.low, self.high = np.full((2 * size + 1, 2), -np.inf), np.full((2 * size + 1, 2), np.inf)
        for node in range(size):
            for child in (2 * node + 1, 2 * node + 2):
                self.low[child], self.high[child] = self.low[node], self.high[node]
            self.high[2 * node + 1, self.dim[node]] = self.cut[node]
            self.low[2 * node + 2, self.dim[node]] = self.cut[node]

    def borders(self, cell: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower borders of a cell, which belong to it, and upper ones, which do not."""
        return self.low[cell + len(self.cut)], self.high[cell + len(self.cut)]

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        x, y = np.ascontiguousarray(points[:, 0]), np.ascontiguousarray(points[:, 1])
        node, by_y = np.zeros(len(points), np.int32), self.dim == 1
        for _ in range(self.depth):
            right = np.where(by_y[node], y, x) >= self.cut[node]
            node = 2 * node + 1 + right
        return node - len(self.cut)

    def touched(self, points: np.ndarray, radius: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, places of the points) for all cells that the points' closed squares reach."""
        work = [(0, np.arange(len(points)))]
        while work:
            node, places = work.pop()
            if not len(places):
                continue
            if node >= len(self.cut):
                yield node - len(self.cut), places
                continue
            value, r = points[places, self.dim[node]], radius[places]
            work.append((2 * node + 1, places[value - r < self.cut[node]]))
            work.append((2 * node + 2, places[value + r >= self.cut[node]]))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(
        np.abs(a[:, 0][:, None] - b[:, 0][None, :]), np.abs(a[:, 1][:, None] - b[:, 1][None, :])
    )


def _nearer(near: list[np.ndarray], distance: np.ndarray) -> None:
    """Takes each point's distance into its ascending list, kept as one array per place."""
    for j, kept in enumerate(near):
        farther = np.maximum(kept, distance) if j + 1 < len(near) else None
        np.minimum(kept, distance, out=kept)
        distance = farther


class Strips:
    """Points in strips along the column of fewer values, each sorted by the other column."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        ascending = [np.sort(c) for c in points.T]
        values = [np.count_nonzero(c[1:] != c[:-1]) for c in ascending]
        self.dim = int(values[1] < values[0])
        along, across = (np.ascontiguousarray(points[:, d]) for d in (self.dim, 1 - self.dim))
        ascending, self.ranked = ascending[self.dim], ascending[1 - self.dim]
        # Strips are about twice as wide as points lie apart.
        width = ascending[n - 1 - n // 10] - ascending[n // 10] or ascending[-1] - ascending[0]
        height = self.ranked[n - 1 - n // 10] - self.ranked[n // 10] or self.ranked[-1] - self.ranked[0]
        count = np.sqrt(n * width / height) / 2 if height > 0 else 1
        marks = ascending[:: max(1, n // max(1, int(min(count, n / 8))))]
        # Equal values stay together; one that fills strips gets its own.
        hot = np.nextafter(marks[1:][marks[1:] == marks[:-1]], np.inf)
        strip = np.searchsorted(np.unique(np.concatenate([marks[1:], hot])), along, side="right")
        by_rank = np.argsort(across)
        # Short whole numbers are sorted by their digits.
        self.rank = np.argsort(strip[by_rank].astype(np.min_scalar_type(int(strip.max()))), kind="stable")
        self.order = by_rank[self.rank]
        self.a, self.b, strip = along[self.order], across[self.order], strip[self.order]
        starts = np.append(0, np.flatnonzero(strip[1:] != strip[:-1]) + 1)
        self.begin, self.end = starts, np.append(starts[1:], n)
        self.strip = np.repeat(np.arange(len(starts)), self.end - starts)
        self.key = self.strip * n + self.rank
        # Strips ascend and do not overlap, so these bound all further ones too.
        self.low, self.high = np.minimum.reduceat(self.a, starts), np.maximum.reduceat(self.a, starts)

    def _walk(self, near, a, b, rows, at, stop, step: int) -> None:
        """Candidates from ``at`` on, for as long as their distance along the strip is below the k-th."""
        while len(rows):
            live = at != stop
            if not live.all():
                rows, at, stop = rows[live], at[live], stop[live]
            beside = np.abs(self.b[at] - b[rows])
            live = beside < near[-1][rows]
            if not live.all():
                rows, at, stop, beside = rows[live], at[live], stop[live], beside[live]
            distance = np.maximum(beside, np.abs(self.a[at] - a[rows]))
            better = distance < near[-1][rows]
            some, distance = rows[better], distance[better]
            for kept in near:
                old = kept[some]
                kept[some] = np.minimum(old, distance)
                distance = np.maximum(old, distance)
            at = at + step

    def _look(self, near, a, b, rank, rows, strip) -> None:
        """Candidates of one strip for each of the rows, on both sides of their place in it."""
        at = np.searchsorted(self.key, strip * len(self.a) + rank[rows])
        self._walk(near, a, b, rows, at, self.end[strip], 1)
        self._walk(near, a, b, rows, at - 1, self.begin[strip] - 1, -1)

    def _beyond(self, near, a, b, rank, rows, strip) -> None:
        """Candidates of the further strips on both sides, for as long as one is nearer than the k-th."""
        for step in (1, -1):
            mine, of = rows, strip + step
            while len(mine):
                live = (of >= 0) & (of < len(self.begin))
                mine, of = mine[live], of[live]
                gap = self.low[of] - a[mine] if step > 0 else a[mine] - self.high[of]
                live = gap < near[-1][mine]
                mine, of = mine[live], of[live]
                self._look(near, a, b, rank, mine, of)
                of = of + step

    def others(self, k: int, wanted: np.ndarray) -> np.ndarray:
        """The k smallest distances of each wanted point to the other points."""
        n = len(self.a)
        near = [np.full(n, np.inf) for _ in range(k)]
        for s in range(1, min(STEPS, n - 1) + 1):
            distance = np.maximum(np.abs(self.a[s:] - self.a[:-s]), np.abs(self.b[s:] - self.b[:-s]))
            distance[self.strip[s:] != self.strip[:-s]] = np.inf
            _nearer([kept[:-s] for kept in near], distance)
            _nearer([kept[s:] for kept in near], distance)
        rows = np.flatnonzero(wanted[self.order])
        for step, stop in ((1, self.end), (-1, self.begin - 1)):
            stop = stop[self.strip[rows]]
            live = (stop - rows) * step > STEPS
            self._walk(near, self.a, self.b, rows[live], rows[live] + step * (STEPS + 1), stop[live], step)
        self._beyond(near, self.a, self.b, self.rank, rows, self.strip[rows])
        out = np.empty((n, k))
        out[self.order] = np.stack(near, axis=1)
        return out[wanted]

    def asked(self, points: np.ndarray, within: np.ndarray, k: int) -> np.ndarray:
        """The k smallest distances to other sets' points; what is not nearer than ``within`` counts as that."""
        near = [within.astype(float) for _ in range(k)]
        a, b = points[:, self.dim], points[:, 1 - self.dim]
        rank = np.searchsorted(self.ranked, b)
        strip = np.maximum(np.searchsorted(self.low, a, side="right") - 1, 0)
        rows = np.arange(len(points))
        self._look(near, a, b, rank, rows, strip)
        self._beyond(near, a, b, rank, rows, strip)
        return np.stack(near, axis=1)


def _others(points: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distances of each wanted point to the other points; infinite where there are fewer."""
    if len(points) > BLOCK:
        return Strips(points).others(k, wanted)
    distance = _distances(points, points)
    np.fill_diagonal(distance, np.inf)
    distance = np.pad(distance[wanted], ((0, 0), (0, k)), constant_values=np.inf)
    return np.sort(distance, axis=1)[:, :k]


def _asked(there: np.ndarray, points: np.ndarray, within: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distances of the points to those of another set, ``within`` where there are fewer so near."""
    if len(there) > BLOCK:
        return Strips(there).asked(points, within, k)
    distance = np.minimum(_distances(points, there), within[:, None])
    return np.sort(np.hstack([distance, np.repeat(within[:, None], k, axis=1)]), axis=1)[:, :k]


def digamma(n: np.ndarray) -> np.ndarray:
    """Of whole numbers from 1 on: by its sum up to nine, by the series beyond."""
    sums = np.array([0.0, *(-EULER + sum(1.0 / j for j in range(1, m)) for m in range(1, 10))])
    x = np.asarray(n, np.float64)
    inverse = 1 / np.maximum(x, 1.0)
    z = inverse * inverse
    series = np.log(np.maximum(x, 1.0)) - inverse / 2 - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240)))
    return np.where(x < 10, sums[np.minimum(x, 9).astype(np.int64)], series)


class Clouds:
    """What tasks know of the features: deviations, cells, and the columns along which they count."""

    def __init__(self, columns: list[str], spread: dict[int, tuple[float, float]], shared: set[int]):
        self.columns, self.spread = columns, spread
        #: Column to count along, by feature and side; features that miss no label share the label's.
        self.line, self.sides = {}, []
        for i in spread:
            first = min(shared) if i in shared else i
            for side in (0, 1):
                if side and first != i:
                    self.line[i, 1] = self.line[first, 1]
                else:
                    self.line[i, side] = len(self.sides)
                    self.sides.append((i, side))
        self.trees: dict[int, Cells] = {}
        self.bounds: list[np.ndarray] = []
        self.before: dict[int, np.ndarray] = {}

    def points(self, batch: pa.Table, i: int) -> np.ndarray:
        """(x, y) of the rows that have both."""
        x, y = batch.column(i).to_numpy(), batch.column(len(self.columns) - 1).to_numpy()
        here = ~(np.isnan(x) | np.isnan(y))
        if not here.all():
            x, y = x[here], y[here]
        # Zero has one sign.
        return np.column_stack([x / self.spread[i][0] + 0.0, y / self.spread[i][1] + 0.0])


def _batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``PACK`` rows."""
    held, n = [], 0
    for frame in frames:
        for at in range(0, frame.num_rows, PACK):
            held.append(frame.slice(at, PACK))
            n += held[-1].num_rows
            if n >= PACK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _cut(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary cell for each stretch of the rows of ``values``."""
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = (np.append(starts, len(values)) * width).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), data])


def _joined(cells: pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """The stretches of binary cells one after the other."""
    return np.concatenate([np.frombuffer(c, dtype) for c in cells.to_pylist()] or [np.empty(0, dtype)])


def _rows(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _different(points: np.ndarray, weight: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points, as complex numbers, in an order that has equal ones side by side: once each, with their weights' sums."""
    points, weight = points[order], weight[order]
    starts = np.append(0, np.flatnonzero(points[1:] != points[:-1]) + 1)
    if len(starts) == len(points):
        return points, weight
    return points[starts], np.add.reduceat(weight, starts)


def _counted(values: np.ndarray, upto: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows from the lower to the upper ends, both included; ``upto`` has those before each of the values and all."""
    # Questions of a cell lie close together, so they share a short stretch of the values.
    begin, end = np.searchsorted(values, [low.min(), high.max()]) + [0, 1]
    here, upto = values[begin:end], upto[begin : end + 1]
    return upto[np.searchsorted(here, high, side="right")] - upto[np.searchsorted(here, low, side="left")]


#: Packed points of a cell with their weights, where any is above one.
POINTS = pa.schema([("position", pa.int32()), ("cell", pa.int32()), ("points", pa.binary()), ("weights", pa.binary())])
#: Packed different values of a range of a column, and how many rows have each.
VALUES = pa.schema(
    [("line", pa.int32()), ("range", pa.int32()), ("values", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("w", pa.int64())]
)
#: What cells leave. ``near``: points that others may ask for, all at least ``edge`` from the border.
#: ``points``, ``distances``: those whose square crosses the border (``open``). ``asked``: they in a cell they reach.
#: ``ranks``, ``weights``: n questions with both ends in a range of a column; ``ends``: those with one end there.
#: ``part``: sums of the points' digammas that are known already.
FOUND = pa.schema(
    [("position", pa.int32()), ("cell", pa.int32()), ("home", pa.int32()), ("line", pa.int32()), ("range", pa.int32())]
    + [("open", pa.bool_()), ("edge", pa.float64()), ("n", pa.int64()), ("part", pa.float64())]
    + [(c, pa.binary()) for c in ("near", "points", "distances", "asked", "ranks", "weights", "ends")]
)
ANSWERS = pa.schema([("position", pa.int32()), ("home", pa.int32()), ("places", pa.binary()), ("distances", pa.binary())])


def _sql(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _points(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(position, x, y, w): different points of every feature, and how many rows each stands for."""
    columns = _present(df, [*features, label])
    last = F.col(f"c{len(features)}")
    unpivoted = [
        columns.select(F.lit(i).alias("position"), F.col(f"c{i}").alias("x"), last.alias("y"))
        for i in range(len(features))
    ]
    rows = functools.reduce(DataFrame.unionAll, unpivoted).where("x IS NOT NULL AND y IS NOT NULL")
    return rows.groupBy("position", "x", "y").agg(F.count(F.lit(1)).alias("w"))


def _present(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns as numbers, missing where they are not."""
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in names]
    return df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)])


def _deviations(
    df: DataFrame, features: list[str], label: str, k: int
) -> tuple[Clouds, dict[int, int], dict[int, list[str]]]:
    """The features that can be scored, how many rows each has, and of those without distances the finite columns."""
    columns = _present(df, [*features, label])
    last = len(features)
    both = [F.when(F.col(f"c{last}").isNotNull(), F.col(f"c{i}")) for i in range(last)]
    label_of = [F.when(F.col(f"c{i}").isNotNull(), F.col(f"c{last}")) for i in range(last)]
    found = columns.agg(
        F.count(f"c{last}").alias("labels"),
        *[F.stddev_pop(b).alias(f"x{i}") for i, b in enumerate(both)],
        *[F.stddev_pop(b).alias(f"y{i}") for i, b in enumerate(label_of)],
        *[F.count(b).alias(f"n{i}") for i, b in enumerate(both)],
    ).first()
    rows = {i: found[f"n{i}"] for i in range(last) if found[f"x{i}"] and found[f"y{i}"] and found[f"n{i}"] > k}
    # Infinite values leave a column no deviation.
    finite = {i: [c for c in "xy" if not np.isnan(found[f"{c}{i}"])] for i in rows}
    infinite = {i: columns for i, columns in finite.items() if len(columns) < 2}
    shared = {i for i in rows if i not in infinite and rows[i] == found["labels"]}
    # Features that miss no label have the same deviation of it.
    spread = {
        i: (found[f"x{i}"], found[f"y{min(shared) if i in shared else i}"]) for i in rows if i not in infinite
    }
    return Clouds([f"c{i}" for i in range(last + 1)], spread, shared), rows, infinite


def _trees(points: DataFrame, clouds: Clouds, rows: dict[int, int]) -> None:
    """The cells of every feature and the ranges of its columns, from a bounded sample by hash of its points."""
    every = {i: max(1, CELL // SAMPLED, rows[i] // (CELLS * SAMPLED)) for i in clouds.spread}
    drawn = F.lit(False)
    for i, n in every.items():
        drawn = drawn | ((F.col("position") == i) & (F.pmod(F.xxhash64("x", "y"), F.lit(n)) == 0))
    sample = points.where(drawn).select("position", "x", "y").toPandas()
    held = {}
    for i in clouds.spread:
        mine = sample.loc[sample["position"] == i, ["x", "y"]].sort_values(["x", "y"]).to_numpy()
        held[i] = mine / np.array(clouds.spread[i]) + 0.0
        depth = np.ceil(np.log2(max(1.0, len(mine) * every[i] / CELL)))
        clouds.trees[i] = Cells(held[i], min(int(depth), int(np.log2(CELLS))))
    for i, side in clouds.sides:
        values, ranges = np.sort(held[i][:, side]), -(-rows[i] // RANGE)
        at = np.arange(1, ranges) * len(values) // ranges
        clouds.bounds.append(np.unique(values[at]) if len(values) else values)


def _values(columns: DataFrame, clouds: Clouds, width: int) -> DataFrame:
    """Different values of every column to count along, a range to a row."""

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(frames):
            for line, (i, side) in enumerate(clouds.sides):
                values, counts = np.unique(clouds.points(batch, i)[:, side], return_counts=True)
                ranges = np.searchsorted(clouds.bounds[line], values, side="right")
                starts = np.append(0, np.flatnonzero(ranges[1:] != ranges[:-1]) + 1)[: len(values)]
                n = np.diff(np.append(starts, len(values)))
                yield pa.RecordBatch.from_arrays(
                    [
                        np.full(len(starts), line, np.int32),
                        ranges[starts].astype(np.int32),
                        _cut(values, starts),
                        _cut(counts.astype(np.int64), starts),
                        n,
                        n,
                    ],
                    schema=VALUES,
                )

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        values, counts = _joined(table["values"]), _joined(table["counts"], np.int64)
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        starts = np.append(0, np.flatnonzero(values[1:] != values[:-1]) + 1)
        values, counts = values[starts], np.add.reduceat(counts, starts)
        row = {"line": key[0].as_py(), "range": key[1].as_py(), "n": len(values), "w": int(counts.sum())}
        return _rows([row | {"values": values.tobytes(), "counts": counts.tobytes()}], VALUES)

    read_ = columns.mapInArrow(read, _sql(VALUES)).repartition(width, "line", "range")
    return stage_table(read_.groupBy("line", "range").applyInArrow(merged, _sql(VALUES)), "neighbour-values")


def _known(values: DataFrame, clouds: Clouds) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Columns of few different values: the values, and the rows before each and in all."""
    found = values.select("line", "range", "n", "w").toPandas().sort_values(["line", "range"])
    total, known = 0, []
    for line, n in found.groupby("line")["n"].sum().sort_values(kind="stable").items():
        total += n
        if total > HELD * RANGE:
            break
        known.append(int(line))
    for line in range(len(clouds.sides)):
        w = np.zeros(len(clouds.bounds[line]) + 1, np.int64)
        mine = found[found["line"] == line]
        w[mine["range"]] = mine["w"]
        clouds.before[line] = np.cumsum(w) - w
    held = {line: [] for line in known}
    for r in values.where(F.col("line").isin(known)).select("line", "range", "values", "counts").collect() if known else []:
        held[r["line"]].append((r["range"], np.frombuffer(r["values"]), np.frombuffer(r["counts"], np.int64)))
    out = {}
    for line, parts in held.items():
        parts.sort(key=lambda p: p[0])
        counts = np.concatenate([p[2] for p in parts])
        out[line] = np.concatenate([p[1] for p in parts]), np.append(0, np.cumsum(counts))
    return out


def _weights(weight: np.ndarray) -> bytes | None:
    return None if (weight == 1).all() else weight.astype(np.int64).tobytes()


def _settled(clouds, known, position, cell, places, points, weight, r, k) -> list[dict]:
    """What is left of points whose distance is exact: sums, and questions where the column is not known."""
    if not len(points):
        return []
    part = float((weight * digamma(np.where(r > 0, k, np.maximum(weight - 1, 1)))).sum())
    out = []
    for side in (0, 1):
        line, value = clouds.line[position, side], points[:, side]
        # What lies at the distance itself is outside, also where rounding would move it in.
        inner = np.maximum(r - ROUNDING * (np.abs(value) + r), 0.0)
        low, high = value - inner, value + inner
        if line in known:
            values, upto = known[line]
            part -= float((weight * digamma(_counted(values, upto, low, high))).sum())
            continue
        row = {"position": position, "home": cell, "line": line, "open": False}
        of_low, of_high = (np.searchsorted(clouds.bounds[line], e, side="right") for e in (low, high))
        whole = of_low == of_high
        for of in np.unique(of_low[whole]).tolist():
            mine = np.flatnonzero(whole & (of_low == of))
            ranks = np.column_stack([low[mine], high[mine]])
            out.append(row | {"range": of, "n": len(mine), "ranks": ranks.tobytes(), "weights": _weights(weight[mine])})
        # Each end is asked alone; the lower one is counted off. The weight goes with the upper one.
        for end, of_end, sign in ((low, of_low, -1.0), (high, of_high, 1.0)):
            for of in np.unique(of_end[~whole]).tolist():
                mine = np.flatnonzero(~whole & (of_end == of))
                ends = np.column_stack([places[mine], end[mine], np.full(len(mine), sign), weight[mine]])
                out.append(row | {"range": of, "n": len(mine), "ends": ends.tobytes()})
    return [*out, {"position": position, "open": False, "part": part}]


def _cells(columns: DataFrame, clouds: Clouds, known, dealt: int, k: int) -> DataFrame:
    """What every cell leaves: finished sums, questions to ranges, and points that depend on other cells."""

    def placed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(frames):
            for i in clouds.spread:
                points = clouds.points(batch, i)
                if not len(points):
                    continue
                # Equal points have equal hashes; of others some may share one, which only leaves them apart.
                bits, weight = points.view(np.uint64), None
                mixed = (bits[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (bits[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F))
                hashes, points = np.sort(mixed), points.view(np.complex128)[:, 0]
                # Joined where one in a hundred is equal to another, so also each point that many rows share.
                if 100 * np.count_nonzero(hashes[1:] == hashes[:-1]) > len(points):
                    points, weight = _different(points, np.ones(len(points), np.int64), np.argsort(mixed))
                cell = clouds.trees[i].of(points.view(np.float64).reshape(-1, 2))
                order = np.argsort(cell.astype(np.int16), kind="stable")
                cell = cell[order]
                starts = np.append(0, np.flatnonzero(cell[1:] != cell[:-1]) + 1)
                weights = pa.nulls(len(starts), pa.binary()) if weight is None else _cut(weight[order], starts)
                of = [np.full(len(starts), i, np.int32), cell[starts].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*of, _cut(points[order], starts), weights], schema=POINTS)

    def inside(key: tuple, table: pa.Table) -> pa.Table:
        position, cell = key[0].as_py(), key[1].as_py()
        parts = [np.frombuffer(p, np.complex128) for p in table["points"].to_pylist()]
        weight = [
            np.ones(len(p), np.int64) if w is None else np.frombuffer(w, np.int64)
            for p, w in zip(parts, table["weights"].to_pylist())
        ]
        points, weight = np.concatenate(parts), np.concatenate(weight)
        points, weight = _different(points, weight, np.argsort(points))
        points = points.view(np.float64).reshape(-1, 2)
        # So many copies tell what the weights tell; a point of more has its distance.
        copies = np.minimum(weight, k + 1)
        first = np.cumsum(copies) - copies
        every = points if copies[-1] == 1 and (copies == 1).all() else np.repeat(points, copies, axis=0)
        seeking = weight <= k
        distance = np.zeros((len(points), k))
        if seeking.any():
            wanted = np.zeros(len(every), bool)
            wanted[first[seeking]] = True
            distance[seeking] = _others(every, wanted, k)
        r = distance[:, -1]
        tree = clouds.trees[position]
        low, high = tree.borders(cell)
        crosses = ((points - r[:, None] < low) | (points + r[:, None] >= high)).any(axis=1)
        places = np.arange(len(points))
        done = ~crosses
        out = _settled(clouds, known.value, position, cell, places[done], points[done], weight[done], r[done], k)
        mine = {"position": position, "cell": cell, "open": False}
        edge = np.minimum(points - low, high - points).min(axis=1)
        rim = edge <= np.partition(edge, len(edge) // 4)[len(edge) // 4]
        for shell in (rim, ~rim):
            if shell.any() and len(tree.cut):
                # The other cells' points count up to k of the copies.
                near = np.repeat(points[shell], np.minimum(weight[shell], k), axis=0)
                out.append(mine | {"edge": float(edge[shell].min()), "near": near.tobytes()})
        if crosses.any():
            here, reach = points[crosses], r[crosses]
            held = np.column_stack([places[crosses], here, weight[crosses]])
            out.append(mine | {"open": True, "points": held.tobytes(), "distances": distance[crosses].tobytes()})
            for other, some in tree.touched(here, reach):
                if other != cell and len(some):
                    asked = np.column_stack([some, here[some], reach[some]])
                    out.append(mine | {"cell": other, "home": cell, "edge": float(reach[some].max()), "asked": asked.tobytes()})
        return _rows(out, FOUND)

    packed = columns.mapInArrow(placed, _sql(POINTS)).repartition(dealt, "position", "cell")
    return stage_table(packed.groupBy("position", "cell").applyInArrow(inside, _sql(FOUND)), "neighbour-cells")


def _crossing(cells: DataFrame, clouds: Clouds, known, dealt: int, k: int) -> DataFrame:
    """What the points leave that depend on other cells, in the same columns."""

    def answered(key: tuple, there: pa.Table, asked: pa.Table) -> pa.Table:
        if not there.num_rows or not asked.num_rows:
            return _rows([], ANSWERS)
        homes = [(h, np.frombuffer(q).reshape(-1, 4)) for h, q in zip(asked["home"].to_pylist(), asked["asked"].to_pylist())]
        every = np.concatenate([q for _, q in homes])
        distance = _asked(_joined(there["near"]).reshape(-1, 2), every[:, 1:3], every[:, 3], k)
        out, at = [], 0
        for home, q in homes:
            d, at = distance[at : at + len(q)], at + len(q)
            some = d[:, 0] < q[:, 3]
            if some.any():
                row = {"position": key[0].as_py(), "home": home}
                out.append(row | {"places": q[some, 0].tobytes(), "distances": d[some].tobytes()})
        return _rows(out, ANSWERS)

    def joined(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        position, cell = key[0].as_py(), key[1].as_py()
        held = _joined(mine["points"]).reshape(-1, 4)
        distance = _joined(mine["distances"]).reshape(-1, k)
        for places, d in zip(answers["places"].to_pylist(), answers["distances"].to_pylist()):
            # A cell answers a point once.
            at, d = np.frombuffer(places).astype(np.int64), np.frombuffer(d).reshape(-1, k)
            distance[at] = np.sort(np.hstack([distance[at], d]), axis=1)[:, :k]
        weight = held[:, 3].astype(np.int64)
        places = held[:, 0].astype(np.int64)
        return _rows(
            _settled(clouds, known.value, position, cell, places, held[:, 1:3], weight, distance[:, -1], k), FOUND
        )

    # Renamed, so that the sides of a cogroup are columns of their own.
    to = [F.col(c).alias(c) for c in ("position", "cell", "home", "edge", "asked")]
    asked = cells.where("asked IS NOT NULL").select(*to)
    # One row per cell that is asked.
    farthest = asked.groupBy("position", "cell").agg(F.max("edge").alias("reach"))
    near = cells.where("near IS NOT NULL").select("position", "cell", "edge", "near")
    near = near.join(F.broadcast(farthest), ["position", "cell"]).where("edge <= reach").select("position", "cell", "near")
    answers = (
        near.repartition(dealt, "position", "cell")
        .groupBy("position", "cell")
        .cogroup(asked.drop("edge").repartition(dealt, "position", "cell").groupBy("position", "cell"))
        .applyInArrow(answered, _sql(ANSWERS))
    )
    mine = [F.col(c).alias(c) for c in ("position", "cell", "points", "distances")]
    crossing = cells.where("open").select(*mine)
    return stage_table(
        crossing.repartition(dealt, "position", "cell")
        .groupBy("position", "cell")
        .cogroup(answers.repartition(dealt, "position", "home").groupBy("position", "home"))
        .applyInArrow(joined, _sql(FOUND)),
        "neighbour-distances",
    )


#: ``part`` sums the points whose ends lie in one range; of the others, ``ends`` has the count of each end.
RANKS = pa.schema(
    [("position", pa.int32()), ("line", pa.int32()), ("home", pa.int32()), ("part", pa.float64()), ("ends", pa.binary())]
)
PARTS = pa.schema([("position", pa.int32()), ("part", pa.float64())])


def _ranks(found: DataFrame, values: DataFrame, clouds: Clouds, width: int) -> DataFrame:
    """(position, part): sums of the digammas of points that ask along columns which tasks do not hold."""
    asked = found.where("range IS NOT NULL").select("position", "home", "line", "range", "n", "ranks", "weights", "ends")
    sizes = asked.groupBy("line", "range").agg(F.sum("n").alias("n")).toPandas().sort_values(["line", "range"])
    tasks = np.maximum(1, -(-sizes["n"].to_numpy(np.int64) // RANGE))
    places = sizes.assign(tasks=tasks, first=np.cumsum(tasks) - tasks)[["line", "range", "first", "tasks"]].astype("int32")
    dealing = F.broadcast(
        found.sparkSession.createDataFrame(places, "line int, range int, first int, tasks int")
    )  # one row per range
    several = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("tasks") - 1)).alias("task")
    there = values.join(dealing, ["line", "range"]).select(several, "line", "range", "values", "counts")
    one = (F.col("first") + F.pmod(F.xxhash64("position", "home"), F.col("tasks"))).cast("int").alias("task")
    asked = asked.join(dealing, ["line", "range"]).select(one, "position", "home", "line", "range", "ranks", "weights", "ends")

    def counted(key: tuple, there: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _rows([], RANKS)
        line, of = asked["line"][0].as_py(), asked["range"][0].as_py()
        # A range without values has no row; counts in it are what lies before.
        values, counts = _joined(there["values"]), _joined(there["counts"], np.int64)
        upto, before = np.append(0, np.cumsum(counts)), int(clouds.before[line][of])
        parts, out = {}, []
        for r in asked.to_pylist():
            if r["ranks"] is not None:
                low, high = np.frombuffer(r["ranks"]).reshape(-1, 2).T
                # Before the lower end what is smaller counts; up to the upper end what is as large too.
                n = _counted(values, upto, low, high)
                w = 1 if r["weights"] is None else np.frombuffer(r["weights"], np.int64)
                parts[r["position"]] = parts.get(r["position"], 0.0) + float((w * digamma(n)).sum())
            else:
                place, end, sign, w = np.frombuffer(r["ends"]).reshape(-1, 4).T
                side = [np.searchsorted(values, end, side=s) for s in ("left", "right")]
                n = sign * (before + upto[np.where(sign < 0, *side)])
                ends = np.column_stack([place, n, np.where(sign < 0, 0, w)])
                out.append({"position": r["position"], "line": line, "home": r["home"], "ends": ends.tobytes()})
        return _rows([*({"position": i, "part": -p} for i, p in parts.items()), *out], RANKS)

    def paired(key: tuple, table: pa.Table) -> pa.Table:
        place, n, w = _joined(table["ends"]).reshape(-1, 3).T
        _, of = np.unique(place, return_inverse=True)
        part = -float((np.bincount(of, w) * digamma(np.bincount(of, n))).sum())
        return _rows([{"position": key[0].as_py(), "part": part}], PARTS)

    # As many partitions as tasks, so that a partition holds few of them.
    parts = max(width, int(tasks.sum()))
    counts = stage_table(
        there.repartition(parts, "task")
        .groupBy("task")
        .cogroup(asked.repartition(parts, "task").groupBy("task"))
        .applyInArrow(counted, _sql(RANKS)),
        "neighbour-ranks",
    )
    split = counts.where("ends IS NOT NULL").groupBy("position", "line", "home").applyInArrow(paired, _sql(PARTS))
    return counts.where("part IS NOT NULL").select("position", "part").unionByName(split)


def _undistanced(points: DataFrame, infinite: dict[int, list[str]], k: int) -> DataFrame:
    """(position, part) of features with infinite values: points have others near them only where more than k are equal."""
    parts = []
    for i, finite in infinite.items():
        equal = points.where(F.col("position") == i).groupBy(*finite).agg(F.sum("w").alias("w"))

        def summed(frames: Iterator[pd.DataFrame], i=i, sides=len(finite)) -> Iterator[pd.DataFrame]:
            for frame in frames:
                w = frame["w"].to_numpy()
                psi = digamma(np.maximum(w - 1, 1)) - np.where(w > k, sides * digamma(w), 0.0)
                yield pd.DataFrame({"position": [i], "part": [float((frame["n"].to_numpy() * w * psi).sum())]})

        sizes = equal.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        parts.append(sizes.mapInPandas(summed, _sql(PARTS)))
    return functools.reduce(DataFrame.unionByName, parts)


def _distanced(points: DataFrame, columns: DataFrame, clouds: Clouds, rows: dict[int, int], k: int) -> DataFrame:
    """(position, part): sums of the points' digammas over all features that have distances."""
    spark = columns.sparkSession
    _trees(points, clouds, rows)
    least, most = int(spark.conf.get("spark.sql.shuffle.partitions")), sum(rows[i] for i in clouds.spread)
    width, dealt = max(least, -(-2 * most // RANGE)), max(least, -(-most // DEALT))
    values = _values(columns, clouds, width)
    known = spark.sparkContext.broadcast(_known(values, clouds))
    cells = _cells(columns, clouds, known, dealt, k)
    found = cells.unionByName(_crossing(cells, clouds, known, dealt, k))
    parts = found.where("part IS NOT NULL").select("position", "part")
    if len(known.value) < len(clouds.sides):
        parts = parts.unionByName(_ranks(found, values, clouds, width))
    known.unpersist()
    return parts


def neighbour_information(
    df: DataFrame, features: list[str], label: str, k: int = NEIGHBOURS
) -> DataFrame:
    """(position, feature, score) of every feature with the label, by its ``k`` nearest neighbours."""
    spark = df.sparkSession
    clouds, rows, infinite = _deviations(df, features, label, k)
    if not rows:
        names = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
        return names.select("position", "feature", F.lit(0.0).alias("score"))
    points, parts = _points(df, features, label), []
    if clouds.spread:
        parts.append(_distanced(points, _present(df, [*features, label]), clouds, rows, k))
    if infinite:
        parts.append(_undistanced(points, infinite, k))
    parts = functools.reduce(DataFrame.unionByName, parts)
    named = [(i, name, rows.get(i, 1), float(digamma(rows[i])) if i in rows else 0.0) for i, name in enumerate(features)]
    names = spark.createDataFrame(named, "position int, feature string, rows bigint, head double")
    # The counts hold the point itself, as the estimator's n + 1 does.
    sums = parts.groupBy("position").agg(F.sum("part").alias("part"))
    score = F.col("head") + F.coalesce("part", F.lit(0.0)) / F.col("rows")
    score = F.round(F.greatest(score, F.lit(0.0)), SCORE_DIGITS)
    # One row per feature.
    return names.join(F.broadcast(sums), "position", "left").select("position", "feature", score.alias("score"))
