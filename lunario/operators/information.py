"""Mutual information between features and a label from binned counts.

The score of a feature is taken from the joint counts of its quantile bins and
the label's quantile bins. One aggregate of quantile sketches, for columns of
many values a few counting passes that make the edges exact, and one count per
(feature, bin, label bin), all combined on the map side; everything after that
has the size of features x bins x bins.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BINS = 10
SKETCH_ACCURACY = 10_000
#: Parts of a span that a sketch tells apart.
STEPS = 1_000
# Scores closer than this are ties, so that summation order cannot decide them.
SCORE_DIGITS = 9


def _binned(column: str) -> Column:
    """Single precision: equal figures reached by different sums land in the same bin."""
    return F.col(column).cast("float")


def _spans(spark: SparkSession, open_spans: dict) -> DataFrame:
    """One row per span (position, low, high); a missing end is unbounded."""
    rows = [(i, *span) for i, span in enumerate(open_spans)]
    return spark.createDataFrame(rows, "span int, position int, low float, high float")


def _narrowed(inside: DataFrame, open_spans: dict) -> dict:
    """Splits each span at a few of its values around every wanted rank, by exact counts.

    The values come from a sketch, which steers but does not decide: the counts
    between and at them tell exactly where each rank lies.
    """
    sketch = inside.groupBy("span").agg(
        F.percentile_approx("x", [i / STEPS for i in range(STEPS + 1)], SKETCH_ACCURACY).alias("q"),
        F.count("x").alias("n"),
    )
    points = {}
    wanted = list(open_spans.values())
    for row in sketch.collect():
        near = set()
        for rank in wanted[row["span"]].values():
            place = rank * STEPS // row["n"]
            near.update(row["q"][max(0, place - 1) : place + 3])
        points[row["span"]] = sorted(near)
    table = inside.sparkSession.createDataFrame(list(points.items()), "span int, points array<float>")
    x = F.col("x")
    # Cell 2i is open below point i, cell 2i + 1 is the point itself.
    below = F.size(F.filter("points", lambda p: p < x))
    upto = F.size(F.filter("points", lambda p: p <= x))
    counted = (
        inside.join(F.broadcast(table), "span")
        .groupBy("span", (below + upto).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells: dict[int, dict[int, int]] = {}
    for row in counted.collect():
        cells.setdefault(row["span"], {})[row["cell"]] = row["n"]
    narrowed: dict = {}
    for i, ((position, low, high), ranks) in enumerate(open_spans.items()):
        ends = [low, *points[i], high]
        for name, rank in ranks.items():
            left = rank
            for cell, n in sorted(cells[i].items()):
                if left <= n:
                    break
                left -= n
            at = (position, ends[cell // 2], ends[cell // 2 + 1])
            if cell % 2:
                at = (position, ends[cell // 2 + 1], ends[cell // 2 + 1])
            narrowed.setdefault(at, {})[name] = left
    return narrowed


def bin_edges(
    df: DataFrame, columns: list[str], bins: int = BINS, accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float]]:
    """Exact inner quantile edges per column: the value at rank ``ceil(share * rows)``.

    A sketch is exact while a column has fewer than ``accuracy`` values. Beyond
    that, each pass counts around sketched values and keeps the span that holds
    the wanted rank, about a hundredth or less of the one before, until it is a
    single value. The driver receives ``STEPS`` values per span, never rows;
    stage ``df`` first if it is costly to build. Missing values have no rank.
    """
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(
        *[
            F.percentile_approx(_binned(c), shares, accuracy).alias(f"q{i}")
            for i, c in enumerate(columns)
        ],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    if row[0] is None:
        raise ValueError("no rows to bin")
    large = [i for i in range(len(columns)) if row[f"n{i}"] >= accuracy]
    edges = {c: row[f"q{i}"] for i, c in enumerate(columns) if i not in large}
    found: dict[tuple[int, int], float] = {}
    open_spans = {
        (i, None, None): {(i, b): ceil(s * row[f"n{i}"]) for b, s in enumerate(shares)}
        for i in large
    }
    values = F.array(
        *[F.struct(F.lit(i).alias("position"), _binned(columns[i]).alias("x")) for i in large]
    )
    while open_spans:
        fits = (F.col("low").isNull() | (F.col("x") > F.col("low"))) & (
            F.col("high").isNull() | (F.col("x") < F.col("high"))
        )
        inside = (
            df.select(F.inline(values))
            .where("x IS NOT NULL")
            .join(F.broadcast(_spans(df.sparkSession, open_spans)), "position")
            .where(fits)
            .select("span", "x")
        )
        spans = _narrowed(inside, open_spans)
        found |= {n: low for (_, low, high), names in spans.items() if low is not None and low == high for n in names}
        open_spans = {k: v for k, v in spans.items() if k[1] is None or k[1] != k[2]}
    for i in large:
        edges[columns[i]] = [found[i, b] for b in range(len(shares))]
    return edges


def mutual_information(
    df: DataFrame, features: list[str], label: str, bins: int = BINS
) -> DataFrame:
    """(position, feature, score) with the score in nats.

    The edges join the unpivoted values as a table, so the plan does not grow with
    features x bins. That table has one row per feature, whatever the data size,
    hence the broadcast.
    """
    edges = bin_edges(df, [*features, label], bins)
    marks = [f"e{i}" for i in range(bins - 1)]
    edge_table = df.sparkSession.createDataFrame(
        [(i, c, *edges[c]) for i, c in enumerate(features)],
        "position int, feature string, " + ", ".join(f"{m} float" for m in marks),
    )
    values = F.array(
        *[
            F.struct(F.lit(i).alias("position"), _binned(c).alias("x"))
            for i, c in enumerate(features)
        ]
    )
    label_bin = sum(
        [(_binned(label) > F.lit(e).cast("float")).cast("int") for e in edges[label]], F.lit(0)
    )
    feature_bin = sum([(F.col("x") > F.col(m)).cast("int") for m in marks], F.lit(0))
    cells = (
        df.select(label_bin.alias("by"), F.inline(values))
        .join(F.broadcast(edge_table), "position")
        .groupBy("position", "feature", feature_bin.alias("bx"), "by")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # Gathered by position first: the finer windows and the final sum then need no
    # further shuffle.
    by_position = cells.withColumn("t", F.sum("n").over(Window.partitionBy("position")))
    with_margins = by_position.withColumn(
        "x", F.sum("n").over(Window.partitionBy("position", "bx"))
    ).withColumn("y", F.sum("n").over(Window.partitionBy("position", "by")))
    return with_margins.groupBy("position", "feature").agg(
        F.round(F.sum(F.expr("n / t * ln(n * t / (x * y))")), SCORE_DIGITS).alias("score")
    )


def best_features(scores: DataFrame, k: int) -> DataFrame:
    """The k highest scores with their rank; of equal scores the later feature wins."""
    ranked = Window.orderBy(F.col("score").desc(), F.col("position").desc())
    # One row per feature, so the single-partition order is bounded by the schema.
    return scores.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
