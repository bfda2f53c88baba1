"""Exact-size random splits without a global sort.

Rows are ordered by a hash of the seed and a unique row key. The cut hashes that
give the exact sizes are found by counting: one pass counts rows per hash
prefix (a fixed number of groups), the next look only inside the prefixes that
hold a cut, so no task orders more hashes than a prefix step has. The split itself then is a row-local comparison: no shuffle of the
data, the same result on any partitioning and after any retry.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lunario.session import stage_table

HASH_CHARS = 32
PREFIX_CHARS = 4
#: Rows of a prefix that are told apart by their whole hash at once.
FEW = 16**PREFIX_CHARS


def split_hash(keys: list[str], seed: int) -> Column:
    """Digest of the seed and the keys; a NULL and a separator inside a key are spelled out."""

    def spelled(key: str) -> Column:
        text = F.replace(F.col(key).cast("string"), F.lit("|"), F.lit("||"))
        return F.coalesce(text, F.lit("|null"))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[spelled(k) for k in keys]))


def _cut_hashes(hashes: DataFrame, cuts_of: Callable[[int], list[int]]) -> list[str]:
    """For each cut position p (from the row count) the p-th smallest hash, '' for p = 0."""
    prefix = F.substring("h", 1, PREFIX_CHARS)
    # At most 16 ** PREFIX_CHARS rows whatever the data size.
    counts = stage_table(
        hashes.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")), "hash-counts"
    )
    running = counts.withColumn("upto", F.sum("n").over(Window.orderBy("prefix")))
    positions = cuts_of(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    cuts = [p for p in positions if p > 0]
    if not cuts:
        return ["" for _ in positions]
    holders = running.agg(
        *[
            F.min(F.when(F.col("upto") >= p, F.struct("upto", "n", "prefix"))).alias(f"p{i}")
            for i, p in enumerate(cuts)
        ]
    ).first()
    # Longer prefixes of the holders only, the whole hash once few rows are left in each.
    length, before = PREFIX_CHARS, [h["upto"] - h["n"] for h in holders]
    while length < HASH_CHARS:
        few = all(h["n"] <= FEW for h in holders)
        finer = HASH_CHARS if few else min(length + PREFIX_CHARS, HASH_CHARS)
        outer = F.substring("h", 1, length)
        within = (
            hashes.where(outer.isin([h["prefix"] for h in holders]))
            .groupBy(outer.alias("outer"), F.substring("h", 1, finer).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(Window.partitionBy("outer").orderBy("prefix")))
        )
        holders = within.agg(
            *[
                F.min(
                    F.when(
                        (F.col("outer") == holder["prefix"]) & (F.col("upto") >= p - past),
                        F.struct("upto", "n", "prefix"),
                    )
                ).alias(f"p{i}")
                for i, (p, holder, past) in enumerate(zip(cuts, holders, before))
            ]
        ).first()
        before = [past + h["upto"] - h["n"] for past, h in zip(before, holders)]
        length = finer
    by_position = dict(zip(cuts, [h["prefix"] for h in holders]))
    return [by_position.get(p, "") for p in positions]


def train_test_split(
    df: DataFrame,
    keys: list[str],
    test_share: float = 0.2,
    seed: int = 42,
    name: str = "is_test",
) -> DataFrame:
    """Flag the ``ceil(test_share * n)`` rows with the smallest key hash as test rows."""
    h = split_hash(keys, seed)
    (cut,) = _cut_hashes(df.select(h.alias("h")), lambda n: [math.ceil(test_share * n)])
    return df.withColumn(name, h <= F.lit(cut))


def kfold(
    df: DataFrame, keys: list[str], folds: int = 3, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Zero-based fold number: equal runs of the hash order, the first folds one row longer."""
    h = split_hash(keys, seed)

    def ends(n: int) -> list[int]:
        sizes = [n // folds + (i < n % folds) for i in range(folds)]
        return [sum(sizes[: i + 1]) for i in range(folds - 1)]

    cuts = _cut_hashes(df.select(h.alias("h")), ends)
    above = [(h > F.lit(cut)).cast("int") for cut in cuts]
    return df.withColumn(name, sum(above, F.lit(0)))


#: Parts that a range of values is cut into by one counting pass.
PARTS = 4096


def _as_number(df: DataFrame, column: str) -> Column:
    """The column as a whole number in the same order: its own, days, or microseconds."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("byte", "short", "integer", "long", "boolean"):
        return value.cast("bigint")
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":
        # From its parts, so that no time zone moves or merges wall-clock times.
        minutes = F.unix_date(value.cast("date")).cast("bigint") * 1440 + F.hour(value) * 60 + F.minute(value)
        seconds = F.extract(F.lit("SECOND"), value) * 1_000_000
        return minutes * 60_000_000 + seconds.cast("bigint")
    raise TypeError(f"{column}: no ordered split by {kind}")


def _from_top(numbers: DataFrame, wanted: int) -> tuple[int, int] | None:
    """The largest number that ``wanted`` rows reach or pass, and the rows above it.

    Every pass counts rows in ``PARTS`` parts of a range and goes on in the part
    that holds the cut, so no task orders more than ``PARTS`` counts and five or
    six passes settle any 64-bit key.
    """
    ends = numbers.agg(F.min("x"), F.max("x"), F.count("x")).first()
    low, high, n = ends[0], ends[1], ends[2]
    if not n or n < wanted:
        return None
    above = 0
    while low < high:
        # In Python's whole numbers: a range of 64-bit keys can be wider than 64 bits.
        width = -(-(high - low + 1) // PARTS)
        offset = f"cast(x as decimal(20,0)) - cast('{low}' as decimal(20,0))"
        part = F.expr(f"int(({offset}) div cast('{width}' as decimal(20,0)))")
        counts = (
            numbers.where(F.col("x").between(low, high)).groupBy(part.alias("part")).count().collect()
        )
        for row in sorted(counts, key=lambda r: -r["part"]):
            if above + row["count"] >= wanted:
                low, high = low + row["part"] * width, min(high, low + (row["part"] + 1) * width - 1)
                break
            above += row["count"]
    return low, above


def time_split(
    df: DataFrame, time_cols: list[str], test_share: float = 0.2, name: str = "is_test"
) -> DataFrame:
    """Flag the newest periods as test: as many whole periods as reach the test share.

    Keeps overlapping rolling windows of neighbouring months on one side. The cut
    is found column by column, by counts over narrowing ranges of values, so
    periods may be as fine as single microseconds. Rows without a period are the
    oldest. Time columns are whole numbers, dates or timestamps.
    """
    wanted = math.ceil(test_share * df.count())
    numbers = df.select(*[_as_number(df, c).alias(f"t{i}") for i, c in enumerate(time_cols)])
    rows, edge = numbers, []
    for i in range(len(time_cols)):
        found = _from_top(rows.select(F.col(f"t{i}").alias("x")), wanted) if wanted else None
        if found is None:
            break
        edge.append(found[0])
        wanted -= found[1]
        rows = rows.where(F.col(f"t{i}") == found[0])
    if not edge:
        # Either no test rows are wanted, or so many that those without a period count too.
        return df.withColumn(name, F.lit(wanted > 0))
    place = [_as_number(df, c) for c in time_cols[: len(edge)]]
    cut = F.struct(*[F.lit(x).cast("bigint").alias(f"t{i}") for i, x in enumerate(edge)])
    here = F.struct(*[p.alias(f"t{i}") for i, p in enumerate(place)])
    return df.withColumn(name, F.coalesce(here >= cut, F.lit(False)))
