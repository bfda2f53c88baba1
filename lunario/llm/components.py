"""Connected components of a link table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario.llm.common import staged

ROUNDS = 64


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node that it reaches.

    Large-star hangs a node's larger neighbours below its smallest one,
    small-star its smaller ones; the number of rounds grows with the logarithm
    of the longest chain. Minima are combined before the shuffle, each round is
    written to the shared folder, and a node of many links is split by the
    join's skew handling, so no task holds a component.
    """
    now = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(ROUNDS):
        mark = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(
            F.col("v").alias("u"), F.least("u", "m").alias("m")
        )
        # Larger neighbours v of u go below the smallest of u and its neighbours.
        large = (
            now.join(least, "u").where("v <> m").select("v", F.col("m").alias("u")).distinct()
        )
        large = staged(large, "large-star")
        smallest = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(smallest, "v")
        small = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = staged(
            small.unionByName(smallest.select("v", F.col("m").alias("u"))).distinct(),
            "small-star",
        )
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)
