"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source has a token target. Of all document rates between 0 and ``CAP``
that meet it, entropy balancing takes those nearest to 1 in relative entropy:
rate = min(CAP, exp(lambda * size / mean size)). The dual is convex with one
unknown per source; safeguarded Newton steps solve it, each step one aggregate
over the table of distinct (source, size), which is all the dual depends on.

Rates become copies per (source, size), from large sizes to small: along running
sums over ranges of sizes, fractions of copies go on from size to size, and a fold
over the smallest ``TAIL`` sizes of a source carries the words still owed, so a
source ends within half of its smallest document of its target. Which documents of a size get the copy
more is settled by their hash, in 4,096 hash ranges per size, so no size of a
hot source meets in one task. Nothing is random: reruns agree.

A null text has size 0; null is a source of its own, last in order. Documents
of size 0 are taken once and count nothing. Repeated rows are separate
documents. Other columns are carried by ``mixed`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.llm.common import carried, shuffle_width, staged, text_hash, whole_text

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
#: No document and no source is taken more often than this.
CAP = 3
HASH_RANGES = 4096
TOLERANCE = 1e-10
STEPS = 80
#: Largest share of a target that a multiplier may still miss after all steps.
MISSED = 1e-6
#: Smallest sizes of a source that are folded one after the other; parts of a copy.
TAIL, UNIT = 1024, 1_000_000_000


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source")).alias("src"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
        text_hash().alias("text_hash"),
        F.xxhash64("doc_id", whole_text()).alias("h"),
    )


def targets(by_size: DataFrame) -> DataFrame:
    """One row per source: src, source_size, rows, target.

    Sources fill at the pace of their weights until ``CAP`` times their size;
    the level at which all words are shared follows from running sums over the
    sources, ordered by the level at which each is full.
    """
    sources = by_size.groupBy("src", "source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("rows")
    )
    listed = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(listed) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), place + 1)
    room = F.col("source_size").cast("double") * CAP
    filled = Window.partitionBy(F.lit(0)).orderBy("full_at", "src")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    level = (
        sources.withColumn("weight", weight)
        .withColumn("full_at", room / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("full", F.coalesce(F.sum(room).over(before), F.lit(0.0)))
        .withColumn(
            "open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        )
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn(
            "shared",
            F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "src", "level")))
            .over(every)["level"],
        )
    )
    return level.select(
        "src",
        "source_size",
        "rows",
        F.least(room, F.coalesce(F.col("weight") * F.col("shared"), room)).alias("target"),
    )


def _rate(tilt: Column) -> Column:
    scaled = tilt * F.col("size") / F.col("mean")
    return F.least(F.lit(float(CAP)), F.exp(F.least(scaled, F.lit(50.0))))


def solve(by_size: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per source with its multiplier ``tilt``, found by Newton steps on the dual."""
    mean = F.greatest(F.col("source_size") / F.col("rows"), F.lit(1e-9))
    state = staged(
        wanted.select(
            "src", "target", "source_size", mean.alias("mean"), F.lit(0.0).alias("tilt"),
            (mean * -60).alias("low"), (mean * 2).alias("high"), F.lit(False).alias("done"),
            F.lit(0.0).alias("missed"),
        ),
        "tilt",
    )
    for _ in range(STEPS):
        rate = _rate(F.col("tilt"))
        words = F.col("docs") * F.col("size")
        slope = F.when(rate < CAP, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            by_size.join(state.where(~F.col("done")), "src")
            .groupBy("src")
            .agg(F.sum(words * rate).alias("taken"), F.sum(slope).alias("slope"))
        )
        gap = F.coalesce(F.col("taken") - F.col("target"), F.lit(0.0))
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.greatest(F.col("slope"), F.lit(1e-300))
        met = F.abs(gap) <= F.col("target") * TOLERANCE
        narrow = (high - low) <= F.lit(1e-13) * F.greatest(F.abs(low), F.abs(high))
        state = staged(
            state.join(sums, "src", "left").select(
                "src", "target", "source_size", "mean",
                F.when(F.col("done") | met, F.col("tilt"))
                .when((newton > low) & (newton < high), newton)
                .otherwise((low + high) / 2)
                .alias("tilt"),
                low.alias("low"), high.alias("high"),
                (F.col("done") | met | narrow).alias("done"),
                F.abs(F.try_divide(gap, "target")).alias("missed"),
            ),
            "tilt",
        )
        if state.where(~F.col("done")).isEmpty():
            return state
    far = state.where(~F.col("done") & (F.col("missed") > MISSED)).count()
    if far:
        raise RuntimeError(f"the targets of {far} sources are not met in {STEPS} steps")
    return state


def _rounded_along(large: DataFrame, width: int) -> DataFrame:
    """Copies of the large sizes of each source: every fraction of a copy goes on to the next size.

    Fractions are whole billionths, so their running sums do not follow the order
    of partitions. Sizes are dealt in ranges; a sum within each range is completed
    by the sums of the ranges before, so no task sees all sizes of a source.
    """
    ranged = staged(
        large.repartitionByRange(width, F.col("src"), F.desc("size")).withColumn(
            "range", F.spark_partition_id()
        ),
        "size-ranges",
    )
    ahead = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and range.
    offsets = (
        ranged.groupBy("src", "range")
        .agg(F.sum("fraction").alias("all"))
        .select("src", "range", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("src", "range").orderBy(F.desc("size"))
    upto = F.sum("fraction").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = ranged.withColumn("run", upto).join(offsets, ["src", "range"])
    whole = F.expr(f"(offset + run) div {UNIT} - (offset + run - fraction) div {UNIT}")
    return run.withColumn("copies", F.col("least") + whole)


def _allotted(by_size: DataFrame, solved: DataFrame) -> DataFrame:
    """Copies for all documents of a (source, size), from large sizes to small.

    Sizes above the ``TAIL`` smallest of their source are rounded along the running
    sum of their expected copies, which leaves a source at most its largest document
    off. The words then owed are carried through its ``TAIL`` smallest sizes by a fold.
    """
    rate = F.when(
        F.col("target") >= CAP * F.col("source_size") * (1 - 1e-12), F.lit(float(CAP))
    ).otherwise(_rate(F.col("tilt")))
    expected = by_size.join(solved, "src").select(
        "src", "size", "docs", (F.col("docs") * rate).alias("expected")
    )
    least = F.floor(F.col("expected") + 0.5 / UNIT).cast("long")
    fraction = F.round((F.col("expected") - least) * UNIT).cast("long")
    expected = staged(
        expected.withColumn("least", least).withColumn("fraction", F.greatest(fraction, F.lit(0))), "expected"
    )
    place = F.row_number().over(Window.partitionBy("src").orderBy("size"))
    small = expected.select("src", "size", place.alias("place")).where(F.col("place") <= TAIL)
    edges = small.groupBy("src").agg(F.max("size").alias("edge"))
    sides = expected.join(edges, "src")
    width = shuffle_width(by_size.sparkSession)
    large = staged(
        _rounded_along(sides.where(F.col("size") > F.col("edge")).drop("edge"), width).select(
            "src", "size", "copies", (F.col("size") * (F.col("expected") - F.col("copies"))).alias("owed")
        ),
        "allotted-large",
    )
    owed = large.groupBy("src").agg(F.round(F.sum("owed"), 3).alias("owed"))
    tail = (
        sides.where(F.col("size") <= F.col("edge"))
        .groupBy("src")
        .agg(
            F.reverse(F.array_sort(F.collect_list(F.struct("size", "docs", "expected")))).alias("sizes")
        )
        .join(owed, "src", "left")
    )
    start = F.struct(
        F.coalesce("owed", F.lit(0.0)).alias("owed"),
        F.array().cast("array<struct<size:bigint,copies:bigint>>").alias("out"),
    )

    def step(state: Column, one: Column) -> Column:
        wish = F.round(one["expected"] + state["owed"] / F.greatest(one["size"], F.lit(1)))
        most = (one["docs"] * CAP).cast("double")
        copies = F.when(one["size"] == 0, one["docs"].cast("double")).otherwise(
            F.greatest(F.lit(0.0), F.least(most, wish))
        )
        return F.struct(
            (state["owed"] + one["size"] * (one["expected"] - copies)).alias("owed"),
            F.concat(
                state["out"],
                F.array(
                    F.struct(one["size"].alias("size"), copies.cast("bigint").alias("copies"))
                ),
            ).alias("out"),
        )

    folded = tail.select("src", F.aggregate("sizes", start, step, lambda s: s["out"]).alias("out"))
    rest = folded.select("src", F.explode("out").alias("o")).select("src", "o.size", "o.copies")
    return large.select("src", "size", "copies").unionByName(rest)


def decisions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, text_hash."""
    return _decided(docs).drop("source")


def _decided(docs: DataFrame) -> DataFrame:
    sized = staged(
        _sized(docs).withColumn("part", F.pmod(F.col("h"), F.lit(HASH_RANGES))), "sizes"
    )
    by_size = staged(
        sized.groupBy("src", "source", "size").agg(F.count(F.lit(1)).alias("docs")), "by-size"
    )
    wanted = staged(targets(by_size), "targets")
    counts = by_size.select("src", "size", "docs")
    allotted = staged(_allotted(counts, solve(counts, wanted)), "allotted")
    parts = sized.groupBy("src", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    each = Window.partitionBy("src", "size")
    earlier = each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slots = (
        parts.join(allotted, ["src", "size"])
        .withColumn("docs", F.sum("n").over(each))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .select(
            "src", "size", "part",
            F.expr("copies div docs").alias("each"),
            (F.col("copies") % F.col("docs") - F.col("before")).alias("more"),
        )
        .join(wanted.select("src", "source_size", "target"), "src")
    )
    rank = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("h", "doc_id"))
    return (
        sized.join(slots, ["src", "size", "part"])
        .withColumn("copies", F.col("each") + F.when(rank <= F.col("more"), 1).otherwise(0))
        .select(
            "doc_id", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"), "text_hash", "source",
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Rows equal in id, text and source share their copies; they meet only where they repeat.
    """
    chosen = (
        staged(_decided(docs), "copies")
        .groupBy("doc_id", "text_hash", "source")
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    )
    return carried(docs, chosen, "source")
