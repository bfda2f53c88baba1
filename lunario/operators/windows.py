"""Ordered per-series operators: label shift, lag, rolling statistics, row position.

Rows of a series are put in order by the given columns (which must identify a
row within its series) and never by a calendar: a missing month is not a gap.

A series key alone is a safe window partition only while every series is short.
Callers whose series can grow without limit pass ``unit``, a coarse step of the
leading order column such as its day. Series longer than ``target_rows`` are
then cut into runs of consecutive units, each run is one window partition, and
only the few rows next to a cut are worked out a second time, each cut in a window
partition of its own. A unit with more than ``target_rows`` rows is itself cut
into pieces, ranges of the order key that a range partitioner deals out, so a day
or minute that holds a whole table is split as well. Positions of the pieces come
from a prefix sum in two levels, over blocks of pieces and within each block. Units
must not overlap along the order; that is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lunario.schema import ROLLING_WINDOW, rolling_name
from lunario.session import stage_table

RUN_ROWS = 4_000_000

_UNIT = "__unit"
_PIECE = "__piece"
_BLOCK = "__block"
_RUN = "__run"
_RANK = "__rank"
_CUTS = "__cuts"
_CUT = "__cut"

Output = Callable[[WindowSpec], Column]


def _same(left: str, right: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def _in_pieces(
    df: DataFrame, series: list[str], order: list[str | Column], target_rows: int, units: DataFrame
) -> DataFrame:
    """``df`` (with ``__unit``) plus ``__piece``: 0, or the order-key range in a unit that is too long.

    ``units`` has the rows per unit of long series. Only rows of units above
    ``target_rows`` move: a range partitioner deals them out by series, unit and
    order key, and they are staged, so that every reader sees the same ranges.
    """
    oversize = stage_table(
        units.where(F.col("__n") > target_rows).select(*series, _UNIT, "__n"), "oversize-units"
    )
    total = oversize.agg(F.sum("__n")).first()[0]
    if total is None:
        return df.withColumn(_PIECE, F.lit(0))
    keys = [*series, _UNIT]
    # At most rows / target_rows units are too long.
    named = oversize.select(*keys, F.lit(True).alias("__oversize"))
    marked = df.alias("d").join(named.alias("o"), _same("d", "o", keys), "left").select(
        "d.*", F.coalesce("o.__oversize", F.lit(False)).alias("__oversize")
    )
    ranges = -(-total // target_rows)
    dealt = (
        marked.where("__oversize")
        .repartitionByRange(ranges, *[F.col(k) for k in keys], *order)
        .withColumn(_PIECE, F.spark_partition_id())
    )
    whole = marked.where("NOT __oversize").withColumn(_PIECE, F.lit(0))
    return whole.unionByName(stage_table(dealt, "series-pieces")).drop("__oversize")


def _positions(pieces: DataFrame, series: list[str]) -> DataFrame:
    """Adds ``__before``, the rows of the series ahead of a piece, and whether the piece overlaps one.

    Pieces are dealt to blocks in order. A window never holds more than the
    pieces of a block, or one row per block of a series.
    """
    place = [_UNIT, _PIECE]
    blocks = stage_table(
        pieces.repartitionByRange(*[F.col(c) for c in [*series, *place]]).withColumn(
            _BLOCK, F.spark_partition_id()
        ),
        "series-blocks",
    )
    ahead = Window.partitionBy(*series).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocks.groupBy(*series, _BLOCK)
        .agg(F.sum("__n").alias("__n"), F.max("__high").alias("__high"))
        .withColumn("__blocks_before", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
        .withColumn("__blocks_high", F.max("__high").over(ahead))
        .drop("__n", "__high")
    )
    before = (
        Window.partitionBy(*series, _BLOCK)
        .orderBy(*place)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = blocks.withColumn(
        "__inside", F.coalesce(F.sum("__n").over(before), F.lit(0))
    ).withColumn("__inside_high", F.max("__high").over(before))
    highest = F.greatest("t.__blocks_high", "i.__inside_high")
    return (
        inside.alias("i")
        .join(totals.alias("t"), _same("i", "t", [*series, _BLOCK]))
        .select(
            *[f"i.{c}" for c in [*series, *place, "__n"]],
            (F.col("t.__blocks_before") + F.col("i.__inside")).alias("__before"),
            (F.col("i.__low") < highest).alias("__overlaps"),
        )
    )


def _runs_of_long_series(
    df: DataFrame,
    series: list[str],
    unit: Column,
    target_rows: int,
    order: list[str | Column] = [],
    margin: int = 0,
) -> tuple[DataFrame, DataFrame] | None:
    """The rows with unit and piece, and (series, unit, piece) -> run, first row position, cuts.

    Cuts are those within ``margin`` rows of the run. Counting passes read just
    the key columns and combine on the map side. There are at most rows /
    target_rows long series.
    """
    tagged = df.withColumn(_UNIT, unit)
    place = F.struct(*order) if order else F.lit(None).cast("int")
    keyed = tagged.select(*series, _UNIT)
    long_series = stage_table(
        keyed.groupBy(*series)
        .agg(F.count(F.lit(1)).alias("__total"))
        .where(F.col("__total") > target_rows),
        "long-series",
    )
    if long_series.isEmpty():
        return None

    def of_long(keys: DataFrame) -> DataFrame:
        if not series:
            return keys
        return keys.alias("u").join(long_series.alias("l"), _same("u", "l", series), "left_semi")

    sizes = of_long(keyed.groupBy(*series, _UNIT).agg(F.count(F.lit(1)).alias("__n")))
    tagged = _in_pieces(tagged, series, order, target_rows, sizes)
    pieces = of_long(
        tagged.select(*series, _UNIT, _PIECE, place.alias("__place"))
        .groupBy(*series, _UNIT, _PIECE)
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.min("__place").alias("__low"),
            F.max("__place").alias("__high"),
        )
    )
    placed = stage_table(
        _positions(pieces, series).withColumn(_RUN, F.floor(F.col("__before") / target_rows)),
        "series-places",
    )
    if not placed.where("__overlaps").isEmpty():
        raise ValueError("unit decreases along the order: its steps overlap")
    runs = placed.groupBy(*series, _RUN).agg(
        F.min("__before").alias("__start"), F.max(F.col("__before") + F.col("__n")).alias("__end")
    )
    # Every run start but the first is a cut; a run meets those near it by steps of the row position.
    step = target_rows + margin
    spots = F.sequence(
        F.floor((F.col("__start") - margin) / step), F.floor((F.col("__end") + margin) / step)
    )
    cuts = runs.where("__start > 0").select(
        *series, F.col("__start").alias(_CUT), F.floor(F.col("__start") / step).alias("__spot")
    )
    seen = runs.withColumn("__spot", F.explode(spots)).alias("r")
    near = F.col(f"c.{_CUT}").between(F.col("r.__start") - margin, F.col("r.__end") + margin)
    marked = (
        seen.join(cuts.alias("c"), [*_same("r", "c", [*series, "__spot"]), near], "left")
        .select(*[f"r.{c}" for c in [*series, _RUN, "__start"]], f"c.{_CUT}")
        .groupBy(*series, _RUN, "__start")
        .agg(F.sort_array(F.collect_set(_CUT)).alias(_CUTS))
    )
    joined = placed.alias("u").join(marked.alias("c"), _same("u", "c", [*series, _RUN]))
    keys = [*series, _UNIT, _PIECE]
    return tagged, stage_table(
        joined.select(*[f"u.{c}" for c in [*keys, _RUN]], "c.__start", f"c.{_CUTS}"), "series-runs"
    )


def _attach_runs(tagged: DataFrame, runs: DataFrame, series: list[str]) -> DataFrame:
    return (
        tagged.alias("d")
        .join(runs.alias("r"), _same("d", "r", [*series, _UNIT, _PIECE]), "left")
        .select("d.*", f"r.{_RUN}", "r.__start", f"r.{_CUTS}")
        .drop(_UNIT, _PIECE)
    )


def over_series(
    df: DataFrame,
    series: list[str],
    order: list[str | Column],
    outputs: dict[str, Output],
    *,
    before: int = 0,
    after: int = 0,
    unit: Column | None = None,
    target_rows: int = RUN_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``outputs`` maps each new column to a function from the ordered window to an
    expression. ``unit`` must not decrease along ``order``, whose columns must tell the rows
    of a series apart.
    """
    taken = [name for name in outputs if name in df.columns]
    if taken:
        raise ValueError(f"output columns exist already: {taken}")
    whole = Window.partitionBy(*series).orderBy(*order)
    plain = {name: make(whole) for name, make in outputs.items()}
    runs = None
    margin = before + after
    if unit is not None:
        runs = _runs_of_long_series(df, series, unit, target_rows, order, margin)
    if runs is None:
        return df.withColumns(plain)

    # Inside a run every row sees all the rows it needs, unless a cut lies less than
    # `after` rows ahead or `before` rows back. Those rows are worked out again over
    # the `before + after` rows on each side of their cut, one partition per cut.
    tagged = _attach_runs(*runs, series)
    in_run = Window.partitionBy(*series, _RUN).orderBy(*order)
    placed = tagged.withColumns(
        {
            # NULL for rows of unsplit series, whose start is NULL.
            _RANK: F.col("__start") + F.row_number().over(in_run) - 1,
            **{name: make(in_run) for name, make in outputs.items()},
        }
    )
    position = F.col(_RANK)

    def crossed(cut: Column) -> Column:
        return (position >= cut - after) & (position < cut + before)

    # Tested after the window, so that both branches below read the same shuffle.
    at_cut = F.coalesce(F.exists(_CUTS, crossed), F.lit(False))
    kept = placed.where(~at_cut)
    seen = F.filter(
        _CUTS, lambda cut: (position >= cut - margin) & (position < cut + margin)
    )
    in_cut = Window.partitionBy(*series, _CUT).orderBy(*order)
    redone = (
        placed.drop(*outputs)
        .withColumn("__first_cut", F.array_min(F.filter(_CUTS, crossed)))
        .withColumn(_CUT, F.explode(seen))
        .withColumns({name: make(in_cut) for name, make in outputs.items()})
        .where(F.col(_CUT) == F.col("__first_cut"))
    )
    columns = [*df.columns, *outputs]
    return kept.select(*columns).unionByName(redone.select(*columns))


def lead_label(
    df: DataFrame,
    series: list[str],
    order: list[str | Column],
    source: str,
    label: str = "target",
    **scale,
) -> DataFrame:
    """The next row's ``source`` as ``label``; the newest row of a series gets NULL.

    Moving one label up replaces moving every other column, the period included,
    one row down: the row stays named after its own (last observed) period.
    """
    return over_series(
        df, series, order, {label: lambda w: F.lead(source, 1).over(w)}, after=1, **scale
    )


def lag_columns(
    df: DataFrame,
    series: list[str],
    order: list[str | Column],
    columns: list[str],
    rows: int = 1,
    **scale,
) -> DataFrame:
    """Replace each column by its value ``rows`` rows earlier in the series."""
    keep = {f"__lag_{c}": (lambda w, c=c: F.lag(c, rows).over(w)) for c in columns}
    lagged = over_series(df, series, order, keep, before=rows, **scale)
    return lagged.select(
        *[F.col(f"__lag_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _clean(column: str) -> str:
    return f"__clean_{column}"


ROLLING = {"mean": F.avg, "std": F.stddev_samp}


def rolling_outputs(
    columns: list[str], method: str, window: int = ROLLING_WINDOW, shift: int = 0
) -> dict[str, Output]:
    """Trailing window of ``window`` rows ending ``shift`` rows back, over cleaned columns."""
    if method not in ROLLING:
        raise NotImplementedError(f"rolling method {method!r}")
    statistic = ROLLING[method]

    def make(column: str) -> Output:
        return lambda w: statistic(_clean(column)).over(w.rowsBetween(1 - window - shift, -shift))

    return {rolling_name(c, method, window): make(c) for c in columns}


def rolling(
    df: DataFrame,
    series: list[str],
    order: list[str | Column],
    columns: list[str],
    methods: list[str],
    window: int = ROLLING_WINDOW,
    shift: int = 0,
    **scale,
) -> DataFrame:
    """Append rolling statistics of the columns that exist; all share one window pass.

    NaN counts as missing.

    ``shift=1`` is the fused form of lag-then-roll: the window ends at the
    previous row.
    """
    present = [c for c in columns if c in df.columns]
    outputs: dict[str, Output] = {}
    if present:
        for method in methods:
            outputs.update(rolling_outputs(present, method, window, shift))
    if not outputs:
        return df
    missing = F.lit(None).cast("double")
    cleaned = df.withColumns(
        {_clean(c): F.nanvl(F.col(c).cast("double"), missing) for c in present}
    )
    rolled = over_series(cleaned, series, order, outputs, before=window - 1 + shift, **scale)
    return rolled.drop(*[_clean(c) for c in present])


def series_position(
    df: DataFrame,
    series: list[str],
    order: list[str | Column],
    name: str = "position",
    *,
    unit: Column | None = None,
    target_rows: int = RUN_ROWS,
) -> DataFrame:
    """Zero-based row number within the series; long series add the start of their run."""
    runs = None
    if unit is not None:
        runs = _runs_of_long_series(df, series, unit, target_rows, order)
    if runs is None:
        whole = Window.partitionBy(*series).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(whole) - 1).cast("bigint"))
    tagged = _attach_runs(*runs, series)
    in_run = Window.partitionBy(*series, _RUN).orderBy(*order)
    start = F.coalesce(F.col("__start"), F.lit(0))
    return tagged.withColumn(
        name, (start + F.row_number().over(in_run) - 1).cast("bigint")
    ).drop(_RUN, _CUTS, "__start")
