"""Window expressions over one series (entity) in date order.

All expressions for one kind of ordering share one window specification, so a frame
that takes them in a single ``withColumns`` is shuffled and sorted once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelftide.params import PanelColumns

ROLLING_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def by_date(panel: PanelColumns) -> WindowSpec:
    return Window.partitionBy(*panel.entity).orderBy(panel.date)


def by_day_number(panel: PanelColumns) -> WindowSpec:
    return Window.partitionBy(*panel.entity).orderBy(F.unix_date(panel.date))


def lag_columns(panel: PanelColumns, lags: Sequence[int]) -> dict[str, Column]:
    """Target of the row ``n`` places earlier; rows, not days."""
    w = by_date(panel)
    return {f"lag_{n}": F.lag(panel.target, n).over(w).cast("double") for n in lags}


def rolling_columns(
    panel: PanelColumns,
    sizes: Sequence[int],
    stats: Sequence[str] = ("mean", "std"),
    include_current: bool = True,
) -> dict[str, Column]:
    """Statistics over ``n`` rows. The frame ends on the current row, or on the one before
    it without ``include_current``; it is shorter at the start of a series."""
    last = 0 if include_current else -1
    w = by_date(panel)
    return {
        f"rolling_{stat}_{n}": ROLLING_STATS[stat](F.col(panel.target).cast("double")).over(
            w.rowsBetween(last - n + 1, last)
        )
        for n in sizes
        for stat in stats
    }


# Working columns: count, sum and sum of squares.
SUMS = ("count", "sum", "squares")


# Squares of 32-bit numbers and sums of them, exactly.
EXACT = "decimal(38,0)"


def needed_sums(stats: Sequence[str]) -> tuple[str, ...]:
    """A mean alone needs no squares."""
    return SUMS if "std" in stats else SUMS[:2]


def running_sums(panel: PanelColumns, stats: Sequence[str] = ("mean", "std")) -> dict[str, Column]:
    """``__running_*``: the sums from the start of the series to the row. Counts and sums of
    32-bit numbers fit 64 bits for any series of days; squares are added as decimals."""
    return _running(panel, by_date(panel).rowsBetween(Window.unboundedPreceding, Window.currentRow), stats)


def _running(panel: PanelColumns, w: WindowSpec, stats: Sequence[str]) -> dict[str, Column]:
    value = F.col(panel.target).cast("bigint")
    sums = {"count": F.count(value), "sum": F.sum(value), "squares": F.sum((value * value).cast("decimal(20,0)"))}
    whole = {"count": "bigint", "sum": "bigint", "squares": EXACT}
    return {f"__running_{name}": F.coalesce(sums[name].over(w), F.lit(0)).cast(whole[name]) for name in needed_sums(stats)}


def frame_sums(
    panel: PanelColumns, sizes: Sequence[int], include_current: bool = True, stats: Sequence[str] = ("mean", "std")
) -> dict[str, Column]:
    """``__frame_*_N``: the sums over a frame of N rows, which are the running sums at its end
    less those before its start. The work per row does not grow with the frame."""
    w = by_date(panel)
    skipped = 0 if include_current else 1

    def upto(name: str, rows_back: int) -> Column:
        running = F.col(f"__running_{name}")
        return F.coalesce(F.lag(running, rows_back).over(w), F.lit(0)) if rows_back else running

    return {
        f"__frame_{name}_{n}": upto(name, skipped) - upto(name, skipped + n) for n in sizes for name in needed_sums(stats)
    }


def calendar_running_sums(panel: PanelColumns, stats: Sequence[str] = ("mean", "std")) -> dict[str, Column]:
    """``__running_*`` up to the day of the row, all rows of that day included."""
    return _running(panel, by_day_number(panel).rangeBetween(Window.unboundedPreceding, Window.currentRow), stats)


def calendar_frame_sums(
    panel: PanelColumns, sizes: Sequence[int], include_current: bool = True, stats: Sequence[str] = ("mean", "std")
) -> dict[str, Column]:
    """``__frame_*_N`` over N days: the running sums of the last day of the frame less those of the last
    day before it. Frames that start with the series grow by a row at a time, so the work per
    row does not grow with N."""
    w = by_day_number(panel)
    skipped = 0 if include_current else 1

    def upto(name: str, days_back: int) -> Column:
        running = F.col(f"__running_{name}")
        return F.coalesce(F.last(running).over(w.rangeBetween(Window.unboundedPreceding, -days_back)), F.lit(0)) if days_back else running

    return {
        f"__frame_{name}_{n}": upto(name, skipped) - upto(name, skipped + n) for n in sizes for name in needed_sums(stats)
    }


def rolling_from_sums(
    sizes: Sequence[int], stats: Sequence[str] = ("mean", "std"), unit: str = ""
) -> dict[str, Column]:
    """The mean and std columns of ``rolling_columns`` (with ``unit`` d of ``calendar_rolling_columns``)
    from the columns of ``frame_sums``."""
    found = {}
    for size in sizes:
        n, total, squares = (F.col(f"__frame_{name}_{size}") for name in SUMS)
        figures = {"mean": F.when(n > 0, total / n)}
        if "std" in stats:
            # Both products are whole numbers below 10^28, and their difference is exact.
            exact_n, exact_total = n.cast("decimal(9,0)"), total.cast("decimal(18,0)")
            spread = (exact_n * squares.cast("decimal(28,0)")).cast(EXACT) - (exact_total * exact_total).cast(EXACT)
            figures["std"] = F.when(n > 1, F.sqrt(spread.cast("double") / (n * (n - 1))))
        found |= {f"rolling_{stat}_{size}{unit}": figures[stat] for stat in stats}
    return found


def calendar_lag_columns(panel: PanelColumns, lags: Sequence[int]) -> dict[str, Column]:
    """Target exactly ``n`` days earlier; NULL when that day has no row."""
    w = by_day_number(panel)
    return {f"lag_{n}d": F.max(F.col(panel.target).cast("double")).over(w.rangeBetween(-n, -n)) for n in lags}


def calendar_rolling_columns(
    panel: PanelColumns,
    sizes: Sequence[int],
    stats: Sequence[str] = ("mean", "std"),
    include_current: bool = True,
) -> dict[str, Column]:
    """Statistics over the rows of the last ``n`` days, however many those are."""
    last = 0 if include_current else -1
    w = by_day_number(panel)
    return {
        f"rolling_{stat}_{n}d": ROLLING_STATS[stat](F.col(panel.target).cast("double")).over(
            w.rangeBetween(last - n + 1, last)
        )
        for n in sizes
        for stat in stats
    }


# Extremes over long frames

# Frames longer than this have their extremes from blocks; shorter ones walk their rows.
WALKED = 64
EXTREMES = {"min": (F.min, F.least), "max": (F.max, F.greatest)}


def with_block_extremes(
    df: DataFrame, panel: PanelColumns, sizes: Sequence[int], stats: Sequence[str], by_days: bool = False, include_current: bool = True
) -> DataFrame:
    """Adds the ``min`` and ``max`` columns of ``rolling_columns`` (``by_days``: of ``calendar_rolling_columns`` with the current
    day) without walking the frames.

    A series is cut into blocks of N rows (or days). A frame of N covers the end of one block and the beginning of the
    next: its extreme is that of a suffix of the one and a prefix of the other. Both are running extremes, so a row costs
    the same for any N; each N takes two sorts inside the partitions of the series.
    """
    if by_days and not include_current:
        raise ValueError("day frames that end the day before are walked")
    unit = "d" if by_days else ""
    value = F.col(panel.target).cast("double")
    w = by_day_number(panel) if by_days else by_date(panel)
    place = F.unix_date(panel.date) if by_days else F.row_number().over(w) - 1
    out = df.withColumn("__place", place)
    out = out.withColumns({f"__block_{n}": F.floor(F.col("__place") / n) for n in sizes})
    for n in sizes:
        block = Window.partitionBy(*panel.entity, f"__block_{n}")
        up, down = block.orderBy("__place"), block.orderBy(F.col("__place").desc())
        # Rows of one day belong to the same frames.
        running = (lambda o: o.rangeBetween(Window.unboundedPreceding, 0)) if by_days else (lambda o: o.rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumns({f"__prefix_{s}_{n}": EXTREMES[s][0](value).over(running(up)) for s in stats})
        out = out.withColumns({f"__suffix_{s}_{n}": EXTREMES[s][0](value).over(running(down)) for s in stats})
    ordered = Window.partitionBy(*panel.entity).orderBy("__place")
    both = lambda s, a, b: EXTREMES[s][1](a, b)
    if by_days:
        marks = {f"__next_{s}_{n}": F.lead(f"__suffix_{s}_{n}").over(ordered) for s in stats for n in sizes}
        out = out.withColumns(marks | {f"__next_block_{n}": F.lead(f"__block_{n}").over(ordered) for n in sizes})
        found = {}
        for n in sizes:
            # The first row of the frame follows the last one before it; without such a row it is the first of the series.
            before = ordered.rangeBetween(Window.unboundedPreceding, -n)
            start = ordered.rangeBetween(Window.unboundedPreceding, 0)
            some = F.count(F.lit(1)).over(before) > 0
            first_block = F.when(some, F.last(f"__next_block_{n}").over(before)).otherwise(F.first(f"__block_{n}").over(start))
            for s in stats:
                suffix = F.when(some, F.last(f"__next_{s}_{n}").over(before)).otherwise(F.first(f"__suffix_{s}_{n}").over(start))
                earlier = F.when(first_block < F.col(f"__block_{n}"), suffix)
                found[f"rolling_{s}_{n}{unit}"] = both(s, F.col(f"__prefix_{s}_{n}"), earlier)
    else:
        found = {
            f"rolling_{s}_{n}": both(s, F.col(f"__prefix_{s}_{n}"), F.lag(f"__suffix_{s}_{n}", n - 1).over(ordered)) for n in sizes for s in stats
        }
    out = out.withColumns(found)
    if not include_current:
        out = out.withColumns({c: F.lag(c).over(ordered) for c in found})
    return out.select(*df.columns, *found)
