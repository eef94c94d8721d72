"""Feature columns of a sales panel. Every step only appends columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from shelftide.functions import series
from shelftide.functions.dates import calendar_columns
from shelftide.functions.prices import price_columns
from shelftide.operators.checks import require_columns
from shelftide.operators.encoding import IdDimension, encode, id_dimensions
from shelftide.params import EncodingParams, FeatureParams, PanelColumns


def _require_series(df: DataFrame, panel: PanelColumns, step: str) -> None:
    require_columns(df, [*panel.grain, panel.target], step)


def _whole_number(df: DataFrame, column: str) -> bool:
    """Integers of up to 32 bits, whose sums and squares are added exactly."""
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType))


def _with_rolling(
    df: DataFrame, params: FeatureParams, panel: PanelColumns, stats: Sequence[str], others: Mapping[str, Column]
) -> DataFrame:
    """Adds ``others`` and the rolling columns over one shuffle and one sort.

    Mean and std of whole numbers come from exact running sums, for any value of 32 bits.
    Everything else aggregates the rows of each frame.
    """
    sizes, last_row = params.rolling, params.include_current
    if params.running_sums and {*stats} <= {"mean", "std"} and _whole_number(df, panel.target):
        return (
            df.withColumns(series.running_sums(panel, stats))
            .withColumns({**others, **series.frame_sums(panel, sizes, last_row, stats)})
            .withColumns(series.rolling_from_sums(sizes, stats))
            .select(*df.columns, *others, *[f"rolling_{stat}_{n}" for n in sizes for stat in stats])
        )
    return df.withColumns({**others, **series.rolling_columns(panel, sizes, stats, last_row)})


def add_lags(
    df: DataFrame, params: FeatureParams = FeatureParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """``lag_N``: target N rows earlier in the series."""
    _require_series(df, panel, "lag features")
    return df.withColumns(series.lag_columns(panel, params.lags))


def add_rolling(
    df: DataFrame,
    params: FeatureParams = FeatureParams(),
    panel: PanelColumns = PanelColumns(),
    stats: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """``rolling_STAT_N`` over N rows. By default the row's own target is in its frame; for
    features known before the day use ``FeatureParams(include_current=False)``."""
    _require_series(df, panel, "rolling features")
    extremes = [s for s in stats if s in series.EXTREMES]
    long = [n for n in params.rolling if n > series.WALKED]
    if not (extremes and long):
        return _with_rolling(df, params, panel, stats, {})
    out = series.with_block_extremes(df, panel, long, extremes, include_current=params.include_current)
    short = replace(params, rolling=tuple(n for n in params.rolling if n not in long))
    out = _with_rolling(out, short, panel, extremes, {}) if short.rolling else out
    others = [s for s in stats if s not in extremes]
    out = _with_rolling(out, params, panel, others, {}) if others else out
    return out.select(*df.columns, *[f"rolling_{stat}_{n}" for n in params.rolling for stat in stats])


def add_calendar_lags(
    df: DataFrame, params: FeatureParams = FeatureParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """``lag_Nd``: target N days earlier, for series with missing days."""
    _require_series(df, panel, "calendar lags")
    return df.withColumns(series.calendar_lag_columns(panel, params.lags))


def add_calendar_rolling(
    df: DataFrame,
    params: FeatureParams = FeatureParams(),
    panel: PanelColumns = PanelColumns(),
    stats: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """``rolling_STAT_Nd`` over N days, for series with missing days. Mean and std of whole numbers
    come from running sums here too, and extremes of long frames from blocks."""
    _require_series(df, panel, "calendar rolling features")
    sizes, last = params.rolling, params.include_current
    extremes = [s for s in stats if s in series.EXTREMES]
    long = [n for n in sizes if n > series.WALKED]
    if extremes and long and last:
        out = series.with_block_extremes(df, panel, long, extremes, by_days=True)
        short = replace(params, rolling=tuple(n for n in sizes if n not in long))
        out = add_calendar_rolling(out, short, panel, extremes) if short.rolling else out
        others = [s for s in stats if s not in extremes]
        out = add_calendar_rolling(out, params, panel, others) if others else out
        return out.select(*df.columns, *[f"rolling_{stat}_{n}d" for n in sizes for stat in stats])
    summed = [s for s in stats if s in ("mean", "std")]
    if not (params.running_sums and summed and _whole_number(df, panel.target)):
        return df.withColumns(series.calendar_rolling_columns(panel, sizes, stats, last))
    framed = [s for s in stats if s not in summed]
    return (
        df.withColumns(series.calendar_running_sums(panel, summed))
        .withColumns({**series.calendar_rolling_columns(panel, sizes, framed, last), **series.calendar_frame_sums(panel, sizes, last, summed)})
        .withColumns(series.rolling_from_sums(sizes, summed, "d"))
        .select(*df.columns, *[f"rolling_{stat}_{n}d" for n in sizes for stat in stats])
    )


def add_calendar(df: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    require_columns(df, [panel.date], "calendar features")
    return df.withColumns(calendar_columns(panel.date))


def add_prices(df: DataFrame) -> DataFrame:
    require_columns(df, ["price", "discount", "competitor_pricing"], "price features")
    return df.withColumns(price_columns())


def add_series_features(
    df: DataFrame, params: FeatureParams = FeatureParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """Lags and rolling statistics together: one shuffle by entity, one sort by date."""
    _require_series(df, panel, "series features")
    return _with_rolling(df, params, panel, ("mean", "std"), series.lag_columns(panel, params.lags))


def build_features(
    encoded: DataFrame, params: FeatureParams = FeatureParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """All feature groups on a frame that has its labels already."""
    df = add_series_features(encoded, params, panel)
    if params.calendar:
        df = add_calendar(df, panel)
    if params.price:
        df = add_prices(df)
    return df


def feature_table(
    cleaned: DataFrame,
    encoding: EncodingParams = EncodingParams(),
    params: FeatureParams = FeatureParams(),
    panel: PanelColumns = PanelColumns(),
    dimensions: Mapping[str, IdDimension] | None = None,
) -> DataFrame:
    """Labels and all feature groups, with the columns of ``build_features(encode(...))``.

    The windows come first here: labels are cheap to add and would only widen the rows
    that the window shuffle moves. Id labels join afterwards on the partitioning that the
    windows leave behind.
    """
    known = id_dimensions(cleaned, encoding) if dimensions is None else dimensions
    labels = [*encoding.label_outputs.values(), *encoding.id_outputs.values()]
    featured = build_features(cleaned, params, panel)
    added = featured.columns[len(cleaned.columns) :]
    return encode(featured, encoding, known).select(*cleaned.columns, *labels, *added)
