"""Chronological train/holdout split.

The cutoff enters a plan as a scalar subquery, so a split frame stays lazy: no value is
fetched to the driver and no frame is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.params import PanelColumns, SplitParams


def cutoff_date(
    df: DataFrame, params: SplitParams = SplitParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """One row: the latest date and the last training date under ``params.rule``.

    Both rules work on the number of rows per date, which is all that is shuffled.
    """
    return _cutoff_of_dates(_rows_per_date(df, panel), params, panel)


def _rows_per_date(df: DataFrame, panel: PanelColumns) -> DataFrame:
    return df.filter(F.col(panel.date).isNotNull()).groupBy(panel.date).agg(F.count(F.lit(1)).alias("row_count"))


def _cutoff_of_dates(per_date: DataFrame, params: SplitParams, panel: PanelColumns) -> DataFrame:
    last = F.max(panel.date)
    if params.rule == "days":
        cutoff = F.date_sub(last, params.holdout_days)
    else:
        day = F.percentile(F.unix_date(panel.date), params.train_share, F.col("row_count"))
        cutoff = F.date_from_unix_date(F.floor(day).cast("int"))
    return per_date.agg(last.alias("last_date"), cutoff.alias("cutoff_date"))


def _last_training_day(cutoff: DataFrame) -> Column:
    return cutoff.select("cutoff_date").scalar()


def with_holdout(
    df: DataFrame, params: SplitParams = SplitParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """Adds ``is_holdout``: after the cutoff. NULL for a NULL date, which is in neither part."""
    return df.withColumn("is_holdout", F.col(panel.date) > _last_training_day(cutoff_date(df, params, panel)))


def time_split(
    df: DataFrame, params: SplitParams = SplitParams(), panel: PanelColumns = PanelColumns()
) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): dates up to the cutoff, dates after it."""
    last_train = _last_training_day(cutoff_date(df, params, panel))
    date = F.col(panel.date)
    return df.filter(date <= last_train), df.filter(date > last_train)


def split_counts(
    df: DataFrame, params: SplitParams = SplitParams(), panel: PanelColumns = PanelColumns()
) -> DataFrame:
    """One row: cutoff and rows on each side of it. Rows are counted per date in one pass
    over the data; the cutoff applies to the dates."""
    per_date = _rows_per_date(df, panel)
    last_train = _last_training_day(_cutoff_of_dates(per_date, params, panel))
    date = F.col(panel.date)
    return per_date.agg(
        F.max(last_train).alias("cutoff_date"),
        F.coalesce(F.sum(F.when(date <= last_train, F.col("row_count"))), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(date > last_train, F.col("row_count"))), F.lit(0)).alias("holdout_rows"),
    )
