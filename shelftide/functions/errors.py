"""Forecast error measures, as additive sums and as figures derived from them.

The sums add up, so a report for several groupings needs one pass over the rows: sum by
the finest grouping, then add the few resulting rows. Errors have no fixed scale, so they are added up in limbs
(``exact``): the figures have the same digits for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.functions.exact import limb_sums, limb_totals

SUMS = ("sq", "abs", "pct")
DECIMALS = 4


def error_sums(prefix: str, actual: Column, forecast: Column, valid: Column | None = None) -> dict[str, Column]:
    """Aggregates over the rows where ``valid`` holds (all rows without it)."""
    error = forecast - actual
    if valid is not None:
        error = F.when(valid, error)
    size = F.abs(error)
    known = error.isNotNull()
    return {
        f"{prefix}_rows": F.count(error),
        f"{prefix}_zero": F.count_if(known & (actual == 0)),
        **limb_sums(f"{prefix}_sq", error * error),
        **limb_sums(f"{prefix}_abs", size),
        **limb_sums(f"{prefix}_pct", F.when(actual != 0, size / F.nullif(actual, F.lit(0)))),
    }


def with_totals(sums: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """The limbs put together: ``<prefix>_sq``, ``_abs`` and ``_pct``."""
    return limb_totals(sums, [f"{p}_{s}" for p in prefixes for s in SUMS])


def rmse(prefix: str) -> Column:
    return F.sqrt(F.try_divide(f"{prefix}_sq", f"{prefix}_rows"))


def mae(prefix: str) -> Column:
    return F.try_divide(f"{prefix}_abs", f"{prefix}_rows")


def mape(prefix: str) -> Column:
    """Percent, over the rows whose actual is not 0; NULL if there is none."""
    used = F.col(f"{prefix}_rows") - F.col(f"{prefix}_zero")
    return 100 * F.try_divide(F.col(f"{prefix}_pct"), used)


def improvement(measure: str) -> Column:
    """Baseline minus model, both already rounded: positive means the model is better."""
    return F.col(f"baseline_{measure}") - F.col(f"model_{measure}")
