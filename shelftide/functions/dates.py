"""Calendar parts of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: str = "date") -> dict[str, Column]:
    """Six calendar columns. Weeks are ISO weeks; Monday is day 0."""
    weekday = F.weekday(date)
    return {
        "day_of_week": weekday,
        "month": F.month(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "day_of_month": F.dayofmonth(date),
        "is_weekend": weekday >= 5,
    }
