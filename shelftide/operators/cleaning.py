"""From the raw columns to the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.operators.checks import require_columns
from shelftide.schemas import CLEAN_SCHEMA, RAW_TO_CLEAN


def rename_raw(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(RAW_TO_CLEAN)


def clean(raw: DataFrame) -> DataFrame:
    """Renamed columns, a boolean holiday flag, and a flag for negative shipped forecasts
    (NULL for an absent one), in the order of ``CLEAN_SCHEMA``. No row is dropped."""
    require_columns(raw, RAW_TO_CLEAN, "clean")
    return (
        rename_raw(raw)
        .withColumns(
            {
                "is_holiday_or_promo": F.col("is_holiday_or_promo").cast("boolean"),
                "is_forecast_anomaly": F.col("demand_forecast") < 0,
            }
        )
        .select(*CLEAN_SCHEMA.names)
    )


def drop_negative(df: DataFrame, column: str = "units_sold") -> DataFrame:
    """Rows whose value is 0 or more. A NULL is not negative and stays."""
    return df.filter(F.coalesce(F.col(column) >= 0, F.lit(True)))


def anomaly_count(cleaned: DataFrame) -> DataFrame:
    """One row: all rows, and rows flagged for a negative shipped forecast."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_forecast_anomaly").alias("anomaly_rows"),
    )
