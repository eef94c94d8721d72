from __future__ import annotations

import datetime
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from shelftide.schemas import CLEAN_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY0 = datetime.date(2020, 1, 6)


def day(n: int) -> datetime.date:
    """Day ``n`` after a Monday."""
    return DAY0 + datetime.timedelta(days=n)


ROW = {
    "date": DAY0,
    "store_id": "S001",
    "product_id": "P0001",
    "category": "Toys",
    "region": "North",
    "inventory_level": 100,
    "units_sold": 10,
    "units_ordered": 50,
    "demand_forecast": 11.0,
    "is_forecast_anomaly": False,
    "price": 50.0,
    "discount": 10,
    "weather_condition": "Sunny",
    "is_holiday_or_promo": False,
    "competitor_pricing": 25.0,
    "seasonality": "Spring",
}


@pytest.fixture
def cleaned(spark):
    """Builds cleaned rows from a default row and the given changes."""

    def build(*changes: dict):
        schema = type(CLEAN_SCHEMA)([type(f)(f.name, f.dataType, True) for f in CLEAN_SCHEMA.fields])
        rows = [tuple({**ROW, **c}[n] for n in schema.names) for c in changes]
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def scored(spark):
    """Builds scored rows: (category, units_sold, demand_forecast, predicted[, store, product, day])."""

    def build(*rows: tuple):
        full = []
        for r in rows:
            category, sold, baseline, predicted, *rest = r
            store, product, n = (*rest, *("S001", "P0001", len(full))[len(rest):])
            full.append((day(n), store, product, category, "North", sold, baseline, predicted))
        return spark.createDataFrame(
            full,
            "date date, store_id string, product_id string, category string, region string, "
            "units_sold int, demand_forecast double, predicted_units_sold double",
        )

    return build
