"""Declared schemas, column orders and renames. All of these are fixed values: they
are the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw file columns, in file order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType(), False),
        T.StructField("Store ID", T.StringType(), False),
        T.StructField("Product ID", T.StringType(), False),
        T.StructField("Category", T.StringType(), False),
        T.StructField("Region", T.StringType(), False),
        T.StructField("Inventory Level", T.IntegerType(), False),
        T.StructField("Units Sold", T.IntegerType(), False),
        T.StructField("Units Ordered", T.IntegerType(), False),
        T.StructField("Demand Forecast", T.DoubleType(), False),
        T.StructField("Price", T.DoubleType(), False),
        T.StructField("Discount", T.IntegerType(), False),
        T.StructField("Weather Condition", T.StringType(), False),
        T.StructField("Holiday/Promotion", T.IntegerType(), False),
        T.StructField("Competitor Pricing", T.DoubleType(), False),
        T.StructField("Seasonality", T.StringType(), False),
    ]
)

# Raw name -> cleaned name.
RAW_TO_CLEAN: dict[str, str] = {
    "Date": "date",
    "Store ID": "store_id",
    "Product ID": "product_id",
    "Category": "category",
    "Region": "region",
    "Inventory Level": "inventory_level",
    "Units Sold": "units_sold",
    "Units Ordered": "units_ordered",
    "Demand Forecast": "demand_forecast",
    "Price": "price",
    "Discount": "discount",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "is_holiday_or_promo",
    "Competitor Pricing": "competitor_pricing",
    "Seasonality": "seasonality",
}

# The cleaned table.
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("inventory_level", T.IntegerType(), False),
        T.StructField("units_sold", T.IntegerType(), False),
        T.StructField("units_ordered", T.IntegerType(), False),
        T.StructField("demand_forecast", T.DoubleType(), False),
        T.StructField("is_forecast_anomaly", T.BooleanType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("discount", T.IntegerType(), False),
        T.StructField("weather_condition", T.StringType(), False),
        T.StructField("is_holiday_or_promo", T.BooleanType(), False),
        T.StructField("competitor_pricing", T.DoubleType(), False),
        T.StructField("seasonality", T.StringType(), False),
    ]
)

# Identifying columns carried next to a prediction.
PREDICTION_KEYS: tuple[str, ...] = (
    "date",
    "store_id",
    "product_id",
    "category",
    "region",
    "units_sold",
    "demand_forecast",
)
PREDICTION_COLUMNS: tuple[str, ...] = (*PREDICTION_KEYS, "predicted_units_sold")

# The recommendation table is the entity keys, category and region, then these.
RECOMMENDATION_MEASURES: tuple[str, ...] = (
    "avg_daily_demand",
    "demand_std_dev",
    "current_inventory_level",
    "lead_time_days",
    "order_cycle_days",
    "service_level_z",
    "safety_stock",
    "reorder_point",
    "target_stock_level",
    "recommended_order_qty",
    "days_of_supply",
    "reorder_recommendation",
)
