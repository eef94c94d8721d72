"""A daily store x product sales panel from the order-line star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.params import LABEL_VALUES, EncodingParams
from shelftide.schemas import RAW_TO_CLEAN

PRODUCTS = 20
CATEGORIES = LABEL_VALUES["category"]
WEATHER = LABEL_VALUES["weather_condition"]

# The region names of the star schema take the place of the default ones.
STAR_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STAR_ENCODING = EncodingParams(labels={**LABEL_VALUES, "region": STAR_REGIONS})


# The columns used of each table. Declared, so no job infers them.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _code(letter: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(letter), F.lpad(number.cast("string"), width, "0"))


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def _with_store(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the region key of their supplier. The tables are joined one after
    the other, so the size of each plain table decides its join: the nation table is small
    by nature, the supplier table grows with the data."""
    return lines.join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with the grain columns of a panel (store, part as product,
    date). Not unique on that grain."""
    return _with_store(table(spark, folder, "lineitem"), spark, folder).select(
        F.col("l_shipdate").cast("date").alias("date"),
        _code("S", F.col("n_regionkey") + 1, 3).alias("store_id"),
        _code("P", F.col("l_partkey"), 12).alias("product_id"),
        F.col("l_quantity").cast("int").alias("units_ordered"),
    )


def retail_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Panel with the cleaned column names, except that the holiday flag is still 0/1.

    Order lines are added up per group before the shuffle of the aggregate, on number keys
    only; whatever follows from the keys (names, codes, category) is added afterwards. Skewed
    supplier or part keys are left to adaptive skew handling, which applies to both joins.
    """
    quantity = F.col("l_quantity")
    grouped = (
        _with_store(table(spark, folder, "lineitem"), spark, folder)
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("l_shipdate").cast("date").alias("date"),
            "n_regionkey",
            (F.col("l_partkey") % PRODUCTS).cast("int").alias("product"),
        )
        .agg(
            F.sum("l_orderkey").alias("order_keys"),
            F.sum(F.when(F.col("l_returnflag") == "R", 0.0).otherwise(quantity)).alias("sold"),
            F.sum(quantity).alias("ordered"),
            F.sum(quantity * (1 + F.col("l_tax") - F.col("l_discount"))).alias("planned"),
            F.min(F.col("l_extendedprice") / quantity).alias("unit_price"),
            F.max("l_discount").alias("top_discount"),
            F.min("l_linenumber").alias("first_line"),
            F.max("p_retailprice").alias("top_retail"),
        )
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    month = F.month("date")
    return grouped.select(
        "date",
        _code("S", F.col("n_regionkey") + 1, 3).alias("store_id"),
        _code("P", F.col("product") + 1, 4).alias("product_id"),
        # The number of products is a multiple of the number of categories, so the category
        # of a part follows from its product number.
        _pick(CATEGORIES, F.col("product") % len(CATEGORIES)).alias("category"),
        F.col("r_name").alias("region"),
        (50 + F.col("order_keys") % 451).cast("int").alias("inventory_level"),
        F.col("sold").cast("int").alias("units_sold"),
        F.col("ordered").cast("int").alias("units_ordered"),
        F.round(F.col("planned") - 3.0, 2).alias("demand_forecast"),
        (F.col("unit_price") / 100).alias("price"),
        F.round(F.col("top_discount") * 100).cast("int").alias("discount"),
        _pick(WEATHER, (F.dayofmonth("date") + F.col("n_regionkey")) % len(WEATHER)).alias("weather_condition"),
        (F.col("top_discount") >= 0.09).cast("int").alias("is_holiday_or_promo"),
        F.when(F.col("first_line") == 7, 0.0).otherwise(F.col("top_retail") / 30).alias("competitor_pricing"),
        F.when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Autumn")
        .otherwise("Winter")
        .alias("seasonality"),
    )


def many_series_panel(spark: SparkSession, folder: str) -> DataFrame:
    """A panel with every part as a product, so that the number of series grows with the
    tables: one row per day, store and part, with the columns that series, demand and stock need."""
    quantity = F.col("l_quantity")
    lines = _with_store(table(spark, folder, "lineitem"), spark, folder)
    grouped = lines.groupBy(F.col("l_shipdate").cast("date").alias("date"), "n_regionkey", "l_partkey").agg(
        F.sum("l_orderkey").alias("order_keys"),
        F.sum(F.when(F.col("l_returnflag") == "R", 0.0).otherwise(quantity)).alias("sold"),
        F.sum(quantity * (1 + F.col("l_tax") - F.col("l_discount"))).alias("planned"),
    )
    named = grouped.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(
        "date",
        _code("S", F.col("n_regionkey") + 1, 3).alias("store_id"),
        _code("P", F.col("l_partkey"), 12).alias("product_id"),
        _pick(CATEGORIES, F.col("l_partkey") % len(CATEGORIES)).alias("category"),
        F.col("r_name").alias("region"),
        (50 + F.col("order_keys") % 451).cast("int").alias("inventory_level"),
        F.col("sold").cast("int").alias("units_sold"),
        F.round(F.col("planned") - 3.0, 2).alias("demand_forecast"),
    )


def raw_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The panel under the column names of the raw file."""
    return retail_panel(spark, folder).withColumnsRenamed({v: k for k, v in RAW_TO_CLEAN.items()})
