"""The raw daily sales file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftide.schemas import RAW_SCHEMA

DATE_FORMAT = "yyyy-MM-dd"
CORRUPT = "_corrupt_record"


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Declared schema, header row. A malformed row or a header that differs from the schema
    fails the job that reads it. Spark reads an empty field as NULL whatever the schema
    says: ``checks.quality_report`` finds those."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_sales_csv_quarantined(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines): the same scan, with malformed rows set apart as text. A header
    that differs from the schema fails the job here as well."""
    marked = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", DATE_FORMAT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    # Spark parses only the columns a query uses, and a malformed value goes unnoticed in any
    # other. This test is true for every row and uses all columns.
    parsed = F.length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in schema.names])) >= 0
    rows = marked.filter(F.col(CORRUPT).isNull() & parsed).select(*schema.names)
    malformed = marked.filter(F.col(CORRUPT).isNotNull() & parsed).select(F.col(CORRUPT).alias("line"))
    return rows, malformed
