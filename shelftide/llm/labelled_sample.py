"""Bounded samples of labelled rows, for models that are fitted in the driver.

Which rows are taken depends on a hash of their id only, so it is the same for any
partitioning. Labels of the held-out quarter (CRC-32 of the id as text, modulo 4, is 2) are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_OUT = 2


def held_out(id_column: Column) -> Column:
    """False for rows without an id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def sample_ids(rows: DataFrame, id_col: str, size: int, kept: list[str] = []) -> DataFrame:  # noqa: B006
    """``size`` rows at most, those with the smallest hash of the id; one row per id. Of values that contradict each
    other under one id the largest counts, in whatever order the rows come."""
    once = rows.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.max(c).alias(c) for c in kept], F.count(F.lit(1)).alias("_n")).drop("_n")
    return once.orderBy(F.xxhash64(id_col), id_col).limit(size)


def with_texts(sample: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sampled rows with the bytes of their documents. The sample is bounded by its size, so
    it is what is broadcast; only sampled texts are shuffled, to keep one of each id (of several texts the one with
    the smallest hash), so the result has as many rows as the sample at most."""
    texts = docs.select(F.col(id_col).cast("long").alias("sample_id"), F.col(text_col).cast("binary").alias("data"))
    named = sample.withColumnRenamed(id_col, "sample_id").withColumn("sample_id", F.col("sample_id").cast("long"))
    joined = texts.join(F.broadcast(named), "sample_id")
    return joined.groupBy(*named.columns).agg(F.min_by("data", F.struct(F.xxhash64("data"), "data")).alias("data"))
