"""Writing results and staging intermediate tables. A path is a folder of part files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelftide.params import OutputParams, PanelColumns
from shelftide.sources.sales_csv import DATE_FORMAT


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("dateFormat", DATE_FORMAT).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_text(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").text(path)
    return path


def write_result(
    df: DataFrame,
    folder: str,
    name: str,
    parquet: bool = True,
    csv: bool = True,
    order_by: Sequence[str] = (),
) -> dict[str, str]:
    """Writes the wanted formats and returns format -> path. With both, the CSV is written
    from the Parquet files, so the frame is computed once and nothing is cached. With
    ``order_by`` the rows are in that order across the part files of either format."""
    if not (parquet or csv):
        raise ValueError("no output format is enabled")

    def arranged(frame: DataFrame) -> DataFrame:
        return frame.orderBy(*order_by) if order_by else frame

    written = {}
    if parquet:
        written["parquet"] = write_parquet(arranged(df), f"{folder}/{name}.parquet")
        df = df.sparkSession.read.schema(df.schema).parquet(written["parquet"])
    if csv:
        written["csv"] = write_csv(arranged(df), f"{folder}/{name}.csv")
    return written


def write_forecast(df: DataFrame, folder: str, output: OutputParams = OutputParams()) -> dict[str, str]:
    return write_result(df, folder, output.forecast_name, output.write_parquet, output.write_csv)


def write_inventory(
    df: DataFrame, folder: str, output: OutputParams = OutputParams(), panel: PanelColumns = PanelColumns()
) -> dict[str, str]:
    return write_result(df, folder, output.inventory_name, output.write_parquet, output.write_csv, panel.entity)


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes a table and returns it as read back: later steps prune its columns, and a lost
    executor costs no recomputation.

    Partition folders get a rebalance first, which writes few files per folder and splits a
    folder that holds much of the data over several tasks.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_staged(df.sparkSession, path, df)


def read_staged(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The declared schema keeps the type of partition columns and the column order."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def stage_by_entity(df: DataFrame, table: str, path: str, panel: PanelColumns = PanelColumns(), buckets: int = 200) -> DataFrame:
    """Rows as a table bucketed by entity, a file for each bucket, sorted by entity and date. Windows, aggregates and
    joins by entity over it need no shuffle. ``table`` is a name in the session's catalog, the files are in ``path``.

    A bucket holds about the rows of 1/``buckets`` of the entities; choose it so that one fits a task."""
    ordered = [*panel.entity, panel.date]
    placed = df.repartition(buckets, *panel.entity).sortWithinPartitions(*ordered)
    writer = placed.write.mode("overwrite").bucketBy(buckets, *panel.entity).sortBy(*ordered)
    writer.format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
