"""Data checks. Reports are DataFrames; the ``require_*`` functions raise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftide.params import LABEL_VALUES, VALUE_RANGES, PanelColumns
from shelftide.schemas import CLEAN_SCHEMA


class SchemaValidationError(ValueError):
    """A frame does not have the columns, types or values its contract promises."""


class DuplicateGrainError(ValueError):
    """More than one row where the contract promises one."""


def require_columns(df: DataFrame, names: Iterable[str], step: str) -> None:
    """Looks at the schema only; starts no job."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"{step}: missing required column(s): {absent}")


def require_schema(df: DataFrame, schema: T.StructType = CLEAN_SCHEMA, step: str = "schema check") -> None:
    """Every declared column present with its declared type. Starts no job."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in actual:
            problems.append(f"{f.name}: absent")
        elif actual[f.name] != f.dataType:
            problems.append(f"{f.name}: {actual[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if problems:
        raise SchemaValidationError(f"{step}: " + "; ".join(problems))


def load_audit(df: DataFrame) -> DataFrame:
    """One row: row count, column count and column names in order."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )


def quality_report(
    df: DataFrame,
    schema: T.StructType = CLEAN_SCHEMA,
    ranges: Mapping[str, tuple[float, float]] = VALUE_RANGES,
) -> DataFrame:
    """NULLs per column declared non-null and values outside the accepted range, counted in
    one pass: (column_name, check_name, violations, total_rows), one row per check."""
    tests = _tests(schema, ranges)
    require_columns(df, [c for c, _, _ in tests], "quality report")
    return _report(df.agg(*_counts(tests)), tests)


def _tests(schema: T.StructType, ranges: Mapping[str, tuple[float, float]]) -> list[tuple[str, str, Column]]:
    tests = [(f.name, "not_null", F.col(f.name).isNull()) for f in schema.fields if not f.nullable]
    return tests + [(c, "in_range", ~F.col(c).between(low, high)) for c, (low, high) in ranges.items()]


def _counts(tests: Sequence[tuple[str, str, Column]]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"), *[F.count_if(broken).alias(f"test_{i}") for i, (_, _, broken) in enumerate(tests)]]


def _report(counted: DataFrame, tests: Sequence[tuple[str, str, Column]]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            F.col(f"test_{i}").alias("violations"),
            F.col("total_rows").alias("total_rows"),
        )
        for i, (column, check, _) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class ObservedRows:
    """What was counted while rows were written: the load audit, the anomaly count and the quality report without a pass of
    their own. Read them only after the write.

    The counts belong to the tasks that write. A task that is tried again, or run twice, counts once, since only the
    first success of each task is taken; for that no shuffle may come between the observed rows and the write.
    """

    observation: Observation
    columns: tuple[str, ...]
    tests: tuple[tuple[str, str, Column], ...]
    spark: SparkSession

    def _row(self) -> DataFrame:
        found = {k: int(v) for k, v in self.observation.get.items()}
        return self.spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} long" for c in found))

    def load_audit(self) -> DataFrame:
        names = F.lit(",".join(self.columns)).alias("column_names")
        return self._row().select("total_rows", F.lit(len(self.columns)).alias("column_count"), names)

    def anomaly_count(self) -> DataFrame:
        return self._row().select("total_rows", "anomaly_rows")

    def quality_report(self) -> DataFrame:
        return _report(self._row(), self.tests)


def observe_rows(
    cleaned: DataFrame, schema: T.StructType = CLEAN_SCHEMA, ranges: Mapping[str, tuple[float, float]] = VALUE_RANGES
) -> tuple[DataFrame, ObservedRows]:
    """The rows to be written, and the counts that their write will have taken."""
    tests = _tests(schema, ranges)
    require_columns(cleaned, ["is_forecast_anomaly", *[c for c, _, _ in tests]], "observed rows")
    observation = Observation()
    watched = cleaned.observe(observation, *_counts(tests), F.count_if("is_forecast_anomaly").alias("anomaly_rows"))
    return watched, ObservedRows(observation, tuple(cleaned.columns), tuple(tests), cleaned.sparkSession)


def require_quality(report: DataFrame) -> None:
    """Raises with the failed checks. The report has one row per check, so it is small."""
    failed = report.filter("violations > 0").collect()
    if failed:
        text = "; ".join(f"{r.column_name} {r.check_name}: {r.violations} of {r.total_rows}" for r in failed)
        raise SchemaValidationError(f"quality check failed: {text}")


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]] = LABEL_VALUES) -> DataFrame:
    """Values outside the configured list: (column_name, value, violations)."""
    require_columns(df, domains, "domain check")
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("value"),
                (~F.col(c).isin(list(values))).alias("broken"),
            )
            for c, values in domains.items()
        ]
    )
    return (
        df.select(F.inline(F.filter(cells, lambda cell: F.coalesce(cell["broken"], F.lit(False)))))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def duplicate_grain(df: DataFrame, keys: Sequence[str] = PanelColumns().grain) -> DataFrame:
    """Key values held by more than one row, with the number of rows. Copies are counted
    before the shuffle, so many copies of one key cost nothing extra."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def require_unique_grain(df: DataFrame, keys: Sequence[str] = PanelColumns().grain) -> None:
    example = duplicate_grain(df, keys).take(1)
    if example:
        raise DuplicateGrainError(f"more than one row per ({', '.join(keys)}), for example {example[0].asDict()}")


def latest_ties(df: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """Entities with more than one row on their latest date, which leaves their current
    stock undefined. Only the latest rows are counted: the latest date per entity is one
    small row each."""
    latest = df.groupBy(*panel.entity).agg(F.max(panel.date).alias(panel.date))
    return duplicate_grain(df.join(latest, [*panel.entity, panel.date], "left_semi"), panel.entity)


def unmatched_entities(demand: DataFrame, stock: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """Entities that have demand but no stock record, one row each."""
    keys = list(panel.entity)
    known = demand.select(*keys).dropna().distinct()
    return known.join(stock.select(*keys).distinct(), keys, "left_anti")
