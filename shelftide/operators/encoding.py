"""Nominal columns and entity ids as integers.

Nominal columns have a configured value list, so their label is a column expression.
Ids have no list: the label of an id is its rank among the distinct ids. That mapping is
built once as an id dimension, which scoring can reuse with a saved model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftide.functions.labels import indicator_columns, label_of
from shelftide.operators.checks import require_columns
from shelftide.params import EncodingParams
from shelftide.sources.shared import shared_folder

# Slack for the relative error of the distinct-count sketch used as a size check.
SKETCH_ERROR = 0.02
SKETCH_SLACK = 1.25


@dataclass(frozen=True)
class IdDimension:
    """``frame`` has one row per id: (``column``, ``output``). ``small`` records that the
    number of ids was checked against the broadcast limit."""

    column: str
    output: str
    frame: DataFrame
    small: bool


def encode_labels(df: DataFrame, params: EncodingParams = EncodingParams()) -> DataFrame:
    require_columns(df, params.label_outputs, "encode")
    return df.withColumns({out: label_of(c, params.labels[c]) for c, out in params.label_outputs.items()})


def one_hot(
    df: DataFrame, domains: Mapping[str, Sequence[str]] = EncodingParams().labels, drop_last: bool = True
) -> DataFrame:
    require_columns(df, domains, "one-hot")
    return df.withColumns(
        {name: c for column, values in domains.items() for name, c in indicator_columns(column, values, drop_last).items()}
    )


def _distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct()


def _rank_in_one_task(ids: DataFrame, column: str, output: str) -> DataFrame:
    """For a checked small number of ids: one sorted array, exploded with positions."""
    listed = ids.agg(F.sort_array(F.collect_list(column)).alias("ids"))
    return listed.select(F.posexplode("ids").alias(output, column)).select(column, output)


def _rank_by_ranges(ids: DataFrame, column: str, output: str, ranges: int) -> DataFrame:
    """For any number of ids: cut the sorted ids into ranges, rank inside each range, and
    add the number of ids in the ranges before.

    Only the lower ends of the ranges (at most ``ranges`` strings) come to the driver. They
    go back into the plan as literals, so a recomputed task gives the same ranks.
    """
    lower_ends = [
        r["low"]
        for r in ids.repartitionByRange(ranges, column)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(column).alias("low"))
        .orderBy("low")
        .collect()
    ]
    if not lower_ends:
        return ids.withColumn(output, F.lit(0))
    # The first range is open at its lower end, so no literal is needed for it.
    cuts = F.array(*[F.lit(low) for low in lower_ends[1:]]).cast(T.ArrayType(ids.schema[column].dataType))
    placed = ids.withColumn("id_range", F.size(F.filter(cuts, lambda low: low <= F.col(column))))
    before = Window.orderBy("id_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("id_range")
        .agg(F.count(F.lit(1)).alias("ids_in_range"))
        # One row per range.
        .select("id_range", F.coalesce(F.sum("ids_in_range").over(before), F.lit(0)).alias("ids_before"))
    )
    within = Window.partitionBy("id_range").orderBy(column)
    return (
        placed.withColumn("position", F.row_number().over(within))
        .join(F.broadcast(offsets), "id_range")
        .select(column, (F.col("ids_before") + F.col("position") - 1).cast("int").alias(output))
    )


def id_dimensions(
    df: DataFrame, params: EncodingParams = EncodingParams(), ranges: int = 200
) -> dict[str, IdDimension]:
    """The id dimension of each id column.

    The distinct id combinations are found in one pass over the rows and checkpointed in
    the shared folder; everything else reads those. How many ids there are selects the way
    to rank and to join them; the ranks do not depend on it.
    """
    columns = list(params.id_outputs)
    require_columns(df, columns, "encode ids")
    shared_folder(df.sparkSession)
    entities = df.select(*columns).distinct().checkpoint()
    sizes = entities.agg(*[F.approx_count_distinct(c, SKETCH_ERROR).alias(c) for c in columns]).first()
    found = {}
    for column, output in params.id_outputs.items():
        small = sizes[column] * SKETCH_SLACK <= params.broadcast_ids
        ids = _distinct_ids(entities, column)
        frame = _rank_in_one_task(ids, column, output) if small else _rank_by_ranges(ids, column, output, ranges)
        found[column] = IdDimension(column, output, frame, small)
    return found


def encode_ids(df: DataFrame, dimensions: Mapping[str, IdDimension]) -> DataFrame:
    """Adds the labels; every row stays, an unseen or NULL id has a NULL label and leaves the
    label of the other id alone.

    Small dimensions are broadcast. For the others the labels are first joined to the
    distinct id combinations (those with NULLs too), and those to the rows on the whole entity key,
    null-safely: no single hot id decides the size of a task, and the labels do not depend on the way.
    """
    original = df.columns
    large = [d for d in dimensions.values() if not d.small]
    if large:
        keys = list(dimensions)
        known = {k: f"__key_{k}" for k in keys}
        entities = df.select(*keys).distinct()
        for d in large:
            entities = entities.join(d.frame, d.column, "left")
        entities = entities.withColumnsRenamed(known)
        same = [F.col(k).eqNullSafe(F.col(alias)) for k, alias in known.items()]
        df = df.join(entities, same, "left").drop(*known.values())
    for d in dimensions.values():
        if d.small:
            df = df.join(F.broadcast(d.frame), d.column, "left")
    return df.select(*original, *[d.output for d in dimensions.values()])


def encode(
    df: DataFrame,
    params: EncodingParams = EncodingParams(),
    dimensions: Mapping[str, IdDimension] | None = None,
) -> DataFrame:
    """Adds one label column per nominal and id column; the originals stay. Without
    ``dimensions`` they are built here, which runs two jobs at once."""
    known = id_dimensions(df, params) if dimensions is None else dimensions
    return encode_ids(encode_labels(df, params), known)
