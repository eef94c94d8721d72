"""Nominal values as numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_of(column: str, values: Sequence[str]) -> Column:
    """Position of the value in ``values``, from 0; NULL for NULL or an unlisted value."""
    domain = F.array(*[F.lit(v) for v in values])
    return (F.nullif(F.array_position(domain, F.col(column)), F.lit(0)) - 1).cast("int")


def indicator_columns(column: str, values: Sequence[str], drop_last: bool = True) -> dict[str, Column]:
    """One 0/1 column per listed value. The last one is implied by the others and dropped
    unless ``drop_last`` is off. A NULL or unlisted value is 0 everywhere."""
    kept = values[:-1] if drop_last else values
    return {
        f"{column}_is_{v.lower().replace(' ', '_')}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int")
        for v in kept
    }
