"""Committed prefix: the units before the first failing one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failures(units: DataFrame, keys: Sequence[str], place: str, bad: Column) -> DataFrame:
    """(keys, first_bad): the place of the first bad unit of every key that has one."""
    return units.filter(bad).groupBy(*keys).agg(F.min(place).alias("first_bad"))


def committed_prefix(
    units: DataFrame, keys: Sequence[str], place: str, bad: Column
) -> DataFrame:
    """Units of every key before its first bad unit.

    A minimum that combines before the shuffle and a join, instead of a running window: a key with
    very many units is never gathered in one task. The right side has one row per key; its
    measured size lets AQE broadcast it, and a hot key of a larger one is split by the skew join.
    """
    failures = first_failures(units, keys, place, bad)
    return (
        units.join(failures, list(keys), "left")
        .filter(F.col("first_bad").isNull() | (F.col(place) < F.col("first_bad")))
        .drop("first_bad")
    )
