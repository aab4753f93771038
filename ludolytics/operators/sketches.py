"""Distinct counts from stored sketches, beside the exact ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an estimate; small counts are exact or nearly so."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def sketches(rows: DataFrame, by: Sequence[str | Column], column: str, lg_k: int = LG_K) -> DataFrame:
    """(by..., sketch): a sketch of the distinct values of each group, such as a tag and day.

    Kept as rows of a table; a day that comes again replaces its own. Nulls do not count. A group has at most
    2^lg_k bytes, whatever its rows.
    """
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(lg_k)).alias("sketch"))


def distinct_counts(stored: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """(by..., n_distinct): the estimate over all stored sketches of each group, so over any range of days."""
    merged = stored.groupBy(*by).agg(F.hll_union_agg("sketch").alias("merged"))
    return merged.select(
        *merged.columns[:-1], F.hll_sketch_estimate("merged").alias("n_distinct")
    )
