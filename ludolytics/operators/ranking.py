"""Top-k operators that hold no unbounded group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """The first k rows in the given order; every row if k is None."""
    return df.orderBy(*order) if k is None else df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first k rows with their position.

    The limit comes first, so the unpartitioned window only ever sees k rows.
    """
    limited = df.orderBy(*order).limit(k)
    return limited.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str,
    slices: int = 1,
) -> DataFrame:
    """The first k rows of each group with their position.

    A filter on row_number lets every map task keep k rows of a group at most, so a group
    with a large share of all rows reaches its task as k rows per map task, whatever its
    size. Spark does this up to spark.sql.optimizer.windowGroupLimitThreshold rows.
    With few, large groups and many map tasks even that is much for one task: slices > 1
    ranks the rows of every `slices`-th map task first and then the k * slices survivors.
    It is not the default, as it moves the rows of small groups twice.
    """
    if slices > 1:
        # One slice per map task, not per row: the map side then still keeps k rows of a group.
        sliced = df.withColumn(_SLICE, F.pmod(F.spark_partition_id(), F.lit(slices)))
        df = _first_k(sliced, [*keys, _SLICE], order, k, rank).drop(_SLICE, rank)
    return _first_k(df, keys, order, k, rank)


def _first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
