"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_of(*columns: str) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])


def to_messages(rows: DataFrame, key: Column, topic: str) -> DataFrame:
    """(topic, key, value): value is the whole row as JSON."""
    return rows.select(
        F.lit(topic).alias("topic"),
        key.alias("key"),
        F.to_json(F.struct(*rows.columns)).alias("value"),
    )


def publishable(
    rows: DataFrame, appids: DataFrame | None = None, published: DataFrame | None = None
) -> DataFrame:
    """The named rows; only those of appids, and without those already published."""
    ready = rows.filter(F.col("name").isNotNull())
    if appids is not None:
        ready = ready.join(appids.select("appid"), "appid", "left_semi")
    if published is not None:
        ready = ready.join(published.select("appid"), "appid", "left_anti")
    return ready


def id_batches(rows: DataFrame, column: str, size: int = 100) -> DataFrame:
    """All ids as comma-separated lists of at most `size`, for an interface that takes lists.

    Rows are numbered inside their partition, so no total order is needed.
    """
    numbered = rows.select(column, F.monotonically_increasing_id().alias("n"))
    # The upper bits number the partition, the lower 33 bits the row in it.
    partition = F.shiftright("n", 33).alias("partition")
    batch = F.floor(F.col("n").bitwiseAND(F.lit(2**33 - 1)) / size).alias("batch")
    lists = numbered.groupBy(partition, batch).agg(F.concat_ws(",", F.collect_list(column)).alias("ids"))
    return lists.select("ids")


def write_messages(
    messages: DataFrame, path: str | None = None, bootstrap_servers: str | None = None
) -> None:
    """As JSON lines below path, one folder per topic, or to the broker."""
    if bootstrap_servers is not None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("kafka.compression.type", "snappy")
            .save()
        )
    else:
        messages.write.mode("append").partitionBy("topic").json(path)
