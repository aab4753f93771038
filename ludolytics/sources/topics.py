"""Topics as streams or bounded drains: from the broker, or from landed JSON lines.

Both give key, value and timestamp, so the pipelines do not know the difference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Broker:
    """Messages of a broker. Needs the Kafka connector on the class path."""

    bootstrap_servers: str
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 1000
    fail_on_data_loss: bool = True

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", self.starting_offsets)
            .option("maxOffsetsPerTrigger", self.max_offsets_per_trigger)
            .option("failOnDataLoss", str(self.fail_on_data_loss).lower())
            .load()
            .select("key", "value", "timestamp")
        )


@dataclass(frozen=True)
class LandedFiles:
    """JSON lines {"key": ..., "value": ...} below path/topic=<topic>."""

    path: str
    max_files_per_trigger: int = 1000

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        lines = (
            spark.readStream.schema("key string, value string")
            .option("maxFilesPerTrigger", self.max_files_per_trigger)
            .json(f"{self.path.rstrip('/')}/topic={topic}")
        )
        return lines.select(
            F.col("key").cast("binary"),
            F.col("value").cast("binary"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )


def landed_documents(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Landed documents as JSON lines: the given columns, one of them the document text."""
    return spark.read.schema(columns).json(path)
