"""The live count view kept by a stream: totals of each game and hour that merge.

A stream of samples drops repeats and keeps a total per game and hour in its state, in update mode: a
trigger hands on the hours that changed, and these replace their rows in the table of hours (the
totals are absolute, so a repeated epoch changes nothing). Averages, peaks and latest counts of any
moment are composed of the hours; only the hour in which the 24-hour window begins is read from the samples.

The watermark bounds the state. A sample that comes later than the delay changes no hour by itself;
it is in the table of samples all the same, and `rebuild_days` makes the hours of its day anew from there.
A stream with a new checkpoint must start from the earliest sample, as its totals begin at none.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ludolytics.functions import ntz
from ludolytics.plans import ingest, views
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import append, read_dates, read_table

HOURS = S.Table(
    "PLAYER_COUNTS_BY_HOUR",
    S.struct(
        appid=S.INT,
        hour=S.TIME,
        total=S.LONG,
        counted=S.LONG,
        samples=S.LONG,
        peak=S.INT,
        game_name=S.TEXT,
        live_player_count=S.INT,
        fetched_at=S.TIME,
    ),
    ("appid", "hour"),
)

# How late a sample may come, and seconds between triggers.
DELAY = "2 hours"
TRIGGER = "300 seconds"


def totals(samples: DataFrame) -> DataFrame:
    """The rows of HOURS of some samples; totals of parts of an hour merge by sums, maxima and the latest."""
    count = F.col("live_player_count")
    by_hour = samples.groupBy("appid", F.window("fetched_at", "1 hour").alias("w")).agg(
        F.sum(count.cast("long")).alias("total"),
        F.count(count).alias("counted"),
        F.count(F.lit(1)).alias("samples"),
        F.max(count).alias("peak"),
        F.max_by(
            F.struct("game_name", "live_player_count", "fetched_at"),
            F.struct("fetched_at", "live_player_count", "game_name"),
        ).alias("latest"),
    )
    return by_hour.select(
        "appid",
        F.col("w.start").cast("timestamp_ntz").alias("hour"),
        "total",
        "counted",
        "samples",
        "peak",
        "latest.game_name",
        "latest.live_player_count",
        F.col("latest.fetched_at").cast("timestamp_ntz").alias("fetched_at"),
    )


def replace_hours(spark: SparkSession, changed: DataFrame, root: str) -> None:
    """Puts the rows of the changed hours in the place of the stored ones; only their days are written."""
    days = changed.agg(F.min("hour"), F.max("hour")).first()
    if days[0] is None:
        return
    stored = read_dates(spark, HOURS, root, days[0].date(), days[1].date())
    touched = changed.select(F.to_date("hour").alias("_touched")).distinct()
    of_days = stored.join(touched, F.to_date("hour") == F.col("_touched"), "left_semi")
    kept = of_days.join(changed.select(*HOURS.keys), list(HOURS.keys), "left_anti")
    merged = kept.select(*HOURS.schema.names).unionByName(changed.select(*HOURS.schema.names))
    append(merged, HOURS, root, date_of="hour", replace=True)


def hours_writer(spark: SparkSession, root: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for the hours that a trigger changed.

    They are written down first: a trigger's totals are computed once, with its state, and read several times.
    """
    path = f"{root.rstrip('/')}/{HOURS.name}_CHANGED"

    def write(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(path)
        replace_hours(spark, spark.read.schema(HOURS.schema).parquet(path), root)

    return write


def start_hours(
    spark: SparkSession,
    samples: DataFrame,
    root: str,
    delay: str = DELAY,
    once: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Keeps HOURS up to date from a stream of samples (record_id, appid, game_name, live_player_count, fetched_at)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    at = F.col("fetched_at").cast("timestamp")  # a watermark needs a time with a zone; sessions run in UTC
    kept = samples.withColumn("fetched_at", at).withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["record_id"])
    writer = (
        totals(kept)
        .writeStream.outputMode("update")
        .queryName("hours")
        .option("checkpointLocation", f"{root}/checkpoints/hours")
        .foreachBatch(hours_writer(spark, root))
    )
    timed = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return timed.start()


def start_document_hours(
    spark: SparkSession, documents: DataFrame, names: DataFrame, root: str, **options
) -> StreamingQuery:
    """The same from a stream of live count documents (appid, value, fetched_at)."""
    return start_hours(spark, ingest.sample_documents(documents, names), root, **options)


def rebuild_days(spark: SparkSession, root: str, low: date | str, high: date | str) -> None:
    """Makes the hours of some days anew from the stored samples; for days that the stream's watermark has passed."""
    made = totals(read_dates(spark, S.GAME_PLAYER_COUNTS, root, low, high))
    append(made, HOURS, root, date_of="hour", replace=True)


def _window_starts(as_of: datetime | str) -> tuple[datetime, datetime]:
    """When the recent hours before as_of begin, and the first whole hour from then on."""
    begins = datetime.fromisoformat(str(as_of)) - timedelta(hours=views.RECENT_HOURS)
    whole = begins.replace(minute=0, second=0, microsecond=0)
    return begins, whole if whole == begins else whole + timedelta(hours=1)


def live_from_hours(hours: DataFrame, samples: DataFrame, as_of: datetime | str) -> DataFrame:
    """The rows of `views.player_counts_live`: of the samples, only those before the first whole recent hour are read."""
    begins, whole = _window_starts(as_of)
    recent = F.col("hour") >= ntz(whole)
    count = F.col("live_player_count")
    cut = samples.filter((F.col("fetched_at") >= ntz(begins)) & (F.col("fetched_at") < ntz(whole)))
    parts = hours.select(
        "appid", "total", "counted", "samples", "peak",
        F.struct("game_name", "live_player_count", "fetched_at").alias("latest"),
        F.when(recent, F.col("total")).alias("recent_total"),
        F.when(recent, F.col("counted")).alias("recent_counted"),
    ).unionByName(
        cut.groupBy("appid").agg(
            F.sum(count.cast("long")).alias("recent_total"), F.count(count).alias("recent_counted")
        ),
        allowMissingColumns=True,
    )
    newest = F.struct("latest.fetched_at", "latest.live_player_count", "latest.game_name")
    per_game = parts.groupBy("appid").agg(
        F.max_by("latest", F.when(F.col("samples").isNotNull(), newest)).alias("latest"),
        F.max("peak").alias("peak_players"),
        F.sum("samples").alias("data_points"),
        F.try_divide(F.sum("total"), F.sum("counted")).alias("avg_all"),
        F.try_divide(F.sum("recent_total"), F.sum("recent_counted")).alias("avg_24h"),
    )
    return views.live_view(per_game)


def live_counts(spark: SparkSession, root: str, as_of: datetime | str) -> DataFrame:
    """The live view of the stored hours and samples."""
    begins, whole = _window_starts(as_of)
    samples = read_dates(spark, S.GAME_PLAYER_COUNTS, root, begins.date(), whole.date())
    return live_from_hours(read_table(spark, HOURS, root), samples, as_of)
