"""The four topic pipelines and the sample pipeline.

Every micro-batch is written as its own partition (stream query, epoch) of a change table,
so a batch that is repeated after a failure overwrites itself and a stream with a new
checkpoint overwrites nothing. Messages without a complete key go to a reject folder by
the same two numbers.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ludolytics.functions import ntz
from ludolytics.plans import ingest
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import ChangeTable, append, read_dates, with_stamps
from ludolytics.sources.topics import Broker, LandedFiles

# Seconds between triggers, and what a drain run waits for.
TRIGGER = "30 seconds"
DRAIN_INTERVAL = "60 seconds"


@dataclass(frozen=True)
class Pipeline:
    """key_parts are the fields of the message without which a record has no key."""

    name: str
    topic: str
    message: T.StructType
    key_parts: tuple[str, ...]
    table: S.Table
    transform: Callable[[DataFrame], DataFrame]


PIPELINES = {
    "players": Pipeline(
        "players",
        S.TOPICS["players"],
        S.PLAYER_MESSAGE,
        ("steamid",),
        S.PLAYERS,
        ingest.players_from_messages,
    ),
    "games": Pipeline(
        "games",
        S.TOPICS["games"],
        S.GAME_MESSAGE,
        ("steamid", "appid"),
        S.GAMES,
        ingest.games_from_messages,
    ),
    "stats": Pipeline(
        "stats",
        S.TOPICS["stats"],
        S.STATS_MESSAGE,
        ("steamid", "appid"),
        S.PLAYER_STATS,
        ingest.stats_from_messages,
    ),
    "game_info": Pipeline(
        "game_info",
        S.TOPICS["game_info"],
        S.GAME_INFO_MESSAGE,
        ("appid",),
        S.GAME_INFO,
        ingest.game_info_from_messages,
    ),
}


def _use_utc(spark: SparkSession) -> None:
    """Times are stored as UTC without a zone, so the session must run in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def batch_writer(
    spark: SparkSession,
    pipeline: Pipeline,
    root: str,
    as_of: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function of a pipeline."""
    table = ChangeTable(spark, pipeline.table, root)

    def write(messages: DataFrame, epoch: int) -> None:
        query = query_of(messages)
        received = messages.select("value").persist()
        try:
            rows = pipeline.transform(received)
            table.write(rows, as_of if as_of is not None else _now(), query, epoch)
            bad = _without_key(pipeline, received)
            folder = f"{root}/rejected/{pipeline.name}/query={query}/epoch={epoch}"
            bad.write.mode("overwrite").json(folder)
        finally:
            received.unpersist()

    return write


def query_of(batch: DataFrame) -> str:
    """The id that a stream keeps in its checkpoint; `batch` outside of a stream."""
    context = batch.sparkSession.sparkContext
    return context.getLocalProperty("sql.streaming.queryId") or "batch"


def _without_key(pipeline: Pipeline, messages: DataFrame) -> DataFrame:
    """The raw values whose rows lack a part of the key."""
    text = F.col("value").cast("string")
    read = messages.select(
        text.alias("value"), F.from_json(text, pipeline.message).alias("data")
    )
    parts = tuple(f"data.{part}" for part in pipeline.key_parts)
    return read.filter(ingest.rejected(parts)).select("value")


def without_repeats(
    messages: DataFrame, pipeline: Pipeline, within: str, arrived: Column | None = None
) -> DataFrame:
    """Leaves out messages that came before: equal in key and fetched_at, or in their whole text where one is missing.

    The watermark is on the time of arrival (`arrived`, the trigger's time by default), so it bounds
    the state by `within` and no message is ever too late: one repeated after its state is
    gone comes through, and the fold of the changes by key makes it one again.
    """
    parts = T.StructType([T.StructField(c, T.StringType()) for c in (*pipeline.key_parts, "fetched_at")])
    text = F.col("value").cast("string")
    read = F.from_json(text, parts)
    whole = F.lit(True)
    for part in parts.names:
        whole = whole & read[part].isNotNull()
    known = messages.withColumns(
        {
            "_message": F.when(whole, F.to_json(read)).otherwise(text),
            "_arrived": F.current_timestamp() if arrived is None else arrived,
        }
    )
    once = known.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_message"])
    return once.drop("_message", "_arrived")


def stop_when_idle(query: StreamingQuery, seconds: float = 30, poll: float = 1) -> int:
    """Waits until a query has read no row for so many seconds, stops it, and gives the rows that it read.

    A failed query raises its error here.
    """
    last, rows, seen = time.monotonic(), 0, None
    while time.monotonic() - last < seconds:
        if query.awaitTermination(poll):
            break
        for progress in query.recentProgress:
            if seen is None or progress.batchId > seen:
                seen = progress.batchId
                if progress.numInputRows:
                    last, rows = time.monotonic(), rows + progress.numInputRows
        if query.status["isTriggerActive"]:  # a long batch is no idle time
            last = time.monotonic()
    query.stop()
    return rows


def start(
    spark: SparkSession,
    pipeline: Pipeline,
    source: Broker | LandedFiles,
    root: str,
    once: bool = False,
    trigger: str = TRIGGER,
    as_of: Column | None = None,
    repeats_within: str | None = None,
    arrived: Column | None = None,
) -> StreamingQuery:
    """Starts a pipeline; `once` drains what is there and stops, `repeats_within` leaves out repeated messages."""
    _use_utc(spark)
    messages = source.stream(spark, pipeline.topic)
    if repeats_within is not None:
        messages = without_repeats(messages, pipeline, repeats_within, arrived)
    writer = (
        messages.writeStream.outputMode("append")
        .queryName(pipeline.name)
        .option("checkpointLocation", f"{root}/checkpoints/{pipeline.name}")
        .foreachBatch(batch_writer(spark, pipeline, root, as_of))
    )
    timed = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return timed.start()


def start_drain(
    spark: SparkSession, pipeline: Pipeline, source: Broker | LandedFiles, root: str
) -> StreamingQuery:
    """The periodic drain: a longer trigger, from the earliest message on; offsets are kept by the checkpoint.

    `stop_when_idle` ends it when nothing has come for a while.
    """
    if isinstance(source, Broker):
        source = replace(source, starting_offsets="earliest")
    return start(spark, pipeline, source, root, trigger=DRAIN_INTERVAL)


def game_info_loader(as_of: datetime | str) -> Pipeline:
    """The loader's form of the game info pipeline: `ingest.prepared_game_info`, under a name and checkpoint of its own."""
    return replace(
        PIPELINES["game_info"],
        name="game_info_loader",
        transform=partial(ingest.prepared_game_info, as_of=as_of),
    )


# ---- live count samples --------------------------------------------------------

LATEST_COUNTS = S.Table(
    "LATEST_PLAYER_COUNTS",
    S.struct(
        appid=S.INT,
        game_name=S.TEXT,
        live_player_count=S.INT,
        fetched_at=S.TIME,
        source=S.TEXT,
        inserted_at=S.TIME,
        updated_at=S.TIME,
    ),
    ("appid",),
)


def sample_writer(
    spark: SparkSession, names: DataFrame, root: str, as_of: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for live count documents (appid, value, fetched_at).

    Samples are appended after leaving out those already stored for the same times
    (in the partitions of their dates only); the latest count of each game is the newest change by its time.
    """
    latest = ChangeTable(spark, LATEST_COUNTS, root, newer_by="fetched_at")

    def write(documents: DataFrame, epoch: int) -> None:
        now = as_of if as_of is not None else _now()
        samples = ingest.count_samples(documents, names).persist()
        try:
            days = samples.agg(F.min("fetched_at"), F.max("fetched_at")).first()
            if days[0] is None:
                return
            stored = read_dates(spark, S.GAME_PLAYER_COUNTS, root, days[0].date(), days[1].date())
            stored = stored.filter(F.col("fetched_at").between(ntz(days[0]), ntz(days[1])))
            fresh = ingest.new_samples(stored, samples)
            stamped = with_stamps(fresh, S.GAME_PLAYER_COUNTS, now)
            append(stamped, S.GAME_PLAYER_COUNTS, root, date_of="fetched_at")
            latest.write(samples.drop("record_id"), now, query_of(documents), epoch)
        finally:
            samples.unpersist()

    return write


def start_samples(
    spark: SparkSession,
    documents: DataFrame,
    names: DataFrame,
    root: str,
    once: bool = False,
    trigger: str = "300 seconds",
    as_of: Column | None = None,
) -> StreamingQuery:
    """Starts the sample pipeline on a stream of live count documents."""
    _use_utc(spark)
    writer = (
        documents.writeStream.outputMode("append")
        .queryName("samples")
        .option("checkpointLocation", f"{root}/checkpoints/samples")
        .foreachBatch(sample_writer(spark, names, root, as_of))
    )
    timed = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return timed.start()
