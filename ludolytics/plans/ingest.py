"""Messages and landed documents to table rows; the same for batch and stream.

A transform gives the data columns of its table. The stamps inserted_at and updated_at
come from the upsert, or from `stamped` where rows are appended.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics.functions import epoch_to_ntz, iso_to_ntz, md5_key, ntz, text_to_int
from ludolytics.operators.ranking import top_k_per_group
from ludolytics.sources import schemas as S


def stamped(rows: DataFrame, as_of: datetime | str) -> DataFrame:
    return rows.withColumns({"inserted_at": ntz(as_of), "updated_at": ntz(as_of)})


def rejected(keys: tuple[str, ...]) -> Column:
    """True where a part of the key is missing: damaged messages and incomplete records."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def parsed(messages: DataFrame, schema: T.DataType) -> DataFrame:
    """The fields of the JSON values. A damaged value gives nulls, a damaged field one null."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select(
        "data.*"
    )


def _columns(table: S.Table) -> list[str]:
    return [c for c in table.schema.names if c not in ("inserted_at", "updated_at")]


def players_from_messages(messages: DataFrame) -> DataFrame:
    rows = parsed(messages, S.PLAYER_MESSAGE).withColumns(
        {
            "lastlogoff": epoch_to_ntz(F.col("lastlogoff")),
            "timecreated": epoch_to_ntz(F.col("timecreated")),
            "fetched_at": iso_to_ntz(F.col("fetched_at")),
        }
    )
    return rows.select(*_columns(S.PLAYERS))


def games_from_messages(messages: DataFrame) -> DataFrame:
    rows = parsed(messages, S.GAME_MESSAGE).withColumns(
        {
            "game_id": md5_key(F.col("steamid"), F.col("appid")),
            "rtime_last_played": epoch_to_ntz(F.col("rtime_last_played")),
            "fetched_at": iso_to_ntz(F.col("fetched_at")),
        }
    )
    return rows.select(*_columns(S.GAMES))


def stats_from_messages(messages: DataFrame) -> DataFrame:
    rows = parsed(messages, S.STATS_MESSAGE).withColumns(
        {
            "stat_id": md5_key(F.col("steamid"), F.col("appid")),
            "rtime_last_played": epoch_to_ntz(F.col("rtime_last_played")),
            "data_type": F.coalesce("data_type", F.lit(S.RECENTLY_PLAYED)),
            "fetched_at": iso_to_ntz(F.col("fetched_at")),
        }
    )
    return rows.select(*_columns(S.PLAYER_STATS))


def game_info_from_messages(messages: DataFrame) -> DataFrame:
    """Prices arrive as text or number and become whole cents; tags stay a map."""
    rows = parsed(messages, S.GAME_INFO_MESSAGE).withColumns(
        {c: text_to_int(F.col(c)) for c in ("price", "initialprice", "discount")}
        | {"fetched_at": iso_to_ntz(F.col("fetched_at"))}
    )
    return rows.select(*_columns(S.GAME_INFO))


def prepared_game_info(messages: DataFrame, as_of: datetime | str) -> DataFrame:
    """The loader's form: no empty tag maps, a default source, a usable time.

    An unreadable time becomes as_of; a missing one stays missing.
    """
    raw = parsed(messages, S.GAME_INFO_MESSAGE)
    read_time = F.coalesce(iso_to_ntz(F.col("fetched_at")), ntz(as_of))
    given = F.col("fetched_at").isNotNull() & (F.col("fetched_at") != "")
    rows = raw.withColumns(
        {c: text_to_int(F.col(c)) for c in ("price", "initialprice", "discount")}
        | {
            "tags": F.when(F.size("tags") > 0, F.col("tags")),
            "fetched_at": F.when(given, read_time),
            "source": F.coalesce("source", F.lit(S.SOURCE_CATALOGUE)),
        }
    )
    return rows.select(*_columns(S.GAME_INFO))


# ---- landed documents -------------------------------------------------------


def player_summaries(documents: DataFrame, fetched_at: datetime | str) -> DataFrame:
    """Documents with player lists to message rows, one per player."""
    answer = F.from_json(F.col("value").cast("string"), S.PLAYER_SUMMARIES)
    listed = documents.select(F.explode(answer["response"]["players"]).alias("p")).select("p.*")
    return listed.withColumns(
        {"fetched_at": F.lit(str(fetched_at)), "source": F.lit(S.SOURCE_PLATFORM)}
    )


def owned_games(documents: DataFrame, fetched_at: datetime | str) -> DataFrame:
    """Documents (steamid, value) with owned games to message rows, one per game."""
    return _listed_games(documents, S.GAME_MESSAGE, fetched_at)


def recent_games(documents: DataFrame, fetched_at: datetime | str) -> DataFrame:
    """The same for recently played games."""
    rows = _listed_games(documents, S.STATS_MESSAGE, fetched_at)
    return rows.withColumn("data_type", F.lit(S.RECENTLY_PLAYED))


def _listed_games(
    documents: DataFrame, message: T.StructType, fetched_at: datetime | str
) -> DataFrame:
    answer = F.from_json(F.col("value").cast("string"), S.owned_games(message))
    listed = documents.select(
        F.col("steamid").alias("_owner"), F.explode(answer["response"]["games"]).alias("g")
    )
    return listed.select("_owner", "g.*").withColumns(
        {
            "steamid": F.col("_owner"),
            "fetched_at": F.lit(str(fetched_at)),
            "source": F.lit(S.SOURCE_PLATFORM),
        }
    ).drop("_owner")


def ranking_rows(documents: DataFrame, fetched_at: datetime | str) -> DataFrame:
    """Documents (list_name, value) holding games keyed by appid to one row per game."""
    games = F.from_json(F.col("value").cast("string"), S.RANKING_LIST)
    return (
        documents.select("list_name", F.posexplode(games).alias("n", "key", "g"))
        .select("list_name", (F.col("n") + 1).alias("position"), "key", "g.*")
        .withColumns(
            {
                "appid": F.col("key").try_cast("int"),
                "fetched_at": F.lit(str(fetched_at)),
                "source": F.lit(S.SOURCE_CATALOGUE),
            }
        )
        .drop("key")
    )


def normalised_reviews(
    pages: DataFrame,
    names: DataFrame,
    reviews_per_game: int | None = None,
    language: str | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Review pages (appid, value, fetched_at) to rows: every review, with its whole text.

    reviews_per_game and max_chars are options: the newest reviews of each game, a cut text.
    """
    page = F.from_json(F.col("value").cast("string"), S.REVIEW_PAGE).alias("page")
    reviews = (
        pages.select("appid", "fetched_at", page)
        .filter(F.col("page.success") != 0)
        .select("appid", "fetched_at", F.explode("page.reviews").alias("r"))
    )

    def field(name: str, default: object) -> Column:
        return F.coalesce(f"r.{name}", F.lit(default)).alias(name.split(".")[-1])

    text = F.coalesce("r.review", F.lit(""))
    rows = reviews.select(
        md5_key(F.col("appid"), F.col("r.recommendationid")).alias("review_id"),
        "appid",
        "r.recommendationid",
        "r.author.steamid",
        field("author.playtime_forever", 0),
        field("author.playtime_at_review", 0),
        field("voted_up", False),
        field("votes_up", 0),
        field("votes_funny", 0),
        field("weighted_vote_score", 0.0),
        (text if max_chars is None else F.substring(text, 1, max_chars)).alias("review_text"),
        epoch_to_ntz(F.col("r.timestamp_created")).alias("timestamp_created"),
        epoch_to_ntz(F.col("r.timestamp_updated")).alias("timestamp_updated"),
        field("language", language or "english"),
        field("comment_count", 0),
        field("steam_purchase", False),
        field("received_for_free", False),
        "fetched_at",
        F.lit(S.SOURCE_REVIEWS).alias("source"),
    )
    if language is not None:
        rows = rows.filter(F.col("language") == language)
    if reviews_per_game is not None:
        order = [F.col("timestamp_created").desc_nulls_last(), F.col("recommendationid")]
        rows = top_k_per_group(rows, ["appid"], order, reviews_per_game, "_n")
    default = F.concat(F.lit("Game_"), F.col("appid").cast("string"))
    known = names.select("appid", F.col("name").alias("_name"))
    named = rows.join(known, "appid", "left").withColumn(
        "game_name", F.coalesce("_name", default)
    )
    return named.select(*_columns(S.GAME_REVIEWS))


def review_summaries(documents: DataFrame) -> DataFrame:
    """Summary documents (appid, value) to one row each; unsuccessful ones are dropped."""
    answer = F.from_json(F.col("value").cast("string"), S.REVIEW_SUMMARY).alias("a")
    read = documents.select("appid", answer).filter(
        (F.col("a.success") != 0) & F.col("a.query_summary").isNotNull()
    )
    return read.select(
        "appid",
        F.coalesce("a.query_summary.review_score", F.lit(0)).alias("review_score"),
        F.coalesce("a.query_summary.review_score_desc", F.lit("")).alias("review_score_desc"),
        F.coalesce("a.query_summary.total_positive", F.lit(0)).alias("total_positive"),
        F.coalesce("a.query_summary.total_negative", F.lit(0)).alias("total_negative"),
        F.coalesce("a.query_summary.total_reviews", F.lit(0)).alias("total_reviews"),
    )


# The widths to which stored texts may be cut.
STORED_REVIEW_CHARS = 5000
STORED_DESCRIPTION_CHARS = {
    "detailed_description": 50000,
    "short_description": 5000,
    "about_the_game": 50000,
}


def normalised_details(documents: DataFrame, cut: bool = False) -> DataFrame:
    """Store documents (value, fetched_at), keyed by appid inside, to one row per game.

    Whole texts are kept unless cut asks for the stored widths.
    """
    games = F.from_json(F.col("value").cast("string"), S.STORE_DETAILS)
    found = documents.select("fetched_at", F.explode(games).alias("key", "v")).filter("v.success")

    def text(name: str) -> Column:
        whole = F.coalesce(f"v.data.{name}", F.lit(""))
        kept = F.substring(whole, 1, STORED_DESCRIPTION_CHARS[name]) if cut else whole
        return kept.alias(name)

    def listed(name: str) -> Column:
        return F.coalesce(f"v.data.{name}", F.array().cast("array<string>")).alias(name)

    return found.select(
        F.col("key").try_cast("int").alias("appid"),
        "v.data.name",
        "v.data.type",
        F.coalesce("v.data.required_age", F.lit(0)).alias("required_age"),
        F.coalesce("v.data.is_free", F.lit(False)).alias("is_free"),
        text("detailed_description"),
        text("short_description"),
        text("about_the_game"),
        F.coalesce("v.data.supported_languages", F.lit("")).alias("supported_languages"),
        "v.data.header_image",
        "v.data.website",
        listed("developers"),
        listed("publishers"),
        listed("categories.description").alias("categories"),
        listed("genres.description").alias("genres"),
        F.col("v.data.release_date.date").alias("release_date"),
        F.coalesce("v.data.release_date.coming_soon", F.lit(False)).alias("coming_soon"),
        F.col("v.data.metacritic.score").alias("metacritic_score"),
        F.col("v.data.metacritic.url").alias("metacritic_url"),
        F.col("v.data.recommendations.total").alias("recommendations_total"),
        F.col("v.data.achievements.total").alias("achievements_total"),
        F.when(F.col("v.data.price_overview") != "{}", F.col("v.data.price_overview")).alias(
            "price_overview"
        ),
        "fetched_at",
        F.lit(S.SOURCE_STORE).alias("source"),
    )


def _counted(documents: DataFrame) -> DataFrame:
    """(record_id, appid, fetched_at, live_player_count) of the documents with an answer; the id is one for a game and minute."""
    answer = F.from_json(F.col("value").cast("string"), S.LIVE_COUNT)["response"]
    counted = documents.select("appid", "fetched_at", answer.alias("a")).filter(
        (F.col("a.result") == 1) & F.col("a.player_count").isNotNull()
    )
    minute = F.date_format("fetched_at", "yyyyMMddHHmm")
    return counted.select(
        md5_key(F.col("appid"), minute).alias("record_id"),
        "appid",
        "fetched_at",
        F.col("a.player_count").alias("live_player_count"),
    )


def count_samples(documents: DataFrame, names: DataFrame) -> DataFrame:
    """Live count documents (appid, value, fetched_at) to samples, one per game and minute.

    All documents of one collection cycle carry the cycle's fetched_at.
    """
    samples = (
        _counted(documents)
        .groupBy("record_id", "appid")
        .agg(
            F.max("fetched_at").alias("fetched_at"),
            F.max("live_player_count").alias("live_player_count"),
        )
    )
    return _named_samples(samples, names)


def sample_documents(documents: DataFrame, names: DataFrame) -> DataFrame:
    """A sample of each document, also on a stream, which drops those of a repeated record_id itself."""
    return _named_samples(_counted(documents), names)


def _named_samples(samples: DataFrame, names: DataFrame) -> DataFrame:
    known = names.select("appid", F.col("name").alias("_name"))
    default = F.concat(F.lit("Game_"), F.col("appid").cast("string"))
    return samples.join(known, "appid", "left").select(
        "record_id",
        "appid",
        F.coalesce("_name", default).alias("game_name"),
        "live_player_count",
        "fetched_at",
        F.lit(S.SOURCE_PLATFORM).alias("source"),
    )


def new_samples(stored: DataFrame, samples: DataFrame) -> DataFrame:
    """The samples not yet stored, so that a repeated cycle adds nothing."""
    return samples.join(stored.select("record_id"), "record_id", "left_anti").select(
        *samples.columns
    )
