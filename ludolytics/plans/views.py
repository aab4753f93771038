"""The views over the raw tables.

A view is a relation: the order of its rows is no part of it and is asked for by its
readers (plans.dashboard), so no view pays for a global sort.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.functions import hour_bucket, ntz, percent, price_cents, price_label
from ludolytics.operators.ranking import top_k_per_group

# Fixed values of the reports.
GAMES_PER_TAG = 100
RECENT_HOURS = 24
RISING = 1.1
FALLING = 0.9

# Tags are few and some hold a large share of the games.
TAG_SLICES = 16


def tag_votes(game_info: DataFrame) -> Column:
    """The tags column as a map, whether stored as a map or as JSON text."""
    if dict(game_info.dtypes)["tags"] == "string":
        return F.from_json("tags", "map<string,string>")
    return F.col("tags")


def games_by_tag(game_info: DataFrame) -> DataFrame:
    """One row per game and tag."""
    tagged = game_info.filter(F.col("tags").isNotNull())
    return tagged.select(
        "appid",
        F.col("name").alias("game_name"),
        "owners",
        price_cents(F.col("price")).alias("price_cents"),
        F.col("ccu").alias("current_players"),
        F.col("positive").alias("positive_reviews"),
        F.col("negative").alias("negative_reviews"),
        "genre",
        F.explode(tag_votes(game_info)).alias("tag_name", "votes"),
    ).select(
        "tag_name",
        "appid",
        "game_name",
        "owners",
        "price_cents",
        "current_players",
        "positive_reviews",
        "negative_reviews",
        "genre",
        F.col("votes").try_cast("int").alias("tag_votes"),
    )


def live_leaderboard(game_info: DataFrame) -> DataFrame:
    """Every named game with its price label and review score."""
    votes = F.col("positive") + F.col("negative")
    return game_info.filter(F.col("name").isNotNull()).select(
        F.col("appid").alias("game_id"),
        F.col("name").alias("game_name"),
        F.col("ccu").alias("player_count"),
        price_label(F.col("price")).alias("current_price"),
        F.col("owners").alias("total_downloads"),
        F.col("positive").alias("positive_reviews"),
        F.col("negative").alias("negative_reviews"),
        percent(F.col("positive"), votes, 1).alias("review_score_pct"),
        "genre",
        "developer",
        "publisher",
        "fetched_at",
        "updated_at",
    )


def top_games_by_tag(game_info: DataFrame, k: int = GAMES_PER_TAG) -> DataFrame:
    """The games of each tag with the most players."""
    games = games_by_tag(game_info).select(
        "tag_name", "game_name", "appid", "owners", "price_cents", "current_players"
    )
    order = [F.col("current_players").desc_nulls_last(), F.col("appid")]
    return top_k_per_group(games, ["tag_name"], order, k, "rank_in_tag", slices=TAG_SLICES)


def user_game_summary(stats: DataFrame, players: DataFrame, game_info: DataFrame) -> DataFrame:
    """What each player has played, with the player's name and the game's genre."""
    ps = stats.filter(F.col("name").isNotNull()).alias("ps")
    p = players.select("steamid", "personaname").alias("p")
    gi = game_info.select("appid", "genre", "positive", "negative").alias("gi")
    return (
        ps.join(p, F.col("ps.steamid") == F.col("p.steamid"), "left")
        .join(gi, F.col("ps.appid") == F.col("gi.appid"), "left")
        .select(
            "ps.steamid",
            "p.personaname",
            "ps.appid",
            F.col("ps.name").alias("game_name"),
            F.col("gi.genre").alias("game_tag"),
            F.col("ps.playtime_forever").alias("hrs_played"),
            F.col("ps.playtime_2weeks").alias("recent_hrs"),
            F.col("ps.rtime_last_played").alias("last_played"),
            "gi.positive",
            "gi.negative",
        )
    )


def game_sentiment_summary(reviews: DataFrame) -> DataFrame:
    """Votes per game. A review without a vote counts in the total only."""
    return (
        reviews.groupBy("appid", "game_name")
        .agg(
            F.count(F.lit(1)).alias("total_reviews"),
            F.count_if(F.col("voted_up")).alias("positive_count"),
            F.count_if(~F.col("voted_up")).alias("negative_count"),
            F.avg("playtime_at_review").alias("avg_playtime_at_review"),
            F.max("timestamp_created").alias("latest_review_date"),
        )
        .withColumn("positive_pct", percent(F.col("positive_count"), F.col("total_reviews"), 1))
    )


def player_counts_live(counts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Per game: the latest count, averages, peak, sample count and trend.

    One scan, one aggregate and one shuffle of partial results instead of four aggregates
    joined together. Of samples with equal times the higher count is the latest, then the
    greater name.
    """
    count = F.col("live_player_count")
    recent = F.col("fetched_at") >= ntz(as_of) - F.expr(f"INTERVAL {RECENT_HOURS} HOURS")
    per_game = counts.groupBy("appid").agg(
        F.max_by(
            F.struct("game_name", "live_player_count", "fetched_at"),
            F.struct("fetched_at", "live_player_count", "game_name"),
        ).alias("latest"),
        F.max(count).alias("peak_players"),
        F.count(F.lit(1)).alias("data_points"),
        F.avg(count).alias("avg_all"),
        F.avg(F.when(recent, count)).alias("avg_24h"),
    )
    return live_view(per_game)


def live_view(per_game: DataFrame) -> DataFrame:
    """The live view of (appid, latest, peak_players, data_points, avg_all, avg_24h)."""
    current, average = F.col("latest.live_player_count"), F.col("avg_24h")
    trend = (
        F.when(average.isNull(), "N/A")
        .when(current > average * RISING, "UP")
        .when(current < average * FALLING, "DOWN")
        .otherwise("STABLE")
    )
    return per_game.select(
        F.col("appid").alias("game_id"),
        F.col("latest.game_name").alias("game_name"),
        current.alias("current_players"),
        F.round("avg_all", 0).alias("avg_players_alltime"),
        F.round("avg_24h", 0).alias("avg_players_24h"),
        "peak_players",
        F.col("latest.fetched_at").alias("last_updated"),
        "data_points",
        trend.alias("trend"),
    )


def player_counts_timeseries(counts: DataFrame) -> DataFrame:
    """The samples with their hour."""
    return counts.select(
        F.col("appid").alias("game_id"),
        "game_name",
        F.col("live_player_count").alias("player_count"),
        F.col("fetched_at").alias("timestamp"),
        hour_bucket(F.col("fetched_at")).alias("hour_bucket"),
    )


def register_views(
    tables: dict[str, DataFrame], as_of: datetime | str
) -> dict[str, DataFrame]:
    """Registers the seven views under their names, for SQL users."""
    views = {
        "GAMES_BY_TAG": games_by_tag(tables["GAME_INFO"]),
        "LIVE_LEADERBOARD": live_leaderboard(tables["GAME_INFO"]),
        "TOP_GAMES_BY_TAG": top_games_by_tag(tables["GAME_INFO"]),
        "USER_GAME_SUMMARY": user_game_summary(
            tables["PLAYER_STATS"], tables["PLAYERS"], tables["GAME_INFO"]
        ),
        "GAME_SENTIMENT_SUMMARY": game_sentiment_summary(tables["GAME_REVIEWS"]),
        "GAME_PLAYER_COUNTS_LIVE": player_counts_live(tables["GAME_PLAYER_COUNTS"], as_of),
        "GAME_PLAYER_COUNTS_TIMESERIES": player_counts_timeseries(tables["GAME_PLAYER_COUNTS"]),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
