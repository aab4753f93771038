"""The queries behind the dashboard pages; limits and selections are parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.functions import excerpt
from ludolytics.operators.ranking import top_k, top_k_per_group
from ludolytics.plans.views import TAG_SLICES, games_by_tag, player_counts_live, tag_votes


def _by_players() -> list:
    return [F.col("current_players").desc_nulls_last(), F.col("game_id")]


def leaderboard(counts: DataFrame, as_of: datetime | str, limit: int = 50) -> DataFrame:
    """The games with the most players now."""
    return leaderboard_of(player_counts_live(counts, as_of), limit)


def leaderboard_of(live: DataFrame, limit: int = 50) -> DataFrame:
    """The same of a live view, however it was made."""
    live = live.filter(F.col("game_name").isNotNull() & F.col("current_players").isNotNull())
    return top_k(live, _by_players(), limit).select(
        "game_id",
        "game_name",
        F.col("current_players").alias("player_count"),
        "avg_players_24h",
        "avg_players_alltime",
        "peak_players",
        "trend",
        "last_updated",
        "data_points",
    )


# How the trends are shown.
TREND_MARKS = {
    "UP": "📈 UP",
    "DOWN": "📉 DOWN",
    "STABLE": "➡️ STABLE",
    "N/A": "⏳ N/A",
}


def with_trend_marks(board: DataFrame) -> DataFrame:
    """The trends as shown; an unknown one counts as not available."""
    pairs = [F.lit(text) for pair in TREND_MARKS.items() for text in pair]
    shown = F.element_at(F.create_map(*pairs), F.col("trend"))
    return board.withColumn("trend", F.coalesce(shown, F.lit(TREND_MARKS["N/A"])))


def leaderboard_metrics(board: DataFrame) -> DataFrame:
    """One row on the games shown."""
    return board.agg(
        F.count(F.lit(1)).alias("total_games"),
        F.sum("player_count").alias("total_players"),
        F.count_if(F.col("trend") == "UP").alias("up_count"),
        F.count_if(F.col("trend") == "DOWN").alias("down_count"),
        F.max("last_updated").alias("last_update"),
        F.date_format(F.max("last_updated"), "HH:mm:ss").alias("last_update_time"),
        F.format_number(F.count(F.lit(1)), 0).alias("total_games_text"),
        F.format_number(F.sum("player_count"), 0).alias("total_players_text"),
    )


def live_counts(counts: DataFrame, as_of: datetime | str, limit: int = 20) -> DataFrame:
    """Live counts with trends, games without a name or count included."""
    live = player_counts_live(counts, as_of).drop("data_points")
    return top_k(live, _by_players(), limit)


def _tag_columns(games: DataFrame) -> DataFrame:
    return games.select(
        "tag_name",
        "game_name",
        F.col("appid").alias("game_id"),
        F.col("owners").alias("total_downloads"),
        "price_cents",
        "current_players",
    )


def games_for_tag(game_info: DataFrame, tag: str, limit: int = 20) -> DataFrame:
    """The games of one tag with the most players."""
    games = games_by_tag(game_info).filter(F.col("tag_name") == tag)
    return top_k(_tag_columns(games), _by_players(), limit)


def games_for_all_tags(game_info: DataFrame, limit: int = 20) -> DataFrame:
    """The same for every tag at once, with the position."""
    games = _tag_columns(games_by_tag(game_info))
    return top_k_per_group(games, ["tag_name"], _by_players(), limit, "position", slices=TAG_SLICES)


def _tags(game_info: DataFrame) -> DataFrame:
    return game_info.filter(F.col("tags").isNotNull()).select(
        F.explode(F.map_keys(tag_votes(game_info))).alias("tag_name")
    )


def tag_list(game_info: DataFrame, limit: int = 100) -> DataFrame:
    return top_k(_tags(game_info).distinct(), [F.col("tag_name")], limit)


def available_tags(game_info: DataFrame, min_games: int = 5, limit: int = 50) -> DataFrame:
    """The tags of at least min_games games, those with most games first."""
    sizes = _tags(game_info).groupBy("tag_name").agg(F.count(F.lit(1)).alias("game_count"))
    common = sizes.filter(F.col("game_count") >= min_games)
    return top_k(common, [F.desc("game_count"), F.col("tag_name")], limit)


def _by_playtime() -> list:
    return [F.col("playtime_forever").desc_nulls_last(), F.col("appid")]


def _described(stats: DataFrame, players: DataFrame, game_info: DataFrame) -> DataFrame:
    names = players.select("steamid", "personaname")
    genres = game_info.select("appid", F.col("genre").alias("game_tag"))
    return (
        stats.join(names, "steamid", "left")
        .join(genres, "appid", "left")
        .select(
            "steamid",
            "personaname",
            F.col("appid").alias("game_id"),
            F.col("name").alias("game_name"),
            "game_tag",
            F.col("playtime_forever").alias("hrs_played"),
            F.col("playtime_2weeks").alias("recent_hrs"),
            F.col("rtime_last_played").alias("last_played"),
        )
    )


def user_profile(
    stats: DataFrame, players: DataFrame, game_info: DataFrame, steamid: str, limit: int = 50
) -> DataFrame:
    """The games one player has played most. The rows are cut before the joins."""
    own = stats.filter((F.col("steamid") == steamid) & F.col("name").isNotNull())
    return _described(top_k(own, _by_playtime(), limit), players, game_info)


def user_profiles(
    stats: DataFrame, players: DataFrame, game_info: DataFrame, limit: int = 50
) -> DataFrame:
    """The same for every player at once."""
    named = stats.filter(F.col("name").isNotNull())
    most = top_k_per_group(named, ["steamid"], _by_playtime(), limit, "position")
    return _described(most, players, game_info)


def sample_users(players: DataFrame, limit: int = 20) -> DataFrame:
    named = players.filter(F.col("personaname").isNotNull()).select("steamid", "personaname")
    return top_k(named.distinct(), [F.col("steamid"), F.col("personaname")], limit)


def user_totals(stats: DataFrame, limit: int | None = None) -> DataFrame:
    """Games and hours of every player; with a limit, over the games that a profile page shows."""
    named = stats.filter(F.col("name").isNotNull()).select(
        "steamid", "appid", "playtime_forever", "playtime_2weeks"
    )
    shown = named
    if limit is not None:
        shown = top_k_per_group(named, ["steamid"], _by_playtime(), limit, "position")
    return shown.groupBy("steamid").agg(
        F.count(F.lit(1)).alias("total_games"),
        (F.sum("playtime_forever") / 60.0).alias("total_hours"),
        (F.sum("playtime_2weeks") / 60.0).alias("recent_hours"),
    )


def game_sentiments(games: DataFrame, limit: int = 20) -> DataFrame:
    """The games of the latest analysis with the best scores.

    Ordered by date first, the first `limit` rows hold every row of the answer; those
    of an earlier date are then dropped. One pass, and the window sees `limit` rows.
    """
    order = [
        F.col("analysis_date").desc_nulls_last(),
        F.col("sentiment_score").desc_nulls_last(),
        F.col("appid"),
    ]
    latest = F.max("analysis_date").over(Window.partitionBy())
    shown = top_k(games, order, limit).withColumn("_latest", latest)
    return shown.filter(F.col("analysis_date") == F.col("_latest")).select(
        F.col("appid").alias("game_id"),
        "game_name",
        "total_reviews_analyzed",
        F.round("avg_sentiment_compound", 3).alias("avg_sentiment"),
        F.round("positive_review_pct", 1).alias("positive_pct"),
        F.round("negative_review_pct", 1).alias("negative_pct"),
        F.round("sentiment_score", 1).alias("sentiment_score"),
        "analysis_date",
    )


def sentiment_metrics(shown: DataFrame) -> DataFrame:
    """One row on the games shown; their scores have one digit, so decimals sum exactly."""
    games = F.count(F.lit(1))

    def mean(name: str):
        return F.try_divide(F.sum(F.col(name).cast("decimal(10,1)")).cast("double"), games)

    return shown.agg(
        mean("sentiment_score").alias("avg_score"),
        mean("positive_pct").alias("avg_positive"),
        F.sum("total_reviews_analyzed").alias("total_reviews"),
    )


def _review_columns(reviews: DataFrame, *extra: str) -> DataFrame:
    vote = F.when(F.coalesce("voted_up", F.lit(False)), "up").otherwise("down")
    return reviews.select(
        *extra,
        "game_name",
        "review_text",
        excerpt(F.col("review_text")).alias("excerpt"),
        "voted_up",
        vote.alias("vote"),
        "playtime_at_review",
        F.floor(F.col("playtime_at_review") / 60).alias("hours_played"),
        "timestamp_created",
    )


def _newest() -> list:
    return [F.col("timestamp_created").desc_nulls_last(), F.col("review_id")]


def review_samples(reviews: DataFrame, appid: int, limit: int = 10) -> DataFrame:
    """The newest reviews of one game."""
    own = reviews.filter(F.col("appid") == appid)
    return _review_columns(top_k(own, _newest(), limit), "appid")


def review_samples_per_game(reviews: DataFrame, limit: int = 10) -> DataFrame:
    """The same for every game at once; texts are fetched for the ranked ids only."""
    narrow = reviews.select("review_id", "appid", "timestamp_created")
    newest = top_k_per_group(narrow, ["appid"], _newest(), limit, "position")
    chosen = reviews.join(newest.select("review_id", "position"), "review_id")
    return _review_columns(chosen, "appid", "position")


def catalogue_size(game_info: DataFrame) -> DataFrame:
    return game_info.agg(
        F.count(F.lit(1)).alias("games"),
        F.format_number(F.count(F.lit(1)), 0).alias("games_text"),
    )
