"""Marts and selections built from the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.operators.ranking import ranked_top_k, top_k_per_group
from ludolytics.plans.views import tag_votes

# Fixed values of the reports.
POPULAR_GAMES = 100
REVIEWS_PER_GAME = 5
GAMES_PER_LIST = 100


def _players_order() -> list[Column]:
    return [F.col("live_player_count").desc_nulls_last(), F.col("appid")]


def popular_games_snapshot(counts: DataFrame, k: int = POPULAR_GAMES) -> DataFrame:
    """The games with the most players in the latest snapshot."""
    latest = counts.select(F.max("fetched_at")).scalar()
    snapshot = counts.filter(F.col("fetched_at") == latest).select(
        "fetched_at", "appid", "game_name", "live_player_count"
    )
    return ranked_top_k(snapshot, _players_order(), k, "ranking")


def popular_games_history(counts: DataFrame, k: int = POPULAR_GAMES) -> DataFrame:
    """The same for every snapshot: what appending snapshot after snapshot amounts to."""
    samples = counts.select("fetched_at", "appid", "game_name", "live_player_count")
    return top_k_per_group(samples, ["fetched_at"], _players_order(), k, "ranking")


def new_history_rows(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The rows of a snapshot that the history lacks, so that a rerun adds nothing."""
    keys = ["fetched_at", "appid"]
    return snapshot.join(history.select(*keys), keys, "left_anti").select(*snapshot.columns)


def popular_games(history: DataFrame) -> DataFrame:
    """The latest snapshot in the history."""
    latest = history.select(F.max("fetched_at")).scalar()
    return history.filter(F.col("fetched_at") == latest)


def recent_reviews(reviews: DataFrame, k: int = REVIEWS_PER_GAME) -> DataFrame:
    """The latest reviews of each game with their position; texts are fetched for the ranked ids only."""
    columns = [
        "appid",
        "game_name",
        "steamid",
        "playtime_forever",
        "playtime_at_review",
        "voted_up",
        "votes_up",
        "votes_funny",
        "weighted_vote_score",
        "review_text",
        "timestamp_updated",
    ]
    order = [F.col("timestamp_updated").desc_nulls_last(), F.col("review_id")]
    narrow = reviews.select("review_id", "appid", "timestamp_updated")
    ranked = top_k_per_group(narrow, ["appid"], order, k, "position").select("review_id", "position")
    return reviews.join(ranked, "review_id").select(*columns, "position")


def ranking_list(
    game_info: DataFrame, name: str, by: Column, k: int = GAMES_PER_LIST
) -> DataFrame:
    """(list_name, position, appid): the first k games by one measure."""
    measured = game_info.select("appid", by.alias("measure")).filter(F.col("measure").isNotNull())
    order = [F.col("measure").desc(), F.col("appid")]
    return ranked_top_k(measured, order, k, "position").select(
        F.lit(name).alias("list_name"), "position", "appid"
    )


def tracked_games(lists: list[DataFrame], catalogue: DataFrame | None, n: int) -> DataFrame:
    """n games: those on the lists first, then the catalogue in its order.

    Every game counts once, at its best position.
    """
    ranked = lists[0].select("position", "appid")
    for other in lists[1:]:
        ranked = ranked.unionByName(other.select("position", "appid"))
    if catalogue is not None:
        behind = F.col("position") + GAMES_PER_LIST
        ranked = ranked.unionByName(catalogue.select(behind.alias("position"), "appid"))
    best = ranked.groupBy("appid").agg(F.min("position").alias("best_position"))
    return best.orderBy("best_position", "appid").limit(n)


def catalogue_up_to(pages: DataFrame, max_games: int) -> DataFrame:
    """The first games of a paged catalogue (page, position, ...), in page order."""
    return pages.orderBy("page", "position").limit(max_games)


def owners_at_least(owners: Column) -> Column:
    """The first number of an owners text, such as `1,000,000 .. 2,000,000`; null without one."""
    first = F.regexp_extract(F.regexp_replace(owners, r"(?<=\d)[,.\u00a0'](?=\d{3})", ""), r"\d+", 0)
    return F.when(first != "", first).cast("bigint")


def games_to_track(game_info: DataFrame, n: int) -> DataFrame:
    """The games whose counts, reviews and details are collected."""
    owners = owners_at_least(F.col("owners"))
    lists = [
        ranking_list(game_info, "top100in2weeks", F.col("ccu")),
        ranking_list(game_info, "top100forever", F.col("positive")),
        ranking_list(game_info, "top100owned", owners),
    ]
    return tracked_games(lists, ranking_list(game_info, "all", owners, n), n)


def games_with_names(appids: DataFrame, game_info: DataFrame) -> DataFrame:
    """Names from the whole catalogue, 'Game_<appid>' where it has none."""
    names = game_info.select("appid", "name")
    default = F.concat(F.lit("Game_"), F.col("appid").cast("string"))
    return appids.join(names, "appid", "left").withColumn(
        "game_name", F.coalesce("name", default)
    ).drop("name")


def games_by_genre(game_info: DataFrame, genre: str) -> DataFrame:
    """The catalogue rows whose genre list names the genre."""
    named = F.array_contains(F.split("genre", r",\s*"), genre)
    return game_info.filter(named)


def games_with_tag(game_info: DataFrame, tag: str) -> DataFrame:
    """The catalogue rows that carry the tag."""
    return game_info.filter(F.map_contains_key(tag_votes(game_info), tag))
