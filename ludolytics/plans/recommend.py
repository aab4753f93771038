"""Recommendations: sources, candidates, similar games, fallback, recorded answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolytics.functions import percent, strip_fences
from ludolytics.operators.ranking import ranked_top_k
from ludolytics.operators.similarity import labels, most_similar
from ludolytics.plans.views import games_by_tag, tag_votes
from ludolytics.sources.schemas import RECOMMENDATIONS

# Fixed values of the recommender.
CANDIDATES = 100
SIMILAR_GAMES = 5
FALLBACK_GAMES = 10
FALLBACK_REASON = "Popular game in similar genre."
DEFAULT_REASON = "Similar gameplay and genre."


def _review_score() -> Column:
    return percent(F.col("positive"), F.col("positive") + F.col("negative"), 1)


def _genres(details: DataFrame) -> Column:
    """The genres column as an array, whether stored as an array or as JSON text."""
    if dict(details.dtypes)["genres"] == "string":
        return F.from_json("genres", "array<string>")
    return F.col("genres")


def source_games(
    details: DataFrame, game_info: DataFrame, appid: int | None = None
) -> DataFrame:
    """The game to start from, or every game: its details, else only its catalogue name."""
    if appid is not None:
        details = details.filter(F.col("appid") == appid)
        game_info = game_info.filter(F.col("appid") == appid)
    info = game_info.select("appid", "ccu", "positive", "negative")
    primary = details.select(
        "appid", "name", _genres(details).alias("genres"), "short_description"
    ).join(info, "appid", "left")
    fallback = game_info.select("appid", "name").join(details.select("appid"), "appid", "left_anti")
    return primary.unionByName(fallback, allowMissingColumns=True)


def candidate_games(
    details: DataFrame, game_info: DataFrame, limit: int = CANDIDATES
) -> DataFrame:
    """The described games with the most players.

    The first pass joins and cuts ids and numbers only; descriptions are read for the
    games that are left, through a join whose small side the limit bounds.
    """
    described = details.filter(F.col("short_description").isNotNull()).select("appid")
    played = game_info.filter(F.col("ccu") > 0).select(
        "appid",
        F.col("ccu").alias("player_count"),
        "positive",
        "negative",
        _review_score().alias("review_score"),
        tag_votes(game_info).alias("tags"),
    )
    chosen = (
        described.join(played, "appid")
        .orderBy(F.col("player_count").desc(), F.col("appid"))
        .limit(limit)
    )
    wide = details.select("appid", "name", _genres(details).alias("genres"), "short_description")
    return F.broadcast(chosen).join(wide, "appid").select(
        "appid",
        "name",
        "genres",
        "short_description",
        "player_count",
        "positive",
        "negative",
        "review_score",
        "tags",
    )


def without_source(candidates: DataFrame, appid: int) -> DataFrame:
    """The candidates without the game itself, taken out after the limit."""
    return candidates.filter(F.col("appid") != appid)


def _labelled(details: DataFrame, game_info: DataFrame) -> DataFrame:
    """The labels of every game that has details, a catalogue row, or both."""
    genres = details.select("appid", _genres(details).alias("genres"))
    tags = game_info.select("appid", tag_votes(game_info).alias("tags"))
    return genres.join(tags, "appid", "full_outer").select(
        "appid", labels(F.col("genres"), F.col("tags")).alias("labels")
    )


def similar_games(
    details: DataFrame,
    game_info: DataFrame,
    appid: int | None = None,
    k: int = SIMILAR_GAMES,
) -> DataFrame:
    """The candidates most like the given game, or like every game, with the reason."""
    candidates = candidate_games(details, game_info).select(
        "appid",
        labels(F.col("genres"), F.col("tags")).alias("labels"),
        F.col("short_description").alias("description"),
        "name",
        F.concat_ws(", ", "genres").alias("genre"),
        "player_count",
        "review_score",
    )
    if appid is not None:
        details = details.filter(F.col("appid") == appid)
        game_info = game_info.filter(F.col("appid") == appid)
    texts = details.filter(F.col("short_description").isNotNull()).select(
        "appid", F.col("short_description").alias("description")
    )
    found = most_similar(_labelled(details, game_info), texts, candidates, k)
    return found.select(
        F.col("appid").alias("source_appid"),
        "position",
        F.col("candidate").alias("appid"),
        "name",
        "genre",
        "player_count",
        "review_score",
        F.round("similarity", 6).alias("similarity"),
        F.round("text_similarity", 6).alias("text_similarity"),
        F.concat(F.lit("Shares "), "shared_labels").alias("reason"),
    )


def _popular_tag_rows(game_info: DataFrame) -> DataFrame:
    """(game, tag) rows of played games. A game appears once for each of its tags."""
    score = percent(
        F.col("positive_reviews"), F.col("positive_reviews") + F.col("negative_reviews"), 1
    )
    return (
        games_by_tag(game_info)
        .filter(F.col("current_players") > 0)
        .select(
            "appid",
            F.col("game_name").alias("name"),
            F.col("tag_name").alias("genre"),
            F.col("current_players").alias("player_count"),
            score.alias("review_score"),
        )
        .distinct()
    )


def _popular_first() -> list[Column]:
    return [F.col("player_count").desc(), F.col("appid"), F.col("genre")]


def fallback_games(game_info: DataFrame, appid: int, limit: int = FALLBACK_GAMES) -> DataFrame:
    """The most played rows of other games."""
    others = _popular_tag_rows(game_info).filter(F.col("appid") != appid)
    return others.orderBy(*_popular_first()).limit(limit).withColumn(
        "reason", F.lit(FALLBACK_REASON)
    )


_SHOWN = ("appid", "name", "genre", "player_count", "review_score", "reason")


def _short_list(game_info: DataFrame, limit: int) -> Column:
    """The popular rows from which every source's fallback can be cut, as one value.

    No fallback takes more than `limit` rows of one game, so the first 2 * limit rows of
    a list with at most `limit` rows per game hold every answer. The list is computed
    once and handed to the sources as a scalar, without a join.
    """
    per_game = Window.partitionBy("appid").orderBy("genre")
    capped = (
        _popular_tag_rows(game_info)
        .withColumn("_n", F.row_number().over(per_game))
        .filter(F.col("_n") <= limit)
    )
    first = ranked_top_k(capped, _popular_first(), 2 * limit, "rank").withColumn(
        "reason", F.lit(FALLBACK_REASON)
    )
    rows = F.collect_list(F.struct("rank", F.struct(*_SHOWN).alias("row")))
    return first.agg(F.sort_array(rows)["row"]).scalar()


def _other_games(rows: Column, source: Column, limit: int) -> Column:
    return F.slice(F.filter(rows, lambda r: r["appid"] != source), 1, limit)


def fallback_for_all(
    sources: DataFrame, game_info: DataFrame, limit: int = FALLBACK_GAMES
) -> DataFrame:
    """The same for every source at once."""
    offered = sources.select(
        F.col("appid").alias("source_appid"), _short_list(game_info, limit).alias("rows")
    )
    others = _other_games(F.col("rows"), F.col("source_appid"), limit)
    return offered.select("source_appid", F.posexplode(others).alias("n", "r")).select(
        "source_appid", (F.col("n") + 1).alias("position"), "r.*"
    )


def recommendations(
    details: DataFrame, game_info: DataFrame, limit: int = FALLBACK_GAMES
) -> DataFrame:
    """For every game: its similar games, or the fallback where none is similar."""
    similar = similar_games(details, game_info).select(
        "source_appid", "position", F.struct(*_SHOWN).alias("found")
    )
    sources = details.select("appid").join(game_info.select("appid"), "appid", "full_outer")
    matched = sources.join(similar, sources["appid"] == similar["source_appid"], "left").select(
        sources["appid"].alias("source"),
        "position",
        "found",
        _short_list(game_info, limit).alias("rows"),
    )
    none_found = F.col("found").isNull()
    answer = F.when(none_found, _other_games(F.col("rows"), F.col("source"), limit)).otherwise(
        F.array("found")
    )
    return matched.select(
        F.col("source").alias("source_appid"),
        F.col("position").alias("_found_at"),
        F.posexplode(answer).alias("n", "r"),
    ).select("source_appid", F.coalesce("_found_at", F.col("n") + 1).alias("position"), "r.*")


def parse_recommendations(answers: DataFrame) -> DataFrame:
    """Recorded free-text answers (answer_id, content) to (answer_id, name, reason).

    Markdown fences go; an answer that is no JSON gives no rows; entries need a name.
    """
    parsed = F.from_json(strip_fences(F.col("content")), RECOMMENDATIONS)["recommendations"]
    return (
        answers.select("answer_id", F.posexplode(parsed).alias("n", "r"))
        .filter(F.col("r.name").isNotNull())
        .select(
            "answer_id",
            (F.col("n") + 1).alias("position"),
            F.col("r.name").alias("name"),
            F.coalesce("r.reason", F.lit(DEFAULT_REASON)).alias("reason"),
        )
    )


def recommended_games(answers: DataFrame, candidates: DataFrame) -> DataFrame:
    """The parsed answers joined to the candidates by exact name; the last reason counts."""
    parsed = parse_recommendations(answers)
    reasons = parsed.groupBy("answer_id", "name").agg(F.max_by("reason", "position").alias("reason"))
    shown = candidates.select(
        "appid", "name", F.concat_ws(", ", "genres").alias("genre"), "player_count", "review_score"
    )
    return reasons.join(shown, "name").select(
        "answer_id", "appid", "name", "genre", "player_count", "review_score", "reason"
    )
