"""The scheduled runs: marts and sentiments, each safe to run again."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ludolytics.functions import ntz
from ludolytics.plans import ingest, marts, sentiment
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import (
    ChangeTable,
    append,
    read_latest,
    read_table,
    replace_date,
    replace_table,
    upsert_date,
    with_stamps,
)


def run_popular_games(
    spark: SparkSession, counts: DataFrame, root: str, version: date | datetime | str | None = None
) -> DataFrame:
    """Appends the latest snapshot to the history once; gives the current ranking.

    With a version, the ranking is stored under it as well, for readers of POPULAR_GAMES.
    """
    history = read_table(spark, S.POPULAR_GAMES_HISTORICAL, root)
    new = marts.new_history_rows(history, marts.popular_games_snapshot(counts))
    append(new, S.POPULAR_GAMES_HISTORICAL, root, date_of="fetched_at")
    current = marts.popular_games(read_table(spark, S.POPULAR_GAMES_HISTORICAL, root))
    if version is None:
        return current
    replace_table(current, S.POPULAR_GAMES, root, version)
    return read_latest(spark, S.POPULAR_GAMES, root)


def run_recent_reviews(
    spark: SparkSession, reviews: DataFrame, root: str, version: date | datetime | str
) -> DataFrame:
    """Stores the latest reviews of each game under a version; a repeated run replaces its own."""
    replace_table(marts.recent_reviews(reviews), S.RECENT_REVIEWS, root, version)
    return read_latest(spark, S.RECENT_REVIEWS, root)


def run_reviews(
    spark: SparkSession,
    pages: DataFrame,
    names: DataFrame,
    root: str,
    run: str,
    as_of: datetime | str,
    language: str | None = None,
) -> DataFrame:
    """Merges landed review pages into GAME_REVIEWS; `run` names the run, which replaces itself when repeated."""
    table = ChangeTable(spark, S.GAME_REVIEWS, root)
    table.write(ingest.normalised_reviews(pages, names, language=language), ntz(as_of), run, 0)
    return table.read()


def run_details(
    spark: SparkSession, documents: DataFrame, root: str, run: str, as_of: datetime | str
) -> DataFrame:
    """The same for store documents and GAME_DETAILS."""
    table = ChangeTable(spark, S.GAME_DETAILS, root)
    table.write(ingest.normalised_details(documents), ntz(as_of), run, 0)
    return table.read()


def run_sentiment(
    spark: SparkSession,
    reviews: DataFrame,
    lexicon: DataFrame,
    root: str,
    day: date | str,
    as_of: datetime | str,
    max_reviews: int | None = None,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """Scores new reviews, then rebuilds the day's games, rankings and report."""
    now = ntz(as_of)
    scored = read_table(spark, S.REVIEW_SENTIMENTS, root)
    fresh = sentiment.unscored_reviews(reviews, scored, max_reviews)
    sentiments = sentiment.review_sentiments(fresh, lexicon, modifiers=modifiers)
    new = with_stamps(sentiments, S.REVIEW_SENTIMENTS, now)
    append(new, S.REVIEW_SENTIMENTS, root, date_of="processed_at")

    stored = read_table(spark, S.REVIEW_SENTIMENTS, root)
    games = sentiment.game_sentiment_analysis(stored, day)
    upsert_date(
        spark, games, S.GAME_SENTIMENT_ANALYSIS, root, day, "analysis_date", now
    )
    analysed = read_table(spark, S.GAME_SENTIMENT_ANALYSIS, root)
    trends = with_stamps(sentiment.sentiment_trends(analysed, day), S.SENTIMENT_TRENDS, now)
    replace_date(trends, S.SENTIMENT_TRENDS, root, "trend_date", day)
    return sentiment.report_summary(analysed, day)
