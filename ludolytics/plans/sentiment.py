"""Reviews to sentiments, to games, to daily rankings and the report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.functions import clean_text, half_up, percent
from ludolytics.operators.lexicon import score_texts
from ludolytics.operators.ranking import ranked_top_k, top_k_per_group

# Fixed values of the daily run.
MIN_TEXT_LENGTH = 10
MIN_REVIEWS_PER_GAME = 5
MIN_REVIEWS_FOR_SCORE_RANKS = 10
MIN_REVIEWS_FOR_CONTROVERSY = 20
GAMES_PER_CATEGORY = 20
CATEGORIES = ("TOP_POSITIVE", "TOP_NEGATIVE", "CONTROVERSIAL", "MOST_REVIEWED")


def unscored_reviews(
    reviews: DataFrame, sentiments: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """Reviews with enough text that have no sentiment yet; max_rows makes a bounded run."""
    new = reviews.select("review_id").join(sentiments.select("review_id"), "review_id", "left_anti")
    fresh = (
        reviews.filter(F.col("review_text").isNotNull())
        .filter(F.length("review_text") > MIN_TEXT_LENGTH)
        .join(new.distinct(), "review_id", "left_semi")
        .select("review_id", "appid", "game_name", "review_text", "voted_up", "playtime_at_review")
    )
    return fresh if max_rows is None else fresh.orderBy("review_id").limit(max_rows)


def review_sentiments(
    reviews: DataFrame,
    lexicon: DataFrame,
    in_context: bool = True,
    max_chars: int | None = None,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """Polarity and label of each review; reviews without any text left are dropped."""
    cleaned = reviews.select(
        "review_id",
        "appid",
        "game_name",
        clean_text(F.col("review_text"), max_chars).alias("clean"),
    )
    ids = ["review_id", "appid", "game_name"]
    scored = score_texts(cleaned, ids, "clean", lexicon, in_context, modifiers)
    return scored.withColumnRenamed("text_length", "review_length").select(
        "review_id",
        "appid",
        "game_name",
        "sentiment_compound",
        "sentiment_positive",
        "sentiment_negative",
        "sentiment_neutral",
        "sentiment_label",
        "review_length",
    )


def game_sentiment_analysis(sentiments: DataFrame, analysis_date: date | str) -> DataFrame:
    """Sentiment per game over all stored reviews, for games with enough of them.

    The scores have four digits at most, so they are summed as decimals: the averages
    do not depend on the order of the rows. The name is a grouping column of the first
    aggregate, which keeps it a hash aggregate; a game with two names takes the one of
    more reviews.
    """
    scores = ("compound", "positive", "negative")
    per_name = sentiments.groupBy("appid", "game_name").agg(
        F.count(F.lit(1)).alias("reviews"),
        *[F.sum(F.col(f"sentiment_{s}").cast("decimal(10,4)")).alias(s) for s in scores],
        *[
            F.count_if(F.col("sentiment_label") == label).alias(label.lower() + "_reviews")
            for label in ("POSITIVE", "NEGATIVE", "NEUTRAL")
        ],
    )
    per_game = per_name.groupBy("appid").agg(
        F.max_by("game_name", F.struct("reviews", "game_name")).alias("game_name"),
        F.sum("reviews").alias("total_reviews_analyzed"),
        *[F.sum(s).alias(s) for s in scores],
        *[F.sum(f"{s}_reviews").alias(f"{s}_reviews") for s in ("positive", "negative", "neutral")],
    )
    total = F.col("total_reviews_analyzed")

    def average(name: str) -> Column:
        return F.col(name).cast("double") / total

    return per_game.filter(total >= MIN_REVIEWS_PER_GAME).select(
        "appid",
        "game_name",
        F.lit(str(analysis_date)).cast("date").alias("analysis_date"),
        total,
        *[average(s).alias(f"avg_sentiment_{s}") for s in scores],
        *[
            percent(F.col(f"{s}_reviews"), total, 2).alias(f"{s}_review_pct")
            for s in ("positive", "negative", "neutral")
        ],
        half_up(average("compound") * 50.0 + 50.0, 2).alias("sentiment_score"),
    )


def _day(games: DataFrame, trend_date: date | str) -> DataFrame:
    return games.filter(F.col("analysis_date") == F.lit(str(trend_date)).cast("date"))


def _category(name: str) -> tuple[Column, list[Column]]:
    """Which games take part in a category, and its order as ascending numbers."""
    reviews, score = F.col("total_reviews_analyzed"), F.col("sentiment_score")
    volume = -reviews.cast("double")
    rules = {
        "TOP_POSITIVE": (reviews >= MIN_REVIEWS_FOR_SCORE_RANKS, [-score, F.lit(0.0)]),
        "TOP_NEGATIVE": (reviews >= MIN_REVIEWS_FOR_SCORE_RANKS, [score, F.lit(0.0)]),
        "CONTROVERSIAL": (
            reviews >= MIN_REVIEWS_FOR_CONTROVERSY,
            [F.abs(F.col("positive_review_pct") - 50.0), volume],
        ),
        "MOST_REVIEWED": (F.lit(True), [volume, F.lit(0.0)]),
    }
    return rules[name]


def trend(
    games: DataFrame, category: str, trend_date: date | str, k: int = GAMES_PER_CATEGORY
) -> DataFrame:
    """The first k games of one category on one day."""
    takes_part, order = _category(category)
    chosen = _day(games, trend_date).filter(takes_part).select(
        F.col("analysis_date").alias("trend_date"),
        F.lit(category).alias("category"),
        "appid",
        "game_name",
        "sentiment_score",
        F.col("total_reviews_analyzed").alias("review_count"),
        order[0].alias("_first"),
        order[1].alias("_second"),
    )
    by = [F.asc_nulls_last("_first"), F.asc_nulls_last("_second"), F.col("appid")]
    return ranked_top_k(chosen, by, k, "rank_in_category").drop("_first", "_second")


def sentiment_trends(
    games: DataFrame, trend_date: date | str, k: int = GAMES_PER_CATEGORY
) -> DataFrame:
    """All four categories of a day from one pass over its games."""
    entries = []
    for name in CATEGORIES:
        takes_part, order = _category(name)
        entry = F.struct(
            F.lit(name).alias("category"), order[0].alias("_first"), order[1].alias("_second")
        )
        entries.append(F.when(takes_part, entry))
    listed = _day(games, trend_date).select(
        F.col("analysis_date").alias("trend_date"),
        "appid",
        "game_name",
        "sentiment_score",
        F.col("total_reviews_analyzed").alias("review_count"),
        F.inline(F.array_compact(F.array(*entries))),
    )
    by = [F.asc_nulls_last("_first"), F.asc_nulls_last("_second"), F.col("appid")]
    ranked = top_k_per_group(listed, ["category"], by, k, "rank_in_category")
    return ranked.select(
        "trend_date",
        "category",
        "appid",
        "game_name",
        "sentiment_score",
        "review_count",
        "rank_in_category",
    )


def trend_category_counts(trends: DataFrame, trend_date: date | str) -> DataFrame:
    day = trends.filter(F.col("trend_date") == F.lit(str(trend_date)).cast("date"))
    return day.groupBy("category").agg(F.count(F.lit(1)).alias("games"))


def report_summary(games: DataFrame, analysis_date: date | str) -> DataFrame:
    """One row on a day's games; zeros where there are none."""
    count = F.count(F.lit(1))

    def mean(name: str) -> Column:
        # Scores have two digits: decimal sums make the mean independent of row order.
        exact = F.sum(F.col(name).cast("decimal(10,2)")).cast("double")
        return half_up(F.coalesce(F.try_divide(exact, count.cast("double")), F.lit(0.0)), 2)

    return _day(games, analysis_date).agg(
        F.countDistinct("appid").alias("games_analyzed"),
        F.coalesce(F.sum("total_reviews_analyzed"), F.lit(0)).alias("total_reviews"),
        mean("sentiment_score").alias("avg_sentiment_score"),
        mean("positive_review_pct").alias("avg_positive_pct"),
    )


def report_top(trends: DataFrame, trend_date: date | str, k: int = 5) -> DataFrame:
    """The first k games of the positive and the negative ranking."""
    ranked = F.col("rank_in_category") <= k
    chosen = F.col("category").isin("TOP_POSITIVE", "TOP_NEGATIVE")
    day = F.col("trend_date") == F.lit(str(trend_date)).cast("date")
    return trends.filter(day & chosen & ranked).select(
        "category",
        F.col("rank_in_category").alias("position"),
        F.col("game_name").alias("game"),
        F.round("sentiment_score", 2).alias("score"),
        F.col("review_count").alias("reviews"),
    )
