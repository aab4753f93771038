"""Every query by name, as a function of (spark, sf_dir) over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.functions import clean_text, ntz
from ludolytics.operators import checks
from ludolytics.operators.publish import id_batches, key_of, publishable, to_messages
from ludolytics.operators.sketches import distinct_counts, relative_error, sketches
from ludolytics.operators.upsert import upsert
from ludolytics.plans import dashboard, ingest, marts, quality, recommend, sentiment, views
from ludolytics.sources import bindings as B
from ludolytics.sources import documents as D
from ludolytics.sources import schemas as S

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = B.AS_OF
DAY = B.ANALYSIS_DATE
TAG = "Brand#2"
GENRE = "ECONOMY"
USER = "42"
GAME = 7
TRACKED = 2000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Registers a query under the name of its function; sessions run in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


# ---- views --------------------------------------------------------------------


@query
def q01_games_by_tag(spark, sf):
    return views.games_by_tag(B.game_info(spark, sf))


@query
def q02_live_leaderboard(spark, sf):
    return views.live_leaderboard(B.game_info(spark, sf))


@query
def q03_top_games_by_tag(spark, sf):
    return views.top_games_by_tag(B.game_info(spark, sf))


@query
def q04_user_game_summary(spark, sf):
    return views.user_game_summary(
        B.player_stats(spark, sf), B.players(spark, sf), B.game_info(spark, sf)
    )


@query
def q05_game_sentiment_summary(spark, sf):
    return views.game_sentiment_summary(B.game_reviews(spark, sf))


@query
def q06_player_counts_live(spark, sf):
    return views.player_counts_live(B.game_player_counts(spark, sf), AS_OF)


@query
def q07_player_counts_timeseries(spark, sf):
    return views.player_counts_timeseries(B.game_player_counts(spark, sf))


# ---- marts --------------------------------------------------------------------


@query
def q08_popular_games_historical(spark, sf):
    return marts.popular_games_snapshot(B.count_snapshots(spark, sf))


@query
def q08_popular_games_backfill(spark, sf):
    return marts.popular_games_history(B.count_snapshots(spark, sf))


@query
def q09_popular_games(spark, sf):
    return marts.popular_games(marts.popular_games_history(B.count_snapshots(spark, sf)))


@query
def q10_recent_reviews(spark, sf):
    return marts.recent_reviews(B.game_reviews(spark, sf))


# ---- sentiment ------------------------------------------------------------------


def _sentiments(spark, sf, in_context=True):
    return sentiment.review_sentiments(
        B.game_reviews(spark, sf).filter(F.length("review_text") > sentiment.MIN_TEXT_LENGTH),
        B.lexicon(spark, sf),
        in_context,
        modifiers=B.modifiers(spark, sf),
    )


def _games(spark, sf):
    return sentiment.game_sentiment_analysis(_sentiments(spark, sf), DAY)


def _trends(spark, sf):
    return sentiment.sentiment_trends(_games(spark, sf), DAY)


@query
def q11_unscored_reviews(spark, sf):
    return sentiment.unscored_reviews(B.game_reviews(spark, sf), B.scored_reviews(spark, sf))


@query
def q12_review_sentiments(spark, sf):
    return _sentiments(spark, sf)


@query
def q13_game_sentiment_analysis(spark, sf):
    return _games(spark, sf)


@query
def q14_trends_top_positive(spark, sf):
    return sentiment.trend(_games(spark, sf), "TOP_POSITIVE", DAY)


@query
def q15_trends_top_negative(spark, sf):
    return sentiment.trend(_games(spark, sf), "TOP_NEGATIVE", DAY)


@query
def q16_trends_controversial(spark, sf):
    return sentiment.trend(_games(spark, sf), "CONTROVERSIAL", DAY)


@query
def q17_trends_most_reviewed(spark, sf):
    return sentiment.trend(_games(spark, sf), "MOST_REVIEWED", DAY)


@query
def q17_sentiment_trends(spark, sf):
    return _trends(spark, sf)


@query
def q18_trend_category_counts(spark, sf):
    return sentiment.trend_category_counts(_trends(spark, sf), DAY)


@query
def q19_sentiment_report_summary(spark, sf):
    return sentiment.report_summary(_games(spark, sf), DAY)


@query
def q20_sentiment_report_top5(spark, sf):
    return sentiment.report_top(_trends(spark, sf), DAY)


# ---- dashboard ------------------------------------------------------------------


@query
def q21_leaderboard(spark, sf):
    return dashboard.leaderboard(B.game_player_counts(spark, sf), AS_OF)


@query
def q21_leaderboard_with_marks(spark, sf):
    return dashboard.with_trend_marks(
        dashboard.leaderboard(B.game_player_counts(spark, sf), AS_OF)
    )


@query
def q22_leaderboard_metrics(spark, sf):
    return dashboard.leaderboard_metrics(
        dashboard.leaderboard(B.game_player_counts(spark, sf), AS_OF)
    )


@query
def q23_games_for_tag(spark, sf):
    return dashboard.games_for_tag(B.game_info(spark, sf), TAG)


@query
def q23_games_for_all_tags(spark, sf):
    return dashboard.games_for_all_tags(B.game_info(spark, sf))


@query
def q24_tag_list(spark, sf):
    return dashboard.tag_list(B.game_info(spark, sf))


@query
def q25_available_tags(spark, sf):
    return dashboard.available_tags(B.game_info(spark, sf))


@query
def q26_user_profile(spark, sf):
    return dashboard.user_profile(
        B.player_stats(spark, sf), B.players(spark, sf), B.game_info(spark, sf), USER
    )


@query
def q26_user_profiles(spark, sf):
    return dashboard.user_profiles(
        B.player_stats(spark, sf), B.players(spark, sf), B.game_info(spark, sf)
    )


@query
def q27_sample_users(spark, sf):
    return dashboard.sample_users(B.players(spark, sf))


@query
def q28_user_totals(spark, sf):
    return dashboard.user_totals(B.player_stats(spark, sf))


@query
def q29_game_sentiments(spark, sf):
    return dashboard.game_sentiments(_games(spark, sf))


@query
def q30_sentiment_metrics(spark, sf):
    return dashboard.sentiment_metrics(dashboard.game_sentiments(_games(spark, sf)))


@query
def q31_review_samples(spark, sf):
    return dashboard.review_samples(B.game_reviews(spark, sf), GAME)


@query
def q31_review_samples_per_game(spark, sf):
    return dashboard.review_samples_per_game(B.game_reviews(spark, sf))


@query
def q36_live_player_counts(spark, sf):
    return dashboard.live_counts(B.game_player_counts(spark, sf), AS_OF)


@query
def q37_catalogue_size(spark, sf):
    return dashboard.catalogue_size(B.game_info(spark, sf))


# ---- recommendations --------------------------------------------------------------


def _joined_genres(df):
    return df.withColumn("genres", F.concat_ws(", ", "genres"))


@query
def q32_recommend_source(spark, sf):
    return _joined_genres(
        recommend.source_games(B.game_details(spark, sf), B.game_info(spark, sf))
    )


@query
def q33_recommend_candidates(spark, sf):
    found = recommend.candidate_games(B.game_details(spark, sf), B.game_info(spark, sf))
    return _joined_genres(recommend.without_source(found, GAME).drop("tags"))


@query
def q34_recommend_similar(spark, sf):
    return recommend.recommendations(B.game_details(spark, sf), B.game_info(spark, sf))


@query
def q35_recommend_fallback(spark, sf):
    return recommend.fallback_games(B.game_info(spark, sf), GAME)


@query
def q35_recommend_fallback_for_all(spark, sf):
    info = B.game_info(spark, sf)
    return recommend.fallback_for_all(info.select("appid"), info)


# ---- data quality -----------------------------------------------------------------


def _facts(spark, sf):
    tables = {
        "GAME_INFO": B.game_info(spark, sf),
        "GAME_PLAYER_COUNTS": B.game_player_counts(spark, sf),
        "GAME_REVIEWS": B.game_reviews(spark, sf),
        "GAME_DETAILS": B.game_details(spark, sf),
        "PLAYERS": B.players(spark, sf),
        "PLAYER_STATS": B.player_stats(spark, sf),
    }
    return checks.collect_facts(spark, tables, quality.EXPECTATIONS)


@query
def q38_dq_freshness(spark, sf):
    return checks.freshness(_facts(spark, sf), AS_OF)


@query
def q39_dq_row_counts(spark, sf):
    return checks.row_counts(_facts(spark, sf))


@query
def q40_dq_null_pct(spark, sf):
    return checks.null_percentages(_facts(spark, sf))


@query
def q41_dq_report(spark, sf):
    return quality.quality_report(_facts(spark, sf), AS_OF)


@query
def q42_dq_alerts(spark, sf):
    return quality.quality_alerts(_facts(spark, sf), AS_OF)


# ---- ingest -----------------------------------------------------------------------


def _flat(df):
    """Maps and arrays as text, so that two engines can compare them."""
    for name, kind in df.dtypes:
        if kind.startswith("map"):
            df = df.withColumn(name, F.to_json(name))
        elif kind.startswith("array"):
            df = df.withColumn(name, F.concat_ws(", ", name))
    return df


@query
def q43_ingest_players(spark, sf):
    return ingest.stamped(ingest.players_from_messages(D.player_messages(spark, sf)), AS_OF)


@query
def q44_ingest_games(spark, sf):
    return ingest.stamped(ingest.games_from_messages(D.game_messages(spark, sf)), AS_OF)


@query
def q45_ingest_game_info(spark, sf):
    rows = ingest.game_info_from_messages(D.game_info_messages(spark, sf))
    return _flat(ingest.stamped(rows, AS_OF))


@query
def q46_ingest_stats(spark, sf):
    return ingest.stamped(ingest.stats_from_messages(D.stats_messages(spark, sf)), AS_OF)


@query
def q47_upsert_game_info(spark, sf):
    arriving = ingest.prepared_game_info(D.arriving_game_info(spark, sf), AS_OF)
    return _flat(upsert(D.stored_game_info(spark, sf), arriving, S.GAME_INFO.keys, ntz(AS_OF)))


@query
def q48_upsert_reviews(spark, sf):
    names = B.game_info(spark, sf)
    arriving = ingest.normalised_reviews(D.review_pages(spark, sf), names)
    return upsert(
        D.stored_reviews(spark, sf),
        arriving,
        S.GAME_REVIEWS.keys,
        ntz(AS_OF),
        update_cols=S.GAME_REVIEWS.update_cols,
    )


@query
def q49_upsert_details(spark, sf):
    arriving = ingest.normalised_details(D.detail_documents(spark, sf))
    merged = upsert(
        D.stored_details(spark, sf),
        arriving,
        S.GAME_DETAILS.keys,
        ntz(AS_OF),
        update_cols=S.GAME_DETAILS.update_cols,
    )
    return _flat(merged)


@query
def q50_ingest_player_counts(spark, sf):
    return ingest.count_samples(D.count_documents(spark, sf), B.game_info(spark, sf))


@query
def q51_tracked_games(spark, sf):
    return marts.games_to_track(B.game_info(spark, sf), TRACKED)


@query
def q52_publish_records(spark, sf):
    rows = publishable(B.game_info(spark, sf), published=D.stored_game_info(spark, sf))
    messages = to_messages(rows, key_of("appid"), S.TOPICS["game_info"])
    return messages.select(
        "topic",
        "key",
        F.get_json_object("value", "$.name").alias("name"),
        F.get_json_object("value", "$.ccu").alias("ccu"),
        F.get_json_object("value", "$.price").alias("price"),
    )


@query
def q53_review_summary(spark, sf):
    return ingest.review_summaries(D.summary_documents(spark, sf))


@query
def q54_games_by_genre(spark, sf):
    return marts.games_by_genre(B.game_info(spark, sf), GENRE)


@query
def q54_games_with_tag(spark, sf):
    return marts.games_with_tag(B.game_info(spark, sf), TAG)


@query
def q50_ingest_player_counts_with_failures(spark, sf):
    return ingest.count_samples(D.failing_count_documents(spark, sf), B.game_info(spark, sf))


@query
def q53_review_summary_with_failures(spark, sf):
    return ingest.review_summaries(D.failing_summary_documents(spark, sf))


@query
def q55_ranking_rows(spark, sf):
    rows = ingest.ranking_rows(D.ranking_documents(spark, sf), AS_OF)
    return rows.select("list_name", "position", "appid", "name", "ccu", "price", "fetched_at", "source")


@query
def q56_player_summaries(spark, sf):
    rows = ingest.player_summaries(D.player_documents(spark, sf), AS_OF)
    return rows.select("steamid", "personaname", "loccityid", "fetched_at", "source")


@query
def q57_owned_games(spark, sf):
    rows = ingest.owned_games(D.played_documents(spark, sf), AS_OF)
    return rows.select("steamid", "appid", "name", "playtime_forever", "fetched_at", "source")


@query
def q57_recent_games(spark, sf):
    rows = ingest.recent_games(D.played_documents(spark, sf, recent=True), AS_OF)
    return rows.select("steamid", "appid", "name", "playtime_2weeks", "data_type", "source")


@query
def q58_id_batches(spark, sf):
    ids = F.split("ids", ",")
    lists = id_batches(B.players(spark, sf), "steamid")
    return lists.select((F.size(ids) <= 100).alias("fits"), F.explode(ids).alias("steamid"))


@query
def q59_catalogue(spark, sf):
    return marts.catalogue_up_to(D.catalogue_pages(spark, sf), TRACKED)


@query
def q60_reviews_in_language(spark, sf):
    rows = ingest.normalised_reviews(D.review_pages(spark, sf), B.game_info(spark, sf), language="en")
    return rows.select("review_id", "appid", "game_name", "language", "review_text")


def _before_the_last(rows):
    """What earlier cycles have stored: all rows but those of the latest one."""
    return rows.filter(F.col("fetched_at") < rows.agg(F.max("fetched_at")).scalar())


@query
def q61_new_history_rows(spark, sf):
    history = marts.popular_games_history(B.count_snapshots(spark, sf))
    return marts.new_history_rows(_before_the_last(history), history)


@query
def q62_new_samples(spark, sf):
    samples = ingest.count_samples(D.count_documents(spark, sf), B.game_info(spark, sf))
    return ingest.new_samples(_before_the_last(samples), samples)


@query
def q63_upsert_game_sentiments(spark, sf):
    games = _games(spark, sf)
    counted = B.game_info(spark, sf).filter("ccu IS NOT NULL").select("appid")
    old = games.join(counted, "appid", "left_semi").withColumn("total_reviews_analyzed", F.lit(0).cast("long"))
    yesterday = old.withColumn("analysis_date", F.date_sub("analysis_date", 1))
    keys = S.GAME_SENTIMENT_ANALYSIS.keys
    return upsert(old.unionByName(yesterday), games, keys, ntz(AS_OF), order=["analysis_date"])


@query
def q64_publish_given_games(spark, sf):
    info = B.game_info(spark, sf).drop("tags", "fetched_at", "updated_at")
    rows = publishable(info, appids=B.count_snapshots(spark, sf))
    return to_messages(rows, key_of("appid"), S.TOPICS["game_info"])


@query
def q65_distinct_games_by_sketch(spark, sf):
    """Exact numbers of games per source, and whether the estimate from daily sketches is as near as it says."""
    counts = B.game_player_counts(spark, sf)
    daily = sketches(counts, ["source", F.to_date("fetched_at").alias("day")], "appid")
    exact = counts.groupBy("source").agg(F.countDistinct("appid").alias("n_games"))
    off = F.abs(F.col("n_distinct") - F.col("n_games"))
    return exact.join(distinct_counts(daily, ["source"]), "source").select(
        "source", "n_games", (off <= F.col("n_games") * relative_error()).alias("near")
    )


# ---- text -------------------------------------------------------------------------


@query
def x1_clean_text(spark, sf):
    reviews = B.game_reviews(spark, sf)
    return reviews.select("review_id", clean_text(F.col("review_text")).alias("clean"))


@query
def z1_lexicon_sentiment(spark, sf):
    return _sentiments(spark, sf, in_context=False)


@query
def z2_content_similarity(spark, sf):
    return recommend.similar_games(B.game_details(spark, sf), B.game_info(spark, sf))


@query
def z3_parse_recommendations(spark, sf):
    return recommend.parse_recommendations(D.recorded_answers(spark, sf))


@query
def z3_recommended_games(spark, sf):
    found = recommend.candidate_games(B.game_details(spark, sf), B.game_info(spark, sf))
    return recommend.recommended_games(D.recorded_answers(spark, sf), found)
