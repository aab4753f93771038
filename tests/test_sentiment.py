import math

import pytest
from pyspark.sql import functions as F

from ludolytics.operators.lexicon import score_texts, sentiment_label
from ludolytics.plans import dashboard, sentiment

WORDS = {"good": 2.0, "bad": -2.0, "flat": 0.0}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(WORDS.items()), "token string, valence double")


def scores(spark, lexicon, texts, in_context=True):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return {r.id: r for r in score_texts(df, ["id"], "t", lexicon, in_context).collect()}


def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


def test_plain_scores(spark, lexicon):
    got = scores(spark, lexicon, ["good day", "bad bad", "nothing here", "...", ""], False)
    assert got[0].sentiment_compound == compound(2.0)
    assert (got[0].sentiment_positive, got[0].sentiment_neutral) == (0.75, 0.25)
    assert got[1].sentiment_compound == compound(-4.0)
    assert got[1].sentiment_label == "NEGATIVE" and got[1].sentiment_negative == 1.0
    assert got[2].sentiment_compound == 0.0 and got[2].sentiment_neutral == 1.0
    assert got[3].sentiment_compound == 0.0 and got[3].sentiment_neutral == 0.0
    assert 4 not in got


def test_context(spark, lexicon):
    cases = {
        "very good": 2.293,
        "very nice good": 2 + 0.293 * 0.95,
        "very a b good": 2 + 0.293 * 0.9,
        "very a b c good": 2.0,
        "slightly bad": -2 + 0.293,
        "very bad": -2.293,
        "not good": -0.74 * 2,
        "don't a b good": -0.74 * 2,
        "not a b c good": 2.0,
        "not very good": -0.74 * 2.293,
        "flat": 0.0,
    }
    got = scores(spark, lexicon, list(cases))
    for n, (text, s) in enumerate(cases.items()):
        assert got[n].sentiment_compound == compound(s), text


def test_a_table_of_modifiers(spark, lexicon):
    rows = [("molto", 0.2, False), ("molto", 0.1, False), ("mai", 0.0, True), (None, 1.0, True)]
    table = spark.createDataFrame(rows, "token string, intensity double, negates boolean")
    cases = {"molto good": 2.2, "mai good": -1.48, "very good": 2.0, "mai a b c good": 2.0, "isn't good": -1.48}
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    got = {r.id: r.sentiment_compound for r in score_texts(df, ["id"], "t", lexicon, modifiers=table).collect()}
    assert got == {n: compound(s) for n, s in enumerate(cases.values())}
    none = score_texts(df, ["id"], "t", lexicon, modifiers=table.filter("false")).collect()
    assert {r.sentiment_compound for r in none if r.id < 4} == {compound(2.0)}


def test_context_changes_the_registered_scores(spark, sf_dir):
    from ludolytics.registry import QUERIES

    scored = QUERIES["q12_review_sentiments"](spark, sf_dir).select("review_id", "sentiment_compound")
    plain = QUERIES["z1_lexicon_sentiment"](spark, sf_dir).select("review_id", F.col("sentiment_compound").alias("plain"))
    both = scored.join(plain, "review_id")
    changed = both.filter("sentiment_compound <> plain").count()
    assert changed > both.count() / 4


def test_shares_add_up(spark, lexicon):
    texts = ["good bad flat word", "good good good", "word", "bad word word word word word word"]
    for r in scores(spark, lexicon, texts).values():
        total = r.sentiment_positive + r.sentiment_negative + r.sentiment_neutral
        assert abs(total - 1) < 0.002


def test_a_shuffled_lexicon_gives_the_same(spark, lexicon):
    texts = ["good day", "bad bad", "nothing here"]
    expected = scores(spark, lexicon, texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert scores(spark, lexicon, texts) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_label_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,)], "c double")
    got = [r[0] for r in df.select(sentiment_label(F.col("c"))).collect()]
    assert got == ["POSITIVE", "NEUTRAL", "NEGATIVE", "NEUTRAL"]


def test_unscored_and_cleaned(spark, lexicon):
    rows = [
        ("null", None),
        ("ten", "0123456789"),
        ("eleven", "01234567890"),
        ("url", "https://example.com/x"),
        ("done", "already scored"),
        ("long", "good " * 3000),
    ]
    df = spark.createDataFrame(rows, "review_id string, review_text string").select(
        "review_id",
        F.lit(1).alias("appid"),
        F.lit("g").alias("game_name"),
        "review_text",
        F.lit(True).alias("voted_up"),
        F.lit(1).alias("playtime_at_review"),
    )
    scored = spark.createDataFrame([("done",)], "review_id string")
    fresh = sentiment.unscored_reviews(df, scored)
    assert {r.review_id for r in fresh.collect()} == {"eleven", "url", "long"}
    assert sentiment.unscored_reviews(df, scored, max_rows=2).count() == 2
    got = {r.review_id: r for r in sentiment.review_sentiments(fresh, lexicon).collect()}
    assert got.keys() == {"eleven", "long"}
    assert got["long"].review_length == 14999
    cut = sentiment.review_sentiments(fresh, lexicon, max_chars=5000).filter("review_id = 'long'")
    assert cut.first().review_length == 5000


def test_minimum_numbers_of_reviews(spark):
    rows = [
        (n, f"g{n}", float(i % 3 - 1) / 10, label)
        for n in (4, 5, 9, 10, 19, 20)
        for i, label in enumerate((["POSITIVE", "NEGATIVE"] * 10)[:n])
    ]
    df = spark.createDataFrame(
        rows, "appid int, game_name string, sentiment_compound double, sentiment_label string"
    ).withColumns({"sentiment_positive": F.lit(0.1), "sentiment_negative": F.lit(0.2)})
    games = sentiment.game_sentiment_analysis(df, "2024-01-01")
    assert {r.appid for r in games.collect()} == {5, 9, 10, 19, 20}
    trends = sentiment.sentiment_trends(games, "2024-01-01").collect()
    members = {}
    for r in trends:
        members.setdefault(r.category, {})[r.rank_in_category] = r.appid
    assert set(members["TOP_POSITIVE"].values()) == {10, 19, 20}
    assert members["CONTROVERSIAL"] == {1: 20}
    assert members["MOST_REVIEWED"] == {1: 20, 2: 19, 3: 10, 4: 9, 5: 5}
    for category, ranks in members.items():
        one = sentiment.trend(games, category, "2024-01-01").collect()
        assert {r.rank_in_category: r.appid for r in one} == ranks
    assert sentiment.sentiment_trends(games, "2024-01-02").count() == 0


def test_two_names_give_one_game(spark):
    rows = [(1, "new", 0.5)] * 4 + [(1, "old", 0.1)] * 2
    df = spark.createDataFrame(
        rows, "appid int, game_name string, sentiment_compound double"
    ).withColumns(
        {
            "sentiment_label": F.lit("POSITIVE"),
            "sentiment_positive": F.lit(0.1),
            "sentiment_negative": F.lit(0.2),
        }
    )
    (r,) = sentiment.game_sentiment_analysis(df, "2024-01-01").collect()
    assert (r.game_name, r.total_reviews_analyzed, r.positive_review_pct) == ("new", 6, 100.0)
    assert r.sentiment_score == round(2.2 / 6 * 50 + 50, 2)


def test_only_the_latest_analysis_is_shown(spark):
    games = spark.createDataFrame(
        [(1, "2024-01-01", 90.0), (2, "2024-01-02", 10.0), (3, "2024-01-02", 20.0)],
        "appid int, d string, sentiment_score double",
    ).select(
        "appid",
        F.lit("g").alias("game_name"),
        F.col("d").cast("date").alias("analysis_date"),
        F.lit(7).alias("total_reviews_analyzed"),
        F.lit(0.12345).alias("avg_sentiment_compound"),
        F.lit(50.0).alias("positive_review_pct"),
        F.lit(50.0).alias("negative_review_pct"),
        "sentiment_score",
    )
    assert [r.game_id for r in dashboard.game_sentiments(games, 5).collect()] == [3, 2]
    metrics = dashboard.sentiment_metrics(dashboard.game_sentiments(games, 5)).first()
    assert (metrics.avg_score, metrics.total_reviews) == (15.0, 14)


def test_empty_day(spark):
    empty = spark.createDataFrame(
        [],
        "appid int, analysis_date date, total_reviews_analyzed int, sentiment_score double, "
        "positive_review_pct double",
    )
    assert tuple(sentiment.report_summary(empty, "2024-01-01").first()) == (0, 0, 0.0, 0.0)
