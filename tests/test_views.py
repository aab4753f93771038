"""Hand-made edge rows with expected values worked out by hand."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ludolytics.plans import dashboard, marts, views

AS_OF = "2024-01-10 12:00:00"
NOW = datetime(2024, 1, 10, 12)
INFO = (
    "appid int, name string, developer string, publisher string, owners string, price string, "
    "ccu int, positive int, negative int, genre string, tags string, fetched_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)


def info(spark, rows):
    """rows: (appid, name, price, ccu, positive, negative, tags)"""
    full = [
        (a, n, "d", "p", "1k", price, ccu, pos, neg, "RPG, Action", tags, NOW, NOW)
        for a, n, price, ccu, pos, neg, tags in rows
    ]
    return spark.createDataFrame(full, INFO)


def test_tags(spark):
    df = info(
        spark,
        [
            (1, "a", None, 5, 1, 1, None),
            (2, "b", "", 5, 1, 1, "[]"),
            (3, "c", "0", 5, 1, 1, "{}"),
            (4, None, "999", None, 0, 0, '{"X": 7, "Y": 7}'),
            (5, "e", "abc", 9, 3, 1, '{"X": 1, "Z": "many"}'),
        ],
    )
    got = {(r.tag_name, r.appid): r for r in views.games_by_tag(df).collect()}
    assert got.keys() == {("X", 4), ("Y", 4), ("X", 5), ("Z", 5)}
    assert got["X", 4].tag_votes == got["Y", 4].tag_votes == 7
    assert got["Z", 5].tag_votes is None
    assert (got["X", 4].price_cents, got["X", 5].price_cents) == (999, None)
    top = {(r.tag_name, r.appid): r.rank_in_tag for r in views.top_games_by_tag(df).collect()}
    assert (top["X", 5], top["X", 4]) == (1, 2)
    as_map = df.withColumn("tags", F.from_json("tags", "map<string,int>"))
    assert views.games_by_tag(as_map).filter("appid = 4").count() == 2
    tags = [r.tag_name for r in dashboard.available_tags(df, min_games=2).collect()]
    assert tags == ["X"]


def test_leaderboard_prices_and_scores(spark):
    df = info(
        spark,
        [
            (1, "a", None, 1, 0, 0, None),
            (2, None, "1", 1, 1, 1, None),
            (3, "c", "1000", None, 2, 1, None),
            (4, "d", "0", 1, 1, 0, None),
        ],
    )
    got = {r.game_id: (r.current_price, r.review_score_pct) for r in views.live_leaderboard(df).collect()}
    assert got == {1: ("Free", None), 3: ("$10.00", 66.7), 4: ("Free", 100.0)}


def counts(spark, rows):
    """rows: (appid, name, count, hours before AS_OF)"""
    full = [
        (str(i), a, n, c, NOW - timedelta(hours=h), "s") for i, (a, n, c, h) in enumerate(rows)
    ]
    return spark.createDataFrame(
        full,
        "record_id string, appid int, game_name string, live_player_count int, "
        "fetched_at timestamp_ntz, source string",
    )


def test_live_counts(spark):
    df = counts(
        spark,
        [
            (1, "old", 50, 30),
            (2, "edge", 10, 24),
            (2, "edge", 10, 24.001),
            (3, "up", 100, 3),
            (3, "up", 130, 1),
            (4, "down", 100, 3),
            (4, "down", 70, 1),
            (5, "same", 100, 3),
            (5, "same", 100, 1),
            (6, "tie", 5, 1),
            (6, "tie", 9, 1),
            (7, "first", 8, 5),
            (7, "second", 8, 2),
            (8, "none", None, 1),
        ],
    )
    got = {r.game_id: r for r in views.player_counts_live(df, AS_OF).collect()}
    assert got[1].trend == "N/A" and got[1].avg_players_24h is None
    assert got[2].data_points == 2 and got[2].avg_players_24h == 10.0
    assert [got[i].trend for i in (3, 4, 5)] == ["UP", "DOWN", "STABLE"]
    assert got[6].current_players == 9 and got[6].peak_players == 9
    assert got[7].game_name == "second" and got[7].data_points == 2
    assert got[8].current_players is None and got[8].trend == "N/A"
    board = dashboard.leaderboard(df, AS_OF, 3)
    assert [r.game_id for r in board.collect()] == [3, 5, 4]
    metrics = dashboard.leaderboard_metrics(board).first()
    assert (metrics.total_players, metrics.up_count, metrics.down_count) == (300, 1, 1)
    assert 8 in [r.game_id for r in dashboard.live_counts(df, AS_OF, 20).collect()]


def test_trend_at_the_thresholds(spark):
    # Mean of 24 h: 20 and 24 give 22 (above by less than a tenth); 0.9 of 20 is 18.
    df = counts(spark, [(1, "a", 18, 2), (1, "a", 22, 1), (2, "b", 22, 2), (2, "b", 18, 1)])
    got = {r.game_id: r.trend for r in views.player_counts_live(df, AS_OF).collect()}
    assert got == {1: "STABLE", 2: "STABLE"}


def test_user_queries(spark):
    stats = spark.createDataFrame(
        [("1", 1, "g1", 60, 0), ("1", 2, "g2", 120, 30), ("1", 3, None, 999, 9), ("2", 1, "g1", 6, 6)],
        "steamid string, appid int, name string, playtime_forever int, playtime_2weeks int",
    ).withColumn("rtime_last_played", F.lit(NOW))
    players = spark.createDataFrame([("1", "Ann"), ("3", None)], "steamid string, personaname string")
    games = info(spark, [(1, "a", None, 1, 1, 1, None)])
    one = dashboard.user_profile(stats, players, games, "1", 1).collect()
    assert [(r.game_id, r.personaname, r.game_tag) for r in one] == [(2, "Ann", None)]
    totals = {r.steamid: tuple(r)[1:] for r in dashboard.user_totals(stats).collect()}
    assert totals == {"1": (2, 3.0, 0.5), "2": (1, 0.1, 0.1)}
    assert [r.steamid for r in dashboard.sample_users(players).collect()] == ["1"]
    summary = views.user_game_summary(stats, players, games).collect()
    assert len(summary) == 3


def test_votes_missing(spark):
    df = spark.createDataFrame(
        [(1, "g", True, 10), (1, "g", None, 20), (1, "g", False, 60)],
        "appid int, game_name string, voted_up boolean, playtime_at_review int",
    ).withColumn("timestamp_created", F.lit(NOW))
    r = views.game_sentiment_summary(df).first()
    assert (r.total_reviews, r.positive_count, r.negative_count, r.positive_pct) == (3, 1, 1, 33.3)


def test_snapshot_is_appended_once(spark):
    df = counts(spark, [(1, "a", 5, 1), (2, "b", 7, 1), (3, "c", None, 1), (1, "a", 99, 2)])
    snapshot = marts.popular_games_snapshot(df, 2)
    assert [(r.appid, r.ranking) for r in snapshot.collect()] == [(2, 1), (1, 2)]
    assert marts.new_history_rows(snapshot, snapshot).count() == 0
    assert marts.popular_games_history(df, 2).count() == 3


def test_tracked_games_count_once_at_their_best_place(spark):
    def ranking(ids):
        return spark.createDataFrame([(i + 1, a) for i, a in enumerate(ids)], "position int, appid int")

    got = marts.tracked_games([ranking([5, 6]), ranking([7, 5])], ranking([9, 6]), 4).collect()
    assert [(r.appid, r.best_position) for r in got] == [(5, 1), (7, 1), (6, 2), (9, 101)]
    pages = spark.createDataFrame([(1, 1, 3), (0, 2, 2), (0, 1, 1)], "page int, position int, appid int")
    assert [r.appid for r in marts.catalogue_up_to(pages, 2).collect()] == [1, 2]
    names = spark.createDataFrame([(5, "five")], "appid int, name string")
    named = marts.games_with_names(spark.createDataFrame([(5,), (6,)], "appid int"), names)
    assert {r.appid: r.game_name for r in named.collect()} == {5: "five", 6: "Game_6"}


def test_genre_and_tag_selection(spark):
    df = info(spark, [(1, "a", None, 1, 1, 1, '{"X": 1}'), (2, "b", None, 1, 1, 1, None)])
    assert marts.games_by_genre(df, "Action").count() == 2
    assert marts.games_by_genre(df, "Act").count() == 0
    assert [r.appid for r in marts.games_with_tag(df, "X").collect()] == [1]


def test_views_can_be_registered(spark, sf_dir):
    from ludolytics.sources import bindings as B

    views.register_views(
        {
            "GAME_INFO": B.game_info(spark, sf_dir),
            "PLAYER_STATS": B.player_stats(spark, sf_dir),
            "PLAYERS": B.players(spark, sf_dir),
            "GAME_REVIEWS": B.game_reviews(spark, sf_dir),
            "GAME_PLAYER_COUNTS": B.game_player_counts(spark, sf_dir),
        },
        B.AS_OF,
    )
    assert spark.sql("SELECT count(*) AS n FROM GAME_PLAYER_COUNTS_LIVE").first().n > 0
