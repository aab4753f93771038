import json
from datetime import datetime

from pyspark.sql import functions as F

from ludolytics.operators.publish import id_batches, key_of, publishable, to_messages
from ludolytics.plans import ingest

AT = datetime(2024, 1, 1)


def messages(spark, *records):
    values = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(values, "value string")


def documents(spark, *rows):
    made = [(a, json.dumps(v), AT) for a, v in rows]
    return spark.createDataFrame(made, "appid int, value string, fetched_at timestamp_ntz")


def names(spark):
    return spark.createDataFrame([(1, "One"), (2, None)], "appid int, name string")


def test_players(spark):
    df = messages(spark, {"steamid": "1", "lastlogoff": 1700000000, "fetched_at": "2024-01-01T00:00:00"}, "{")
    rows = ingest.players_from_messages(df).collect()
    assert rows[0].lastlogoff == datetime(2023, 11, 14, 22, 13, 20)
    assert rows[0].timecreated is None and rows[0].fetched_at == AT
    assert rows[1].steamid is None
    bad = ingest.players_from_messages(df).filter(ingest.rejected(("steamid",)))
    assert bad.count() == 1


def test_game_info_prices_and_tags(spark):
    df = messages(
        spark,
        {"appid": 1, "price": "999", "discount": 10, "tags": {"A": 1}, "fetched_at": "broken"},
        {"appid": 2, "price": 0, "tags": {}},
        {"appid": 3, "price": "x", "tags": [], "source": "s", "fetched_at": "2024-01-01T00:00:00"},
    )
    rows = {r.appid: r for r in ingest.game_info_from_messages(df).collect()}
    assert [rows[i].price for i in (1, 2, 3)] == [999, 0, None]
    assert rows[1].tags == {"A": 1} and rows[1].fetched_at is None and rows[1].discount == 10
    ready = {r.appid: r for r in ingest.prepared_game_info(df, "2024-02-01 00:00:00").collect()}
    assert ready[1].fetched_at == datetime(2024, 2, 1) and ready[2].fetched_at is None
    assert ready[2].tags is None and ready[3].tags is None and ready[3].source == "s"
    assert ready[1].source == "steamspy"


def review(rid, created, **more):
    return {"recommendationid": rid, "author": {"steamid": "7"}, "timestamp_created": created} | more


def test_reviews(spark):
    pages = documents(
        spark,
        (1, {"success": 1, "reviews": [review("a", 10, review="x" * 6000), review("b", 30)]}),
        (1, {"success": 1, "reviews": [review("c", 20, language="german", voted_up=True)]}),
        (2, {"success": 0, "reviews": [review("d", 10)]}),
        (3, {"success": 1, "reviews": [review("e", 0)]}),
    )
    rows = {r.recommendationid: r for r in ingest.normalised_reviews(pages, names(spark), 2).collect()}
    assert rows.keys() == {"b", "c", "e"}
    assert rows["b"].game_name == "One" and rows["e"].game_name == "Game_3"
    assert rows["b"].voted_up is False and rows["c"].voted_up is True and rows["b"].votes_up == 0
    assert rows["b"].review_text == "" and rows["b"].language == "english"
    assert rows["e"].timestamp_created is None
    whole = ingest.normalised_reviews(pages, names(spark), None).filter("recommendationid = 'a'")
    assert len(whole.first().review_text) == 6000
    cut = ingest.normalised_reviews(pages, names(spark), None, max_chars=5000)
    assert cut.agg(F.max(F.length("review_text"))).first()[0] == 5000
    # A review without a language is in the one that was asked for.
    german = ingest.normalised_reviews(pages, names(spark), None, "german").collect()
    assert {r.recommendationid for r in german} == {"a", "b", "c", "e"}
    english = ingest.normalised_reviews(pages, names(spark), None, "english").collect()
    assert {r.recommendationid for r in english} == {"a", "b", "e"}


def test_review_summary(spark):
    docs = documents(
        spark,
        (1, {"success": 1, "query_summary": {"review_score": 8, "total_reviews": 5}}),
        (2, {"success": 1}),
        (3, {"success": 0, "query_summary": {}}),
    )
    (row,) = ingest.review_summaries(docs).collect()
    assert tuple(row) == (1, 8, "", 0, 0, 5)


def test_details(spark):
    data = {
        "name": "One",
        "detailed_description": "y" * 50001,
        "genres": [{"description": "RPG"}, {"id": 1}],
        "release_date": {"date": "2020"},
        "price_overview": {"final": 5},
    }
    docs = documents(
        spark,
        (1, {"1": {"success": True, "data": data}}),
        (2, {"2": {"success": False}}),
        (3, {"3": {"success": True, "data": {"name": "Three", "price_overview": {}}}}),
    )
    rows = {r.appid: r for r in ingest.normalised_details(docs).collect()}
    assert rows.keys() == {1, 3}
    assert rows[1].genres == ["RPG", None] and rows[1].developers == []
    assert rows[1].release_date == "2020" and rows[1].coming_soon is False
    assert rows[1].price_overview == '{"final":5}' and rows[3].price_overview is None
    assert len(rows[1].detailed_description) == 50001 and rows[3].short_description == ""
    cut = ingest.normalised_details(docs, cut=True).filter("appid = 1").first()
    assert len(cut.detailed_description) == 50000


def test_other_documents(spark):
    players = messages(spark, {"response": {"players": [{"steamid": "1"}, {"steamid": "2"}]}})
    assert ingest.player_summaries(players, AT).count() == 2
    owned = spark.createDataFrame(
        [("9", json.dumps({"response": {"games": [{"appid": 1, "playtime_forever": 5}]}}))],
        "steamid string, value string",
    )
    (game,) = ingest.owned_games(owned, AT).collect()
    assert (game.steamid, game.appid, game.source) == ("9", 1, "steam_api")
    (recent,) = ingest.recent_games(owned, AT).collect()
    assert recent.data_type == "recently_played"
    ranking = spark.createDataFrame(
        [("top", json.dumps({"10": {"name": "Ten"}, "x": {"name": "?"}}))], "list_name string, value string"
    )
    rows = ingest.ranking_rows(ranking, AT).collect()
    assert [(r.position, r.appid, r.name) for r in rows] == [(1, 10, "Ten"), (2, None, "?")]


def test_publishing(spark):
    rows = spark.createDataFrame([(1, "7", "a"), (2, "8", None)], "appid int, steamid string, name string")
    sent = {r.key: json.loads(r.value) for r in to_messages(rows, key_of("steamid", "appid"), "t").collect()}
    assert sent == {"7_1": {"appid": 1, "steamid": "7", "name": "a"}, "8_2": {"appid": 2, "steamid": "8"}}
    more = rows.union(spark.createDataFrame([(3, "9", "c")], rows.schema))
    assert {r.appid for r in publishable(more).collect()} == {1, 3}
    assert {r.appid for r in publishable(more, published=rows).collect()} == {3}
    assert {r.appid for r in publishable(more, appids=rows.select("appid")).collect()} == {1}


def test_id_batches(spark):
    ids = spark.range(0, 1005, 1, 3).select(F.col("id").cast("string").alias("steamid"))
    batches = [r.ids.split(",") for r in id_batches(ids, "steamid").collect()]
    assert max(map(len, batches)) == 100
    assert sorted(int(i) for b in batches for i in b) == list(range(1005))
