import json
from datetime import datetime

from pyspark.sql import functions as F

from ludolytics.functions import ntz
from ludolytics.operators.publish import write_messages
from ludolytics.plans import ingest
from ludolytics.sources import documents as D
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import ChangeTable, read_table
from ludolytics.sources.topics import LandedFiles
from ludolytics.streaming import jobs
from ludolytics.streaming.pipelines import (
    LATEST_COUNTS,
    PIPELINES,
    batch_writer,
    sample_writer,
    start,
    start_samples,
)

NOW = "2024-02-01 00:00:00"


def land(path, topic, messages, name):
    folder = path / f"topic={topic}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(m) + "\n" for m in messages))


def drain(spark, name, path, root):
    query = start(
        spark, PIPELINES[name], LandedFiles(str(path)), root, once=True, as_of=ntz(NOW)
    )
    query.awaitTermination()
    table = PIPELINES[name].table
    return ChangeTable(spark, table, root).read()


def test_stream_equals_batch_and_a_second_run_changes_nothing(spark, sf_dir, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    sources = {
        "players": D.player_messages,
        "games": D.game_messages,
        "stats": D.stats_messages,
        "game_info": D.game_info_messages,
    }
    for name, messages in sources.items():
        write_messages(messages(spark, sf_dir), path=str(landed))
        pipeline = PIPELINES[name]
        got = drain(spark, name, landed, root)
        expected = ingest.stamped(pipeline.transform(messages(spark, sf_dir)), NOW)
        assert got.columns == expected.columns
        flat = [F.to_json(F.struct("*")).alias("row")]
        first = sorted(r.row for r in got.select(*flat).collect())
        assert first == sorted(r.row for r in expected.select(*flat).collect())
        again = drain(spark, name, landed, root)
        assert sorted(r.row for r in again.select(*flat).collect()) == first


def test_later_messages_update_and_damaged_ones_are_set_aside(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    topic = S.TOPICS["games"]

    def message(steamid, appid, minutes, at):
        record = {"steamid": steamid, "appid": appid, "playtime_forever": minutes, "fetched_at": at}
        return {"key": str(appid), "value": json.dumps(record)}

    land(
        landed,
        topic,
        [
            message("7", 1, 10, "2024-01-01T00:00:00"),
            message(None, 1, 99, "2024-01-01T00:00:00"),
            {"key": "x", "value": "{broken"},
            message("7", 1, 20, "2024-01-02T00:00:00+00:00"),
        ],
        "a.json",
    )
    rows = drain(spark, "games", landed, root).collect()
    assert [(r.steamid, r.appid, r.playtime_forever) for r in rows] == [("7", 1, 20)]
    rejected = spark.read.json(f"{root}/rejected/games").collect()
    assert sorted(r["value"][:12] for r in rejected) == ["""{"steamid": """, "{broken"]
    land(landed, topic, [message("7", 1, 30, "2024-01-03T00:00:00")], "b.json")
    rows = drain(spark, "games", landed, root).collect()
    assert [r.playtime_forever for r in rows] == [30]
    assert rows[0].rtime_last_played is None


def test_a_repeated_epoch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    write = batch_writer(spark, PIPELINES["players"], root, ntz(NOW))

    def batch(name):
        value = json.dumps({"steamid": "1", "personaname": name})
        return spark.createDataFrame([(value,)], "value string").select(
            F.col("value").cast("binary")
        )

    write(batch("a"), 0)
    write(batch("a"), 0)
    table = ChangeTable(spark, S.PLAYERS, root)
    assert [r.personaname for r in table.read().collect()] == ["a"]
    assert table.changes_in().count() == 1
    write(batch("b"), 1)
    assert [r.personaname for r in table.read().collect()] == ["b"]


def test_a_new_checkpoint_over_existing_rows_loses_nothing(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    topic = S.TOPICS["players"]

    def run(checkpoint, at):
        query = (
            LandedFiles(str(landed)).stream(spark, topic).writeStream.trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / checkpoint))
            .foreachBatch(batch_writer(spark, PIPELINES["players"], root, ntz(at))).start()
        )
        query.awaitTermination()
        return query.id

    land(landed, topic, [{"key": "1", "value": json.dumps({"steamid": "1", "personaname": "a"})}], "a.json")
    first = run("one", "2024-02-01 00:00:00")
    land(landed, topic, [{"key": "2", "value": json.dumps({"steamid": "2", "personaname": "b"})}], "b.json")
    second = run("two", "2024-02-02 00:00:00")
    table = ChangeTable(spark, S.PLAYERS, root)
    assert {r.steamid: r.personaname for r in table.read().collect()} == {"1": "a", "2": "b"}
    assert {r["_query"] for r in table._read_from().collect()} == {first, second}


def test_samples_are_stored_once_and_the_latest_wins(spark, tmp_path):
    root = str(tmp_path)
    names = spark.createDataFrame([(1, "One")], "appid int, name string")
    write = sample_writer(spark, names, root, ntz(NOW))

    def documents(rows):
        made = [
            (appid, json.dumps({"response": {"result": result, "player_count": n}}), at)
            for appid, result, n, at in rows
        ]
        return spark.createDataFrame(made, "appid int, value string, fetched_at timestamp_ntz")

    t1, t2 = datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 5)
    write(documents([(1, 1, 10, t2), (2, 1, 20, t2), (3, 42, 5, t2), (4, 1, None, t2)]), 0)
    write(documents([(1, 1, 10, t2), (2, 1, 20, t2)]), 0)
    write(documents([(1, 1, 99, t1)]), 1)
    stored = read_table(spark, S.GAME_PLAYER_COUNTS, root).collect()
    assert sorted((r.appid, r.game_name, r.live_player_count) for r in stored) == [
        (1, "One", 10),
        (1, "One", 99),
        (2, "Game_2", 20),
    ]
    latest = ChangeTable(spark, LATEST_COUNTS, root, newer_by="fetched_at").read().collect()
    assert sorted((r.appid, r.live_player_count) for r in latest) == [(1, 10), (2, 20)]


def test_sample_stream(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    answer = json.dumps({"response": {"result": 1, "player_count": 7}})
    line = {"appid": 1, "value": answer, "fetched_at": "2024-01-01T00:00:00"}
    (landed / "a.json").write_text(json.dumps(line) + "\n")
    stream = spark.readStream.schema("appid int, value string, fetched_at timestamp_ntz").json(str(landed))
    names = spark.createDataFrame([], "appid int, name string")
    root = str(tmp_path / "tables")
    start_samples(spark, stream, names, root, once=True, as_of=ntz(NOW)).awaitTermination()
    assert read_table(spark, S.GAME_PLAYER_COUNTS, root).first().live_player_count == 7


def test_marts_reviews_and_details_are_stored_and_can_run_again(spark, sf_dir, tmp_path):
    from ludolytics.sources import bindings as B

    root, names = str(tmp_path), B.game_info(spark, sf_dir)

    def flat(df):
        return sorted(r.row for r in df.select(F.to_json(F.struct("*")).alias("row")).collect())

    pages = D.review_pages(spark, sf_dir)
    one = flat(jobs.run_reviews(spark, pages, names, root, "monday", NOW))
    assert len(one) == B.game_reviews(spark, sf_dir).count()
    assert flat(jobs.run_reviews(spark, pages, names, root, "monday", NOW)) == one
    english = flat(jobs.run_reviews(spark, pages, names, f"{root}/en", "monday", NOW, language="en"))
    assert 0 < len(english) < len(one)

    documents = D.detail_documents(spark, sf_dir)
    one = flat(jobs.run_details(spark, documents, root, "monday", NOW))
    assert len(one) == ingest.normalised_details(documents).count() > 0
    assert flat(jobs.run_details(spark, documents, root, "monday", NOW)) == one

    counts = B.count_snapshots(spark, sf_dir)
    ranking = flat(jobs.run_popular_games(spark, counts, root, version="2024-01-30"))
    assert ranking == flat(jobs.run_popular_games(spark, counts, root, version="2024-01-30"))
    assert ranking == flat(jobs.run_popular_games(spark, counts, root)) and ranking

    reviews = B.game_reviews(spark, sf_dir)
    first = flat(jobs.run_recent_reviews(spark, reviews, root, "2024-01-29"))
    again = flat(jobs.run_recent_reviews(spark, reviews, root, "2024-01-29"))
    some = reviews.filter("appid < 5")
    assert first == again and flat(jobs.run_recent_reviews(spark, some, root, "2024-01-30")) == [
        row for row in first if json.loads(row)["appid"] < 5
    ]


def test_daily_jobs_can_run_again(spark, sf_dir, tmp_path):
    from ludolytics.sources import bindings as B

    root = str(tmp_path)
    counts = B.count_snapshots(spark, sf_dir)
    first = sorted(map(tuple, jobs.run_popular_games(spark, counts, root).collect()))
    second = sorted(map(tuple, jobs.run_popular_games(spark, counts, root).collect()))
    assert first == second and len(first) > 0

    reviews, lexicon = B.game_reviews(spark, sf_dir), B.lexicon(spark, sf_dir)
    day = "2024-01-30"
    one = jobs.run_sentiment(spark, reviews, lexicon, root, day, NOW).collect()
    trends = sorted(map(tuple, read_table(spark, S.SENTIMENT_TRENDS, root).collect()))
    two = jobs.run_sentiment(spark, reviews, lexicon, root, day, NOW).collect()
    assert one == two
    assert trends == sorted(map(tuple, read_table(spark, S.SENTIMENT_TRENDS, root).collect()))
    scored = read_table(spark, S.REVIEW_SENTIMENTS, root)
    assert scored.count() == scored.select("review_id").distinct().count() > 0
