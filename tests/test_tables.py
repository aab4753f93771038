import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ludolytics.functions import ntz
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import (
    ChangeTable,
    append,
    read_dates,
    read_latest,
    read_table,
    replace_date,
    replace_table,
    shared_root,
    upsert_date,
)

NOW = "2024-02-01 00:00:00"
SMALL = S.Table(
    "SMALL",
    S.struct(id=S.INT, text=S.TEXT, fetched_at=S.INT, inserted_at=S.TIME, updated_at=S.TIME),
    ("id",),
)


def rows(spark, data):
    return spark.createDataFrame(data, "id int, text string, fetched_at int")


def content(table):
    return {r["id"]: r["text"] for r in table.read().collect()}


LATER = "2024-02-02 00:00:00"


def test_state_is_the_fold_of_all_changes(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    assert content(table) == {}
    table.write(rows(spark, [(i, "a", 1) for i in range(20)]), ntz(NOW), "s", 0)
    assert content(table) == dict.fromkeys(range(20), "a")
    table.write(rows(spark, [(3, "b", 2), (99, "c", 2), (None, "x", 2)]), ntz(LATER), "s", 1)
    assert content(table) == dict.fromkeys(range(20), "a") | {3: "b", 99: "c"}
    row = table.read().where("id = 3").first()
    assert (str(row.inserted_at), str(row.updated_at)) == (NOW, LATER)


def test_interleaved_writers_lose_nothing(spark, tmp_path):
    one, two = (ChangeTable(spark, SMALL, str(tmp_path)) for _ in range(2))
    one.write(rows(spark, [(1, "a", 1)]), ntz(NOW), "one", 0)
    two.write(rows(spark, [(2, "b", 1)]), ntz(NOW), "two", 0)
    one.write(rows(spark, [(1, "c", 2)]), ntz(LATER), "one", 1)
    assert content(two) == {1: "c", 2: "b"}


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    table.write(spark.range(100_000).selectExpr("cast(id AS int) AS id", "'a' AS text", "1 AS fetched_at"), ntz(NOW), "s", 0)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    table.write(spark.range(1000).selectExpr("cast(id AS int) AS id", "'b' AS text", "2 AS fetched_at"), ntz(LATER), "s", 1)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert before.items() <= after.items()
    assert spark.read.parquet(*[str(p) for p in after if p not in before]).count() == 1000
    assert table.read().where("text = 'b'").count() == 1000 and table.read().count() == 100_000


def aged(folder, days):
    """Makes all files below look written some days ago."""
    for p in folder.rglob("*.parquet"):
        then = p.stat().st_mtime - days * 86400
        os.utime(p, (then, then))


def test_a_stored_state_changes_nothing_for_readers(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    table.refresh()
    assert content(table) == {}
    table.write(rows(spark, [(1, "a", 1), (2, "a", 1)]), ntz(NOW), "s", 0)
    reader = table.read()
    table.refresh()
    table.write(rows(spark, [(2, "b", 2)]), ntz(LATER), "s", 1)
    assert content(table) == {1: "a", 2: "b"}
    assert {r["id"]: r["text"] for r in reader.collect()} == {1: "a", 2: "a"}
    table.refresh()
    row = table.read().where("id = 2").first()
    assert content(table) == {1: "a", 2: "b"}
    assert (str(row.inserted_at), str(row.updated_at)) == (NOW, LATER)


def test_old_changes_are_left_out_of_the_scan(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    table.write(rows(spark, [(i, "a", 1) for i in range(20)]), ntz(NOW), "s", 0)
    aged(tmp_path / "SMALL" / "changes", 3)
    table.refresh()
    table.write(rows(spark, [(2, "b", 2)]), ntz(LATER), "s", 1)
    assert content(table) == dict.fromkeys(range(20), "a") | {2: "b"}
    assert table._read_from().where("_epoch >= 0").count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(table.read()._jdf.queryExecution(), "formatted")
    assert "file_modification_time" in plan


def test_a_late_or_repeated_run_is_seen(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    table.write(rows(spark, [(1, "a", 1)]), ntz(NOW), "run", 0)
    table.write(rows(spark, [(5, "new", 1)]), ntz(LATER), "other", 0)
    aged(tmp_path / "SMALL" / "changes", 3)
    table.refresh()
    table.write(rows(spark, [(1, "c", 1), (5, "old", 1)]), ntz(NOW), "run", 0)
    table.write(rows(spark, [(7, "x", 1)]), ntz("2024-01-05 00:00:00"), "earlier", 0)
    assert content(table) == {1: "c", 5: "new", 7: "x"}
    table.refresh()
    assert content(table) == {1: "c", 5: "new", 7: "x"}


def test_a_whole_refresh_forgets_what_a_repeated_run_no_longer_has(spark, tmp_path):
    table = ChangeTable(spark, SMALL, str(tmp_path))
    table.write(rows(spark, [(1, "a", 1), (2, "a", 1)]), ntz(NOW), "run", 0)
    table.refresh()
    table.write(rows(spark, [(1, "b", 1)]), ntz(NOW), "run", 0)
    table.refresh()
    assert content(table) == {1: "b", 2: "a"}
    table.refresh(whole=True)
    assert content(table) == {1: "b"}


def test_marts_are_replaced_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    made = lambda text: rows(spark, [(1, text, 1)]).withColumns({s: ntz(NOW) for s in ("inserted_at", "updated_at")})
    assert read_latest(spark, SMALL, root).count() == 0
    replace_table(made("a"), SMALL, root, "2024-01-01")
    replace_table(made("b"), SMALL, root, "2024-01-02")
    replace_table(made("c"), SMALL, root, "2024-01-02")
    assert [r["text"] for r in read_latest(spark, SMALL, root).collect()] == ["c"]


def test_dates_are_replaced_or_merged_alone(spark, tmp_path):
    root = str(tmp_path)
    schema = "trend_date date, category string, appid int, rank_in_category int"

    def trends(data):
        df = spark.createDataFrame(data, schema)
        return df.withColumns(
            {
                "game_name": F.lit("g"),
                "sentiment_score": F.lit(1.0),
                "review_count": F.lit(1),
                "processed_at": ntz(NOW),
            }
        )

    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    replace_date(trends([(d1, "A", 1, 1)]), S.SENTIMENT_TRENDS, root, "trend_date", d1)
    replace_date(trends([(d2, "A", 1, 1), (d2, "A", 2, 2)]), S.SENTIMENT_TRENDS, root, "trend_date", d2)
    replace_date(trends([(d2, "A", 3, 1)]), S.SENTIMENT_TRENDS, root, "trend_date", d2)
    got = read_table(spark, S.SENTIMENT_TRENDS, root)
    assert sorted((r.trend_date, r.appid) for r in got.collect()) == [(d1, 1), (d2, 3)]
    replace_date(trends([]), S.SENTIMENT_TRENDS, root, "trend_date", d2)
    got = read_table(spark, S.SENTIMENT_TRENDS, root)
    assert [(r.trend_date, r.appid) for r in got.collect()] == [(d1, 1)]


def test_merge_into_a_day_keeps_games_that_no_longer_qualify(spark, tmp_path):
    root = str(tmp_path)
    table = S.GAME_SENTIMENT_ANALYSIS

    def games(day, data):
        df = spark.createDataFrame(data, "appid int, total_reviews_analyzed int")
        given = df.columns
        rest = [f for f in table.schema.fields if f.name not in (*given, "analysis_date", "processed_at")]
        return df.select(
            *given,
            F.lit(day).alias("analysis_date"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest],
        )

    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    upsert_date(spark, games(d1, [(1, 5)]), table, root, d1, "analysis_date", ntz(NOW))
    upsert_date(spark, games(d2, [(1, 6), (2, 6)]), table, root, d2, "analysis_date", ntz(NOW))
    upsert_date(spark, games(d2, [(1, 7)]), table, root, d2, "analysis_date", ntz(NOW))
    got = read_table(spark, table, root).collect()
    assert sorted((r.analysis_date, r.appid, r.total_reviews_analyzed) for r in got) == [
        (d1, 1, 5),
        (d2, 1, 7),
        (d2, 2, 6),
    ]


def test_append_and_empty_table(spark, tmp_path):
    root = str(tmp_path)
    table = S.POPULAR_GAMES_HISTORICAL
    assert read_table(spark, table, root).count() == 0
    data = [(datetime(2024, 1, 1), 1, "g", 5, 1)]
    append(spark.createDataFrame(data, table.schema), table, root)
    assert read_table(spark, table, root).collect()[0].appid == 1


def test_rows_appended_by_date_are_read_by_date(spark, tmp_path):
    root, table = str(tmp_path), S.POPULAR_GAMES_HISTORICAL
    data = [(datetime(2024, 1, d), 1, "g", 5, 1) for d in (1, 2)]
    append(spark.createDataFrame(data, table.schema), table, root, date_of="fetched_at")
    assert read_dates(spark, table, root, "2024-01-02", "2024-01-03").count() == 1
    assert read_table(spark, table, root).count() == 2


def test_shared_root_is_the_session_s(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        with pytest.raises(ValueError):
            shared_root(spark)
    else:
        assert shared_root(spark) == named.rstrip("/")
