"""The live view kept by a stream, against the view over all samples."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ludolytics.functions import ntz
from ludolytics.plans import dashboard, ingest, views
from ludolytics.sources import bindings as B
from ludolytics.sources import schemas as S
from ludolytics.sources.tables import append, read_table, with_stamps
from ludolytics.sources.topics import LandedFiles
from ludolytics.streaming import hourly
from ludolytics.streaming.pipelines import PIPELINES, start, stop_when_idle

FIELDS = ["record_id", "appid", "game_name", "live_player_count", "fetched_at"]


def flat(df):
    return sorted(r.row for r in df.select(F.to_json(F.struct("*")).alias("row")).collect())


def land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(dict(zip(FIELDS, row), fetched_at=row[4].isoformat())) for row in rows]
    (folder / name).write_text("".join(line + "\n" for line in lines))


def drain(spark, folder, root, **options):
    schema = "record_id string, appid int, game_name string, live_player_count int, fetched_at timestamp_ntz"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    hourly.start_hours(spark, stream, root, once=True, **options).awaitTermination()


def test_drained_samples_give_the_live_view_exactly(spark, sf_dir, tmp_path):
    counts = B.game_player_counts(spark, sf_dir)
    rows = sorted((tuple(r) for r in counts.select(*FIELDS).collect()), key=lambda r: (r[4], r[0]))
    folder, root = tmp_path / "landed", str(tmp_path / "tables")
    third = len(rows) // 3
    parts = [rows[:third] + rows[:50], rows[2 * third :] + rows[third - 20 : third], rows[third : 2 * third] + rows[-30:]]
    for k, part in enumerate(parts):  # the last third before the second: late, and some samples in two epochs
        land(folder, f"{k}.json", part)
        drain(spark, folder, root, delay="4000 days")
    append(with_stamps(counts, S.GAME_PLAYER_COUNTS, ntz(B.AS_OF)), S.GAME_PLAYER_COUNTS, root, date_of="fetched_at")
    live = hourly.live_counts(spark, root, B.AS_OF)
    expected = views.player_counts_live(counts, B.AS_OF)
    assert live.columns == expected.columns and flat(live) == flat(expected)
    assert flat(dashboard.leaderboard_of(live)) == flat(dashboard.leaderboard(counts, B.AS_OF))
    for as_of in ("2024-01-20 00:00:00", "2024-01-25 13:30:00"):
        assert flat(hourly.live_counts(spark, root, as_of)) == flat(views.player_counts_live(counts, as_of))


def test_samples_after_the_watermark_come_in_by_rebuilding_their_day(spark, tmp_path):
    folder, root = tmp_path / "landed", str(tmp_path / "tables")
    start_at = datetime(2024, 1, 1, 0, 30)
    row = lambda name, hours, n: (name, 1, "One", n, start_at + timedelta(hours=hours))
    land(folder, "0.json", [row("a", 0, 10), row("b", 1, 20), row("a", 0, 10)])
    drain(spark, folder, root)
    land(folder, "1.json", [row("c", 2, 30), row("b", 1, 20), row("d", 30, 40)])
    drain(spark, folder, root)
    land(folder, "2.json", [row("late", 3, 99), row("a", 0, 10)])  # both more than two hours late
    drain(spark, folder, root)
    stored = read_table(spark, hourly.HOURS, root)
    assert sorted((r.hour.day, r.hour.hour, r.total, r.samples) for r in stored.collect()) == [
        (1, 0, 10, 1), (1, 1, 20, 1), (1, 2, 30, 1), (2, 6, 40, 1),
    ]
    everything = [row("a", 0, 10), row("b", 1, 20), row("c", 2, 30), row("late", 3, 99), row("d", 30, 40)]
    samples = spark.createDataFrame(everything, "record_id string, appid int, game_name string, live_player_count int, fetched_at timestamp_ntz")
    complete = with_stamps(samples.withColumn("source", F.lit("x")), S.GAME_PLAYER_COUNTS, ntz("2024-01-03"))
    append(complete, S.GAME_PLAYER_COUNTS, root, date_of="fetched_at")
    hourly.rebuild_days(spark, root, "2024-01-01", "2024-01-01")
    as_of = "2024-01-02 10:00:00"
    assert flat(hourly.live_counts(spark, root, as_of)) == flat(views.player_counts_live(samples, as_of))


def test_a_repeated_epoch_and_no_rows_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    samples = spark.createDataFrame(
        [("a", 1, "One", 5, datetime(2024, 1, 1, 3, 10)), ("b", 1, None, None, datetime(2024, 1, 1, 3, 20))],
        "record_id string, appid int, game_name string, live_player_count int, fetched_at timestamp_ntz",
    )
    write = hourly.hours_writer(spark, root)
    changed = hourly.totals(samples)
    write(changed, 0)
    first = flat(read_table(spark, hourly.HOURS, root))
    write(changed, 0)
    write(changed.limit(0), 1)
    assert flat(read_table(spark, hourly.HOURS, root)) == first and len(first) == 1


def test_documents_parse_to_samples_on_a_stream(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    answer = json.dumps({"response": {"result": 1, "player_count": 7}})
    lines = [{"appid": a, "value": v, "fetched_at": "2024-01-01T00:10:00"} for a, v in ((1, answer), (2, "{}"), (1, answer))]
    (landed / "a.json").write_text("".join(json.dumps(line) + "\n" for line in lines))
    stream = spark.readStream.schema("appid int, value string, fetched_at timestamp_ntz").json(str(landed))
    names = spark.createDataFrame([(1, "One")], "appid int, name string")
    root = str(tmp_path / "tables")
    hourly.start_document_hours(spark, stream, names, root, once=True).awaitTermination()
    rows = read_table(spark, hourly.HOURS, root).collect()
    assert [(r.appid, r.game_name, r.total, r.samples) for r in rows] == [(1, "One", 7, 1)]
    batch = spark.read.schema("appid int, value string, fetched_at timestamp_ntz").json(str(landed))
    assert ingest.sample_documents(batch, names).columns == ingest.count_samples(batch, names).columns


def message(steamid, name, at):
    return {"key": steamid, "value": json.dumps({"steamid": steamid, "personaname": name, "fetched_at": at})}


def test_repeated_messages_within_and_after_the_watermark(spark, tmp_path):
    """A message that comes twice in different epochs is written once; after the watermark it comes again and changes nothing."""
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    folder = landed / f"topic={S.TOPICS['players']}"
    folder.mkdir(parents=True)
    from ludolytics.sources.tables import ChangeTable

    table = ChangeTable(spark, S.PLAYERS, root)
    seen = []

    def run(name, messages, arrived):
        (folder / name).write_text("".join(json.dumps(m) + "\n" for m in messages))
        query = start(
            spark, PIPELINES["players"], LandedFiles(str(landed)), root, once=True, as_of=ntz("2024-02-01"),
            repeats_within="1 hour", arrived=F.lit(arrived).cast("timestamp"),
        )
        query.awaitTermination()
        seen.append(sorted(r.personaname for r in table.changes_in().collect()))

    one, two = message("1", "a", "2024-01-01T00:00:00"), message("2", "b", "2024-01-01T00:00:00")
    run("0.json", [one, one], "2024-01-01 00:00:00")
    assert seen[-1] == ["a"]
    run("1.json", [one, two, {"key": "x", "value": "{broken"}], "2024-01-01 00:30:00")
    assert seen[-1] == ["a", "b"]
    run("2.json", [message("3", "c", "2024-01-01T00:00:00")], "2024-01-01 05:00:00")
    run("3.json", [one], "2024-01-01 05:10:00")  # its state is gone by now
    assert seen[-1] == ["a", "a", "b", "c"]
    assert {r.steamid: r.personaname for r in table.read().collect()} == {"1": "a", "2": "b", "3": "c"}
    assert [r.value for r in spark.read.json(f"{root}/rejected/players").collect()] == ["{broken"]


def test_a_drain_stops_when_idle(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "tables")
    folder = landed / f"topic={S.TOPICS['players']}"
    folder.mkdir(parents=True)
    (folder / "0.json").write_text(json.dumps(message("1", "a", "2024-01-01T00:00:00")) + "\n")
    query = start(spark, PIPELINES["players"], LandedFiles(str(landed)), root, trigger="1 second", as_of=ntz("2024-02-01"))
    began = time.time()
    rows = stop_when_idle(query, seconds=6, poll=0.5)
    assert not query.isActive and rows == 1 and time.time() - began >= 6


@pytest.mark.parametrize("version", ["second", 7])
def test_versions_must_be_dates_or_times(spark, tmp_path, version):
    from ludolytics.sources.tables import replace_table

    with pytest.raises(ValueError):
        replace_table(spark.createDataFrame([], hourly.HOURS.schema), hourly.HOURS, str(tmp_path), version)
