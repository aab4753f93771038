from datetime import datetime

from pyspark.sql import functions as F

from ludolytics.operators import checks
from ludolytics.plans import quality

AS_OF = "2024-01-10 00:00:00"


def table(spark, rows):
    return spark.createDataFrame(rows, "a int, fetched_at timestamp_ntz, updated_at timestamp_ntz")


def facts(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 9, 23)
    tables = {
        "GOOD": table(spark, [(i, None, new) for i in range(9)] + [(None, old, None)]),
        "STALE": table(spark, [(i, old, new) for i in range(8)] + [(None, old, new)] * 2),
        "EMPTY": table(spark, []),
        "GONE": lambda: spark.read.parquet("/nowhere/at/all"),
    }
    expected = checks.Expectation(2, 3, ("a", "b"))
    return checks.collect_facts(spark, tables, dict.fromkeys(tables, expected))


def test_checks(spark):
    found = facts(spark)
    fresh = {r.table_name: r for r in checks.freshness(found, AS_OF).collect()}
    assert {k: v.status for k, v in fresh.items()} == {
        "GOOD": "PASS", "STALE": "FAIL", "EMPTY": "FAIL", "GONE": "ERROR",
    }
    assert fresh["GOOD"].hours_since_update == 1.0
    assert fresh["EMPTY"].error == "No data found"
    rows = {r.table_name: r.status for r in checks.row_counts(found).collect()}
    assert rows == {"GOOD": "PASS", "STALE": "PASS", "EMPTY": "FAIL", "GONE": "ERROR"}
    nulls = {(r.table_name, r.column_name): r for r in checks.null_percentages(found).collect()}
    assert (nulls["GOOD", "a"].status, nulls["GOOD", "a"].null_percentage) == ("PASS", 10.0)
    assert (nulls["STALE", "a"].status, nulls["STALE", "a"].null_percentage) == ("FAIL", 20.0)
    assert nulls["EMPTY", "a"].null_percentage == 0.0
    assert {nulls[t, "b"].status for t in ("GOOD", "GONE")} == {"ERROR"}


def test_report_and_alerts(spark):
    found = facts(spark)
    report = quality.quality_report(found, AS_OF).first()
    assert tuple(report) == (1, 4, 2, 4, "DEGRADED")
    messages = [r.message for r in quality.quality_alerts(found, AS_OF).collect()]
    assert "EMPTY is out of date: hours without a new row unknown" in messages
    assert "EMPTY is too small: it has 0 of at least 3 rows" in messages
    good = found.filter(F.col("table_name") == "GOOD")
    assert quality.quality_report(good, AS_OF).first().overall_status == "HEALTHY"
    assert quality.quality_alerts(good, AS_OF).count() == 0


def test_review_texts_are_not_ranked(spark, sf_dir):
    from ludolytics.registry import QUERIES

    for name in ("q10_recent_reviews", "q31_review_samples_per_game"):
        df = QUERIES[name](spark, sf_dir)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        limits = [part for part in plan.split("\n\n") if "WindowGroupLimit" in part.split("\n")[0]]
        assert limits and not any("text" in part for part in limits), name


def test_one_scan_per_table(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    expected = checks.Expectation(1, 1, ("event_id", "user_id", "value"))
    df = checks.table_facts(events, "EVENTS", expected, ["ts"])
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert plan.count("FileScan") == 1


def test_a_damaged_file_is_an_error_of_its_table_alone(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    new = datetime(2024, 1, 9, 23)
    rows = table(spark, [(i, None, new) for i in range(4)])
    rows.write.parquet(good)
    rows.write.parquet(bad)
    for part in (tmp_path / "bad").glob("*.parquet"):
        part.write_bytes(b"PAR1 but nothing else")
        (tmp_path / "bad" / f".{part.name}.crc").unlink()
    read = spark.read.schema(rows.schema).parquet
    tables = {"GOOD": read(good), "BAD": read(bad)}
    expected = checks.Expectation(2, 3, ("a",))
    found = checks.collect_facts(spark, tables, dict.fromkeys(tables, expected), alone=True)
    fresh = {r.table_name: r for r in checks.freshness(found, AS_OF).collect()}
    assert {k: v.status for k, v in fresh.items()} == {"GOOD": "PASS", "BAD": "ERROR"}
    assert fresh["BAD"].error
    assert {r.status for r in checks.null_percentages(found).collect()} == {"PASS", "ERROR"}
    assert quality.quality_report(found, AS_OF).first().overall_status == "DEGRADED"


def test_facts_of_a_write_equal_those_of_a_scan(spark, tmp_path):
    new = datetime(2024, 1, 9, 23)
    expected = checks.Expectation(2, 3, ("a", "b"))
    for n, data in enumerate(([(i, None, new) for i in range(8)] + [(None, new, None)], [])):
        rows = table(spark, data)
        path = str(tmp_path / str(n))
        facts_written = checks.checked_write(rows, "T", expected, lambda df, to=path: df.write.parquet(to))
        stored = spark.read.parquet(path)
        assert stored.count() == len(data)
        assert facts_written.collect() == checks.table_facts(stored, "T", expected).collect()


def test_sketches_of_days_add_up(spark):
    from ludolytics.operators.sketches import distinct_counts, relative_error, sketches

    rows = spark.range(60_000).selectExpr("id % 3 AS tag", "id % 7 AS day", "id % 20000 AS player")
    stored = sketches(rows, ["tag", "day"], "player")
    assert stored.count() == 21
    for r in distinct_counts(stored, ["tag"]).collect():
        assert abs(r.n_distinct - 20_000) <= 20_000 * relative_error()
    few = distinct_counts(stored.where("day < 0"), ["tag"])
    assert few.count() == 0
    empty = sketches(rows.selectExpr("tag", "CAST(NULL AS bigint) AS player"), ["tag"], "player")
    assert {r.n_distinct for r in distinct_counts(empty, ["tag"]).collect()} == {0}
