"""Data quality of the monitored tables: checks, report and alert lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.operators.checks import (
    Expectation,
    age_in_hours,
    freshness_status,
    volume_status,
)

# Hours a table may be old, rows it must have, columns that must be filled.
EXPECTATIONS = {
    "GAME_INFO": Expectation(48, 1000, ("appid", "name")),
    "GAME_PLAYER_COUNTS": Expectation(1, 100, ("appid", "live_player_count", "fetched_at")),
    "GAME_REVIEWS": Expectation(168, 100, ("appid", "review_text", "voted_up")),
    "GAME_DETAILS": Expectation(168, 100, ("appid", "name", "short_description")),
    "PLAYERS": Expectation(168, 10, ("steamid", "personaname")),
    "PLAYER_STATS": Expectation(168, 10, ("steamid", "appid")),
}


def _verdicts(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Freshness and row count status of each table, still one row per table."""
    return facts.select(
        "table_name",
        freshness_status(as_of).alias("freshness"),
        F.round(age_in_hours(as_of), 2).alias("hours_since_update"),
        volume_status().alias("volume"),
        "row_count",
        "min_expected",
    )


def quality_report(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    """One row; HEALTHY only if every freshness and row count check passes.

    Missing values are reported by their own query and do not change the status.
    """
    verdicts = _verdicts(facts, as_of)
    fresh, full = F.col("freshness") == "PASS", F.col("volume") == "PASS"
    return verdicts.agg(
        F.count_if(fresh).alias("freshness_passed"),
        F.count(F.lit(1)).alias("freshness_total"),
        F.count_if(full).alias("row_count_passed"),
        F.count(F.lit(1)).alias("row_count_total"),
        F.when(F.bool_and(fresh & full), "HEALTHY").otherwise("DEGRADED").alias("overall_status"),
    )


def quality_alerts(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    """One line per failed freshness or row count check; none if all is well."""
    hours = F.when(F.col("hours_since_update").isNotNull(), F.format_string("%.2f", "hours_since_update"))
    stale = F.concat("table_name", F.lit(" is out of date: hours without a new row "), F.coalesce(hours, F.lit("unknown")))
    rows = F.coalesce("row_count", F.lit(0))
    small = F.format_string("%s is too small: it has %s of at least %s rows", "table_name", rows, "min_expected")
    checks = F.array(
        F.struct(
            F.lit("freshness").alias("check_name"),
            F.col("freshness").alias("status"),
            stale.alias("message"),
        ),
        F.struct(
            F.lit("row_count").alias("check_name"),
            F.col("volume").alias("status"),
            small.alias("message"),
        ),
    )
    return (
        _verdicts(facts, as_of)
        .select("table_name", F.inline(checks))
        .filter(F.col("status") != "PASS")
    )
