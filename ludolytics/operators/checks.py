"""Table checks: freshness, row count and missing values from one scan per table, or from none: during its write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ludolytics.functions import hours_between, ntz

TIME_COLUMNS = ("fetched_at", "inserted_at", "updated_at")
MAX_NULL_PCT = 10.0

_NULLS = "array<struct<column_name:string,null_count:bigint,error:string>>"


@dataclass(frozen=True)
class Expectation:
    max_age_hours: int
    min_rows: int
    critical_columns: tuple[str, ...]


def _stated(name: str, expected: Expectation) -> list:
    return [
        F.lit(name).alias("table_name"),
        F.lit(float(expected.max_age_hours)).alias("threshold_hours"),
        F.lit(expected.min_rows).cast("bigint").alias("min_expected"),
    ]


def _measures(columns: Sequence[str], expected: Expectation, time_columns: Sequence[str]) -> list[Column]:
    """Row count, latest time and missing values; only columns that the table has are read."""
    times = [F.col(c) for c in time_columns if c in columns]
    last = F.max(F.coalesce(*times)) if times else F.lit(None)
    return [
        F.count(F.lit(1)).alias("row_count"),
        last.cast("timestamp_ntz").alias("last_update"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in expected.critical_columns if c in columns],
    ]


def _facts(measured: DataFrame, name: str, expected: Expectation) -> DataFrame:
    """The measures of a table as its facts; a critical column that it lacks is an error of that column alone."""
    nulls = []
    for c in expected.critical_columns:
        present = f"null_{c}" in measured.columns
        nulls.append(
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col(f"null_{c}") if present else F.lit(None)).cast("bigint").alias("null_count"),
                F.lit(None if present else f"no column {c}").cast("string").alias("error"),
            )
        )
    return measured.select(
        *_stated(name, expected),
        "row_count",
        "last_update",
        F.array(*nulls).cast(_NULLS).alias("nulls"),
        F.lit(None).cast("string").alias("error"),
    )


def table_facts(
    df: DataFrame,
    name: str,
    expected: Expectation,
    time_columns: Sequence[str] = TIME_COLUMNS,
) -> DataFrame:
    """One row: row count, latest time and missing values of the critical columns."""
    return _facts(df.agg(*_measures(df.columns, expected, time_columns)), name, expected)


def checked_write(
    rows: DataFrame,
    name: str,
    expected: Expectation,
    write: Callable[[DataFrame], None],
    time_columns: Sequence[str] = TIME_COLUMNS,
) -> DataFrame:
    """Writes rows and gives the facts of what was written, counted by the write itself.

    `write` must run one job on all rows (an append, say): the first job that ends gives the counts.
    A task that is run again counts once. A failed write raises.
    """
    seen = Observation()
    write(rows.observe(seen, *_measures(rows.columns, expected, time_columns)))
    types = {"row_count": "bigint", "last_update": "timestamp_ntz"}
    values = seen.get
    measured = rows.sparkSession.createDataFrame(
        [tuple(values.values())], ", ".join(f"`{c}` {types.get(c, 'bigint')}" for c in values)
    )
    return _facts(measured, name, expected)


def _unreadable(spark: SparkSession, name: str, expected: Expectation, error: str) -> DataFrame:
    failed = [
        F.struct(F.lit(c), F.lit(None).cast("bigint"), F.lit(error))
        for c in expected.critical_columns
    ]
    return spark.range(1).select(
        *_stated(name, expected),
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("timestamp_ntz").alias("last_update"),
        F.array(*failed).cast(_NULLS).alias("nulls"),
        F.lit(error).alias("error"),
    )


def collect_facts(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    expectations: Mapping[str, Expectation],
    alone: bool = False,
) -> DataFrame:
    """The facts of all tables. A table that cannot be opened gives a row with the error.

    With `alone`, each table is scanned by a job of its own, here and now, so that one whose
    files cannot be read gives a row with the error too, and the others their facts.
    """
    rows = []
    for name, expected in expectations.items():
        failures = (PySparkException, Py4JJavaError, KeyError) if alone else (AnalysisException, KeyError)
        try:
            table = tables[name]
            facts = table_facts(table() if callable(table) else table, name, expected)
            if alone:
                facts = spark.createDataFrame(facts.collect(), facts.schema)  # one row
            rows.append(facts)
        except failures as failure:
            rows.append(_unreadable(spark, name, expected, _cause(failure)))
    return reduce(DataFrame.unionByName, rows)


def _cause(failure: Exception) -> str:
    """What an error row names: the class of the failure, or of the job's on the side of the JVM."""
    if isinstance(failure, Py4JJavaError):
        return failure.java_exception.getClass().getSimpleName()
    return type(failure).__name__


def age_in_hours(as_of: datetime | str) -> Column:
    return hours_between(F.col("last_update"), ntz(as_of))


def freshness_status(as_of: datetime | str) -> Column:
    return (
        F.when(F.col("error").isNotNull(), "ERROR")
        .when(age_in_hours(as_of) <= F.col("threshold_hours"), "PASS")
        .otherwise("FAIL")
    )


def volume_status() -> Column:
    return (
        F.when(F.col("error").isNotNull(), "ERROR")
        .when(F.col("row_count") >= F.col("min_expected"), "PASS")
        .otherwise("FAIL")
    )


def freshness(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    return facts.select(
        "table_name",
        freshness_status(as_of).alias("status"),
        "last_update",
        F.round(age_in_hours(as_of), 2).alias("hours_since_update"),
        "threshold_hours",
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("last_update").isNull(), "No data found")
        .alias("error"),
    )


def row_counts(facts: DataFrame) -> DataFrame:
    return facts.select(
        "table_name", volume_status().alias("status"), "row_count", "min_expected", "error"
    )


def null_percentages(facts: DataFrame) -> DataFrame:
    """One row per critical column; an empty table has 0 percent."""
    columns = facts.select("table_name", "row_count", F.inline("nulls"))
    share = F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    pct = F.coalesce(share * 100.0, F.lit(0.0))
    readable = F.col("error").isNull()
    return columns.select(
        "table_name",
        "column_name",
        F.when(~readable, "ERROR")
        .when(pct <= MAX_NULL_PCT, "PASS")
        .otherwise("FAIL")
        .alias("status"),
        F.when(readable, F.round(pct, 2)).alias("null_percentage"),
        "null_count",
        F.col("row_count").alias("total_rows"),
        "error",
    )
