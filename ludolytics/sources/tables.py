"""Parquet tables: keyed tables as logs of changes, and tables replaced or appended by date.

MERGE needs a row-level capable catalogue (`operators.upsert.merge_into`), which plain
Parquet is not. A ChangeTable therefore only adds: every micro-batch becomes a partition
(stream query, epoch) of a change table, and the state is the fold of all changes by key. A
batch writes its own rows and no others; a repeated epoch overwrites its own partition; a
new checkpoint is a new query and so overwrites nothing. A scheduled run stores the state
as a mart; readers fold it with the files written since.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics.operators.upsert import STAMPS, upsert
from ludolytics.sources.schemas import Table

QUERY, EPOCH = "_query", "_epoch"
DAY, VERSION = "_day", "_version"


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def _stored(
    spark: SparkSession, path: str, schema: T.StructType, written_since: datetime | None = None
) -> DataFrame:
    """The Parquet rows below a path, or of its files written since; none where nothing was written yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
        if written_since is None:
            return found
        # A condition on the file alone: older files are left out of the scan.
        since = F.timestamp_seconds(F.lit(written_since.replace(tzinfo=UTC).timestamp()))
        return found.where(F.col("_metadata.file_modification_time") >= since)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class ChangeTable:
    """A table whose rows are unique by key, kept as its changes.

    newer_by names a column by which a change is newer than another; without it the one
    that came later is. The first change of a key gives the columns that aren't updated.
    overlap is longer than any batch takes: files may become visible that much later than they were written.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: Table,
        root: str,
        newer_by: str | None = None,
        overlap: timedelta = timedelta(days=1),
    ) -> None:
        self.spark = spark
        self.table = table
        self.newer_by = newer_by
        self.root = root.rstrip("/")
        self.overlap = overlap
        self.changes = f"{self.root}/{table.name}/changes"
        self._state = replace(table, name=f"{table.name}/state")
        extra = [T.StructField(QUERY, T.StringType()), T.StructField(EPOCH, T.LongType())]
        self._change_schema = T.StructType([*table.schema.fields, *extra])

    def write(self, rows: DataFrame, as_of: Column, query: str, epoch: int) -> None:
        """Adds the changes of one epoch, or writes them again; rows without a whole key are left out."""
        stamped = rows.dropna(subset=list(self.table.keys)).withColumns({stamp: as_of for stamp in STAMPS})
        given = [
            (F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.table.schema.fields
        ]
        (
            stamped.select(*given, F.lit(query).alias(QUERY), F.lit(epoch).cast("long").alias(EPOCH))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(QUERY, EPOCH)
            .parquet(self.changes)
        )

    def changes_in(self) -> DataFrame:
        """All changes that were written, in the table's columns."""
        return _stored(self.spark, self.changes, self._change_schema).select(*self.table.schema.names)

    def _read_from(self) -> DataFrame:
        """The stored state and the changes that it may lack."""
        version = latest_version(self.spark, self._state, self.root)
        if version is None:
            return _stored(self.spark, self.changes, self._change_schema)
        since = datetime.strptime(version, _VERSION_FORMAT) - self.overlap
        changes = _stored(self.spark, self.changes, self._change_schema, since)
        state = read_latest(self.spark, self._state, self.root)
        return state.withColumns({QUERY: F.lit(""), EPOCH: F.lit(-1).cast("long")}).unionByName(changes)

    def read(self) -> DataFrame:
        """The state as of now; an empty table where nothing was written yet.

        Changes count by when their file was written, not by their own times, so a late run, or an
        earlier one repeated under its old time, is never missed.
        """
        return self._folded(self._read_from())

    def _folded(self, changes: DataFrame) -> DataFrame:
        names = self.table.schema.names
        updated = [c for c in (self.table.update_cols or names) if c not in (*self.table.keys, *STAMPS)]
        fixed = [c for c in names if c not in (*self.table.keys, *STAMPS, *updated)]
        comparable = [f.name for f in self.table.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        own = ["fetched_at"] if "fetched_at" in names else []
        # The hash only decides between changes of equal times, so that a rerun repeats itself.
        arrival = ["updated_at", EPOCH, *own, F.xxhash64(*comparable)]
        first = F.struct("inserted_at", *arrival)
        last = F.struct(*([self.newer_by] if self.newer_by else []), *arrival)
        folds = [F.min("inserted_at").alias("inserted_at"), F.max_by(F.struct("updated_at", *updated), last).alias("_last")]
        if fixed:
            folds.append(F.min_by(F.struct(*fixed), first).alias("_first"))
        folded = changes.groupBy(*self.table.keys).agg(*folds)

        def column(name: str) -> Column:
            if name in self.table.keys or name == "inserted_at":
                return F.col(name)
            return F.col("_first" if name in fixed else "_last")[name].alias(name)

        return folded.select(*[column(name) for name in names])

    def refresh(self, whole: bool = False) -> None:
        """Stores the state as a mart, on a schedule; readers then leave older changes out.

        Folding a change twice changes nothing, so refreshes and batches may overlap. Rows that a
        repeated batch no longer has stay in a stored state; `whole` folds all changes anew.
        Retention may drop changes older than the version before last less the overlap.
        """
        began = datetime.now(UTC).replace(tzinfo=None)
        all_changes = _stored(self.spark, self.changes, self._change_schema)
        replace_table(self._folded(all_changes if whole else self._read_from()), self._state, self.root, began)


# ---- tables kept by date ------------------------------------------------------


def read_table(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """The stored rows; an empty table where nothing was written yet."""
    path = f"{root.rstrip('/')}/{table.name}"
    return _stored(spark, path, table.schema).select(*table.schema.names)


def read_dates(
    spark: SparkSession, table: Table, root: str, low: date | str, high: date | str
) -> DataFrame:
    """The stored rows of a table appended by date, between two dates; other partitions are not listed into the scan."""
    dated = T.StructType([*table.schema.fields, T.StructField(DAY, T.DateType())])
    stored = _stored(spark, f"{root.rstrip('/')}/{table.name}", dated)
    days = F.col(DAY).between(F.lit(str(low)).cast("date"), F.lit(str(high)).cast("date"))
    return stored.filter(days).select(*table.schema.names)


def _typed(rows: DataFrame, table: Table) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])


def replace_date(
    rows: DataFrame, table: Table, root: str, date_col: str, day: date | str
) -> None:
    """Replaces the rows of one day, also by none; all other days stay.

    New files are staged before the old ones go. Only a day that becomes empty is simply cleared.
    """
    chosen = F.col(date_col) == F.lit(str(day)).cast("date")
    of_day = _typed(rows, table).filter(chosen)
    path = f"{root.rstrip('/')}/{table.name}"
    if of_day.isEmpty():
        of_day.drop(date_col).write.mode("overwrite").parquet(f"{path}/{date_col}={day}")
        return
    writer = of_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(date_col).parquet(path)


def append(
    rows: DataFrame, table: Table, root: str, date_of: str | None = None, replace: bool = False
) -> None:
    """Adds rows; date_of names a time by whose date the files are partitioned.

    With `replace`, the rows take the place of all stored ones of their dates; new files are
    staged before the old ones go, so the rows may come from these dates.
    """
    typed = _typed(rows, table)
    by: Sequence[str] = ()
    if date_of is not None:
        typed, by = typed.withColumn(DAY, F.to_date(date_of)), (DAY,)
    writer = typed.write.mode("append")
    if replace:
        writer = typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(f"{root.rstrip('/')}/{table.name}")


_VERSION_FORMAT = "%Y-%m-%dT%H-%M-%S.%f"
_VERSIONS = T.StructType([T.StructField(VERSION, T.StringType()), T.StructField("rows", T.LongType())])


def _version_text(version: date | datetime | str) -> str:
    """A date or time as text that sorts by it; anything else is refused."""
    if isinstance(version, date) and not isinstance(version, datetime):
        version = datetime(version.year, version.month, version.day)
    if not isinstance(version, (datetime, str)):
        raise ValueError(f"a version is a date or a time, not {version!r}")
    return datetime.fromisoformat(str(version)).strftime(_VERSION_FORMAT)


def replace_table(rows: DataFrame, table: Table, root: str, version: date | datetime | str) -> None:
    """Stores a whole mart as a version of its own (a date or time); a repeated version replaces itself.

    Readers go by a table of versions, whose row is written last, also for a mart without rows. A
    version that becomes empty when it is repeated is cleared before that.
    """
    text, path = _version_text(version), f"{root.rstrip('/')}/{table.name}"
    stamped = _typed(rows, table).withColumn(VERSION, F.lit(text))
    if stamped.isEmpty():
        stamped.drop(VERSION).write.mode("overwrite").parquet(f"{path}/{VERSION}={text}")
    else:
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(VERSION).parquet(path)
    done = rows.sparkSession.range(1).select(F.col("id").alias("rows"), F.lit(text).alias(VERSION))
    writer = done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(VERSION).parquet(f"{path}_VERSIONS")


def latest_version(spark: SparkSession, table: Table, root: str) -> str | None:
    """The text of the latest version that was written to its end; reads folder names alone."""
    versions = _stored(spark, f"{root.rstrip('/')}/{table.name}_VERSIONS", _VERSIONS)
    return versions.agg(F.max(VERSION)).first()[0]


def read_latest(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """The rows of the latest version; none where that one has none, or nothing was written yet."""
    path = f"{root.rstrip('/')}/{table.name}"
    last = latest_version(spark, table, root)
    versioned = T.StructType([*table.schema.fields, T.StructField(VERSION, T.StringType())])
    stored = _stored(spark, path, versioned)
    return stored.where(F.col(VERSION) == F.lit(last)).select(*table.schema.names)


def with_stamps(rows: DataFrame, table: Table, as_of: Column) -> DataFrame:
    """Fills the stamp columns that the table has and the rows lack."""
    missing = [c for c in (*STAMPS, "processed_at") if c in table.schema.names]
    return rows.withColumns({c: as_of for c in missing if c not in rows.columns})


def upsert_date(
    spark: SparkSession,
    rows: DataFrame,
    table: Table,
    root: str,
    day: date | str,
    date_col: str,
    as_of: Column,
) -> None:
    """Merges the rows of one day into that day's partition and rewrites only it."""
    chosen = F.col(date_col) == F.lit(str(day)).cast("date")
    stored = read_table(spark, table, root).filter(chosen)
    stamped = with_stamps(rows.filter(chosen), table, as_of)
    merged = upsert(stored, stamped, table.keys, as_of, order=[date_col])
    # Dynamic overwrite stages the new files first, so the day may be read and replaced.
    (
        _typed(merged, table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(f"{root.rstrip('/')}/{table.name}")
    )
