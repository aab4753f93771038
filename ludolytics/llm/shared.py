"""Helpers that several operators use."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word, and the class of all others: `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def keep(df: DataFrame) -> DataFrame:
    """The same rows, read back from the folder that spark.checkpoint.dir names.

    This cuts the lineage and makes one computation serve several readers; the files are
    on shared storage, so they outlive executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Unset, it is a temporary one where all runs in one process, and refused on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="checkpoint-")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many `_` added as it takes to clash with no column, upper and lower case being one."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(df: DataFrame, name: str = "_row") -> DataFrame:
    """The rows with a unique key that stays: the place in its file, or where the plan is more than a Parquet table a number written once."""
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            place = F.concat_ws(":", F.hex(F.xxhash64("_metadata.file_path")), "_metadata.row_index")
            return df.select("*", place.alias(name))
        except AnalysisException:  # no Parquet
            pass
    return keep(df.withColumn(name, F.monotonically_increasing_id().cast("string")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task turns into Python objects at once, and that a stage of the pipeline sends to Python at once.
ROWS = 250
SENT_ROWS = 1000


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches' rows, in order, at most `rows` at once: however many Spark sends, few of their texts are Python objects at a time. An empty batch stays one."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function; when a task's rows end, its worker returns the memory that is free but held for more, as it may stay idle beside the next stages.

    Python's lists of free small objects go first, as one of them holds a megabyte; then what Arrow and the C library hold.
    """

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim()

    return whole


def trim() -> None:
    """Returns what the C library holds of freed memory, where it is one that can."""
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def process_store() -> dict:
    """Things that are costly to build, kept by a Python worker from task to task."""
    import sys
    import types

    return vars(sys.modules.setdefault("_ludolytics_llm_store", types.ModuleType("_ludolytics_llm_store")))


def once(key: tuple, build):
    """What `build` gives, built once in each Python worker."""
    store = process_store()
    name = repr(key)
    if name not in store:
        store[name] = build()
    return store[name]
