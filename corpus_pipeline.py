"""A corpus pipeline of five stages: each works on all that its predecessor kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; `run` writes each stage's rows
to the folder that spark.checkpoint.dir names (where all runs in one process and it is unset,
to a temporary one) and reads them again for the next. SQL cannot express these stages.

Every stage takes any rows: a null text is an empty one, an empty table gives an empty
table, repeated rows are rows of their own (of copies, one stays), and all columns but text
and n_chars go through as they are, whatever their names.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.llm import bpe, mixing, pii, simhash, toxicity
from ludolytics.llm.shared import SENT_ROWS, free_name, shared_folder, table, with_rows

ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, run on its own or by `run`, with few rows at once on their way to Python: a whole partition in one batch is held by both sides at the same time."""

    @functools.wraps(stage)
    def set_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SENT_ROWS))
        return stage(spark, docs, sf_dir)

    return set_first


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a model, trained on them and the labels, does not take for toxic.

    Null and empty texts stay unless texts without a known word are taken for toxic; without a
    toxic label all stay.
    """
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: fingerprints within two bits, or five-word shingles alike by 0.8 or more.

    Texts without words are one group. The row of the least id stays, a null one only if the
    group has no other; ties go by the place of the row.
    """
    return simhash.first_rows(docs)


@in_small_batches
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and their new lengths; a null text stays null."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row for each copy of a document that it takes.

    Texts without words have no size, so the mix takes nothing of them. Null is a source.
    """
    row = free_name(docs, "_row")
    keyed = with_rows(docs, row)
    mixed = mixing.apply_mix(keyed, mixing.mix(keyed, row_col=row), row_col=row)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@in_small_batches
def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256, decoded_sha256 of each row of the mix; a null text has no tokens."""
    done = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, carry=("source",))
    return done.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    folder = f"{root.rstrip('/')}/corpus-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
