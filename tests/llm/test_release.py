"""What a task gives back when it ends."""

import gc
import random
import sys

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from conftest import SF_DIR

from ludolytics.llm import bpe, pii, toxicity
from ludolytics.llm.shared import ROWS, SENT_ROWS, giving_back, pieces, table


def test_an_encoder_gives_back_what_it_remembers():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    texts = ["", "Ein Text, und noch ein Text.", "a" * 10_000, "naïve Ωμέγα 漢字 🙂 " * 50]
    first = [encoder(text) for text in texts]
    encoder.release()
    assert not encoder._words and not encoder.machine._pairs and len(encoder.machine._states) == 1
    assert [encoder(text) for text in texts] == first


class Rows:
    """Stands for a table; its tasks' function is what comes back."""

    columns, schema = ["doc_id", "text"], None

    def select(self, names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_tasks_give_back_what_arrow_holds(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            Pool.released += 1

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [None, None]}, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    stages = [pii.mask(Rows(), field=object()), toxicity.clean(Rows(), toxicity.Model({}, -9.0))]
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    for k, run in enumerate(stages):
        found = run(iter([batch, batch]))
        assert next(found).equals(batch) and Pool.released == k
        assert [b.equals(batch) for b in found] == [True] and Pool.released == k + 1


def test_a_task_leaves_no_free_objects_behind():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    drawn = random.Random(3)
    texts = [" ".join("".join(drawn.choices("abcdefghij", k=9)) for _ in range(200)) for _ in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": texts})

    @giving_back
    def run(batches):
        for found, _ in bpe.encode_batches(batches, encoder):
            yield found

    gc.collect()
    held = sys.getallocatedblocks()
    assert sum(found.num_rows for found in run(iter([batch]))) == 40
    assert sys.getallocatedblocks() - held < 1500


def test_few_rows_are_python_objects_at_once():
    class Plain:
        def __call__(self, text):
            return text.encode()

        def release(self):
            pass

    rows = 2 * ROWS + 1
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": ["a"] * rows})
    found = list(bpe.encode_batches(iter([batch, batch.slice(0, 0)]), Plain()))
    assert [len(packed) for _, packed in found] == [ROWS, ROWS, 1, 0]
    assert [k for piece, _ in found for k in piece.column(0).to_pylist()] == list(range(rows))
    assert list(pieces(iter([]))) == []


def test_stages_run_on_their_own_send_few_rows_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs, before = table(spark, SF_DIR, "documents"), spark.conf.get(name)
    try:
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_copies, corpus_pipeline.mask_personal_data, corpus_pipeline.encode_tokens):
            spark.conf.set(name, "10000")
            stage(spark, docs, SF_DIR)
            assert int(spark.conf.get(name)) == SENT_ROWS
    finally:
        spark.conf.set(name, before)
