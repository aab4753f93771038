"""The pipeline's stages, each against a plain version on what its predecessor kept."""

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from conftest import SF_DIR

from ludolytics.llm import bpe, mixing, pii, simhash, toxicity
from ludolytics.llm.shared import table


def test_every_stage_takes_effect(spark, tmp_path):
    import tiktoken

    kept, docs = [], table(spark, SF_DIR, "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        kept.append(docs)
        docs = spark.read.parquet(str(tmp_path / str(k)))
    start, clean, single, masked, mixed = kept
    assert all(df.columns == start.columns for df in kept)
    model = toxicity.train(start, table(spark, SF_DIR, "labels"))
    texts = {r.doc_id: r.text for r in start.collect()}
    assert {r.doc_id for r in clean.collect()} == {d for d, t in texts.items() if model.score(t) < 0.5}
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))
    field = pii.train()
    assert {r.doc_id: r.text for r in masked.collect()} == {r.doc_id: pii.mask_text(r.text, pii.find(r.text, field)) for r in single.collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix(masked).collect() if r.taken}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    expected = Counter((r.doc_id, r.source, len(library.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert Counter((r.doc_id, r.source, r.n_tokens, r.decoded_sha256) for r in docs.collect()) == expected
