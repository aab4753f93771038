"""The pipeline's stages on rows without an id and with repeated ones."""

import random
from collections import Counter

import corpus_pipeline

from ludolytics.llm import mixing

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_null_and_repeated_ids(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    same = text(30)
    rows = [(7, same, "en", "a", 0)] * 3 + [(None, same, "en", "a", 0)] + [(None, text(20 + k), "en", "b", 0) for k in range(4)] + [(8, text(40 + k), "en", "b", 0) for k in range(3)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    single = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(map(str, single.collect())) == sorted(str(r) for r in docs.distinct().collect() if r.doc_id or r.text != same)
    for given in (docs, single):
        masked = corpus_pipeline.mask_personal_data(spark, given, "")
        decided = mixing.mix(masked)
        taken, mixed = Counter(), Counter()
        for row in decided.collect():
            taken[row.doc_id] += row.taken
        for row in corpus_pipeline.mix_sources(spark, masked, "").collect():
            mixed[row.doc_id] += len(row.text.split())
        assert mixed == Counter({k: n for k, n in taken.items() if n}) and mixed[None]
