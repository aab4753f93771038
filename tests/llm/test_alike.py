"""Near copies that fingerprints miss."""

import itertools
import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np

from ludolytics.llm import alike, simhash
from ludolytics.llm.shared import table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def five_words(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_stage_drops_alike_texts_that_fingerprints_miss(spark):
    rng = random.Random(8)
    common = [f"c{rng.randrange(50)}" for _ in range(30)]
    rows = []
    for k in range(25):
        words = common[: rng.choice([0, 30])] + [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 40, 90]))]
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    prints = {d: simhash.fingerprint(t.encode()) for d, t, *_ in rows}
    sets = {d: five_words(t) for d, t, *_ in rows}
    group = {d: d for d in sets}
    missed = 0
    for a, b in itertools.combinations(sorted(sets), 2):
        near = (prints[a] ^ prints[b]).bit_count() <= 2
        same = 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
        missed += same and not near
        if (near or same) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {d: low if g == high else g for d, g in group.items()}
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert missed > 5 and sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))


def test_copies_of_one_text_meet_few_others(spark, monkeypatch):
    """Copies alike their text, but often not each other: compared with it, hardly a pair is left; all alike are still connected."""
    rng = random.Random(11)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(base)]
    for _ in range(80):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 2, 3, 3, 6])):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    compared, verified = [], alike._verified

    def counting(given, pairs):
        compared.append(pairs.count())
        return verified(given, pairs)

    monkeypatch.setattr(alike, "_verified", counting)
    found = alike.links(spark.createDataFrame([(t,) for t in [*texts, *texts[:9]]], "text string").repartition(3)).collect()
    known: dict[bytes, int] = {}
    sets = {alike.signature(w): alike.shingles(w, known) for w in (alike.words_of(t.encode()) for t in texts)}
    near = [(u, v) for u, v in itertools.combinations(sets, 2) if alike.alike(sets[u], sets[v])]
    assert all(alike.alike(sets[r.u], sets[r.v]) for r in found)

    def parts(pairs):
        group = {s: s for s in sets}
        for u, v in pairs:
            low, high = sorted((group[u], group[v]))
            group = {s: low if g == high else g for s, g in group.items()}
        return group

    assert parts(near) == parts([(r.u, r.v) for r in found])
    assert len(near) > 300 and compared[0] < 120 and compared[1] < 5


def test_prefixes_of_alike_sets_meet():
    rng = random.Random(9)
    counts = np.random.default_rng(9).integers(0, 4, alike.SLOTS).astype(np.uint16)
    near = 0
    for _ in range(600):
        words = [b"%d" % rng.randrange(60) for _ in range(rng.randint(1, 80))]
        other = list(words)
        for _ in range(rng.choice([1, 1, 2])):
            other[rng.randrange(len(other))] = b"x"
        a, b = alike.shingles(words, {}), alike.shingles(other, {})
        one, two = (alike.prefix(s, counts).tolist() for s in (a, b))
        if alike.alike(a, b):
            near += 1
            i = next(i for i, s in enumerate(one) if s in two)  # where they meet first
            assert alike.may_be_alike(len(a), len(b), len(a) - i, len(b) - two.index(one[i]))
            assert 9 * int(np.bitwise_count((alike.sketch(a) ^ alike.sketch(b)).view(np.uint64)).sum()) <= len(a) + len(b)
    assert near > 100


def test_slots_count_the_shingles_of_all_texts(spark):
    texts = [f"a{k % 7} b c d e f{k % 3}" if k % 4 else None for k in range(200)]
    sums = alike.slot_sums(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    counts = Counter(int(s) for t in texts for s in alike.slots(alike.shingles(alike.words_of((t or "").encode()), {})))
    assert {int(k): int(sums[k]) for k in np.flatnonzero(sums)} == dict(counts)


def test_given_documents_have_48_more_pairs_linked(spark):
    """All rows of the larger given table: 48 pairs of texts of different words are alike by 0.8, and all are linked."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    texts = {alike.signature(words): words for words in (alike.words_of(r.text.encode()) for r in docs.select("text").distinct().collect()) if words}
    known: dict[bytes, int] = {}
    sets = {s: set(alike.shingles(w, known).tolist()) for s, w in texts.items()}
    holders = defaultdict(list)
    for s, found in sets.items():
        for h in sorted(found)[: len(found) - (4 * len(found) + 4) // 5 + 1]:
            holders[h].append(s)
    pairs = {(u, v) for group in holders.values() for u, v in itertools.combinations(sorted(group), 2)}
    pairs = {(u, v) for u, v in pairs if 5 * len(sets[u] & sets[v]) >= 4 * len(sets[u] | sets[v])}
    group = {s: s for s in sets}
    for r in alike.links(docs.select("text")).collect():
        assert (min(r.u, r.v), max(r.u, r.v)) in pairs
        low, high = sorted((group[r.u], group[r.v]))
        group = {s: low if g == high else g for s, g in group.items()} if low != high else group
    assert len(pairs) == 48 and all(group[u] == group[v] for u, v in pairs)
