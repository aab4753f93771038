"""Every operator against a brute-force version on small tables with hard rows, and against its SQL."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import database, differences
from conftest import SF_DIR

from ludolytics.llm import bpe, chat, components, lm, lzhash, mixing, pii, quality, simhash, tokencount, toxicity
from ludolytics.llm.queries import ORACLE, QUERIES
from ludolytics.llm.shared import free_name, with_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{k % 977} mail{k}@mail.example.com" for k in range(9000))
HARD = [
    (1, "The quick brown fox.\nThe quick brown fox.\nThe quick brown fox. and so on it is", "a", "x"),
    (2, None, "a", "x"),
    (3, "", None, "x"),
    (4, " \t\n\r ", "b", None),
    (5, LONG, "b", "x"),
    (6, "ÄÖÜ é 中文 🙂 +1 (076) 555-8046, 4111 1111 1111 1111, 1.2.3.4, 300.1.1.1", "b", "x"),
    (6, "ÄÖÜ é 中文 🙂 +1 (076) 555-8046, 4111 1111 1111 1111, 1.2.3.4, 300.1.1.1", "b", "x"),
    (7, "x" * 50_000, "c", "x"),
    (None, "no id here but many words in the text of it", "c", "x"),
    (8, "[INST] <|turn|> <\\|end|> </s> it's <|endoftext|> done", "c", "x"),
]
COLUMNS = "doc_id long, text string, source string, spans string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(HARD, COLUMNS).selectExpr("*", "1 AS fingerprint", "2 AS size", "3 AS ids", "4 AS words", "5 AS key")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows_of(df, key="doc_id"):
    found = defaultdict(list)
    for row in df.collect():
        found[row[key]].append(row)
    return found


def test_native_queries_equal_their_sql(spark):
    db = database(SF_DIR)
    for name, sql in ORACLE.items():
        assert differences(QUERIES[name](spark, SF_DIR), db, sql) is None, name


# ---- op1 ---------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in BASE.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            fits = {
                "email": True,
                "ip": all(int(part) < 256 for part in match[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits) if kind == "card" else False,
                "phone": 8 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((kind, *match.span()))
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    pieces = ["1", "23", ".", "-", " ", "@", "a", "b.c", "+", "4", "255", "(", ")", "%", "4111 1111 1111 1111"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))
        assert pii.base_spans(text) == plain_base(text)


def test_field_finds_unusual_forms_on_held_out_sentences():
    field = pii.train()
    right = wrong = total = 0
    for text, spans in pii.made_up(200, seed=99):
        found = set(field.decode(text, 0, len(text)))
        right, wrong, total = right + len(found & set(spans)), wrong + len(found - set(spans)), total + len(spans)
    assert right >= 0.95 * total and wrong <= 0.05 * total


def test_decoding_is_the_best_segmentation():
    field = pii.train()
    text = "a 076-555-8046 b"
    tokens, found = pii.segments(text, 0, len(text))
    scores = field.scores(field.rows(text, tokens, found))
    at = {span: k for k, span in enumerate(found)}

    def best(place, before):
        if place == len(tokens):
            return 0.0, []
        options = []
        value, rest = best(place + 1, 0)
        options.append((field.steps[before, 0] + value, rest))
        for (i, j), k in at.items():
            if i == place:
                for y in range(len(pii.KINDS)):
                    value, rest = best(j, y + 1)
                    options.append((field.steps[before, y + 1] + scores[k, y] + value, [(pii.KINDS[y], tokens[i][0], tokens[j - 1][1]), *rest]))
        return max(options, key=lambda o: o[0])

    assert best(0, 0)[1] == field.decode(text, 0, len(text))


def test_pii_on_hard_rows(docs, none):
    found = rows_of(pii.digests(pii.spans(docs)))
    assert sum(map(len, found.values())) == len(HARD)
    for doc_id, text, *_ in HARD:
        base = plain_base(text or "")
        for row in found[doc_id]:
            lines = [":".join(map(str, s)) for s in base]
            assert row["base_sha256"] == hashlib.sha256(",".join(lines).encode()).hexdigest()
            assert row["n_email"] == sum(s[0] == "email" for s in base)
            assert set(lines) <= set(row["spans"].split(",")) | {""}
    masked = rows_of(pii.mask(docs))
    assert masked[6][0]["text"].startswith("ÄÖÜ é 中文 🙂 <PHONE>, <CARD>, <IP>, 300")
    assert masked[2][0]["text"] is None and pii.mask(docs).columns == docs.columns
    assert pii.digests(pii.spans(none)).count() == 0


# ---- op2 ---------------------------------------------------------------------------


def test_nnpu_finds_toxic_words_from_positives_and_unlabelled(spark):
    rng = random.Random(1)
    words = [f"word{k}" for k in range(300)]
    data, labels, truth = [], [], {}
    for doc in range(1500):
        toxic = rng.random() < 0.15
        text = rng.choices(words, k=30) + (["vileA", "vileB"] if toxic else [])
        rng.shuffle(text)
        truth[doc] = toxic
        data.append((doc, " ".join(text)))
        if rng.random() < 0.6:
            labels.append((doc, int(toxic)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, given)
    assert {"vilea", "vileb"} <= set(model.weights) or "vile=" in model.weights
    found = toxicity.scores(docs, model).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 200 and all(bool(r.predicted) == truth[r.doc_id] for r in held)
    assert {r.doc_id for r in toxicity.clean(docs, model).collect()} == {r.doc_id for r in found if not r.predicted}


def test_negative_risk_is_not_followed():
    rng = np.random.default_rng(0)
    toxic = (rng.random((20, 60)) < 0.5).astype(np.float32)
    weights, bias = toxicity.fit_nnpu(toxic, toxic[:10], 0.5)
    assert np.isfinite(weights).all() and np.isfinite(bias)


def test_slope_equals_differences_of_the_plain_risk():
    """Row by row, on both sides of the point where the corrected part of the risk falls below nought."""
    rng = np.random.default_rng(1)
    toxic, other = (rng.random((9, 4)) < 0.6).astype(float), (rng.random((14, 4)) < 0.4).astype(float)
    undone = 0
    for prior, scale in itertools.product((0.1, 0.4, 0.7), (0.1, 1.0, 3.0)):

        def risks(w, prior=prior):
            loss = lambda row, sign: np.log1p(np.exp(-sign * (row @ w)))
            positive = prior * sum(loss(row, 1) for row in toxic) / len(toxic)
            return positive, sum(loss(row, -1) for row in other) / len(other) - prior * sum(loss(row, -1) for row in toxic) / len(toxic)

        for w in rng.normal(size=(20, 4)) * scale:
            undone += risks(w)[1] < 0
            aim = sum if risks(w)[1] >= 0 else (lambda r: -r[1])
            plain = [(aim(risks(w + e)) - aim(risks(w - e))) / 2e-5 for e in 1e-5 * np.eye(4)]
            assert np.allclose(toxicity.risk_slope(toxic, other, w, prior), plain, atol=1e-6)
    assert 0 < undone < 180


def test_an_id_of_many_rows_is_one_row_of_the_sample(spark, monkeypatch):
    """A third of all rows under one id: what is kept and collected stays as small as the ids."""
    sizes = []
    monkeypatch.setattr(toxicity, "keep", lambda df, own=toxicity.keep: sizes.append((out := own(df)).count()) or out)
    rows = [(7, f"vile {k}") for k in range(500)] + [(k, "vile slur" if k % 4 == 0 else "kind word") for k in range(100, 1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(100, 1100)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert sizes[0] <= 1001 and model.score("vile slur") > 0.5 > model.score("kind word")


def test_toxicity_on_hard_rows(docs, none, spark):
    model = toxicity.Model({"quick": 9.0}, -2.0)
    found = rows_of(toxicity.scores(docs, model))
    assert sum(map(len, found.values())) == len(HARD)
    assert found[1][0]["predicted"] == 1 and found[2][0]["score"] == found[3][0]["score"] < 0.5 and found[None][0]["held_out"]
    assert toxicity.scores(none, model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None and toxicity.train(none, labels.limit(0)) is None
    assert {r.score for r in toxicity.scores(docs, None).collect()} == {0.0}


# ---- op3 ---------------------------------------------------------------------------


def plain_fingerprint(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=2):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= distance:
            root[top(a)] = top(b)
    return {v: top(v) for v in values}


def test_near_duplicates_on_hard_rows(docs, none):
    found = rows_of(simhash.near_duplicates(docs))
    prints = {doc_id: plain_fingerprint(text) for doc_id, text, *_ in HARD}
    roots = plain_components(set(prints.values()))
    assert sum(map(len, found.values())) == len(HARD)
    for doc_id, value in prints.items():
        same = [d for d, v in prints.items() if d is not None and roots[v] == roots[value]]
        for row in found[doc_id]:
            assert row["fingerprint"] == f"{value:016x}" and row["component_id"] == min(same, default=None)
    assert simhash.near_duplicates(none).count() == 0


def test_fingerprint_links_alone_are_the_components(docs):
    """The setting of the query: no link but those of the fingerprints."""
    prints = [plain_fingerprint(t) for _, t, *_ in HARD]
    root = plain_components(prints)
    least = {}
    for (doc_id, *_), value in zip(HARD, prints, strict=True):
        if doc_id is not None:
            least[root[value]] = min(doc_id, least.get(root[value], doc_id))
    expected = sorted(str((d, f"{v:016x}", least.get(root[v]))) for (d, *_), v in zip(HARD, prints, strict=True))
    assert sorted(str(tuple(r)) for r in simhash.near_duplicates(docs, jaccard=False).collect()) == expected


@pytest.mark.parametrize("bucket", [2, 1000])
@pytest.mark.parametrize("plan", ["own", "wide", "whole"])
def test_search_loses_no_link(spark, bucket, plan):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(60)}
    fps = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    bits = tuple(range(64))
    plans = {
        "own": simhash.make_plan(*simhash.bit_counts(fps)),
        "wide": [simhash.Part(bits[:20], 0), simhash.Part(bits[20:], 1)],
        "whole": [simhash.Part(bits[:8], -1), simhash.Part(bits[8:], 2)],
    }
    chosen = plans[plan]
    assert sum(p.threshold + 1 for p in chosen) == 3 and sorted(b for p in chosen for b in p.bits) == list(bits)
    edges = simhash.links(fps, chosen, bucket=bucket)
    found = {r.node: r.root for r in components.components(edges).collect()}
    expected = plain_components({simhash.signed(v) for v in values})
    groups = lambda of: {frozenset(k for k in of if of[k] == r) for r in of.values()}
    whole = {v: found.get(v, v) for v in expected}
    signed_expected = plain_components(values)
    assert groups(whole) == {frozenset(simhash.signed(v) for v in g) for g in groups(signed_expected)}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(5, 5), (7, None), (200, 200)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: 100 for k in range(100, 161)} | {k: 0 for k in range(40)} | {200: 200}


# ---- op4, op5 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return tokencount.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_spliced_counts_equal_the_library(counter):
    rng = random.Random(2)
    pieces = ["AB Cd.", "x,y;Z9 ", "abcdefgh", "é é ́", "'s't're ", "<|endoftext|>", "0123 ", "\n\t  ", "!?.", "한국각", "İIß"]
    widened = 0
    for k in range(250):
        text = "".join(rng.choice(pieces) for _ in range(rng.choice([40, 300])))
        if k % 5 == 0:
            text = re.sub(r"\s", "", text)
        if k % 7 == 0:
            text = "a" * 900 + text
        expected = len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
        count, more = tokencount.splice_count(text, counter.ends, 256, 80)
        assert count == expected == counter.counts([text])[0]
        widened += more
    assert widened


def test_token_counts_on_hard_rows(docs, none, counter):
    found = rows_of(tokencount.token_counts(docs, public_tokenizers.path("word_bpe_49k.json")))
    for doc_id, text, *_ in HARD:
        n = len(counter.tokenizer.encode(text or "", add_special_tokens=False).ids)
        for row in found[doc_id]:
            assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len((text or "").encode()), n, n > 2048)
    assert sum(map(len, found.values())) == len(HARD)
    assert tokencount.token_counts(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def test_transducer_equals_the_library(library):
    rng, encoder = random.Random(4), bpe.Encoder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    tokens = list(encoder.machine.ranks)
    for _ in range(800):
        text = rng.choice([
            "".join(rng.choice("abcdeéüÖ🙂中 \n'\t0") for _ in range(rng.randint(1, 60))), "a" * rng.randint(1, 90),
            " " * rng.randint(1, 200) + "x", b"".join(rng.choices(tokens, k=8)).decode("utf8", "ignore"),
        ])
        assert list(memoryview(encoder(text)).cast("I")) == library.encode_ordinary(text)
    small = bpe.Transducer(encoder.machine.ranks, max_states=50)
    long = ("abcdefghij" * 3000).encode()
    blocks = [long[k : k + 7] for k in range(0, len(long), 7)]
    assert [t for part in small.stream(blocks) for t in part] == library._encode_single_piece(long)


def test_streaming_decoder():
    text = "aé中🙂߿￿" * 50
    data = text.encode()
    for size in (1, 2, 3, 5, 64):
        machine = bpe.Utf8Stream()
        assert "".join(machine.feed(data[k : k + size]) for k in range(0, len(data), size)) == text
        machine.close()
    for bad in (b"\xc0\x80", b"\xed\xa0\x80", b"\xf5\x80\x80\x80", b"a\xe9b", b"\x80"):
        with pytest.raises(ValueError):
            machine = bpe.Utf8Stream()
            for k in range(len(bad)):
                machine.feed(bad[k : k + 1])
            machine.close()


def test_round_trip_on_hard_rows(docs, none, library):
    found = rows_of(bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN, carry=("source",)))
    lists = rows_of(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN))
    back = rows_of(bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY))
    for doc_id, text, *_ in HARD:
        ids = library.encode_ordinary(text or "")
        for row in found[doc_id]:
            packed = np.array(ids, "<u4").tobytes()
            assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
            assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert lists[doc_id][0]["ids"] == ids and back[doc_id][0]["text"] == (text or "")
    assert bpe.round_trip(none, VOCABULARY, public_tokenizers.PATTERN).count() == 0


# ---- op6 ---------------------------------------------------------------------------


def test_mix_on_hard_rows(docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    first = mixing.mix(docs).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect())) and len(first) == len(HARD)
    sizes = Counter()
    for _, text, source, _ in HARD:
        sizes[source] += len(WORD.findall(text or ""))
    weights = dict(zip(["a", "b", "c", None], [5, 2, 1, 5], strict=True))
    free, total = set(weights), sum(sizes.values())
    while True:
        level = (total - sum(3 * sizes[s] for s in weights if s not in free)) / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        free -= over
    goal = {sizes[s]: level * weights[s] if s in free else 3 * sizes[s] for s in weights}
    taken = Counter()
    for row in first:
        assert row["target"] == pytest.approx(goal[row["source_size"]]) and 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source_size"]] += row["taken"]
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in goal)
    assert mixing.mix(none).count() == 0


def test_mix_takes_whole_epochs_and_cuts_one_document(spark):
    data = [(k, "s" if k < 5 else "t", " a b  c\nd e ") for k in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string")
    decided = mixing.mix(docs)
    took = {r.doc_id: r.taken for r in decided.collect()}
    assert [took[k] for k in range(5)] == [15] * 5 and sum(took.values()) == 200
    mixed = mixing.apply_mix(docs, decided)
    lengths = Counter()
    for row in mixed.collect():
        lengths[row.doc_id] += len(WORD.findall(row.text))
        assert " a b  c\nd e ".startswith(row.text)
    assert lengths == {k: n for k, n in took.items() if n} and mixed.columns == docs.columns


def test_ranges_of_a_repeated_id_of_null_and_of_low_weights(spark, monkeypatch):
    """Rows of one id have keys of their own, and no range of keys holds much more than its share."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    texts = [f"{k} words" if k % 2 else f"{k * 7919} # 12 34 56 78 ;; 90 =" for k in range(3000)]
    ids = [7] * 1000 + [None] * 1000 + list(range(100, 1100))
    docs = spark.createDataFrame([(d, t, "s") for d, t in zip(ids, texts, strict=True)], "doc_id long, text string, source string")
    narrow = mixing.sized(docs, "doc_id", "text", "source", 0)
    assert narrow.select("key").distinct().count() == 3000
    slots = Counter(r.slot for r in mixing.ranged(narrow, mixing.targets(narrow)).collect())
    assert len(slots) > 55 and max(slots.values()) <= 100
    assert sum(r.taken for r in mixing.mix(docs).collect()) == sum(len(t.split()) for t in texts)


def test_mix_beside_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 5, 6, 7, 8, "9")], "doc_id long, text string, source string, _id int, _size int, _taken int, _copy int, _row string")
    assert [r.asDict() for r in mixing.apply_mix(docs, mixing.mix(docs)).collect()] == [r.asDict() for r in docs.collect()]
    keyed = with_rows(docs, free_name(docs, "_row"))
    assert keyed.columns == [*docs.columns, "_row_"]


# ---- op7 ---------------------------------------------------------------------------


def test_scores_equal_a_plain_network(docs, none):
    model = lm.train(docs, settings=lm.Settings(words=20, rounds=1, share=1.0))
    tables, bias, out, out_bias = (p.astype(np.float64) for p in model.parts)
    found = rows_of(lm.scores(docs, model))
    for doc_id, text, *_ in HARD:
        if text is LONG:
            continue
        ids = [model.id_of(t) for t in lm.TOKENS.findall((text or "").lower())]
        padded = [model.outside] * 2 + ids + [model.outside] * 2
        total = 0.0
        for k, token in enumerate(ids):
            inner = np.tanh(bias + sum(tables[j][padded[k + 2 + o]] for j, o in enumerate((-2, -1, 1, 2))))
            logits = inner @ out + out_bias
            total += logits[token] - np.log(np.exp(logits).sum())
        for row in found[doc_id]:
            assert row["n_tokens"] == len(ids) and row["log_likelihood"] == pytest.approx(total, abs=1e-2, rel=1e-4)
            assert (row["mean_log_likelihood"] is None) == (not ids)
    together = rows_of(lm.train_and_score(docs, settings=lm.Settings(words=20, rounds=1, share=1.0)))
    assert {k: sorted(map(tuple, v)) for k, v in together.items()} == {k: sorted(map(tuple, v)) for k, v in found.items()}
    assert lm.train_and_score(none).count() == 0
    empty = lm.train(none)
    assert lm.scores(none, empty).count() == 0 and sum(map(len, found.values())) == len(HARD)


@pytest.mark.parametrize("known", [0, 3, 1 << 17])
def test_rare_tokens_are_scored_as_themselves(docs, none, monkeypatch, known):
    """Class and share by plain counts, with the counts joined, known in part, and all known."""
    monkeypatch.setattr(lm, "KNOWN", known)
    settings = lm.Settings(words=20, rounds=1, share=1.0)
    classes = {k: v[0] for k, v in rows_of(lm.train_and_score(docs, settings=settings)).items()}
    found = rows_of(lm.token_scores(docs, settings=settings))
    counted = Counter(t for _, text, *_ in HARD for t in lm.tokens_of(text or ""))
    frequent = {t for t, _ in sorted(counted.items(), key=lambda c: (-c[1], c[0]))[:20]}
    sums = Counter()
    for token, n in counted.items():
        if token not in frequent:
            sums[lm.rare_place(token)] += n
    assert sum(map(len, found.values())) == len(HARD)
    changed = 0
    for doc_id in {d for d, *_ in HARD}:
        texts = [text for d, text, *_ in HARD if d == doc_id]
        if len(texts) > 1:
            continue
        rare = [t for t in lm.tokens_of(texts[0] or "") if t not in frequent]
        shares = sum(math.log(counted[t] / sums[lm.rare_place(t)]) for t in rare)
        row = found[doc_id][0]
        assert row["n_tokens"] == classes[doc_id]["n_tokens"]
        assert row["log_likelihood"] == pytest.approx(classes[doc_id]["log_likelihood"] + shares, abs=1e-5, rel=1e-9)
        assert (row["mean_log_likelihood"] is None) == (not row["n_tokens"])
        changed += bool(shares)
    assert changed > 3 and lm.token_scores(none).count() == 0


def test_words_of_equal_length_are_told_apart(spark):
    """A word the corpus has often against one of the same class that it has once, beyond the vocabulary; copies keep their rows."""
    texts = ["the often the", "the often the", "the often the", "the qxzvw the"]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, texts[0])], "doc_id long, text string")
    found = rows_of(lm.token_scores(docs, settings=lm.Settings(words=1)))
    assert found[0][0]["log_likelihood"] - found[3][0]["log_likelihood"] == pytest.approx(math.log(4 / 2), abs=1e-6)
    assert len(found[3]) == 2 and found[None][0]["log_likelihood"] == found[0][0]["log_likelihood"]


def test_both_sides_help(spark):
    from ludolytics.llm.shared import table

    docs = table(spark, SF_DIR, "documents")
    model = lm.train(docs)
    texts = [r.text for r in docs.limit(60).collect()]
    rng = random.Random(1)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in texts]
    assert sum(model.score(t)[1] for t in texts) > sum(model.score(t)[1] for t in mixed)


# ---- op8 ---------------------------------------------------------------------------


def test_chat_escapes_and_reads_back(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|>x<|end|>\n", "<\\|end|>", "[\\\\/INST]", "<\\", "plain", "", None, "<|body|>\n<|body|>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)] + [(2, 0, None, "x"), (None, None, "<|x", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' AS formatted", "1 AS turns")
    done = chat.format_conversations(df.withColumn("parts", chat.text_part(df["text"])), stretch_bits=1)
    back = {r.conv_id: r for r in chat.read_back(done).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r[2], r[3] or "") for r in rows if r[0] == 1]
    assert [(t.role, t.text) for t in back[2].turns] == [("", "x")] and [(t.role, t.text) for t in back[None].turns] == [("<|x", "y")]
    digest = {r.conv_id: r for r in chat.digests(chat.read_back(done)).collect()}[1]
    loss = "".join(t or "" for t in texts[1::2])
    assert digest.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and digest.loss_chars == len(loss)
    assert chat.digests(chat.read_back(chat.format_conversations(df.limit(0).withColumn("parts", chat.text_part(df["text"]))))).count() == 0


def test_chat_flattens_typed_parts(spark):
    parts = [("text", "see <|image|>", None, None), ("image", None, "s3://a", 64), ("text", " and ", None, 0), ("audio", None, "b", 10), ("document", None, "c", 3), (None, "end", None, 0)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_conversations(df).first()
    assert row.formatted.startswith("<|turn|>user<|body|>see <\\|image|><|part:1:image|> and <|part:3:audio|><|part:4:document|>end<|end|>\n")
    assert [(a.turn, a.place, a.kind, a.ref, a.tokens) for a in row.attachments] == [(0, 1, "image", "s3://a", 66), (0, 3, "audio", "b", 12), (0, 4, "document", "c", 1537)]
    assert row.placeholder_tokens == 66 + 12 + 1537


def test_no_kind_or_cut_makes_a_mark(spark):
    """Kinds that equal the template's marks, and control strings that begin in one text part and end in the next."""
    kinds = ["turn", "end", "body", "part:1:x", "|>", ""]
    cut = [("<", "|turn|>"), ("</", "s>"), ("<\\", "|end|>"), ("[/IN", "ST]"), ("<", "\\|x")]
    rows = [(1, k, "user", [("text", "a<", None, 0), (kind, None, "r", 1), ("text", "|turn|>\\|b", None, 0)]) for k, kind in enumerate(kinds)]
    rows += [(2, k, "assistant", [("text", one, None, 0), ("text", two, None, 0)]) for k, (one, two) in enumerate(cut)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    done = chat.format_conversations(df)
    back = {r.conv_id: r.turns for r in chat.read_back(done).collect()}
    assert [(t.role, t.text, t.n_attachments) for t in back[1]] == [("user", "a<|turn|>\\|b", 1)] * len(kinds)
    assert [(t.role, t.text, t.n_attachments) for t in back[2]] == [("assistant", one + two, 0) for one, two in cut]
    assert {r.conv_id: r.n_attachments for r in chat.digests(chat.read_back(done)).collect()} == {1: len(kinds), 2: 0}


def test_messages_get_parts_of_every_kind(spark):
    texts = ["one\ntwo\nthree", None, "plain", "<|turn|>\n"]
    rows = [(1, k, role, text) for k, (role, text) in enumerate((r, t) for t in texts for r in ("user", "assistant"))] + [(1, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(df.withColumn("parts", chat.attached(df["role"], df["turn"], df["text"])))
    row = done.first()
    assert [(a.turn, a.place, a.kind, a.ref, a.tokens) for a in row.attachments] == [(0, 0, "image", "turn/0", 5), (2, 1, "audio", "turn/2", 3), (4, 1, "document", "turn/4", 513), (6, 0, "image", "turn/6", 4)]
    said = [("user", "x")] + [(r[2], r[3] or "") for r in rows[:-1]]
    assert [(t.role, t.text) for t in chat.read_back(done).first().turns] == said


# ---- op9 ---------------------------------------------------------------------------


def plain_signature(text):
    known, phrase, found = set(), "", []
    for char in text:
        phrase += char
        if phrase not in known:
            known.add(phrase)
            found.append(phrase)
            phrase = ""
    return sorted({xxhash.xxh32_intdigest(p) for p in found})[:128]


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    both = sorted(set(a) | set(b))[:128]
    return sum(x in a and x in b for x in both) / len(both)


@pytest.mark.parametrize("rows", [1, 3, 500])
def test_fingerprints_beside_the_next(docs, none, spark, monkeypatch, rows):
    monkeypatch.setattr(lzhash, "beside_next", lambda d, i, t, own=lzhash.beside_next: own(d, i, t, rows=rows))
    of = lambda text: np.uint64(xxhash.xxh64_intdigest(text, seed=42)).astype(np.int64)
    order = sorted(((d if d is not None else -1, t or "") for d, t, *_ in HARD), key=lambda r: (r[0], of(r[1]), r[1]))
    expected = []
    for k, (doc_id, text) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        cut = len(text) - len(text) // 4
        edited = text[:cut] + follower[: len(text) // 4]
        a, b, c = map(plain_signature, (text, edited, follower))
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), lzhash.as_text(np.array(a, np.uint32)), lzhash.as_text(np.array(b, np.uint32)), plain_likeness(a, b), plain_likeness(a, c)))
    found = [(-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, lzhash.compare_next(docs).collect())]
    assert sorted(found) == sorted(expected)
    assert lzhash.compare_next(none).count() == 0
    alone = lzhash.compare_next(spark.createDataFrame([(1, "abcabc")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_parts_of_a_repeated_id_and_of_null(spark):
    ids = [7] * 1000 + [None] * 1000 + list(range(100, 1100))
    docs = spark.createDataFrame([(d, f"text {k}") for k, d in enumerate(ids)], "doc_id long, text string")
    placed = lzhash.beside_next(docs, "doc_id", "text", rows=50).collect()
    sizes = Counter(r.part for r in placed)
    assert sum(r.late == 0 for r in placed) == 3000 and max(sizes.values()) <= 100
    assert len({r.part for r in placed if r.doc_id == 7}) > 15 and len({r.part for r in placed if r.doc_id is None}) > 15
    assert len(placed) == 3000 + len(sizes)


# ---- op10 --------------------------------------------------------------------------


def test_quality_on_hard_rows(docs, none):
    found = rows_of(quality.apply_rules(docs))
    assert sum(map(len, found.values())) == len(HARD)
    for doc_id, text, *_ in HARD:
        words = WORD.findall(text or "")
        grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        cover = {k + j for k in range(len(words) - 4) for j in range(5) if grams[tuple(words[k : k + 5])] > 1}
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover))
        for row in found[doc_id]:
            assert tuple(row)[1:6] == expected
            failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
            assert row["base_failed"] == failed and not (failed and row["kept"])
    assert found[None][0]["kept"] and quality.apply_rules(none).count() == 0
