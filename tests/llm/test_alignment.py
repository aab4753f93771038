"""Pair counts and scores of the alignment against the libraries on whole texts, one document at a time."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR

from ludolytics.llm import alignment
from ludolytics.llm.queries import QUERIES
from ludolytics.llm.shared import table

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(texts, libraries):
    a_lib, b_lib = libraries
    letters = {}
    spare = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    documents, counts = [], Counter()
    for text in texts:
        groups, links = [], Counter()
        if text:
            ids_a, ids_b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            bytes_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in ids_a]
            pieces = [b_lib.id_to_piece(i) for i in ids_b]
            bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
                i = j = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append((ids_a[i:p], ids_b[j:q]))
                    i, j = p, q
                    for (x, m), (y, n) in ((s, t) for s in Counter(groups[-1][0]).items() for t in Counter(groups[-1][1]).items()):
                        links[x, y] += m * n
        documents.append((groups, links))
        counts.update(links.keys())
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for groups, links in documents:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), links.total(), sum(m for p, m in links.items() if counts[p] == best[p[0]]),
                     sum(m * counts[p] for p, m in links.items()), hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return rows, counts, documents


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def hard_texts():
    rng = random.Random(13)
    words = ["the", "ingha", "ÄÖÜ", "中文字", "🙂🙂", "it's", "<|endoftext|>", "</s>", "<s>", "<0x41>", "12345", "\t", "\n\n", " ", " ", "\x1c", "\x85", "　", "á", "x" * 40]
    texts = ["".join(rng.choice(words) + rng.choice(["", " ", " ", "  ", "\n"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    return [None, "", " ", "  ", "\n", "a", " a", "a ", "▁", "a ▁ b", "x" * 3000, "ab" * 4000, "中文" * 700, "same text", "same text", "same text"] + texts


def test_alignment_on_hard_texts(spark, libraries, monkeypatch):
    texts = hard_texts()
    rows = [(k if k % 5 else None, t, 1, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, container int, bucket string").repartition(4)
    found = alignment.align(docs, *PATHS)
    expected, _, _ = plain(texts, libraries)
    assert Counter(tuple(r) for r in found.select("doc_id", *NAMES).collect()) == Counter((r[0], *e) for r, e in zip(rows, expected))


def test_small_containers_slices_and_stores_change_nothing(libraries, monkeypatch):
    import pyarrow as pa

    texts = [t for t in hard_texts() if t]
    expected, counts, documents = plain(texts, libraries)
    monkeypatch.setattr(alignment, "SLICE", 50)
    store = alignment.Stretches(alignment.Vocabularies(*PATHS))
    for text, (groups, links) in zip(texts, documents):
        if not groups:
            continue
        stretches = alignment._CUT.split(text)
        store.learn([s for s in dict.fromkeys(stretches) if s not in store.places])
        _, starts, sizes, pairs, of = store.table()
        got = Counter()
        for s in stretches:
            at = slice(starts[store.places[s]], starts[store.places[s]] + sizes[store.places[s]])
            for p, m in zip(pairs[at].tolist(), of[at].tolist()):
                got[p >> 32, p & 0xFFFFFFFF] += m
        assert got == links
        if store.full() or len(store.groups) > 50:
            store.empty()


def test_bitmaps_round_trip():
    rng = np.random.default_rng(5)
    for width in (1, 7, 8, 100, 3000):
        pairs = np.arange(30) * 7 << 32
        at = np.unique(rng.integers(0, 30, 4 * width) * width + np.minimum(rng.geometric(0.02, 4 * width), width - 1))
        pair, doc, links = pairs[at // width], at % width, rng.geometric(0.4, len(at))
        planes = alignment.pack(pair, doc, links, width)
        held = {c: np.frombuffer(x.tobytes(), alignment._TYPES[c]) for c, x in planes.items()}
        assert held["sizes"].tolist() == [len(set(doc[(pair == p) & (links >> k & 1 == 1)])) for p, k in zip(held["pairs"], held["planes"])]
        plane, back = alignment.unpack(**held, width=width)
        total = Counter()
        for p, d in zip(plane.tolist(), back.tolist()):
            total[int(held["pairs"][p]), d] += 1 << int(held["planes"][p])
        assert total == Counter(dict(zip(zip(pair.tolist(), doc.tolist()), links.tolist())))


def test_counts_of_documents_and_links(spark, libraries):
    texts = hard_texts()[:120]
    _, counts, documents = plain(texts, libraries)
    links = Counter()
    for _, each in documents:
        links.update(each)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    planes = alignment.containers(docs, *PATHS).where("bucket >= 0")
    assert {(r.a, r.b): (r.docs, r.links) for r in alignment.pair_counts(planes).collect()} == {p: (n, links[p]) for p, n in counts.items()}


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none, *PATHS).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], none.schema)
    assert {tuple(r) for r in alignment.align(empty, *PATHS).select("doc_id", *NAMES).collect()} == {(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)}


def test_query_on_the_given_table(spark, libraries):
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    expected, _, _ = plain([r.text for r in rows], libraries)
    found = QUERIES["op13_token_alignment"](spark, SF_DIR).select("doc_id", *NAMES).collect()
    assert Counter(map(tuple, found)) == Counter((r.doc_id, *e) for r, e in zip(rows, expected))


@pytest.mark.parametrize("path", ["word_bpe_49k.json"])
def test_other_tokenizers_are_refused(path):
    with pytest.raises(ValueError):
        alignment.Vocabularies(public_tokenizers.path(path), PATHS[1])
