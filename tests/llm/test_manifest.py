"""The Merkle manifest against a plain one, on rows that fill several heights of node rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from compare import database, differences
from conftest import SF_DIR

from ludolytics.llm import manifest
from ludolytics.llm.queries import ORACLE, QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, t int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, more=0):
    values = (row[0], row[3], row[2], row[4] if row[4] is None else row[4] + more, row[1])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 2])) for k in range(0, len(levels[-1]), 2)])
    return levels


def plain_path(levels, at, folded):
    proof = ""
    for level in levels[:-1]:
        mate = level[at ^ 1] if at ^ 1 < len(level) else ""
        folded = sha(mate + folded if at % 2 else folded + mate)
        proof, at = proof + mate, at // 2
    return proof, folded


def plain(rows):
    langs = {}
    for row in rows:
        langs.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    order = sorted(langs, key=str.encode)
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = plain_levels([plain_leaf(r) for r in langs[lang]])
    over = plain_levels([trees[lang][-1][0] for lang in order])
    found = []
    for place, lang in enumerate(order):
        for at, row in enumerate(langs[lang]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            proof, folded = plain_path(trees[lang], at, plain_leaf(row, int(hit)))
            more, folded = plain_path(over, place, folded)
            root = over[-1][0]
            found.append((row[0], plain_leaf(row), trees[lang][-1][0], root, sha(proof + more), folded, folded == root))
    return found


def result(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_on_hard_rows(spark):
    rng = random.Random(12)
    rows = [(k, f"text {k} ÄÖ 中🙂", "big", "s", k % 50, "x", 1) for k in range(4500)]
    rows += [(rng.randrange(100), None if k % 3 else "", rng.choice(["a", "ä", "b", None]), None, None if k % 2 else 7, "x", 1) for k in range(300)]
    rows += [(None, "no id", "a", "s", 3, "x", 1)] * 2 + [(9, "same", "a", "s", 3, "x", 1)] * 70 + [(5, "alone", "", "s", 3, "x", 1), (6, "long " * 20_000, "zz", "s", 100_000, "x", 1)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    found = manifest.with_tampered_lengths(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert result(found) == Counter(plain(rows))


@pytest.mark.parametrize("langs", [1, 2, 70])
def test_manifest_of_many_trees_and_single_rows(spark, langs):
    rows = [(k, "t", f"l{k % langs:03}", "s", 1, "x", 1) for k in range(langs)]
    assert result(manifest.with_tampered_lengths(spark.createDataFrame(rows, COLUMNS))) == Counter(plain(rows))


def test_manifest_of_nothing(spark):
    assert manifest.with_tampered_lengths(spark.createDataFrame([], COLUMNS)).collect() == []


def test_query_equals_its_sql(spark):
    name = "op12_merkle_manifest"
    assert differences(QUERIES[name](spark, SF_DIR), database(SF_DIR), ORACLE[name]) is None
