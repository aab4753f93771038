"""Multiprobe search against full search: recall, scores, order and hard rows."""

import itertools
from collections import defaultdict

import numpy as np
import pytest

from ludolytics.llm import neighbours
from ludolytics.llm.queries import QUERIES
from ludolytics.llm.shared import table

SCHEMA = "vec_id long, embedding array<float>, entry string, bucket int"


def plain(rows, every=20, k=20):
    """query_id -> (vec_id, score) by full search; rows are (vec_id, vector)."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    sizes = [len(v) for _, v in good]
    size = max(sorted(set(sizes)), key=sizes.count) if sizes else 0
    good = [(i, v) for i, v in good if len(v) == size]
    pool = np.array([v for _, v in good])
    ids = np.array([i for i, _ in good])
    found = {}
    for i, v in good:
        if i % every == 0:
            scores = np.add.reduce(pool * v, axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            found[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def result(df):
    found = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def recall(found, expected):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in want}) for q, want in expected.items())
    return hits / sum(map(len, expected.values()))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_on_the_given_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    expected = plain(rows)
    found = result(QUERIES["op11_multiprobe_search"](spark, sf))
    assert found.keys() == expected.keys() and all(len(found[q]) == len(want) for q, want in expected.items())
    assert recall(found, expected) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, got in found.items():
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for i, s in got)


def test_hard_rows_and_a_third_of_one_vector(spark):
    rng = np.random.default_rng(3)
    same = rng.normal(size=8)
    rows = [(k, (3 * rng.normal(size=8) * rng.uniform(0.1, 5)).tolist()) for k in range(400)] + [(k, same.tolist()) for k in range(400, 600)]
    rows += [(600 + k, (same + 0.001 * rng.normal(size=8)).tolist()) for k in range(100)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    bad = [(None, [1.0] * 8), (1000, None), (1001, []), (1002, [0.0] * 8), (1003, [None] + [1.0] * 7), (1004, [float("nan")] * 8), (1005, [float("inf")] * 8), (1006, [1.0] * 7), (1020, [0.0, -0.0] * 4)]
    expected = plain(rows)
    given = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + rows[:30] + bad], SCHEMA).repartition(5)
    found = result(neighbours.search(given, block=16))
    assert found.keys() == expected.keys() and recall(found, expected) >= 0.9
    assert all(len(v) == 20 and q not in {i for i, _ in v} for q, v in found.items())
    for q in (400, 580):  # ties by the smaller id
        assert found[q] == expected[q]


def test_few_rows_are_all_found(spark):
    rows = [(0, [1.0, 0.0]), (20, [-1.0, 0.5]), (3, [0.0, 2.0]), (4, [-5.0, -5.0])]
    given = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    assert result(neighbours.search(given)) == plain(rows)
    assert neighbours.search(given.limit(0)).collect() == []
    assert neighbours.search(given.where("vec_id = 0")).collect() == []


def test_visits_ascend_and_differ():
    rng = np.random.default_rng(4)
    places = rng.uniform(-3, 3, (2, 3))
    cells, inside = np.floor(places), places - np.floor(places)
    every = {(t, step): sum((inside[t, k] if s < 0 else 1 - inside[t, k]) ** 2 for k, s in enumerate(step) if s) for t in range(2) for step in itertools.product((-1, 0, 1), repeat=3)}
    got = [(t, tuple((found - cells[t]).astype(int).tolist())) for t, found in neighbours.visits(places, 1000)]
    assert sorted(got) == sorted(every) and np.allclose([every[g] for g in got], sorted(every.values()))


def test_every_query_meets_every_entry_of_its_bucket_once(spark):
    rows = [(b, e, q) for b, n, m in ((1, 300, 5), (2, 4, 200), (3, 90, 90), (4, 2, 0), (5, 0, 3)) for q, count in ((False, n), (True, m)) for e in range(count)]
    cells = neighbours._cells(spark.createDataFrame(rows, "bucket long, entry long, is_query boolean"), block=32)
    kept = [tuple(r) for r in cells.collect()]
    sides = defaultdict(lambda: ([], []))
    for cell, entry, is_query in kept:
        sides[cell][is_query].append(entry)
    met = sorted((e, q) for lying, asking in sides.values() for e in lying for q in asking)
    assert met == sorted((e, q) for n, m in ((300, 5), (4, 200), (90, 90)) for e in range(n) for q in range(m))
    assert max(len(x) for s in sides.values() for x in s) < 64
