import math
import random

import numpy as np
import pytest

from shelfmark.llm import common, permindex, topk


@pytest.fixture(scope="module")
def vectors(spark, small):
    return common.read(spark, small, "embeddings")


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, [0.0], 2) for r in rows], "vec_id long, embedding array<double>, i int, v array<double>, copy int")


def _best(ids, scores, k):
    return [(n, *x) for n, x in enumerate(sorted(zip(ids, scores, strict=True), key=lambda x: (-x[1], x[0]))[:k], 1)]


def test_top_k_equals_all_products(vectors):
    rows = {r.vec_id: [math.floor(1024 * x) for x in r.embedding] for r in vectors.collect()}
    want = set()
    for q in rows:
        if q % 100 == 0:
            others = [i for i in rows if i != q]
            want |= {(q, *x) for x in _best(others, [sum(a * b for a, b in zip(rows[q], rows[i], strict=True)) for i in others], 10)}
    got = topk.top_k(vectors, "i % 100 = 0", 10).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)


def test_blocks_are_pruned_without_loss():
    """Clustered vectors: blocks below the k-th score are left out, the answer stays."""
    pick = np.random.default_rng(2)
    docs = np.floor(1024 * (np.repeat(pick.normal(size=(20, 16)), 100, axis=0) + 0.05 * pick.normal(size=(2000, 16))))
    ids = pick.permutation(2000).astype(np.int64)
    seen = []
    real = topk._exact
    topk._exact = lambda d, q, small: seen.append(len(d)) or real(d, q, small)
    try:
        got = topk.search(ids, docs, ids[:20], docs[:20], 10)
    finally:
        topk._exact = real
    assert sum(seen) < 20 * 2000 / 2
    for n, (found, scores) in enumerate(got):
        rows = [i for i in range(2000) if i != n]
        want = _best(ids[rows].tolist(), (docs[rows] @ docs[n]).astype(int).tolist(), 10)
        assert [(i, s) for _, i, s in want] == list(zip(found.tolist(), scores.tolist(), strict=True))


def test_top_k_odd_rows(spark):
    rows = [
        (0, [1.0, -1.0]), (100, [0.5, 0.25]), (1, [1.0, -1.0]), (1, [1.0, -1.0]), (2, None), (3, [1.0, None]), (4, [math.nan, 1.0]),
        (5, [math.inf, 0.0]), (None, [1.0, 1.0]), (6, [2.0]), (7, []), (200, [-0.0001, 0.0]),
    ]
    got = topk.top_k(_table(spark, rows), "i % 100 = 0", 10).collect()
    good = [(i, v) for i, v in rows if i not in (None, 2, 3, 4, 5)]
    want = []
    for q, v in good:
        if q % 100 == 0:
            others = [(i, w) for i, w in good if i != q]
            scores = [sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(v, w, strict=False)) for _, w in others]
            want += [(q, *x) for x in _best([i for i, _ in others], scores, 10)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.top_k(_table(spark, []), "i % 100 = 0", 10).collect() == []


def test_top_k_large_components(spark):
    rows = [(0, [3e15, 2.0]), (1, [2e15, 5.0]), (2, [-1e300, 1.0]), (3, [0.001, 1.0])]
    got = {(r.vec_id, r.score) for r in topk.top_k(_table(spark, rows), "i = 0", 10).collect()}
    assert got == {(1, 2**63 - 1), (2, -(2**63)), (3, 1024 * (3 * 10**15) + 2 * 1024 * 1024)}


def _cosine(a, b):
    return np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b))


def test_neighbours_have_recall(vectors):
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    got = permindex.nearest(vectors, "i % 10 = 0", 5, part=0.15, least=32).collect()
    queries = [q for q in rows if q % 10 == 0]
    want = {(q, i) for q in queries for _, i, _ in _best([i for i in rows if i != q], [_cosine(rows[q], rows[i]) for i in rows if i != q], 5)}
    assert len(got) == 5 * len(queries)
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    for r in got:
        assert r.score == pytest.approx(_cosine(rows[r.query_id], rows[r.vec_id]), abs=1e-14)


def test_footrule_of_inverted_files():
    pick = random.Random(4)
    near = np.array([pick.sample(range(12), 5) for _ in range(40)], np.int16)
    found = permindex.Postings(near).distances(near[3])

    def footrule(x, y):
        at = [{p: n for n, p in enumerate(z)} for z in (x.tolist(), y.tolist())]
        return sum(abs(at[0].get(p, 5) - at[1].get(p, 5)) for p in {*at[0], *at[1]})

    want = np.array([footrule(row, near[3]) for row in near])
    assert (found - found[3] == want).all()


def test_neighbours_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [1e200, 1e200]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [1.0, None]), (4, [math.nan, 1.0]),
        (5, [math.inf, 0.0]), (6, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, []), (9, [-1.0, 1e-200]),
    ]
    got = permindex.nearest(_table(spark, rows), "i % 50 = 0", 5).collect()
    assert [(r["rank"], r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [
        (1, 1, 1.0), (2, 1, 1.0), (3, 7, 1.0), (4, 50, round(math.sqrt(0.5), 6)), (5, 9, -1.0),
    ]
    assert permindex.nearest(_table(spark, []), "i % 50 = 0", 5).collect() == []


def _exact(rows, k, every):
    want = []
    for q, v in rows:
        if q % every == 0:
            others = [(i, w) for i, w in rows if i != q]
            want += [(q, *x) for x in _best([i for i, _ in others], [_cosine(np.array(v), np.array(w)) for _, w in others], k)]
    return want


def test_half_of_the_vectors_are_copies(spark):
    """Ties go to the smallest ids: copies are indexed once, and none is cut off."""
    pick = np.random.default_rng(8)
    rows = [(i, [1.0, 2.0, 2.0, 0.0] if i % 2 else pick.normal(size=4).tolist()) for i in range(600)]
    got = permindex.nearest(_table(spark, rows), "i % 25 = 0", 5, part=0.2, least=16).collect()
    want = {(q, n, i) for q, n, i, _ in _exact(rows, 5, 25)}
    copies = {(q, n, i) for q, n, i in want if q % 2}
    found = {(r.query_id, r["rank"], r.vec_id) for r in got}
    assert copies and copies <= found and len(found & want) >= 0.95 * len(want)
    assert found == {(r.query_id, r["rank"], r.vec_id) for r in permindex.nearest(_table(spark, rows[::-1]), "i % 25 = 0", 5, part=0.2, least=16).collect()}


def test_equal_footrules_are_all_reranked():
    """Vectors beyond the cut that are as near by footrule as the last one within it count too."""
    near = np.array([[0, 1]] * 40 + [[1, 0]] * 10, np.int16)
    shard = permindex.Shard(np.array([[1.0, n / 1000] for n in range(50)]), np.arange(50), np.arange(51), near)
    ids, _ = permindex.search(shard, np.array([99]), np.array([[1.0, 0.039]]), np.array([[0, 1]], np.int16), 3, 0.1, 1)[0]
    assert ids.tolist() == [39, 38, 37]


def test_ids_that_repeat_with_other_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.1]), (0, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.3]), (7, [0.0, 1.0])]
    got = permindex.nearest(_table(spark, rows), "i = 0", 3).collect()
    assert sorted((round(r.score, 3), r["rank"], r.vec_id) for r in got if r["rank"] == 3) == [(0.958, 3, 6), (0.982, 3, 6)]
    assert all(r.vec_id == 5 for r in got if r["rank"] < 3) and len(got) == 6


def test_top_k_over_many_shards(spark, monkeypatch):
    """Clustered vectors, a busy one among them: a query goes to a few shards only, and loses nothing."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(topk, "GROUP", 4)
    pick = np.random.default_rng(6)
    centers = 3 * pick.normal(size=(25, 8))
    rows = [(i, [1.0] * 8 if i % 3 == 0 else (centers[i % 25] + 0.05 * pick.normal(size=8)).tolist()) for i in range(1500)]
    rows += [(9, [1.0] * 8)] * 300
    got = topk.top_k(_table(spark, rows), "i % 20 = 0", 10).collect()
    docs, ids = topk.whole(np.array([v for _, v in rows])), [i for i, _ in rows]
    want = []
    for q, v in rows:
        if q % 20 == 0:
            scores = (docs @ topk.whole(np.array(v))).astype(int).tolist()
            want += [(q, *x) for x in _best(*zip(*[(i, s) for i, s in zip(ids, scores, strict=True) if i != q], strict=True), 10)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)

    usable = topk.usable(_table(spark, rows), "vec_id", "embedding")
    shards = topk.ordered(usable)
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert sum(sizes) == usable.count() and max(sizes) < 200


def test_floors_prune_blocks_of_other_shards():
    pick = np.random.default_rng(7)
    docs = topk.whole(np.repeat(pick.normal(size=(10, 16)), 50, axis=0) + 0.02 * pick.normal(size=(500, 16)))
    ids = np.arange(500)
    scores = (docs @ docs[0]).astype(int)
    floor = np.sort(scores[1:])[-10]
    found, best = topk.search(ids, docs, ids[:1], docs[:1], 10, floors=np.array([floor]))[0]
    assert (best >= floor).all() and len(found) == 10
    assert len(topk.search(ids, docs, ids[:1], docs[:1], 10, floors=np.array([scores.max() + 1]))[0][0]) == 0
