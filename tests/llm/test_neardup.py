import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import neardup


def brute(rows, plan):
    """{doc_id: (set size, least id reachable)} by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words, k = re.findall(r"[^\x20\x09-\x0d]+", low), plan.shingle
        sets[i] = {tuple(words[a : a + k]) for a in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
    up, having = {i: i for i in sets}, collections.defaultdict(list)

    def root(x):
        return x if up[x] == x else root(up[x])

    for i in sorted(sets):
        for j, n in collections.Counter(j for s in sets[i] for j in having[s]).items():
            if 100 * n >= plan.percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
        for s in sets[i]:
            having[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def _compare(frame, pairs, plan):
    got = neardup.groups(frame, plan).collect()
    want = brute(pairs, plan)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(want) and all(r.first == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("plan", [neardup.Plan(3, 85), neardup.Plan(5, 80)])
def test_groups_of_documents(documents, texts, plan):
    _compare(documents, list(texts.items()), plan)


def test_many_near_copies_and_chains(rows):
    """A large group of copies, each with words of its own, a chain of drifting texts, a shared passage."""
    pick = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    pairs = [(i, " ".join(w if pick.random() > 0.012 else f"x{pick.randint(0, 9999)}" for w in base)) for i in range(150)]
    drift = [f"v{i}" for i in range(100)]
    for i in range(200, 240):
        drift = [*drift[2:], f"n{i}", f"m{i}"]
        pairs.append((i, " ".join(drift)))
    passage = " ".join(f"p{i}" for i in range(60))
    pairs += [(i, passage + " " + " ".join(f"q{i}_{k}" for k in range(40))) for i in range(300, 340)]
    _compare(rows(pairs), pairs, neardup.Plan(3, 85))


def test_odd_rows(rows):
    long = "all work and no play " * 4000
    pairs = [(1, "A b c d"), (1, "A b c d"), (None, "a B c d"), (7, None), (8, ""), (9, " \t\n"), (10, "a b"), (11, "A  B"), (12, "b a"), (13, long), (14, long)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in neardup.groups(rows(pairs), neardup.Plan(3, 85)).collect()}
    assert got == {
        (1, 2, 1), (None, 2, 1), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 1, 10), (11, 1, 10), (12, 1, 12), (13, 5, 13), (14, 5, 13),
    }
    kept = neardup.one_of_each(rows(pairs), neardup.Plan(3, 85)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [1, 7, 8, 9, 10, 12, 13]))
    assert all(r.spans == 4 and r.t == "x" for r in kept)
    assert neardup.groups(rows([]), neardup.Plan()).collect() == []
    assert neardup.one_of_each(rows([]), neardup.Plan()).collect() == []


def test_superminhash_estimates_similarity():
    pick = np.random.default_rng(5)
    a, b = pick.integers(0, 2**63, 400).astype(np.uint64), pick.integers(0, 2**63, 400).astype(np.uint64)
    errors = []
    for shared in (0, 100, 200, 300, 390):
        x, y = np.sort(a), np.sort(np.concatenate([a[:shared], b[shared:]]))
        first, second = neardup.super_minhash([x, y], 192)
        errors.append(abs((first == second).mean() - shared / (800 - shared)))
    assert max(errors) < 0.12


def test_superminhash_one_permutation_an_element():
    """A single element takes each register in a step of its own; an empty set takes none."""
    one, none, two = neardup.super_minhash([np.array([99], np.uint64), np.array([], np.uint64), np.array([99, 5], np.uint64)], 192)
    assert sorted((one >> np.uint64(32)).tolist()) == list(range(192))
    assert (none == neardup._EMPTY).all() and (two <= one).all()


def test_shingles_follow_ascii_rules():
    sets = neardup.shingle_sets(pa.array(["ÀB c d", "Àb C D", "àb c d", None, "a\x1cb\x0bc"]), 3)
    assert (sets[0] == sets[1]).all() and (sets[0] != sets[2]).all() and len(sets[3]) == 0 and len(sets[4]) == 1


def test_components(spark):
    pick = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 130), (130, 110)] + [(pick.randint(200, 260), pick.randint(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame([(min(p), max(p)) for p in links if p[0] != p[1]], "a long, b long").repartition(5)
    up = {x: x for p in links for x in p}

    def root(x):
        return x if up[x] == x else root(up[x])

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.cls: r.comp for r in neardup.components(frame).collect()}
    assert got == {x: root(x) for x in up if x in got} and len({*up} - {*got}) <= 20
