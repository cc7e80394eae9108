import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfmark.llm import periods


def _smallest(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:], strict=False)))


def _brute(words, times=4, least=6):
    """(start, length, period) of all runs: each period is tried at every word."""
    out = set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(times * q, least) and _smallest(words[start : i + q]) == q:
                out.add((start, i + q - start, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _texts(pick):
    out = []
    for _ in range(pick.randint(0, 6)):
        kinds = pick.choice([1, 2, 3, 8])
        words = [pick.randrange(kinds) for _ in range(pick.randint(0, 70))]
        if words and pick.random() < 0.6:
            a, p = pick.randrange(len(words)), 1 + pick.randrange(max(1, len(words) // 4))
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        out.append(words)
    return out


def _flat(texts):
    return np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64)


@pytest.mark.parametrize("chunk", [1, 17, 1 << 19])
def test_runs_equal_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(periods, "CHUNK", chunk)
    pick = random.Random(chunk)
    for _ in range(150):
        texts = _texts(pick)
        times, least = pick.choice([(4, 6), (2, 2), (3, 1), (4, 4)])
        got = list(zip(*(c.tolist() for c in periods.runs(*_flat(texts), times, least)), strict=True))
        assert got == [(n, *r) for n, t in enumerate(texts) for r in _brute(t, times, least)], texts


def test_grammar_extensions_equal_plain_comparison():
    pick = random.Random(2)
    for _ in range(80):
        texts = _texts(pick)
        grammar = periods.Grammar(*_flat(texts))
        asked = [(grammar.starts[n], t, a, b) for n, t in enumerate(texts) for a in range(len(t)) for b in range(a + 1, len(t))]
        x, y = (np.array([s + q[k] for s, *q in asked], np.int64) for k in (1, 2))
        onwards = [next((k for k in range(len(t) - b) if t[a + k] != t[b + k]), len(t) - b) for _, t, a, b in asked]
        back = [next((k for k in range(a + 1) if t[a - k] != t[b - k]), a + 1) for _, t, a, b in asked]
        assert grammar.extend(x, y).tolist() == onwards and grammar.extend(x, y, -1).tolist() == back


def test_grammar_shrinks_and_spells_its_texts():
    pick = random.Random(4)
    words = [pick.randrange(50) for _ in range(4000)] + [7] * 3000 + [1, 2] * 1000
    grammar = periods.Grammar(*_flat([words]))
    sizes = [len(s) for s in grammar.symbols]
    assert sizes[-1] == 3 and sum(sizes) < 12 * len(words)  # two separators and one symbol
    for low, above, blocks, parts in zip(grammar.low[1:], grammar.symbols[1:], grammar.blocks, grammar.symbols, strict=False):
        rules = {}
        for symbol, a, b in zip(above.tolist(), low[:-1].tolist(), low[1:].tolist(), strict=True):
            body = parts[a:b].tolist()
            assert rules.setdefault(symbol, body) == body and (len(set(body)) == 1 if blocks else len(body) <= 2)
        assert len({tuple(b) for b in rules.values()}) == len(rules)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _looped(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words if h % 10 else [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _row(doc_id, text):
    words = _looped(doc_id, _words(text))
    runs = _brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sums = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(kept))]
    return doc_id, len(runs), *told, *sums


def test_odd_rows(rows):
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    body = "a b\tc  d é\x85f g　h a b c d"
    pairs = [*((i, body * (1 + i % 5)) for i in planted), *((i, "") for i in planted[:3]), (planted[0], None), (planted[1], "one"), (None, "x " * 30)]
    pairs += [(3, "x " * 30), (3, "x " * 30), (4, "ab " * 5), (5, "a b c " * 4000 + "a a a a a a a"), (6, None), (-7, "q w e r " * 9)]
    got = periods.digests(periods.find_runs(periods.looped(rows(pairs)))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((_row(*p) for p in pairs), key=repr)
    assert periods.digests(periods.find_runs(periods.looped(rows([])))).collect() == []


def test_runs_and_collapsed_texts(rows):
    got = {r.doc_id: r for r in periods.find_runs(rows([(1, "to be or to be or to be or to be or not"), (2, "no run"), (3, None)])).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 12, 3)] and got[1].collapsed == "to be or not" and got[1].n_words == 13
    assert (got[2].runs, got[2].collapsed, got[3].runs, got[3].collapsed, got[3].n_words) == ([], "no run", [], "", 0)


def test_runs_of_documents(documents, texts):
    short = {i: t for i, t in texts.items() if len(t or "") < 3000}
    got = periods.digests(periods.find_runs(periods.looped(documents))).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: tuple(r) for r in got if r.doc_id in short} == {i: _row(i, t) for i, t in short.items()}
    assert any(r.n_runs for r in got) and any(r.doc_id in short and r.n_runs for r in got)


@pytest.mark.parametrize("words", [np.zeros(300_000, np.int64), np.arange(300_000) % 70_000])
def test_one_long_run(words):
    assert [c.tolist() for c in periods.runs(words, np.array([len(words)]))] == [[0], [0], [300_000], [max(1, int(words.max()) + 1)]]
