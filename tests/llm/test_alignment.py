import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfmark.llm import alignment
from shelfmark.llm.bpe import byte_letters

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tokens(vocab):
    """[(id, bytes)] of both sides of a text, by the libraries alone."""
    a, b = Tokenizer.from_file(vocab(A)), SentencePieceProcessor(model_file=vocab(B))
    a.encode_special_tokens = True
    byte_of = {c: n for n, c in enumerate(byte_letters())}

    def make(text):
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            name = b.id_to_piece(i)
            right.append((i, bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (left, right)):
            return [], []
        return left, right

    return make


def _spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def _brute(pairs, tokens):
    """One row a text: every pair of token occurrences is looked at."""
    links, rows = [], []
    for i, text in pairs:
        left, right = map(_spans, tokens(text or ""))
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups = []
        for start, end in zip([0, *cuts], cuts, strict=False):
            groups.append("|".join(",".join(str(n) for n, s, e in side if start <= s and e <= end) for side in (left, right)))
        own = [(x, y) for x, _, e in left for y, _, f in right if e == f]
        links.append(own)
        rows.append((i, len(left), len(right), len(groups), len(own), ";".join(groups)))
    counts = Counter(link for own in links for link in own)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(*r[:5], sum(counts[x] == best[x[1]] for x in own), sum(counts[x] for x in own), r[5]) for r, own in zip(rows, links, strict=True)], counts, best


def _rows(found):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in found.collect()]


def _odd(odd_texts):
    pick = random.Random(3)
    texts = [t for t in odd_texts if len(t) < 400][::12]
    texts += ["<|endoftext|> a", "a▁b", "▁", " ", "<s>", None, "", "naïve  café\n\n\n", "\x00", "日本語のテキスト", "the the the", "the the the"]
    return [(pick.randint(1, 60) if pick.random() < 0.9 else None, t) for t in texts]


def test_alignment_of_odd_texts(vocab, rows, odd_texts, tokens):
    pairs = _odd(odd_texts)
    want, counts, best = _brute(pairs, tokens)
    table = rows(pairs).repartition(3)
    assert sorted(_rows(alignment.linked(table, vocab(A), vocab(B))), key=repr) == sorted(want, key=repr)
    got = alignment.pair_counts(alignment.aligned(table, vocab(A), vocab(B)))
    assert {((r.a, r.b), r.n, r.best) for r in got.collect()} == {(x, n, n == best[x[1]]) for x, n in counts.items()}
    assert any(r[1] == 0 and t for r, (_, t) in zip(want, pairs, strict=True))  # some texts are not what B spells


def test_alignment_of_documents(vocab, documents, texts, tokens):
    pairs = sorted((i, t) for i, t in texts.items() if len(t or "") < 2500)
    table = documents.where("length(text) < 2500 or text is null")
    got = alignment.linked(table, vocab(A), vocab(B), show=alignment.digested)
    want = {r[0]: (*r[1:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in _brute(pairs, tokens)[0]}
    assert {r[0]: r[1:] for r in _rows(got)} == want


def test_a_long_text_and_an_empty_table(vocab, rows, tokens):
    pairs = [(1, "Zwölf Boxkämpfer jagen Viktor\tquer. " * 300), (1, "Zwölf"), (2, None)]
    got = _rows(alignment.linked(rows(pairs), vocab(A), vocab(B)))
    assert sorted(got, key=repr) == sorted(_brute(pairs, tokens)[0], key=repr)
    assert alignment.linked(rows([]), vocab(A), vocab(B)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_overlaps_and_groups_of_any_intervals(seed):
    pick = np.random.default_rng(seed)
    total = int(pick.integers(1, 80))
    ends = [np.sort(np.append(pick.choice(total - 1, int(pick.integers(0, total)), replace=False) + 1, total)) if total > 1 else np.array([1]) for _ in range(2)]
    ends = [np.unique(e) for e in ends]
    lens = [np.diff(np.append(0, e)) for e in ends]
    a, b = alignment.overlaps(ends[0], lens[0], ends[1], lens[1])
    spans = [list(zip((e - n).tolist(), e.tolist(), strict=True)) for e, n in zip(ends, lens, strict=True)]
    want = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if max(s, t) < min(e, f)]
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == want
    cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    got = alignment.coalesce(ends[0], lens[0], ends[1], lens[1])
    assert got.n == len(cuts)
    assert got.a_group.tolist() == np.searchsorted(cuts, ends[0]).tolist() and got.b_group.tolist() == np.searchsorted(cuts, ends[1]).tolist()
