import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from shelfmark.llm import sentences

NAME = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library(vocab):
    return SentencePieceProcessor(model_file=vocab(NAME))


@pytest.fixture(scope="module")
def own(vocab):
    return sentences.Sentences(vocab(NAME))


def _cut(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _more(pick):
    marks = ["▁", "▁▁", "<s>", "<0x41>", "<unk>", "    ", "==", "-", "#", "_", "é", "中", "\0"]
    found = ["".join(pick.choice(marks) for _ in range(pick.randint(0, 80))) for _ in range(400)]
    found += ["".join(chr(pick.randint(1, 0x2FFF)) for _ in range(30)) for _ in range(300)]
    found += ["".join(pick.choice("aeto i") for _ in range(200)) for _ in range(200)]
    return [*found, " " * 1000, "=" * 999, "-" * 777]


def test_merge_rounds_equal_the_library(own, library, odd_texts):
    texts = [*odd_texts, *_more(random.Random(13))]
    for _ in range(2):  # the second time from the cache
        ids, bounds = own.encode(pa.array([*texts, None]))
        want = library.encode([*texts, ""])
        assert _cut(ids, bounds) == want
        assert [t.decode() for t in own.decode(ids.astype(np.int64), bounds)] == library.decode(want)


def test_any_ids_decode_as_the_library_does(own, library):
    pick = random.Random(5)
    rows = [[pick.randint(0, 31_999) if pick.random() < 0.5 else pick.randint(0, 300) for _ in range(pick.randint(0, 12))] for _ in range(3000)]
    bounds = np.append(0, np.cumsum([len(r) for r in rows]))
    got = own.decode(np.array([i for r in rows for i in r]), bounds)
    assert [t.decode() for t in got] == [library.decode(r) for r in rows]


def _merge(word, pieces, scores):
    """One merge after another: the best score first, then the leftmost place."""
    parts = list(word)
    while True:
        found = [(-scores[a + b], n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in pieces]
        if not found:
            return parts
        _, n = min(found)
        parts[n : n + 2] = [parts[n] + parts[n + 1]]


@pytest.mark.parametrize("seed", range(8))
def test_rounds_equal_single_merges_for_any_vocabulary(seed):
    """Vocabularies in which late pieces open early pairs, with equal scores and letters that are no piece."""
    pick = random.Random(seed)
    names = {"".join(pick.choice("abc") for _ in range(pick.randint(2, 5))) for _ in range(40)} | set("ab" if seed % 2 else "abc")
    pieces = {n: i for i, n in enumerate(sorted(names))}
    scores = {n: float(-pick.randint(0, 12)) for n in pieces}
    merges = sentences.PieceMerges(pieces, scores, len(pieces))
    words = ["".join(pick.choice("abcd") for _ in range(pick.randint(1, 30))) for _ in range(300)]
    points, lens = sentences.code_points(words)
    symbols, counts = merges.run(merges.symbol[points].astype(np.int64), lens)
    name = {i: n for n, i in pieces.items()}
    got = [[name.get(i) or chr(i - len(pieces)) for i in w] for w in _cut(symbols, np.append(0, np.cumsum(counts)))]
    assert got == [_merge(w, pieces, scores) for w in words]


def test_models_of_another_kind_are_refused(vocab, monkeypatch):
    monkeypatch.setattr(SentencePieceProcessor, "is_unused", lambda self, i: i == 300)
    with pytest.raises(ValueError, match="byte fallback"):
        sentences.Sentences(vocab(NAME))


def test_round_trip_of_odd_rows(vocab, library, rows):
    pairs = [(1, "The cat  sat"), (1, "The cat  sat"), (None, "<s> x퟿"), (3, None), (4, ""), (5, "long " * 30_000)]
    got = sentences.round_trip(rows(pairs), vocab(NAME)).collect()
    want = []
    for i, text in pairs:
        ids = library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sentences.round_trip(rows([]), vocab(NAME)).collect() == []


def test_round_trip_of_documents(vocab, library, documents, texts):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentences.round_trip(documents, vocab(NAME)).collect()}
    for i, text in texts.items():
        ids = library.encode(text or "")
        sums = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids))]
        assert got[i] == (len(ids), *sums)


def test_encode_then_decode(vocab, library, rows):
    pairs = [(1, "Grüße, 中文\n"), (2, ""), (None, " a"), (3, None)]
    encoded = sentences.encode_pieces(rows(pairs), vocab(NAME))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: library.encode(t or "") for i, t in pairs}
    assert {(r.doc_id, r.text) for r in sentences.decode_pieces(encoded, vocab(NAME)).collect()} == {(i, t or "") for i, t in pairs}
