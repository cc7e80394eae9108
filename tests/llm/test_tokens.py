import bisect
import hashlib
import zlib
from collections import namedtuple

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe, packing, token_files
from shelfmark.llm.chunks import split_texts
from shelfmark.llm.library import LibraryEncoder
from shelfmark.session import scratch


def _ids(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _cut(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_chunks_join_to_their_text(odd_texts):
    for texts in ([t for t in odd_texts if "  " not in t], odd_texts, ["a b\nc  \n d", None, ""]):
        codes, keys, bounds = split_texts(pa.array(texts, pa.string()))
        joined = ["".join(keys[c].as_py() for c in codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert joined == [t or "" for t in texts]


def test_merge_rounds_equal_the_library(vocab, odd_texts):
    path = vocab("byte_bpe_50k.json")
    own, library = bpe.ByteBpe(path), Tokenizer.from_file(path)
    ids, bounds = own.encode(pa.array(odd_texts))
    want = _ids(path, odd_texts)
    assert _cut(ids, bounds) == want
    assert [t.decode() for t in own.decode(ids, bounds)] == [library.decode(w, skip_special_tokens=False) for w in want]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_library_equals_whole_texts(vocab, odd_texts, name):
    for _ in range(2):  # the second time from the cache
        assert _cut(*LibraryEncoder(vocab(name)).texts(pa.array(odd_texts))) == _ids(vocab(name), odd_texts)


def test_forgetting_caches_change_nothing(vocab, odd_texts):
    encoder = LibraryEncoder(vocab("word_bpe_49k.json"), limit=7)
    for at in range(0, 200, 10):
        part = odd_texts[at : at + 10]
        assert _cut(*encoder.texts(pa.array(part))) == _ids(vocab("word_bpe_49k.json"), part)


def test_round_trip(vocab, rows):
    pairs = [(1, "The cat  sat"), (1, "The cat  sat"), (None, "<|endoftext|> x"), (3, None), (4, "")]
    got = bpe.round_trip(rows(pairs), vocab("byte_bpe_50k.json")).collect()
    want = []
    for (i, text), ids in zip(pairs, _ids(vocab("byte_bpe_50k.json"), [t for _, t in pairs]), strict=True):
        blob = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(blob).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(rows([]), vocab("byte_bpe_50k.json")).collect() == []


def test_encode_then_decode(vocab, rows):
    pairs = [(1, "Grüße, 中文\n"), (2, ""), (None, "a")]
    encoded = bpe.encode_texts(rows(pairs), vocab("byte_bpe_50k.json"))
    assert {(r.doc_id, r.text) for r in bpe.decode_ids(encoded, vocab("byte_bpe_50k.json")).collect()} == set(pairs)


def test_token_files(spark, vocab, documents, texts):
    out = scratch(spark, "files")
    token_files.write(documents, out, vocab("word_bpe_49k.json"), end_id=2, width=2)
    order = sorted(texts)
    want, start = [], 0
    for i, ids in zip(order, _ids(vocab("word_bpe_49k.json"), [texts[i] for i in order]), strict=True):
        want.append((i, start, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())))
        start += len(ids) + 1
    assert sorted(map(tuple, token_files.checksums(spark, out).collect())) == want
    some = token_files.read(spark, out).where("doc_id = 7").first()
    assert some.ids == _ids(vocab("word_bpe_49k.json"), [texts[7]])[0] + [2]


def test_token_files_odd_rows(spark, vocab, rows):
    out = scratch(spark, "files")
    pairs = [(5, "b"), (5, "a"), (5, "a"), (None, "null first"), (-3, None), (9, "word " * 3000)]
    token_files.write(rows(pairs), out, vocab("word_bpe_49k.json"), end_id=2, width=4)
    got = sorted(token_files.checksums(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -3, 5, 5, 5, 9]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    empty = scratch(spark, "files")
    token_files.write(rows([]), empty, vocab("word_bpe_49k.json"), end_id=2)
    assert token_files.checksums(spark, empty).collect() == []


def test_token_files_refuse_what_does_not_fit(spark, vocab, rows):
    with pytest.raises(Exception, match="needs more than 2 bytes"):
        token_files.write(rows([(1, "a")]), scratch(spark, "files"), vocab("byte_bpe_50k.json"), end_id=70_000, width=2)


def _best_fit(lengths, capacity):
    gaps, n = [], 0
    for size in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, size)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = capacity, n + 1
        bisect.insort(gaps, gap - size)
    return n


packing_row = namedtuple("packing_row", "sequence_id offset length")


def _check_packing(got, capacity):
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_documents(vocab, documents, texts):
    got = packing.packed(documents, vocab("byte_bpe_50k.json"), 0, 512).collect()
    order = sorted(texts)
    want = set()
    for i, ids in zip(order, _ids(vocab("byte_bpe_50k.json"), [texts[i] for i in order]), strict=True):
        ids = [*ids, 0]
        cuts = [0, *range(len(ids) % 512 or 512, len(ids) + 1, 512)]
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want.add((i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    assert _check_packing(got, 512) <= 1.02 * _best_fit([w[3] for w in want], 512) + 1


@pytest.mark.parametrize("capacity", [1, 5, 2048])
def test_packing_of_any_lengths(spark, capacity):
    pick = np.random.default_rng(capacity)
    for lengths in (np.concatenate([pick.integers(1, capacity + 1, 300), np.full(100, max(1, capacity // 3)), np.ones(700, int)]), []):
        items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "key long, length long")
        placed = packing.pack(items, capacity).join(items, "key").collect()
        assert sorted(r.key for r in placed) == list(range(len(lengths)))
        if len(lengths):
            assert _check_packing(placed, capacity) <= 1.1 * _best_fit(list(lengths), capacity) + 1


def _mostly_empty(pick):
    return np.concatenate([np.ones(20_000, int), pick.integers(1, 2049, 20)])


@pytest.mark.parametrize(
    "lengths",
    [_mostly_empty, lambda pick: np.ones(20_000, int), lambda pick: pick.integers(1, 33, 10_000), lambda pick: pick.integers(257, 513, 2_000)],
    ids=["mostly empty", "empty", "short", "one range"],
)
def test_packing_fills_open_gaps(spark, lengths):
    """Small items and those of one range take about as many sequences as best-fit decreasing."""
    sizes = lengths(np.random.default_rng(6))
    items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "key long, length long")
    placed = packing.pack(items, 2048).join(items, "key").collect()
    assert sorted(r.key for r in placed) == list(range(len(sizes)))
    assert _check_packing(placed, 2048) <= 1.02 * _best_fit(sizes.tolist(), 2048) + 1


@pytest.mark.parametrize("seed", range(12))
def test_rounds_over_lengths_equal_best_fit_decreasing(seed):
    """As many sequences as one piece after another gives, every piece once, and no more entries than promised."""
    pick = np.random.default_rng(seed)
    capacity = int(pick.choice([1, 2, 7, 64, 100, 2048]))
    lengths = pick.integers(1, int(pick.integers(1, capacity + 1)) + 1, int(pick.integers(1, 3000)))
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    plan = packing.best_fit(counts, capacity)
    sizes = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = plan.places(sizes, ranks)
    rows = [packing_row(*r) for r in zip(sequence.tolist(), offset.tolist(), sizes.tolist(), strict=True)]
    assert _check_packing(rows, capacity) == _best_fit(lengths.tolist(), capacity)
    assert len(plan.length) <= 4 * capacity * (1 + np.log2(capacity))


def test_a_third_of_all_pieces_has_one_length(spark, monkeypatch):
    """A common length is ranked in several groups."""
    monkeypatch.setattr(packing, "RANKED", 50)
    lengths = [1] * 400 + [3 + n % 60 for n in range(800)]
    items = spark.createDataFrame([(k * 7, n, "x", k) for k, n in enumerate(lengths)], "key long, length long, salt string, rank long")
    placed = packing.pack(items, 64).collect()
    assert sorted(r.key for r in placed) == sorted(k * 7 for k in range(1200)) and {r.salt for r in placed} == {"x"}
    assert _check_packing(placed, 64) == _best_fit(lengths, 64)
    with pytest.raises(ValueError, match="lengths"):
        packing.pack(items, 60)


def test_packing_odd_rows(vocab, rows):
    pairs = [(1, None), (1, None), (None, ""), (2, "long " * 3000)]
    got = packing.packed(rows(pairs), vocab("byte_bpe_50k.json"), 0, 2048).collect()
    assert sorted((str(r.doc_id), r.piece, r.length) for r in got)[:2] == [("1", 0, 1), ("1", 0, 1)]
    assert sum(r.length for r in got if r.doc_id == 2) == len(_ids(vocab("byte_bpe_50k.json"), ["long " * 3000])[0]) + 1
    _check_packing(got, 2048)
    assert packing.packed(rows([]), vocab("byte_bpe_50k.json")).collect() == []
