"""Packing: the search against brute force, whole plans, tokens round trip, odd rows."""

from __future__ import annotations

import random
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from commentlens.llm import packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, piece string, length string, sequence_id int, offset int, _tie int, _number int, _place int"


def fewest(sizes: tuple[int, ...], limit: int) -> int:
    """Fewest sequences by trying every set for the first one."""

    @lru_cache(maxsize=None)
    def go(left: tuple[int, ...]) -> int:
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = len(left)
        for chosen in range(1 << len(rest)):
            inside = [s for i, s in enumerate(rest) if chosen >> i & 1]
            if first + sum(inside) <= limit:
                best = min(best, 1 + go(tuple(s for i, s in enumerate(rest) if not chosen >> i & 1)))
        return best

    return go(tuple(sorted(sizes, reverse=True)))


def counts_of(sizes, limit: int) -> np.ndarray:
    return np.bincount(np.array(sizes, int), minlength=limit + 1)


def holds(plan, counts: np.ndarray, limit: int) -> int:
    found = np.zeros_like(counts)
    for times, filling in plan:
        assert times > 0 and 0 < sum(filling) <= limit
        for size in filling:
            found[size] += times
    assert (found == counts).all()
    return sum(times for times, _ in plan)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_small_plans_need_the_fewest_sequences(sizes):
    counts = counts_of(sizes, 20)
    assert holds(packing.plan(counts, 20), counts, 20) == fewest(tuple(sizes), 20)
    assert packing.least_bins(counts, 20) <= fewest(tuple(sizes), 20)


def test_search_beats_best_fit_where_that_wastes():
    # 6+4, 5+5, 4+3+3: best-fit decreasing opens one more
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    counts = counts_of(sizes, 60)
    assert sum(t for t, _ in packing.best_fit(counts, 60)) == 4
    assert holds(packing.plan(counts, 60), counts, 60) == 3 == fewest(tuple(sizes), 60)


def test_undominated_fillings():
    counts = counts_of([7, 6, 4, 4, 3, 2], 10)
    # 10 alone isn't there; 7+3, 6+4, 4+4+2 fill it, and 4+3+2 leaves room; 4+4+2 has 4+2 = 6
    assert packing.fillings(counts, 10)[0] in [(7, 3), (6, 4)]
    assert set(packing.fillings(counts, 10)) == {(7, 3), (6, 4)}
    assert packing.fillings(counts, 7) == [(7,)]
    assert packing.fillings(counts, 1) == [()]


@pytest.mark.parametrize("seed", range(4))
def test_large_plans_are_whole_and_near_the_bound(seed):
    rnd = np.random.default_rng(seed)
    sizes = np.concatenate([rnd.integers(1, 2049, 3000), np.full(2000, 683 + seed), rnd.integers(200, 400, 3000)])
    counts = np.bincount(sizes, minlength=2049)
    found = holds(packing.plan(counts, 2048, nodes=3000), counts, 2048)
    assert found <= sum(t for t, _ in packing.best_fit(counts, 2048)) + counts[2048]
    assert found <= 1.01 * packing.least_bins(counts, 2048)


def test_copies_of_one_length_cost_no_more_than_few():
    for n in (10, 10**9):
        counts = np.zeros(2049, np.int64)
        counts[[683, 1366, 300]] = n
        assert holds(packing.plan(counts, 2048), counts, 2048) >= packing.least_bins(counts, 2048)


def test_cut():
    assert list(packing.cut(5, 2)) == [(0, 1), (1, 3), (3, 5)]
    assert list(packing.cut(4, 2)) == [(0, 2), (2, 4)]
    assert list(packing.cut(1, 2)) == [(0, 1)]


def test_ids_are_the_tokenizers():
    rnd = random.Random(3)
    letters = "abcdeABC 019'\n\t  é日本🙂 \u0085 \x1c\x00ſßİ٣–…½²"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["it's we'll I'M 'S", "<|endoftext|>", "a<|endoftext|>b", " " * 9000 + "x", "\n" * 5000, "x" * 20_000, "ab" * 9000, ""]
    plain = Tokenizer.from_file(TOKENIZER)
    assert packing._encoder(TOKENIZER)(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_other_tokenizer_files_are_read_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Hello There", "", "a b  c"]
    plain = Tokenizer.from_file(path)
    assert packing._encoder(path)(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    words = ["the", "of", "reader", "comment", "é", "日本", "x1", "\n", "  "]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 20, 60, 300]))) for _ in range(120)]
    made = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, None), (7, None), (8, ""), (1, texts[1]), (1, texts[1]), (9, "y" * 4000)]
    return [(i, t, "p", "l", 1, 2, 3, 4, 5) for i, t in made]


def test_documents_come_back_whole(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    packed = packing.pack(packing.pieces(docs, TOKENIZER, limit=128), limit=128).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    want = Counter((r[0], tuple([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0])) for r in rows)
    by_doc: dict = {}
    for r in packed:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 128 and (r.piece == 0 or r.length == 128)
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, tuple(ids.tolist())))
    for doc, found in by_doc.items():
        texts = Counter({ids: n for (d, ids), n in want.items() if d == doc})
        if sum(texts.values()) == 1:
            found.sort()
            assert [p[1] for p in found] == [sum(len(q[2]) for q in found[:k]) for k in range(len(found))]
            assert sum((p[2] for p in found), ()) == next(iter(texts))
        else:
            assert sum(len(p[2]) for p in found) == sum(len(ids) * n for ids, n in texts.items())
    assert set(by_doc) == {r[0] for r in rows}
    by_sequence: dict = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 128
    counts = counts_of([r.length for r in packed], 128)
    assert len(by_sequence) == packing.least_bins(counts, 128)


def test_sequences_join_their_pieces(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = packing.pack(packing.pieces(docs, TOKENIZER, limit=64), limit=64)
    whole = packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in packed.collect())
    assert all(len(r.ids) == 4 * r.n_tokens <= 256 for r in whole)


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(packing.pieces(none, TOKENIZER)).collect() == []


def test_too_long_pieces_are_refused(spark):
    with pytest.raises(ValueError, match="doesn't fit"):
        packing.pack(spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length long"), limit=8)
