"""Periodic runs: transforms against integers, runs and collapsed texts against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from commentlens.llm import periodic
from commentlens.llm.queries import op13_block_convolution

SCHEMA = "doc_id long, text string, words string, found string"


def brute(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` by comparing all words at every distance."""
    out: dict = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                out.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def bumpy(rnd: random.Random) -> list[int]:
    """Numbers with many periods, nested, neighbouring and broken ones."""
    out: list[int] = []
    for _ in range(rnd.randint(0, 7)):
        unit = [rnd.randint(0, rnd.choice([1, 2, 40])) for _ in range(rnd.randint(1, 14))]
        out += (unit * rnd.randint(1, 8))[: rnd.randint(1, 90)]
    return out


@pytest.mark.parametrize("p, g", periodic.PRIMES)
def test_roots_and_correlations(p, g):
    assert all(p % d for d in range(2, int(p**0.5) + 1)) and (p - 1) % (1 << 16) == 0
    rnd = np.random.default_rng(1)
    for size in (1, 2, 8, 64, 512):
        a, b = rnd.integers(0, 1 << 30, (3, size)), rnd.integers(0, 1 << 30, (3, 2 * size))
        want = [[sum(int(x) * int(y) for x, y in zip(a[r], b[r, o:])) % p for o in range(size)] for r in range(3)]
        assert periodic.correlations(a.astype(float), b.astype(float), p, g).astype(int).tolist() == want


def test_longest_transform_is_exact():
    p, g = periodic.PRIMES[0]
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(0, p, (1, 1 << 15)), rnd.integers(0, p, (1, 1 << 16))
    found = periodic.correlations(a.astype(float), b.astype(float), p, g)[0]
    for o in (0, 1, 77, (1 << 15) - 1):
        assert int(found[o]) == sum(int(x) * int(y) for x, y in zip(a[0], b[0, o:])) % p


def test_zero_places_of_large_numbers():
    rnd = np.random.default_rng(3)
    most = 1 << 21
    windows = rnd.integers(0, most, (4, 64))
    blocks = np.stack([windows[r, r * 5 : r * 5 + 32] for r in range(4)])
    blocks[3, 0] ^= 65537  # differs by a multiple of a prime
    found = periodic.zero_places(blocks, windows, most)
    assert [np.flatnonzero(f).tolist() for f in found] == [[0], [5], [10], []]


@pytest.mark.parametrize("most_block, chunk", [(1 << 15, 1 << 19), (4, 64), (1, 1 << 10)])
def test_runs_as_by_brute_force(monkeypatch, most_block, chunk):
    monkeypatch.setattr(periodic, "MOST_BLOCK", most_block)
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    rnd = random.Random(most_block)
    for _ in range(250):
        texts = [bumpy(rnd) for _ in range(rnd.randint(0, 4))]
        first = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        found = periodic.runs(np.array(sum(texts, []), np.int64), first)
        want = [(s + f, s + n + f, q) for f, t in zip(first.tolist(), texts) for s, n, q in brute(t)]
        assert [tuple(r) for r in found.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def test_long_texts():
    for words, want in [
        ([1] * 100_000, [[0, 100_000, 1]]),
        (list(range(30_000)) * 4, [[0, 120_000, 30_000]]),
        (list(range(30_000)) * 3, []),
    ]:
        assert periodic.runs(np.array(words), np.array([0, len(words)])).tolist() == want


def test_lower_exponents_are_refused():
    with pytest.raises(ValueError, match="four periods"):
        periodic.runs(np.array([1, 1]), np.array([0, 2]), exponent=3)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    texts = [" ".join(f"w{k}" for k in bumpy(rnd)) for _ in range(150)]
    texts += ["", None, " \n\t ", "a", "la la la la la la", "la la la la", "x y\tx y\nx y  x y x", "é " * 6, "a b " * 3, "z " * 30_000]
    made = [(i, t) for i, t in enumerate(texts)] + [(None, "a a a a a a a"), (3, texts[3]), (3, texts[3])]
    return [(i, t, "1", "2") for i, t in made]


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_collapsed_texts(spark, rows):
    got = periodic.collapse(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = split(r.text)
        runs = brute(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words) and r.collapsed == collapsed(words, runs)
        assert (r.words, r.found) == ("1", "2")


def test_clashing_columns_need_a_prefix(spark):
    docs = spark.createDataFrame([("a a a a a a", 5)], "text string, runs int")
    with pytest.raises(ValueError, match="prefix"):
        periodic.collapse(docs)
    row = periodic.collapse(docs, prefix="p_").first()
    assert row.runs == 5 and row.p_collapsed == "a"


def test_no_documents(spark):
    assert periodic.collapse(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_as_by_brute_force(spark, rows, tmp_path):
    spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_block_convolution(spark, str(tmp_path)).collect()
    found = sorted(tuple(r) for r in got if r.doc_id is not None)
    want = []
    for i, text, *_ in rows:
        words = split(text)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *longest, *digests))
    assert found == sorted(w for w in want if w[0] is not None)
    assert len(got) == len(rows)
