"""Periodic runs of words, found by block convolution at dyadic scales, and their removal.

A run is a maximal stretch of words with smallest period q that is at least
``exponent`` periods (and ``least`` words) long. For periods from B up to 2B the
words are cut into blocks of B. The sums of squared differences between a block
and every place at a distance of B up to 2B are Σ block² + Σ place² - 2 Σ
block·place; the last term is a correlation, computed for all blocks at once by
number-theoretic transforms modulo primes whose product exceeds any sum, so a
sum of zero is exact. With an exponent of 4, a run of period q contains a whole
block and its repetition at distance q, and neighbouring blocks at one distance
form chains, each of which is extended word by word to the run's bounds.

Everything happens within one text; texts are dealt to tasks by Spark and
handled in Arrow batches, all texts of a batch in the same transforms.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from commentlens.llm.shared import SPACE, slices

#: Primes with a primitive root, such that 2**16 divides p - 1.
PRIMES = [(65537, 3), (786433, 10), (7340033, 3), (23068673, 3)]
MOST_BLOCK = 1 << 15  # longer periods meet the following text in several windows of this length
CHUNK = 1 << 19  # numbers in a transform's table at a time

RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


# Transforms


@lru_cache(maxsize=None)
def _powers(p: int, g: int, n: int, sign: int) -> np.ndarray:
    """Powers 0 to n - 1 of a root of order n."""
    root = pow(g, (p - 1) // n, p)
    root = root if sign > 0 else pow(root, p - 2, p)
    out = [1]
    for _ in range(n - 1):
        out.append(out[-1] * root % p)
    return np.array(out, np.float64)


@lru_cache(maxsize=None)
def _table(p: int, g: int, rows: int, columns: int, n: int, sign: int) -> np.ndarray:
    """The n-th root to the power row x column."""
    return _powers(p, g, n, sign)[np.outer(np.arange(rows), np.arange(columns)) % n]


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    x -= np.floor(x * (1.0 / p)) * p
    return x


def _radix(p: int, n: int) -> int:
    # products of two residues, summed over a radix, stay below 2**53
    return min(n, 64 if p < 1 << 23 else 8)


def transform(x: np.ndarray, p: int, g: int, sign: int) -> np.ndarray:
    """Number-theoretic transform of every row, in the order that ``restored`` undoes. Row lengths are powers of two.

    A row of ``r x m`` numbers is transformed down its columns by one matrix
    product, multiplied by powers of the root, and then along its rows.
    """
    count, n = x.shape
    r = _radix(p, n)
    if r == n:
        return _mod(x @ _table(p, g, n, n, n, sign), p)
    m = n // r
    y = _mod(_table(p, g, r, r, r, sign) @ x.reshape(count, r, m), p)
    y = _mod(y * _table(p, g, r, m, n, sign), p)
    return transform(y.reshape(count * r, m), p, g, sign).reshape(count, n)


def restored(x: np.ndarray, p: int, g: int) -> np.ndarray:
    """Rows whose ``transform`` with sign 1 is ``x``, times their length."""
    count, n = x.shape
    r = _radix(p, n)
    if r == n:
        return _mod(x @ _table(p, g, n, n, n, -1), p)
    m = n // r
    y = restored(x.reshape(count * r, m), p, g).reshape(count, r, m)
    y = _mod(y * _table(p, g, r, m, n, -1), p)
    return _mod(_table(p, g, r, r, r, -1) @ y, p).reshape(count, n)


def correlations(blocks: np.ndarray, windows: np.ndarray, p: int, g: int) -> np.ndarray:
    """Σ blocks[r, j] · windows[r, o + j] modulo p for o below the block length.

    ``windows`` is twice as wide as ``blocks``, so nothing wraps around.
    """
    size = blocks.shape[1]
    padded = np.zeros(windows.shape)
    padded[:, :size] = blocks
    product = _mod(transform(padded % p, p, g, -1) * transform(windows % p, p, g, 1), p)
    # the row length is divided out by its inverse
    return np.mod(restored(product, p, g)[:, :size] * pow(windows.shape[1], p - 2, p), p)


def zero_places(blocks: np.ndarray, windows: np.ndarray, most: int) -> np.ndarray:
    """Where a block occurs: true at [r, o] if the squared differences of block r and its window at o sum to zero.

    ``most`` bounds the numbers; as many primes are used as their product needs
    to exceed any sum.
    """
    size = blocks.shape[1]
    squares = np.cumsum(windows.astype(np.int64) ** 2, axis=1)
    squares = np.concatenate([np.zeros((len(blocks), 1), np.int64), squares], axis=1)
    both = squares[:, size : 2 * size] - squares[:, :size] + (blocks.astype(np.int64) ** 2).sum(1, keepdims=True)
    found, bound, product = None, size * most * most, 1
    for p, g in PRIMES:
        zero = (both % p) == (2 * correlations(blocks, windows, p, g)) % p
        found = zero if found is None else found & zero
        product *= p
        if product > bound:
            return found
    raise ValueError("too many different words in a text")


# Runs


def runs(words: np.ndarray, first: np.ndarray, exponent: int = 4, least: int = 6) -> np.ndarray:
    """Runs ``(start, end, period)`` in texts that lie one after the other in ``words``, sorted.

    ``words`` holds word numbers from 0 up within each text, and ``first`` the
    start of every text and the end of the last. The block argument needs an
    ``exponent`` of 4 or more. A word that occurs fewer than ``exponent`` times in its
    text is in no run, so such words part the texts into segments first.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods may hold no whole block and its repetition")
    segments, values = _segments(words, first, exponent, max(least, exponent))
    found = np.zeros((0, 3), np.int64)
    period = 1
    while True:
        segments = segments[segments[:, 1] - segments[:, 0] >= exponent * period]
        if not len(segments):
            break
        block = min(period, MOST_BLOCK)
        chains = [_chains(values, segments, block, shift, found) for shift in range(period, 2 * period, block)]
        chains = np.concatenate(chains)
        ends = _extended(values, chains, block)
        enough = ends[:, 1] - ends[:, 0] >= np.maximum(least, exponent * ends[:, 2])
        found = _smallest(np.concatenate([found, ends[enough]]))
        period *= 2
    return found


def _segments(words: np.ndarray, first: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``(start, end)`` of words that are common enough in their text, and small numbers for the words."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if not len(words):
        return np.zeros((0, 2), np.int64), words
    wide = int(words.max()) + 1
    _, number, counts = np.unique(text * wide + words, return_inverse=True, return_counts=True)
    common = counts[number] >= exponent
    # numbers from 1 up within a text, of its common words only
    rank = np.cumsum(counts >= exponent)
    lowest = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(lowest, text[common], rank[number[common]])
    values = np.where(common, rank[number] - lowest[text] + 1, 0)
    edge = np.zeros(len(words) + 1, bool)
    edge[first] = True
    edge[1:] |= ~common
    edge[:-1] |= ~common
    bounds = np.flatnonzero(edge)
    pairs = np.stack([bounds[:-1], bounds[1:]], 1)
    pairs = pairs[pairs[:, 1] - pairs[:, 0] >= least]
    return pairs[common[pairs[:, 0]]], values


def _chains(values: np.ndarray, segments: np.ndarray, size: int, shift: int, known: np.ndarray) -> np.ndarray:
    """Stretches ``(start, end, period)`` that consecutive blocks and their repetitions cover, periods from ``shift`` on.

    A run's blocks lie from less than a block after its start to less than a
    block before its last period, so chains too short for a run even if
    extended by that are left out, as are repetitions inside a run whose
    period divides theirs.
    """
    length = segments[:, 1] - segments[:, 0]
    count = np.maximum((length - shift) // size, 0)  # a block's nearest place must lie inside
    segment = np.repeat(np.arange(len(segments)), count)
    start = segments[segment, 0] + (np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)) * size
    most = int(values.max()) if len(values) else 0
    parts = []
    step = max(CHUNK // (2 * size), 1)
    offsets = np.arange(2 * size)
    for a in range(0, len(start), step):
        at, end = start[a : a + step], segments[segment[a : a + step], 1]
        blocks = values[at[:, None] + offsets[:size]]
        places = at[:, None] + shift + offsets
        windows = np.where(places < end[:, None], values[np.minimum(places, len(values) - 1)], 0)
        zero = zero_places(blocks, windows, most)
        zero &= places[:, :size] + size <= end[:, None]
        r, o = np.nonzero(zero)
        parts.append(np.stack([at[r], shift + o, segment[a + r]], 1))
    met = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
    met = _outside(met, size, known)
    met = met[np.lexsort((met[:, 0], met[:, 2], met[:, 1]))]
    if not len(met):
        return np.zeros((0, 5), np.int64)
    new = np.ones(len(met), bool)
    new[1:] = (met[1:, 1] != met[:-1, 1]) | (met[1:, 2] != met[:-1, 2]) | (met[1:, 0] != met[:-1, 0] + size)
    head = np.flatnonzero(new)
    blocks = np.diff(np.append(head, len(met)))
    begin, period = met[head, 0], met[head, 1]
    long = blocks * size + period + 2 * (size - 1) >= 4 * period
    bounds = segments[met[head, 2]]
    return np.column_stack([begin, begin + blocks * size + period, period, bounds])[long]


def _outside(met: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Repetitions that aren't inside a known run whose period divides their distance."""
    known = known[known[:, 1] - known[:, 0] >= 2 * size]
    if not len(met) or not len(known):
        return met
    met = met[np.argsort(met[:, 0], kind="stable")]
    keep = np.ones(len(met), bool)
    low = np.searchsorted(met[:, 0], known[:, 0])
    high = np.searchsorted(met[:, 0], known[:, 1] - 2 * size, side="right")
    for (_, end, period), a, b in zip(known.tolist(), low.tolist(), high.tolist()):
        part = met[a:b]
        keep[a:b] &= (part[:, 0] + part[:, 1] + size > end) | (part[:, 1] % period != 0)
    return met[keep]


def _extended(values: np.ndarray, chains: np.ndarray, size: int) -> np.ndarray:
    """Chains grown to both sides as far as their period holds, by less than a block."""
    out = chains[:, :3].copy()
    reach = np.arange(1, size + 1)
    for a in range(0, len(chains), max(CHUNK // size, 1)):
        rows = slice(a, a + max(CHUNK // size, 1))
        start, end, period, low, high = (c[:, None] for c in chains[rows].T)
        left, right = start - reach, end - 1 + reach
        same = (left >= low) & (values[np.maximum(left, 0)] == values[np.maximum(left, 0) + period])
        out[rows, 0] -= np.logical_and.accumulate(same, axis=1).sum(1)
        right_in = np.minimum(right, len(values) - 1)
        same = (right < high) & (values[right_in] == values[right_in - period])
        out[rows, 1] += np.logical_and.accumulate(same, axis=1).sum(1)
    return out


def _smallest(found: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, by start, then period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


# Texts


def collapse(docs: DataFrame, text: str = "text", exponent: int = 4, least: int = 6, prefix: str = "") -> DataFrame:
    """Every row with its runs and its text without their repetitions.

    Adds ``runs`` (start, length and period in words, by start, then period),
    ``n_words`` and ``collapsed``: the words that no run holds after its first
    period, joined by one space. ``prefix`` goes before the three names; a
    column of such a name is an error. Null and empty texts have no words, no
    runs, and an empty collapsed text. Repeated rows are handled each by
    itself, all other columns and the number of rows stay as they are, and an
    empty table gives an empty one.
    """
    names = [f"{prefix}{name}" for name in ("n_words", "runs", "collapsed")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} exist already; give a prefix")
    kept = list(docs.columns)
    added = [StructField(name, kind) for name, kind in zip(names, (LongType(), RUNS, StringType()))]
    schema = StructType([*docs.schema.fields, *added])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, at):
                found = _collapsed(some.column(at), exponent, least)
                yield pa.RecordBatch.from_arrays([*some.columns, *found], [*kept, *names])

    return docs.mapInArrow(run, schema)


def _collapsed(texts: pa.Array, exponent: int, least: int) -> list[pa.Array]:
    # bytes.split parts words at the six ASCII white-space characters only
    words = [(t or "").encode().split() for t in texts.to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    numbers = []
    for own in words:
        codes: dict[bytes, int] = {}
        numbers.extend([codes.setdefault(w, len(codes)) for w in own])
    found = runs(np.array(numbers, np.int64), first, exponent, least)
    text = np.searchsorted(first, found[:, 0], side="right") - 1
    dropped = np.zeros(first[-1] + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 1], -1)
    gone = np.cumsum(dropped[:-1]) > 0
    changed = set(text.tolist())
    lines = []
    for k, own in enumerate(words):
        if k in changed:
            own = [w for w, g in zip(own, gone[first[k] : first[k + 1]].tolist()) if not g]
        lines.append(b" ".join(own).decode())
    struct = pa.StructArray.from_arrays(
        [pa.array(found[:, 0] - first[text]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])],
        ["start", "length", "period"],
    )
    offsets = np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)
    return [pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets), struct), pa.array(lines, pa.string())]


# Planted repetitions


def planted(doc_id: str | Column, text: str | Column) -> Column:
    """A text of which one document in ten, picked by the checksum of its id, repeats some of its words.

    With h = crc32(id as text) and g = floor(h / 10): if 10 divides h, word i
    from place ``a = g % n`` on becomes word ``a + (i - a) % p``, where p is
    ``1 + floor((n - a) / (3 + g % 8))``. Null ids and texts without words stay.
    """
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    column = F.col(text) if isinstance(text, str) else text
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(column, F.lit(f"([^{SPACE}]+)"), F.lit(1))

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        taken = F.transform(
            words, lambda w, i: F.when(i < a, w).otherwise(F.element_at(words, (a + F.pmod(i - a, p) + 1).cast("int")))
        )
        return F.when(n > 0, F.array_join(taken, " ")).otherwise(column)

    # one array serves all three uses
    whole = F.transform(F.array(words), repeated)[0]
    return F.when(h % 10 == 0, whole).otherwise(column)
