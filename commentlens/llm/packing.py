"""Packing documents into as few token sequences as possible, by bin completion.

Documents are cut into pieces of at most ``limit`` tokens in parallel. Only the
number of pieces of each length reaches the driver (``limit`` counts at most,
whatever the corpus). There a branch and bound decides how sequences are filled:
it takes the largest piece left, enumerates the undominated fillings around it,
applies one to as many sequences as the counts allow, and goes back when the
waste so far, with the least waste that what is left must cause, can't beat the
best solution known. Best-fit solutions are the incumbents. A filling is a
multiset of lengths, so the plan is a table of fillings; the pieces, numbered in
order of length across range partitions, look up their places in it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from commentlens.operators.numbering import number_rows
from commentlens.session import once

# Parameters of the search; they bound its work, never which documents are packed.
NODES = 4000  # fillings tried in all
WIDTH = 16  # fillings kept of those around one piece
SMALL = 24  # with so few lengths left, every undominated filling is listed
LEAVES = 2000
COMMON = 8

PIECES = "doc_id long, piece int, start long, length long, ids binary"

_LONG_SPACE = re.compile(r"\s{4096}")


# Tokens


@lru_cache(maxsize=4)
def _encoder(path: str):
    """A function from a list of texts to lists of ids, as the tokenizer file in ``path`` gives them.

    A byte-level file whose merges come in the order of their ids is the same as a
    table of byte strings with ranks, which ``tiktoken`` encodes several times
    as fast. Texts that hold the string of a special token, or very long white
    space (on which that library fails), go through ``tokenizers`` itself, as do
    all texts under any other kind of file.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)

    def plain(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]

    ranks = _byte_ranks(spec)
    if ranks is None:
        return plain
    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t["content"] for t in spec.get("added_tokens", [])]

    def mixed(texts: list[str]) -> list[list[int]]:
        return [
            plain([t])[0] if any(s in t for s in special) or _LONG_SPACE.search(t) else fast.encode_ordinary(t) for t in texts
        ]

    return mixed


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings with their ids, when the file is byte-level BPE whose merges are in the order of the ids."""
    model, before = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    steps = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")]
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer") or any(steps):
        return None
    if before.get("add_prefix_space") or before.get("use_regex") is False or model.get("ignore_merges") or model.get("byte_fallback"):
        return None
    # A byte is written as itself if it is printable Latin-1, else as the next character from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {token: i for token, i in model["vocab"].items() if token not in special}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocab.get(token, -1) for token in merged]
    if len(merged) + 256 != len(vocab) or ids != sorted(ids) or min(ids, default=256) < 256:
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocab.items()}


def cut(n: int, limit: int) -> Iterator[tuple[int, int]]:
    """Bounds of the pieces of ``n`` tokens: all but the first of ``limit`` tokens."""
    first = n - (n - 1) // limit * limit
    yield 0, first
    for start in range(first, n, limit):
        yield start, start + limit


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048, end: int = 0) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids``, the ids as little-endian unsigned 32-bit numbers.

    A document's tokens are those of its text (none for null), followed by
    ``end``, so every row gives a piece at least. Documents of more than
    ``limit`` tokens are cut into pieces of ``limit``; the first may be shorter.
    Repeated rows and null ids give their own pieces; other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(keys), 256):
                out: list[list] = [[], [], [], [], []]
                for key, ids in zip(keys[at : at + 256], encode([t or "" for t in texts[at : at + 256]])):
                    row = np.array([*ids, end], "<u4")
                    for k, (a, b) in enumerate(cut(len(row), limit)):
                        for column, value in zip(out, (key, k, a, b - a, row[a:b].tobytes())):
                            column.append(value)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, PIECES)


# The search


def least_bins(counts: np.ndarray, limit: int) -> int:
    """Lower bound on the sequences that ``counts`` pieces of each length need.

    For every k: pieces above ``limit - k`` stay alone, those above half of the
    limit don't meet, and what pieces from k up don't find room beside them
    fills sequences of its own.
    """
    size = np.arange(limit + 1)
    n, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * size)])
    k = np.arange(limit // 2 + 1)
    half = limit // 2 + 1
    above = n[limit + 1] - n[half]
    beside = n[limit - k + 1] - n[half]
    room = beside * limit - (total[limit - k + 1] - total[half])
    rest = total[half] - total[k]
    return int(above + np.maximum(0, -(-(rest - room) // limit)).max())


def best_fit(counts: np.ndarray, limit: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts: fillings ``(times, lengths)``."""
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        for room in sorted(r for r in open_ if r >= size):
            kept = []
            for times, filling in open_[room]:
                while left and times:
                    most = min(room // size, left)
                    used = min(times, left // most)
                    open_.setdefault(room - most * size, []).append((used, filling + (size,) * most))
                    left, times = left - used * most, times - used
                if times:
                    kept.append((times, filling))
            open_[room] = kept
            if not kept:
                del open_[room]
            if not left:
                break
        if left:
            most = limit // size
            if left >= most:
                open_.setdefault(limit - most * size, []).append((left // most, (size,) * most))
            if left % most:
                open_.setdefault(limit - left % most * size, []).append((1, (size,) * (left % most)))
    return [f for found in open_.values() for f in found]


def fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Undominated multisets of the lengths left that fit ``room``, the fullest first.

    One filling dominates another when the other's pieces can be dealt into its
    pieces' places. So a length that fills the room alone is the only answer; a
    filling must leave no room for another piece; and none of its pieces, nor
    two of them together, may give way to one larger piece that still fits.
    """
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes) or not room:
        return [()]
    if sizes[-1] == room:
        return [(room,)]
    found = _all(counts, room, sizes) if len(sizes) <= SMALL else _by_first(counts, room, sizes) | _by_common(counts, room, sizes)
    # Where only some are listed, what dominates them may not be among them.
    good = [f for f in found if not _dominated(f, counts, room)] or found
    # Of equally full ones first those of common lengths, which would else be left over together.
    return sorted(good, key=lambda f: (-sum(f), -sum(int(counts[s]) for s in f) / len(f), len(f), f))[:WIDTH]


def _all(counts: np.ndarray, room: int, sizes: np.ndarray) -> set[tuple[int, ...]]:
    """Every filling that leaves no room for another piece, up to ``LEAVES``."""
    lengths, out = sizes[::-1].tolist(), set()

    def go(at: int, room: int, chosen: tuple[int, ...]) -> None:
        if len(out) >= LEAVES:
            return
        if at == len(lengths):
            out.add(chosen)
            return
        size = lengths[at]
        for copies in range(min(int(counts[size]), room // size), -1, -1):
            go(at + 1, room - copies * size, chosen + (size,) * copies)

    go(0, room, ())
    return {f for f in out if not any(counts[s] > f.count(s) for s in lengths if s <= room - sum(f))}


def _by_first(counts: np.ndarray, room: int, sizes: np.ndarray) -> set[tuple[int, ...]]:
    """The best-fit filling below each possible first piece."""
    below = np.zeros(room + 1, np.int64)
    below[sizes] = sizes
    below = np.maximum.accumulate(below)
    rows, last, left = [sizes], sizes, room - sizes
    while True:
        nxt = below[np.minimum(left, last)]
        if not nxt.any():
            break
        rows.append(nxt)
        left, last = left - nxt, np.where(nxt > 0, nxt, last)
    table = np.stack(rows, 1)
    best = np.argsort(left, kind="stable")[: 8 * WIDTH]
    out = set()
    for row in table[best].tolist():
        filling = tuple(s for s in row if s)
        if all(counts[s] >= filling.count(s) for s in set(filling)):
            out.add(filling)
    return out or {_greedy(counts, room, sizes)}


def _by_common(counts: np.ndarray, room: int, sizes: np.ndarray) -> set[tuple[int, ...]]:
    """Copies of each of the commonest lengths with one piece that fills the room."""
    out = set()
    for size in sizes[np.argsort(-counts[sizes], kind="stable")[:COMMON]].tolist():
        for copies in range(1, min(int(counts[size]), room // size) + 1):
            rest = room - copies * size
            if not rest or counts[rest] > copies * (rest == size):
                out.add(tuple(sorted((size,) * copies + (rest,) * (rest > 0), reverse=True)))
    return out


def _greedy(counts: np.ndarray, room: int, sizes: np.ndarray) -> tuple[int, ...]:
    chosen: tuple[int, ...] = ()
    for size in sizes[::-1].tolist():
        copies = min(int(counts[size]), room // size)
        chosen, room = chosen + (size,) * copies, room - copies * size
    return chosen


def _dominated(filling: tuple[int, ...], counts: np.ndarray, room: int) -> bool:
    slack = room - sum(filling)
    one = {s: 1 for s in filling}
    two = {a + b: 0 for i, a in enumerate(filling[:12]) for b in filling[i + 1 : 12]}
    for total, least in (one | two).items() if len(filling) > 1 else one.items():
        for other in range(total + least, min(total + slack, room) + 1):
            if counts[other] > filling.count(other):
                return True
    return False


def plan(counts: np.ndarray, limit: int, nodes: int = NODES) -> list[tuple[int, tuple[int, ...]]]:
    """Fillings ``(times, lengths)`` that hold ``counts[l]`` pieces of each length l, in as few sequences as the search finds.

    It ends as soon as a solution meets the lower bound, when the branches are
    exhausted, or after ``nodes`` fillings tried.
    """
    counts = np.asarray(counts, np.int64).copy()
    full, counts[limit] = int(counts[limit]), 0
    whole = [(full, (limit,))] if full else []
    if not counts.any():
        return whole
    least, total = least_bins(counts, limit), int((counts * np.arange(limit + 1)).sum())
    best = best_fit(counts, limit)
    bins = sum(t for t, _ in best)
    stack: list = [(counts, 0, 0, (), None)]
    while stack and bins > least and nodes > 0:
        left, used, waste, path, todo = stack.pop()
        if todo is None:
            if not left.any():
                if used < bins:
                    best, bins = _unroll(path), used
                continue
            if waste > (bins - 1) * limit - total or used + least_bins(left, limit) >= bins:
                continue
            if len(path) % 64 == 0 and path:
                # an incumbent from here on by best fit
                tail = best_fit(left, limit)
                if used + sum(t for t, _ in tail) < bins:
                    best = _unroll(path) + tail
                    bins = sum(t for t, _ in best)
            largest = int(np.flatnonzero(left)[-1])
            rest = left.copy()
            rest[largest] -= 1
            todo = [(largest, *f) for f in fillings(rest, limit - largest)][::-1]
        filling = todo.pop()
        if todo:
            stack.append((left, used, waste, path, todo))
        nodes -= 1
        lengths, copies = np.unique(filling, return_counts=True)
        times = int((left[lengths] // copies).min())
        after = left.copy()
        after[lengths] -= times * copies
        stack.append((after, used + times, waste + times * (limit - sum(filling)), ((times, filling), path), None))
    return whole + best


def _unroll(path: tuple) -> list[tuple[int, tuple[int, ...]]]:
    out = []
    while path:
        step, path = path
        out.append(step)
    return out


# Places


def places(fillings: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Where the pieces of each length go: rows ``first, sequence, copies, offset, length``, by length and ``first``.

    Piece number r of a length, counted from 0, belongs to the last row of that
    length whose ``first`` is at most r; with ``j = r - first`` it is copy ``j %
    copies`` in sequence ``sequence + j // copies``. ``first`` counts on over
    all lengths in ascending order.
    """
    rows, sequence = [], 0
    for times, filling in fillings:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            copies = filling.count(length)
            rows.append((length, sequence, copies, offset, times * copies))
            offset += copies * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    first = np.cumsum(table[:, 4]) - table[:, 4]
    return np.column_stack([first, table[:, 1:4], table[:, 0]])


def pack(found: DataFrame, limit: int = 2048, nodes: int = NODES) -> DataFrame:
    """``pieces`` rows (or any rows with ``doc_id``, ``piece`` and a ``length`` from 1 to ``limit``) with ``sequence_id`` and ``offset`` (runs jobs).

    ``found`` is stored once. The sequences are numbered from 0; pieces lie one
    after the other from offset 0, without gaps. The plan has a row per length
    of a filling: each filling uses up a length or splits a kind of open
    sequence once a length, so its size follows ``limit`` and not the corpus.
    """
    stored = once(found, "pieces")
    rows = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # limit rows at most
    counts = np.zeros(limit + 1, np.int64)
    for row in rows:
        if row["length"] is None or not 1 <= row["length"] <= limit:
            raise ValueError(f"a piece of {row['length']} tokens doesn't fit sequences of {limit}")
        counts[row["length"]] = row["n"]
    table = places(plan(counts, limit, nodes))
    # The last column parts repeated rows and rows without ids, so no group of them is one task's.
    numbered = number_rows(
        stored.withColumn("_tie", F.monotonically_increasing_id()), ["length", "doc_id", "piece", "_tie"], "_number"
    ).drop("_tie")
    names = stored.columns
    schema = StructType([*stored.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("_number").to_numpy() - 1
            row = table[np.searchsorted(table[:, 0], number, side="right") - 1]
            j = number - row[:, 0]
            sequence, offset = row[:, 1] + j // row[:, 2], row[:, 3] + j % row[:, 2] * row[:, 4]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(look_up, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, n_tokens, n_pieces, ids``; a group holds ``limit`` tokens at most."""
    part = F.struct("offset", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    tokens = F.aggregate("parts", F.lit(0).cast("long"), lambda done, p: done + p["length"])
    return grouped.select("sequence_id", tokens.alias("n_tokens"), F.size("parts").alias("n_pieces"), joined.alias("ids"))
