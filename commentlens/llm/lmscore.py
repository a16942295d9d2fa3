"""Cross-entropy difference of a target and a background n-gram model.

Both are bigram models over one vocabulary, smoothed alike by their own
unigrams. The background counts every document, the target those with a good
label. A document scores its mean loss per word under the target less that
under the background; the lower, the more it is like the target.

The models hold every word and word pair of the corpus and are nowhere in one
piece. Documents are gathered into *chunks* of many words. A chunk tells its
distinct grams once, with its own counts, to the parts of the model that hold
them; these answer with the counts of the whole corpus, and the chunk's
documents are scored from the answers. A gram that is everywhere is thus one
row a chunk, and what is moved grows with the corpus and not faster.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from commentlens.llm.shared import small_batches
from commentlens.session import once

PRIOR = 100.0
# Words that a unigram model takes as possible beside those it has seen.
UNSEEN = 1e6
KNOWN_WORDS = 500_000
CHUNK_WORDS = 250_000
GRAM_BITS = 48
# Labelled documents that may be sent to every task.
MOST_SENT = 1_000_000
# Words of the corpus for each part of the model.
PART_WORDS = 1_000_000


class _Words(dict):
    """Hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word) | zlib.adler32(word) << 32
        return value


def codes(text: str | None, known: _Words) -> np.ndarray:
    """48-bit hashes of the words of a whole lower-cased text."""
    words = [] if text is None else text.lower().encode("utf-8", "surrogatepass").split()
    return _mixed(np.fromiter(map(known.__getitem__, words), np.uint64, len(words))) >> np.uint64(64 - GRAM_BITS)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def grams(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of every word and of every pair of a chunk; a text starts from a mark of its own."""
    before = np.concatenate([np.zeros(1, np.uint64), words])[: len(words)]
    before[starts] = 0
    pairs = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + _mixed(words))
    return _mixed(words) >> np.uint64(64 - GRAM_BITS), pairs >> np.uint64(64 - GRAM_BITS)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, high bytes together, as most of these are zero, and compressed."""
    return zlib.compress(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes(), 1)


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(planes), np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _chunker(text: str, names: list[str]):
    """Stretches of a task's documents with the hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, held, good, size = _Words(), [], [], [], 0

        def chunk() -> pa.RecordBatch:
            docs = pa.Table.from_batches(rows).select(names).combine_chunks()
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in docs.columns]
            structs = pa.StructArray.from_arrays(columns, fields=list(docs.schema))
            flat = np.concatenate(held)
            known_words, place = np.unique(flat, return_inverse=True)
            sizes = np.array([len(x) for x in held], np.int64)
            fine = np.array(good, bool)
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs),
                    pa.array([sizes.tobytes()], pa.binary()),
                    pa.array([fine.tobytes()], pa.binary()),
                    pa.array([_planes(np.diff(known_words, prepend=np.uint64(0)))], pa.binary()),
                    pa.array([_planes(place.astype(np.uint32))], pa.binary()),
                    pa.array([len(flat)], pa.int64()),
                    pa.array([int(sizes[fine].sum())], pa.int64()),
                ],
                names=["docs", "sizes", "good", "words", "places", "n_all", "n_good"],
            )

        for batch in batches:
            first = 0
            marks = batch.column("_lm_good").to_pylist()
            for k, value in enumerate(batch.column(text).to_pylist()):
                held.append(codes(value, known))
                good.append(bool(marks[k]))
                size += len(held[-1]) + 1
                if size >= CHUNK_WORDS:
                    rows.append(batch.slice(first, k + 1 - first))
                    yield chunk()
                    rows, held, good, size, first = [], [], [], 0, k + 1
            if first < batch.num_rows:
                rows.append(batch.slice(first))
        if rows:
            yield chunk()

    return run


def _unpacked(sizes: bytes, words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of a chunk's documents, where those with words start, and its words' and pairs' hashes."""
    size = np.frombuffer(sizes, np.int64)
    word = np.cumsum(_numbers(words, np.uint64), dtype=np.uint64)[_numbers(places, np.uint32)]
    starts = (np.cumsum(size) - size)[size > 0]
    return (size, starts, *grams(word, starts))


def _asker(bits: int):
    """Distinct grams of every chunk with its own counts, cut by the parts of the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("chunk", "sizes", "good", "words", "places"))
            for chunk, sizes, good, words, places in zip(*columns, strict=True):
                size, _, singles, pairs = _unpacked(sizes, words, places)
                fine = np.repeat(np.frombuffer(good, bool), size)
                distinct, place = np.unique(np.concatenate([singles, pairs]), return_inverse=True)
                seen = np.bincount(place, minlength=len(distinct)).astype(np.uint64)
                liked = np.bincount(place[np.concatenate([fine, fine])], minlength=len(distinct)).astype(np.uint64)
                part = (distinct >> np.uint64(GRAM_BITS - bits)).astype(np.int64)
                cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
                spans = list(zip(cuts, [*cuts[1:], len(part)], strict=True)) if len(part) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part[a]) for a, _ in spans], pa.int64()),
                        pa.array([chunk] * len(spans), pa.int64()),
                        pa.array([_planes(np.diff(distinct[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
                        pa.array([_planes(seen[a:b]) for a, b in spans], pa.binary()),
                        pa.array([_planes(liked[a:b]) for a, b in spans], pa.binary()),
                    ],
                    names=["part", "chunk", "grams", "seen", "liked"],
                )

    return run


def _teller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all chunks, in each chunk's own order; rows come sorted by part."""
    held: list[tuple] = []

    def answer() -> pa.RecordBatch:
        asked = [np.cumsum(_numbers(row[2], np.uint64), dtype=np.uint64) for row in held]
        _, place = np.unique(np.concatenate(asked), return_inverse=True)
        totals = [
            np.bincount(place, weights=np.concatenate([_numbers(row[k], np.uint64) for row in held])).astype(np.uint64)[place] for k in (3, 4)
        ]
        ends = np.cumsum([len(x) for x in asked])
        seen, liked = ([_planes(x) for x in np.split(total, ends[:-1])] for total in totals)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in held], pa.int64()),
                pa.array([row[1] for row in held], pa.int64()),
                pa.array(seen, pa.binary()),
                pa.array(liked, pa.binary()),
            ],
            names=["part", "chunk", "seen", "liked"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                yield answer()
                held = []
            held.append(row)
    if held:
        yield answer()


def losses(single: np.ndarray, context: np.ndarray, pair: np.ndarray, total: int) -> np.ndarray:
    """Loss of each word in bits, from the counts of it, the word before it, and both: pairs smoothed by words, these by one each."""
    base = (single + 1) / (total + UNSEEN)
    return -np.log2((pair * (context > 0) + PRIOR * base) / (context + PRIOR))


def _scorer(totals: tuple[int, int], names: list[str]):
    """Documents of every chunk with their mean losses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("docs")
            columns = (batch.column(c).to_pylist() for c in ("sizes", "words", "places", "answers"))
            for k, (sizes, words, places, answers) in enumerate(zip(*columns, strict=True)):
                size, starts, singles, pairs = _unpacked(sizes, words, places)
                _, place = np.unique(np.concatenate([singles, pairs]), return_inverse=True)
                word, pair = place[: len(singles)], place[len(singles) :]
                of = np.repeat(np.arange(len(size)), size)
                means = []
                for key, total in zip(("liked", "seen"), totals, strict=True):
                    # Parts are cut by the highest bits, so their order is that of the grams.
                    found = [_numbers(a[key], np.uint64) for a in answers or []]
                    count = np.concatenate(found).astype(np.float64) if found else np.empty(0)
                    context = np.concatenate([np.zeros(1), count[word]])[: len(word)]
                    context[starts] = 0
                    loss = losses(count[word], context, count[pair], total)
                    means.append(np.bincount(of, weights=loss, minlength=len(size)) / np.maximum(size, 1))
                docs = lists.slice(k, 1).flatten()
                kept = [docs.field(i) for i in range(docs.type.num_fields)]
                empty = size == 0
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(size), *(pa.array(m, pa.float64(), mask=empty) for m in means)], names=names
                )

    return run


def scored(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", keep_text: bool = True
) -> DataFrame:
    """The documents with ``n_words``, both losses and their ``difference`` (runs jobs).

    Null and blank texts have no words and null losses. Without good labels
    the target knows nothing but its uniform base. Repeated rows count and
    score each for themselves; null ids are never labelled, ids labelled more
    than once are good if any label is. Columns that have the new names are
    replaced; an empty table gives no rows. Grams are told apart by 48-bit
    hashes.
    """
    spark = documents.sparkSession
    small_batches(spark)
    added = ["n_words", "target_loss", "background_loss"]
    kept = documents.drop(*added, "difference")
    names = [c for c in kept.columns if keep_text or c != text]
    fields = kept.select(*names).schema
    good = labels.where(F.col(label) == 1).select(F.col(doc_id).alias("_lm_id")).where(F.col("_lm_id").isNotNull()).distinct()
    # Few enough to send everywhere, or else both sides are shuffled.
    good = once(good, "good")
    good = F.broadcast(good) if good.count() <= MOST_SENT else good
    marked = kept.join(good.withColumn("_lm_good", F.lit(True)), F.col(doc_id) == F.col("_lm_id"), "left").drop("_lm_id")
    stretch = StructType().add("docs", ArrayType(fields))
    for name in ("sizes", "good", "words", "places"):
        stretch = stretch.add(name, BinaryType())
    stretches = marked.mapInArrow(_chunker(text, names), stretch.add("n_all", LongType()).add("n_good", LongType()))
    chunks = once(stretches.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    size = chunks.agg(F.coalesce(F.sum("n_all"), F.lit(0)).alias("n_all"), F.coalesce(F.sum("n_good"), F.lit(0)).alias("n_good")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = int(np.ceil(np.log2(max(size["n_all"] / PART_WORDS, parts, 1))))
    asked = chunks.select("chunk", "sizes", "good", "words", "places").mapInArrow(
        _asker(bits), "part long, chunk long, grams binary, seen binary, liked binary"
    )
    told = asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_teller, "part long, chunk long, seen binary, liked binary")
    answers = told.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("part", "seen", "liked"))).alias("answers"))
    joined = chunks.select("chunk", "docs", "sizes", "words", "places").join(answers, "chunk", "left").drop("chunk")
    schema = StructType(list(fields)).add("n_words", "long").add("target_loss", "double").add("background_loss", "double")
    found = joined.mapInArrow(_scorer((size["n_good"], size["n_all"]), [*names, *added]), schema)
    return found.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
