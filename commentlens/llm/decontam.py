"""Benchmark decontamination by suffix arrays over shards of the corpus.

A shard is a run of documents of about ``SHARD_WORDS`` words within a task. Its
suffix array holds the places from which at least ``least`` words are all known
to the test items, sorted by the words that follow; nothing else can match an
item. Every suffix of every item is put in its place in that order by bisection.
Equal windows of all items have one range of places, which are their
occurrences; and of all suffixes the two next to a place share most words with
it, which gives every document's longest verbatim match and where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SHARE = 20
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 16 << 20

# ASCII letters and digits and all bytes above 127 make words; letters are lower-cased.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

HITS = "struct<spans:array<struct<start:bigint,stop:bigint>>,items:array<string>,longest:bigint,longest_at:bigint,longest_item:string>"


NO_HITS = ([], [], 0, None, None)


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Items:
    """Test items as word codes: all suffixes and all windows."""

    def __init__(self, rows: list[tuple[str, str]], window: int) -> None:
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.names: list[str] = []
        stream: list[int] = []
        starts, lengths = [], []
        for name, text in rows:
            found = [self.codes.setdefault(w, len(self.codes) + 1) for w in words(text)]
            if found:
                self.names.append(name)
                starts.append(len(stream))
                lengths.append(len(found))
                stream += [*found, 0]
        self.stream = np.array(stream, np.int64)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.least = int(min(window, self.lengths.min())) if starts else 0
        self._order: SuffixArray | None = None

    def _array(self) -> SuffixArray:
        """All suffixes of all items in order, for the items of a match and for the order of queries."""
        if self._order is None:
            self._order = SuffixArray(self.stream, 1)
        return self._order

    def sorted_suffixes(self) -> np.ndarray:
        """Places in the stream of the suffixes of items of a window or more, sorted by their words."""
        places = self._array().places
        long = self.lengths >= self.window
        item = np.searchsorted(self.starts, places, "right") - 1
        left = self.starts[item] + self.lengths[item] - places
        return places[long[item] & (left >= self.window)]

    def holder(self, codes: np.ndarray) -> str:
        """The smallest name of the items that hold these words, whole items only where they are shorter than a window."""
        array = self._array()
        low, high = array.ranges(codes, np.zeros(1, np.int64), len(codes))
        item = np.unique(np.searchsorted(self.starts, array.places[int(low[0]) : int(high[0])], "right") - 1)
        fits = item[(self.lengths[item] == len(codes)) | (len(codes) >= self.window)]
        return min(self.names[i] for i in fits.tolist())

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Place in the stream and item of every suffix."""
        item = np.repeat(np.arange(len(self.starts)), self.lengths)
        inside = np.arange(len(item)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        return self.starts[item] + inside, item


class SuffixArray:
    """Places of a shard's word codes, sorted by the words that follow.

    Code 0 stands for a word that no item has and for a document's end. Runs of
    other words shorter than ``least`` are left out. Doubling: places sorted by
    their first 2**j words give ranks by which the next pass sorts pairs; the
    passes end when all ranks differ or no place goes on that far.
    """

    def __init__(self, codes: np.ndarray, least: int) -> None:
        n = len(codes)
        ends = np.flatnonzero(np.append(codes, 0) == 0)
        run = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        self.codes, self.run = codes, run
        starts_of_run = (codes != 0) & (np.append(0, codes[:-1]) == 0)
        full = np.repeat(run[starts_of_run], run[starts_of_run])
        places = np.flatnonzero(codes)[full >= least]
        rank = np.zeros(n + 1, np.int64)
        rank[places] = codes[places]
        step, deepest = 1, int(run.max(initial=0))
        while len(places) and step < deepest:
            after = np.where(run[places] > step, rank[np.minimum(places + step, n)], 0)
            key = rank[places] * (n + 2 + int(codes.max())) + after
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank[places[order]] = np.cumsum(np.append(1, key[1:] != key[:-1]))
            step *= 2
        self.places = places[np.argsort(rank[places], kind="stable")] if len(places) else places

    def word(self, rows: np.ndarray, depth: int | np.ndarray) -> np.ndarray:
        """Code ``depth`` words into the suffixes at ``rows``, 0 beyond their end."""
        at = self.places[rows]
        return np.where(self.run[at] > depth, self.codes[np.minimum(at + depth, len(self.codes) - 1)], 0)

    def ranges(self, stream: np.ndarray, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For every query place, the rows whose first ``depth`` words equal the query's: from, to."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.places), np.int64)
        for d in range(depth):
            want = stream[queries + d]
            low, high = self._bisect(want, d, low, high, False), self._bisect(want, d, low, high, True)
        return low, high

    def _bisect(self, want: np.ndarray, depth: int | np.ndarray, low: np.ndarray, high: np.ndarray, past: bool) -> np.ndarray:
        """Within rows that agree on the words before, the first with a word not below (or above) ``want``."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_]) >> 1
            d = depth if np.isscalar(depth) else depth[open_]
            word = self.word(mid, d)
            right = word <= want[open_] if past else word < want[open_]
            low[open_[right]] = mid[right] + 1
            high[open_[~right]] = mid[~right]

    def insertions(self, stream: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """For every query place, the first row that doesn't come before the query's words to the end of its item."""
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(self.places), np.int64)
        length = np.zeros(len(queries), np.int64)
        live = np.arange(len(queries))
        while len(live):
            # an ended query comes before all rows that go on
            want = stream[queries[live] + length[live]]
            live, want = live[want > 0], want[want > 0]
            a = self._bisect(want, length[live], low[live], high[live], False)
            b = self._bisect(want, length[live], low[live], high[live], True)
            low[live], high[live] = a, b
            length[live] += 1
            live = live[a < b]
        return low

    def shared(self, rows: np.ndarray, stream: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``rows`` have in common with the queries beside them."""
        length = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            want = stream[queries[live] + length[live]]
            live = live[(want > 0) & (self.word(rows[live], length[live]) == want)]
            length[live] += 1
        return length


def _search(shard: list[np.ndarray], items: Items) -> list[tuple]:
    """Hit spans, item names and the longest match of every document of a shard."""
    found = [NO_HITS] * len(shard)
    if not items.names:
        return found
    codes = np.concatenate([x for doc in shard for x in (doc, [0])]).astype(np.int64)
    array = SuffixArray(codes, items.least)
    if not len(array.places):
        return found
    doc_starts = np.cumsum([0, *[len(doc) + 1 for doc in shard]])[:-1]
    queries, item = items.suffixes()
    left = items.starts[item] + items.lengths[item] - queries
    docs, starts, lengths, windows = [], [], [], []
    owners: list[np.ndarray] = []  # items of each different window that occurs
    for size in np.unique(np.minimum(items.lengths, items.window)):
        mine = np.flatnonzero((np.minimum(items.lengths, items.window)[item] == size) & (left >= size))
        low, high = array.ranges(items.stream, queries[mine], int(size))
        occurs = low < high
        mine, low, high = mine[occurs], low[occurs], high[occurs]
        # equal windows have equal ranges; other ranges of the same size don't meet them
        order = np.argsort(low, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(low[order]) != 0)[: len(order)])
        n = (high - low)[order[first]]
        rows = np.repeat(low[order[first]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = array.places[rows]
        doc = np.searchsorted(doc_starts, at, "right") - 1
        docs.append(doc)
        starts.append(at - doc_starts[doc])
        lengths.append(np.full(len(at), size))
        windows.append(np.repeat(np.arange(len(first)) + len(owners), n))
        owners += [np.unique(item[mine[own]]) for own in np.split(order, first[1:])] if len(first) else []
    doc, start, length, window = (np.concatenate(x) for x in (docs, starts, lengths, windows))
    if not len(doc):
        return found
    names: dict[tuple, list[str]] = {}

    def names_of(own: np.ndarray) -> list[str]:
        key = tuple(np.unique(own).tolist())
        if key not in names:
            names[key] = sorted({items.names[i] for w in key for i in owners[w].tolist()})
        return names[key]

    longest = _longest(array, doc_starts, items)
    order = np.lexsort((start, doc))
    doc, start, length, window = doc[order], start[order], length[order], window[order]
    cuts = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc))
    for a, b in zip([0, *cuts[:-1]], cuts):
        d = int(doc[a])
        # a short item is matched as a whole; longer matches reach beyond a window
        size = int(length[a:b].max())
        at = int(start[a:b][length[a:b] == size][0])
        best, best_at = max((size, -at), longest.get(d, (0, 0)))
        words_of = codes[doc_starts[d] - best_at : doc_starts[d] - best_at + best]
        found[d] = (merged(start[a:b], start[a:b] + length[a:b]), names_of(window[a:b]), best, -best_at, items.holder(words_of))
    return found


def _longest(array: SuffixArray, doc_starts: np.ndarray, items: Items) -> dict[int, tuple[int, int]]:
    """Each document's longest match with items of a window or more: its length, and less its first place."""
    queries = items.sorted_suffixes()
    if not len(queries):
        return {}
    # queries in order have their places in order
    at = array.insertions(items.stream, queries)
    rows = np.arange(len(array.places))
    after = np.searchsorted(at, rows, side="right")
    best = np.zeros(len(rows), np.int64)
    for beside in (after - 1, after):
        near = np.flatnonzero((beside >= 0) & (beside < len(queries)))
        best[near] = np.maximum(best[near], array.shared(rows[near], items.stream, queries[beside[near]]))
    enough = best >= items.window
    place, best = array.places[enough], best[enough]
    doc = np.searchsorted(doc_starts, place, "right") - 1
    order = np.lexsort((place, -best, doc))
    first = order[np.append(True, np.diff(doc[order]) != 0)[: len(order)]]
    return {int(doc[i]): (int(best[i]), -int(place[i] - doc_starts[doc[i]])) for i in first}


def merged(start: np.ndarray, stop: np.ndarray) -> list[dict]:
    """Union of spans that are sorted by their start."""
    reach = np.maximum.accumulate(stop)
    first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    last = np.append(first[1:], len(start)) - 1
    return [{"start": int(a), "stop": int(b)} for a, b in zip(start[first], reach[last], strict=True)]


def _matcher(shared, text: str, window: int, shard_words: int, out: list[str]):
    """Arrow function that adds an item block's matches to rows that carry those of earlier blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, window)
        code = items.codes.get
        held: list[pa.RecordBatch] = []
        docs: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = _search(docs, items)
            at = 0
            for batch in held:
                rows = found[at : at + batch.num_rows]
                counts = [len(d) for d in docs[at : at + batch.num_rows]]
                at += batch.num_rows
                yield _added(batch, rows, counts, out)

        for whole in batches:
            # A batch of long texts is taken in slices, so a shard stays near its size.
            for offset in range(0, whole.num_rows, 256):
                batch = whole.slice(offset, 256)
                for value in batch.column(text).to_pylist():
                    found = words(value)
                    docs.append(np.fromiter(map(code, found, repeat(0)), np.int64, len(found)))
                    size += len(found)
                held.append(batch)
                if size >= shard_words:
                    yield from flush()
                    held, docs, size = [], [], 0
        if held:
            yield from flush()

    return run


def _added(batch: pa.RecordBatch, rows: list[tuple], counts: list[int], out: list[str]) -> pa.RecordBatch:
    columns = {name: batch.column(name) for name in batch.schema.names}
    old = columns["_hits"].to_pylist()
    hits = []
    for before, (spans, names, longest, at, item) in zip(old, rows, strict=True):
        if before and before["items"]:
            both = sorted([(s["start"], s["stop"]) for s in before["spans"]] + [(s["start"], s["stop"]) for s in spans])
            spans = merged(np.array([a for a, _ in both]), np.array([b for _, b in both]))
            names = sorted({*before["items"], *names})
        if before and before["longest"]:
            earlier = (before["longest"], before["longest_at"], before["longest_item"])
            longest, at, item = min([earlier, *([(longest, at, item)] if longest else [])], key=lambda m: (-m[0], m[1], m[2]))
        hits.append({"spans": spans, "items": names, "longest": longest, "longest_at": at, "longest_item": item})
    columns["_hits"] = pa.array(hits, batch.schema.field("_hits").type)
    columns["_words"] = pa.array(counts, pa.int64())
    return pa.RecordBatch.from_arrays([columns[n] for n in out], names=out)


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """The documents with ``_words`` and ``_hits`` added (reads the benchmark).

    ``_hits`` has the merged ``spans`` of words that lie in an occurrence of a
    window, the ``items`` with such windows as strings, and the longest match
    that holds a window: its length, its first word, and the smallest name of
    the items that have it (0 and nulls where no window occurs).

    Items come in blocks of about ``block_bytes``, each broadcast for one pass
    over the documents, so no broadcast grows with the benchmark. Null texts
    and items without words match nothing; a null item id is named ``null``;
    repeated items count once by their id, and repeated documents each for
    themselves. Columns named ``_words`` or ``_hits`` may not be there yet.
    """
    spark = documents.sparkSession
    named = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"), F.col(item_text).alias("text")
    ).where(F.col("text").isNotNull())
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    part = F.pmod(F.xxhash64("name", "text"), F.lit(blocks))
    frame = documents.withColumn("_words", F.lit(0).cast("long")).withColumn("_hits", F.lit(None).cast(HITS))
    for block in range(blocks):
        rows = [tuple(r) for r in named.where(part == block).distinct().collect()]
        shared = spark.sparkContext.broadcast(rows)
        out = frame if keep_text or block < blocks - 1 else frame.drop(text)
        frame = frame.mapInArrow(_matcher(shared, text, window, shard_words, out.columns), out.schema)
    return frame


def judged(matched: DataFrame, share: int = SHARE) -> DataFrame:
    """Adds the verdict and what it rests on to matched documents.

    ``n_words, n_hit, n_items, items_sha256, contaminated``: a ``share``-th of the
    words hit, one at least; ``longest, longest_at, longest_item``: the longest
    match. Columns of these names are replaced.
    """
    n_hit = F.aggregate("_hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (
        matched.withColumn("n_words", F.col("_words"))
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("_hits.items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("_hits.items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
        .withColumns({name: F.col(f"_hits.{name}") for name in ("longest", "longest_at", "longest_item")})
        .drop("_words", "_hits")
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, share: int = SHARE, text: str = "text", **options) -> DataFrame:
    """The documents without those that hold test items, whatever their other columns are called.

    Rows travel whole beside their text, so no column of theirs meets one of the
    operator's. An empty benchmark removes nothing.
    """
    packed = documents.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = matches(packed, benchmark, text="text", keep_text=False, **options)
    return judged(found, share).where(~F.col("contaminated")).select("row.*")
