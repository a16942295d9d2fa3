"""Documents that share most of their five-word shingles, by count vectors.

A document's shingles are hashed into 256 groups; their counts are a point, and
the sum of coordinate minima bounds the overlap of two documents. Points are
indexed in R-trees, packed by size and coordinates, one for each *meeting*:
among sets with a Jaccard of 0.75 or more, the first ``n - ceil(0.75 n) + 1``
shingles in any common order meet, so the tree of each such shingle sees every
pair that can link, and one tree over all points, whose bounds hardly part
unrelated documents, isn't needed. A point has one more coordinate in a meeting,
what its set holds from the meeting's shingle on: at the first shingle that two
sets share they have no more than the smaller of these in common. What the
bounds leave is verified on the whole shingle sets.

Meetings of few members who are the same are one meeting, in which a member's
last coordinate is its largest.

Documents with equal sets are one class from the start. Large groups of near
copies never become all their pairs: a first round tries each member against
one leader per shingle; in the next ones the trees of large meetings, in blocks,
give each member a few partners; the last trees give every pair of members that are
not yet in one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentlens.llm.components import components
from commentlens.llm.shared import small_batches
from commentlens.session import once

WORDS = 5
GROUPS = 256  # a power of two: the first bits of a shingle's hash
FINE = 1536  # larger sets have counts in more groups too, 3 to 6 shingles in each
# Jaccard of at least NUMBER / OF.
NUMBER, OF = 3, 4
SKETCH_BITS = 19
SKETCH_WORDS = 4_000_000
KNOWN_WORDS = 500_000
LEADERS = 1
# Meetings of more members pass rounds of a few partners a member, in blocks of so many.
SMALL = 16
ROUNDS = 2
NEAREST = 2
THIN_BLOCK = 1000
LEAF = 16
FAN = 8
BLOCK = 20_000
PRUNED = 2  # times that the members of a meeting are judged
MOST_SENT = 1_000_000
MEMBERS = 64  # texts that are verified against one copy of their leader's

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Hashes(dict):
    """64-bit hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct hashes of a whole text's word 5-grams; of all its words if they are fewer."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(words) - width + 1 + k]
    return np.unique(_mixed(total))


def _sketcher(text: str):
    """Counts by bucket of the shingles that several documents of a stretch share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = _Hashes(), [], 0
        table = np.zeros(1 << SKETCH_BITS, np.int64)

        def add() -> None:
            found, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            np.add.at(table, (found[often] & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), count[often])

        for batch in batches:
            for value in batch.column(text).to_pylist():
                held.append(shingles(value, hashes))
                size += len(held[-1])
                if size >= SKETCH_WORDS:
                    add()
                    held, size = [], 0
        if held:
            add()
        bucket = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(table[bucket])], names=["bucket", "seen"])

    return run


def common_buckets(documents: DataFrame, text: str) -> np.ndarray:
    """How common each of 2**19 buckets of shingles is, for the order of shingles (runs a job).

    Any order gives all links; this one puts what many documents share last,
    so that meetings stay small. The table's size is fixed.
    """
    rows = documents.select(text).mapInArrow(_sketcher(text), "bucket long, seen long")
    summed = rows.groupBy("bucket").agg(F.sum("seen").alias("seen")).toArrow()
    table = np.zeros(1 << SKETCH_BITS, np.uint32)
    table[summed["bucket"].to_numpy()] = np.minimum(summed["seen"].to_numpy(), 2**32 - 1)
    return table


def _fine_counts(found: np.ndarray) -> bytes | None:
    """A large set's counts in groups whose number grows with it; null if it is small or a count needs more than a byte."""
    if len(found) <= FINE:
        return None
    bits = GROUPS.bit_length() - 1 + ((len(found) - 1) // FINE).bit_length()
    counts = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _describer(shared, text: str, doc_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, hashes, told = shared.value, _Hashes(), set()
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            sizes, classes, prefixes, vectors, fines = [], [], [], [], []
            for value in batch.column(text).to_pylist():
                found = shingles(value, hashes)
                n = len(found)
                sizes.append(n)
                classes.append(int(_mixed(np.array([found.sum() + np.uint64(n)])).view(np.int64)[0]) if n else None)
                counts = np.bincount((found >> np.uint64(65 - GROUPS.bit_length())).astype(np.int64), minlength=GROUPS)
                fine = _fine_counts(found)
                # Of a task's copies only the first brings its shingles to the meetings.
                if len(told) >= KNOWN_WORDS:
                    told.clear()
                if classes[-1] in told:
                    found = found[:0]
                elif n:
                    told.add(classes[-1])
                # the shingles are sorted already, so a stable sort by how common they are is enough
                order = np.argsort(common[(found & mask).astype(np.int64)], kind="stable")[: n - (NUMBER * n + OF - 1) // OF + 1]
                prefixes.append(found[order].view(np.int64))
                vectors.append(counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes())
                fines.append(fine)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            offsets = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id),
                    batch.column("body"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.array(vectors, pa.binary()),
                    pa.array(fines, pa.binary()),
                ],
                names=["doc_id", "body", "n", "cls", "prefix", "vector", "fine"],
            )

    return run


def _jaccard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets have the Jaccard, of texts that follow that of their leader (a null ``a``)."""
    hashes, leader = _Hashes(), np.empty(0, np.uint64)
    for batch in batches:
        linked = []
        for a, text in zip(batch.column("a").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = shingles(text, hashes)
            if a is None:
                leader = found
            both = len(np.intersect1d(leader, found, assume_unique=True))
            linked.append(a is not None and OF * both >= NUMBER * (len(leader) + len(found) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _points(blobs) -> np.ndarray:
    """Counts by group; those of large documents come in four bytes each."""
    if all(len(v) == GROUPS for v in blobs):
        return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, GROUPS).astype(np.int32)
    return np.stack([np.frombuffer(v, np.uint8 if len(v) == GROUPS else "<u4") for v in blobs]).astype(np.int32)


def _leaf_join(cuts: np.ndarray, n: np.ndarray, rest: np.ndarray, part: np.ndarray, blobs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``_tree_join`` gives for trees of one leaf, of all such meetings at once; ``cuts`` are the meetings' first rows."""
    sizes = np.diff(np.append(cuts, len(n)))
    meeting, few = np.repeat(np.arange(len(cuts)), sizes), np.repeat(sizes <= LEAF, sizes)
    left, right = [], []
    for step in range(1, LEAF):
        x = np.flatnonzero(few[:-step] & (meeting[:-step] == meeting[step:]))
        y = x + step
        need = NUMBER * (n[x] + n[y])
        fits = (part[x] != part[y]) & (NUMBER * np.maximum(n[x], n[y]) <= OF * np.minimum(n[x], n[y]))
        fits &= np.minimum(rest[x], rest[y]) * (NUMBER + OF) >= need
        left.append(x[fits])
        right.append(y[fits])
        if not len(x):
            break
    x, y = np.concatenate([np.empty(0, np.int64), *left]), np.concatenate([np.empty(0, np.int64), *right])
    fits = np.zeros(len(x), bool)
    for k in range(0, len(x), 1 << 15):  # bounded memory
        some = slice(k, k + (1 << 15))
        low = np.minimum(_points(blobs[x[some]]), _points(blobs[y[some]])).sum(axis=1)
        fits[some] = low * (NUMBER + OF) >= NUMBER * (n[x[some]] + n[y[some]])
    return x[fits], y[fits]


def _tree_join(n: np.ndarray, rest: np.ndarray, part: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in different parts that the bounds leave, from a join of a packed R-tree with itself.

    Rows are packed by size, and within runs of like size by their counts in
    the first groups, into leaves, and leaves into nodes. A box holds the
    largest count of every group, the largest ``rest`` and the range of sizes of what is
    below it. Two boxes whose summed minima, or whose smaller rest, stay below
    the least overlap of their smallest members hold no link, so nothing below
    them is compared.
    """
    order = np.lexsort((points[:, 1], points[:, 0], n // max(LEAF, int(np.sqrt(len(n)) * LEAF))))
    order = order[np.argsort(n[order], kind="stable")] if len(n) <= 4 * LEAF else order
    n, rest, points, part = n[order], rest[order], points[order], part[order]
    levels, width = [(points, rest, n, n)], LEAF
    while len(levels[-1][1]) > 1:
        top, most, small, large = levels[-1]
        at = np.arange(0, len(most), width)
        levels.append((
            np.maximum.reduceat(top, at), np.maximum.reduceat(most, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at),
        ))
        width = FAN
    i = j = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        top, most, small, large = levels[depth]
        need = NUMBER * (small[i] + small[j])
        fits = (NUMBER * small[j] <= OF * large[i]) & (NUMBER * small[i] <= OF * large[j])
        fits &= np.minimum(most[i], most[j]) * (NUMBER + OF) >= need
        i, j, need = i[fits], j[fits], need[fits]
        fits = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 15):  # bounded memory
            some = slice(k, k + (1 << 15))
            fits[some] = np.minimum(top[i[some]], top[j[some]]).sum(axis=1) * (NUMBER + OF) >= need[some]
        i, j = i[fits], j[fits]
        if depth:
            width = FAN if depth > 1 else LEAF
            below = len(levels[depth - 1][1])
            side = np.arange(width)
            x = (i[:, None] * width + np.repeat(side, width)[None, :]).ravel()
            y = (j[:, None] * width + np.tile(side, width)[None, :]).ravel()
            there = (x < below) & (y < below) & (x <= y)
            i, j = x[there], y[there]
    apart = (i < j) & (part[i] != part[j])
    return order[i[apart]], order[j[apart]]


def _few_each(x: np.ndarray, y: np.ndarray, cls: np.ndarray, n: np.ndarray, points: np.ndarray, salt: int) -> np.ndarray:
    """Which pairs are among the ``NEAREST`` of a row by their bound, or join it with the partner whose salted class is least."""
    rank = np.empty(len(cls), np.int64)
    rank[np.argsort(_mixed(cls.view(np.uint64) + np.uint64(salt)))] = np.arange(len(cls))
    best = np.full(len(cls), len(cls))
    np.minimum.at(best, x, rank[y])
    np.minimum.at(best, y, rank[x])
    some = (best[x] == rank[y]) | (best[y] == rank[x])
    near = np.empty(len(x))
    for k in range(0, len(x), 1 << 15):  # bounded memory
        i, j = x[k : k + (1 << 15)], y[k : k + (1 << 15)]
        near[k : k + (1 << 15)] = np.minimum(points[i], points[j]).sum(axis=1) / (n[i] + n[j])
    row, pair = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
    order = np.lexsort((-near[pair], row))
    row, pair = row[order], pair[order]
    some[pair[NEAREST:][row[NEAREST:] != row[:-NEAREST]]] = True
    some[pair[:NEAREST]] = True
    return some


def _tree_pairs(salt: int):
    """Pairs that the trees leave, of rows sorted by meeting; with a salt, a few for each row."""
    names = ("token", "i", "j", "n", "rest", "cls", "root", "vector")

    def flush(data: dict) -> pa.RecordBatch:
        key = np.stack([data[k] for k in ("token", "i", "j")])
        cuts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        x, y = _leaf_join(cuts, data["n"], data["rest"], data["root"], data["vector"])
        left, right = [data["cls"][x]], [data["cls"][y]]
        for a, b in zip(cuts, [*cuts[1:], key.shape[1]], strict=True):
            if b - a > LEAF:
                cls, n, points = data["cls"][a:b], data["n"][a:b], _points(data["vector"][a:b])
                x, y = _tree_join(n, data["rest"][a:b], data["root"][a:b], points)
                if salt:
                    some = _few_each(x, y, cls, n, points, salt)
                    x, y = x[some], y[some]
                left.append(cls[x])
                right.append(cls[y])
        x, y = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def joined(parts: list[dict]) -> dict:
        return {k: np.concatenate([p[k] for p in parts]) for k in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            last = [part[k][-1] for k in ("token", "i", "j")]
            tail = (part["token"] == last[0]) & (part["i"] == last[1]) & (part["j"] == last[2])
            cut = int(np.argmax(tail))
            if cut:
                yield flush(joined([*held, {k: v[:cut] for k, v in part.items()}]))
                held = [{k: v[cut:] for k, v in part.items()}]
            else:
                held.append(part)
        if held:
            yield flush(joined(held))

    return run


def _fine_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose summed minima in the groups of the one that has fewer allow the overlap, and pairs without such groups."""
    for batch in batches:
        fits = []
        for n, left, right in zip(*(batch.column(k).to_pylist() for k in ("n", "left", "right")), strict=True):
            if left is not None and right is not None:
                groups = min(len(left), len(right))
                x, y = (np.frombuffer(v, np.uint8).reshape(groups, -1).sum(axis=1, dtype=np.int64) for v in (left, right))
                fits.append(bool(np.minimum(x, y).sum() * (NUMBER + OF) >= NUMBER * n))
            else:
                fits.append(True)
        yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))


def _finer(pairs: DataFrame, brief: DataFrame) -> DataFrame:
    """Pairs that the bound of finer counts leaves.

    Of unrelated sets of thousands of shingles ``GROUPS`` counts bound the
    overlap by about what a link needs, so they would nearly all be verified.
    """
    large = brief.where(F.col("fine").isNotNull())
    left = large.select(F.col("cls").alias("a"), F.col("n").alias("_a"), F.col("fine").alias("left"))
    right = large.select(F.col("cls").alias("b"), F.col("n").alias("_b"), F.col("fine").alias("right"))
    sized = pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", (F.col("_a") + F.col("_b")).alias("n"), "left", "right")
    return sized.mapInArrow(_fine_bound, "a long, b long")


def _verified(pairs: DataFrame, own: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose whole sets have the Jaccard.

    Texts are moved and not their sets, which are three times as large: that of
    the member once a pair, that of the leader once for each of its blocks of
    members, so no leader's pairs are in one task.
    """
    turn = _rank(F.col("a")) < _rank(F.col("b"))
    turned = pairs.select(F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"))
    blocks = turned.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("blocks"))
    dealt = turned.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), "blocks").alias("block"))
    leaders = dealt.select(F.lit(None).cast("long").alias("a"), "b", "block").distinct()
    asked = dealt.union(leaders).withColumn("cls", F.coalesce("a", "b"))
    wanted = once(asked.join(classes, "cls").select("a", "b", "block", F.col("first.doc_id").alias("_id"), F.col("first.body").alias("_body")), "wanted")
    # Few enough to send everywhere, or else both sides are shuffled.
    side = F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted
    texts = own.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_body")))
    # The leader's text has no ``a`` and comes first; rows that repeat an id and text are one.
    block = texts.groupBy("b", "block").agg(F.sort_array(F.collect_set(F.struct("a", "text"))).alias("texts"))
    held = block.select("b", F.inline("texts")).mapInArrow(_jaccard, "a long, b long")
    return held.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _rank(cls: Column, part: int | Column = 0) -> Column:
    """The order in which classes become leaders."""
    return F.xxhash64(cls, F.lit(part).cast("long"))


def near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's class and component: rows ``doc_id, body, n, cls, root, component_id`` (runs jobs).

    ``cls`` is the class of documents with the same shingle set, ``n`` its
    size, ``root`` the smallest class of its component, ``body`` a hash of the
    text and ``component_id`` the smallest id reachable by links. Components are
    whole. Links are not counted: two members of a component need not have been
    compared, once other links tie them.

    Null, empty and blank texts have no class and reach only themselves.
    Repeated rows each give a row. Null ids give a null component unless a
    linked document has an id. Ids are whole numbers.
    """
    spark = documents.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shared = spark.sparkContext.broadcast(common_buckets(own, "text"))
    described = once(
        own.withColumn("body", F.xxhash64("text")).mapInArrow(
            _describer(shared, "text", "doc_id"),
            "doc_id long, body long, n long, cls long, prefix array<long>, vector binary, fine binary",
        ),
        "described",
    )
    classes = once(
        described.where(F.col("n") > 0)
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "body")).alias("first"),
        ),
        "classes",
    )
    meetings = once(_meetings(described, parts), "meetings")
    brief = once(_brief(described, meetings), "brief")
    tried = once(_finer(_bounded(_stars(meetings), brief), brief), "stars")
    links = once(_verified(tried, own, classes), "links")
    large = meetings.where(F.col("size") > SMALL)
    salts = range(1, ROUNDS + 1) if large.limit(1).count() else []
    for salt in [*salts, 0]:
        trees = _trees(_opened(large if salt else meetings, components(links)), brief, parts, salt)
        more = once(_finer(trees.distinct().join(tried, ["a", "b"], "left_anti"), brief), "pairs")
        if more.limit(1).count():
            links = once(links.union(_verified(more, own, classes)), "links")
            tried = tried.union(more)
    final = components(links)
    reached = classes.select("cls", "least").join(final.withColumnRenamed("node", "cls"), "cls", "left")
    reached = reached.withColumn("root", F.coalesce("root", "cls"))
    least = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = reached.select("cls", "root").join(least, "root").select("cls", "root", "component_id")
    return described.select("doc_id", "body", "n", "cls").join(by_class, "cls", "left").select(
        "doc_id",
        "body",
        "n",
        "cls",
        "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _meetings(described: DataFrame, parts: int) -> DataFrame:
    """Members of the meetings who may link there: rows ``token, cls, n, rest, size, leader``.

    The smallest member bounds what a member needs of its own set from the
    shingle on; a meeting of two is judged by both. Those who stay are judged
    again by each other. Small meetings get a hash
    of their members for a token, so all that have the same ones are one, where
    ``rest`` is the largest: that at the first shingle which they share.
    """
    meeting = W.partitionBy("token")
    rest, n, low = F.col("rest"), F.col("n"), F.col("low")
    rows = (
        described.select("cls", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("place", "token"))
        .select("cls", "n", "token", (F.col("n") - F.col("place")).alias("rest"))
        .repartition(parts, "token")
        .dropDuplicates(["token", "cls"])
    )
    alone = OF * (NUMBER + OF) * rest >= NUMBER * (OF * n + F.greatest(OF * low, NUMBER * n))
    two = (OF * low >= NUMBER * F.col("high")) & ((NUMBER + OF) * F.col("least") >= NUMBER * (low + F.col("high")))
    fit = rows
    for _ in range(PRUNED):
        fit = fit.withColumns({
            "size": F.count(F.lit(1)).over(meeting),
            "low": F.min("n").over(meeting),
            "high": F.max("n").over(meeting),
            "least": F.min("rest").over(meeting),
        }).where((F.col("size") > 1) & F.when(F.col("size") == 2, two).otherwise(alone)).select("cls", "n", "token", "rest")
    leader = F.struct("cls", "n", (n - rest).alias("place"))
    led = fit.withColumns({
        "size": F.count(F.lit(1)).over(meeting),
        "members": F.bit_xor(F.xxhash64("cls")).over(meeting),
        "leader": F.min_by(leader, _rank(F.col("cls"), F.pmod("token", F.lit(LEADERS)))).over(meeting),
    }).where(F.col("size") > 1)
    token = F.when(F.col("size") <= SMALL, F.col("members")).otherwise(F.col("token"))
    return led.withColumn("token", token).groupBy("token", "cls").agg(
        F.max("n").alias("n"), F.max("rest").alias("rest"), F.max("size").alias("size"), F.min("leader").alias("leader")
    )


def _brief(described: DataFrame, meetings: DataFrame) -> DataFrame:
    """Size and points of the classes in some meeting, so that the joins of pairs and trees move no others."""
    points = described.where(F.col("n") > 0).groupBy("cls").agg(F.first("n").alias("n"), F.first("vector").alias("vector"), F.first("fine").alias("fine"))
    met = once(meetings.select("cls").distinct(), "met")
    # Few enough to send everywhere, or else both sides are shuffled.
    return points.join(F.broadcast(met) if met.count() <= MOST_SENT else met, "cls", "left_semi")


def _trees(members: DataFrame, brief: DataFrame, parts: int, salt: int) -> DataFrame:
    """Pairs that the trees of the members' meetings leave: rows ``a, b``, which may repeat.

    Without a salt all of them: the blocks of a large meeting meet in pairs.
    With one, a few partners for each row within its block.
    """
    blocks = F.ceil(F.col("size") / (THIN_BLOCK if salt else BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("cls", "token", F.lit(salt)) if salt else F.xxhash64("cls"), blocks).cast("int")
    other = F.explode(F.array("block") if salt else F.sequence(F.lit(0), blocks - 1))
    dealt = members.withColumn("block", block).withColumn("other", other)
    blocked = dealt.join(brief.select("cls", "vector"), "cls").select(
        "token", "cls", "root", "n", "rest", "vector", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    return blocked.repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(_tree_pairs(salt), "a long, b long")


def _stars(meetings: DataFrame) -> DataFrame:
    """Each member with its meetings' leaders, where sizes and places allow a link: rows ``a, b``.

    Both prefixes are in one order, so of the shingles that two share the first
    leaves most of either set; a pair that can link shows it there.
    """
    own, other = F.col("n"), F.col("leader.n")
    both = F.least(F.col("rest"), other - F.col("leader.place"))
    fits = (OF * F.least(own, other) >= NUMBER * F.greatest(own, other)) & ((NUMBER + OF) * both >= NUMBER * (own + other))
    pair = meetings.where((F.col("leader.cls") != F.col("cls")) & fits)
    return pair.select(F.least("cls", "leader.cls").alias("a"), F.greatest("cls", "leader.cls").alias("b")).distinct()


def _opened(meetings: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the meetings that are not all in one component, with their roots."""
    rooted = meetings.drop("leader", "size").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    meeting = W.partitionBy("token")
    low, high = F.min("root").over(meeting), F.max("root").over(meeting)
    spread = rooted.withColumns({"low": low, "high": high, "size": F.count(F.lit(1)).over(meeting)})
    return spread.where(F.col("low") != F.col("high")).select("token", "cls", "n", "rest", "size", "root")


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose summed coordinate minima allow the overlap."""
    for batch in batches:
        a, b, n, left, right = (batch.column(k) for k in range(5))
        if not batch.num_rows:
            continue
        low = np.minimum(_points(left.to_pylist()), _points(right.to_pylist())).sum(axis=1, dtype=np.int64)
        fits = pa.array(low * (NUMBER + OF) >= NUMBER * n.to_numpy())
        yield pa.RecordBatch.from_arrays([a.filter(fits), b.filter(fits)], names=["a", "b"])


def _bounded(pairs: DataFrame, brief: DataFrame) -> DataFrame:
    """Pairs that the bound leaves."""
    left = brief.select(F.col("cls").alias("a"), F.col("n").alias("_a"), F.col("vector").alias("left"))
    right = brief.select(F.col("cls").alias("b"), F.col("n").alias("_b"), F.col("vector").alias("right"))
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", (F.col("_a") + F.col("_b")).alias("n"), "left", "right")
    return sized.mapInArrow(_bound, "a long, b long")


def first_of_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group only, that of the smallest id (runs jobs).

    Null ids come last and ties go by a hash of the text; of rows that repeat
    the id and text of the one that stays, one stays. Documents without words
    stay, repeated or not.
    """
    found = once(near_copies(documents, doc_id, text).where(F.col("n") > 0), "grouped")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "body")
    first = found.groupBy("root").agg(F.min(place).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("body") == F.col("first.body"))
    judged = found.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), same.alias("stays"))
    gone = judged.where(~F.col("stays")).select("_id", "_body").distinct()
    repeated = judged.where("stays").groupBy("_id", "_body").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    repeated = once(repeated.select("_id", "_body"), "repeated")
    own = F.col(doc_id).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_body"))
    kept = documents.join(gone, own, "left_anti")
    again = kept.join(repeated, own, "left_semi").dropDuplicates([doc_id, text])
    return kept.join(repeated, own, "left_anti").unionByName(again)
