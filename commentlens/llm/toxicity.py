"""Toxicity by averaged subword embeddings under a linear softmax.

A word's vector is the mean of the vectors of its character n-grams and of the
word itself, all hashed to a fixed number of buckets, so a misspelling shares
most of its vector with the word it hides. A window of 25 words has the mean
vector of its distinct words, and a linear softmax over two classes scores it;
a text scores as its worst window, since a few words in a long text are enough.
Vectors and softmax are trained together, in numpy, on a bounded sample of
labelled texts; the trained model is a table of fixed size, and every text is
scored where it lies.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.shared import small_batches

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
DIMENSIONS = 4
WINDOW = 25
SCALE = 10.0
TRAIN_ROWS = 6000
WORD_WINDOWS = 3
WARM_EPOCHS = 3
EPOCHS = 12
BATCH = 200
RATE = 0.02
SEED = 7
FOLDS = 5
KNOWN_WORDS = 400_000
# Fixed value: punctuation that is cut from both ends of a word.
_EDGES = ".,;:!?\"'()[]{}<>|#*$%&~^=+_-/"


def windows(text: str | None) -> list[set[str]]:
    """Distinct lower-cased words of every window of a whole text; one empty window for none."""
    found = [] if text is None else text.lower().split()
    return [set(found[i : i + WINDOW]) for i in range(0, len(found), WINDOW)] or [set()]


def grams(word: str) -> list[str]:
    """A word and its character n-grams, with marks at its ends."""
    marked = f"<{word.strip(_EDGES)}>"
    return [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


@dataclass
class Model:
    """Score of a bucket (its vector on the softmax's axis), and the bias."""

    weights: np.ndarray
    bias: float


class _Grams(dict):
    """Scores of n-grams, kept for a bounded number."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.weights = model.weights.tolist()

    def __missing__(self, gram: str) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[gram] = self.weights[bucket(gram)]
        return value


class Words(dict):
    """Scores of words, the mean of their n-grams', kept for a bounded number."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.grams = _Grams(model)

    def __missing__(self, word: str) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = grams(word)
        value = self[word] = sum(map(self.grams.__getitem__, found)) / len(found)
        return value


def _ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and the list that each is in."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((x for xs in lists for x in xs), np.int64, int(sizes.sum()))
    return flat, np.repeat(np.arange(len(lists)), sizes)


def _sums(values: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(keys, values[:, d], n) for d in range(values.shape[1])], axis=1)


def _spans(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the given rows of a ragged list, and the place of each entry's row among them."""
    n = starts[rows + 1] - starts[rows]
    return np.repeat(starts[rows] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()), np.repeat(np.arange(len(rows)), n)


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Train vectors and softmax together, by Adam over shuffled batches of windows.

    The first ``WARM_EPOCHS`` give every window its text's label; the others
    train each text's worst window of the moment only, which is what scores
    it. Both classes weigh the same. Words of fewer than ``WORD_WINDOWS`` windows are left out of the
    training, and buckets that no other word has score 0. With no rows, or with
    one class only, the model scores that class everywhere.
    """
    ones = sum(labels)
    if not labels or ones in (0, len(labels)):
        return Model(np.zeros(BUCKETS), 0.0 if not labels else (6.0 if ones else -6.0))
    often: Counter = Counter()
    for text in texts:
        for bag in windows(text):
            often.update(bag)
    index = {w: i for i, w in enumerate(sorted(w for w, n in often.items() if n >= WORD_WINDOWS))}
    del often
    lists = _ragged([[bucket(g) for g in grams(w)] for w in index])
    used, slot = np.unique(lists[0], return_inverse=True)
    word_starts = np.searchsorted(lists[1], np.arange(len(index) + 1))
    bags = [np.array(sorted(index[w] for w in bag if w in index), np.int32) for text in texts for bag in windows(text)]
    text_of = np.repeat(np.arange(len(texts)), [max(1, -(-len((t or "").split()) // WINDOW)) for t in texts])
    bag_starts = np.cumsum([0, *map(len, bags)])
    words, bag_of = np.concatenate(bags), np.repeat(np.arange(len(bags)), np.diff(bag_starts))
    width = np.maximum(np.diff(word_starts), 1)[:, None]
    share = SCALE / WINDOW
    random = np.random.default_rng(SEED)
    params = [random.normal(0, 0.1, (len(used), DIMENSIONS)), random.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)]
    vectors, softmax, bias = params
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    y = np.array(labels)[text_of]
    weight = np.where(y == 1, len(labels) / (2 * ones), len(labels) / (2 * (len(labels) - ones)))
    step = 0
    for epoch in range(WARM_EPOCHS + EPOCHS):
        order = random.permutation(len(bags))
        if epoch >= WARM_EPOCHS:
            of_word = np.bincount(lists[1], (vectors @ (softmax[:, 1] - softmax[:, 0]))[slot], len(index)) / width[:, 0]
            scores = np.bincount(bag_of, of_word[words], len(bags))
            by_score = order[np.lexsort((scores[order], text_of[order]))]
            worst = by_score[np.append(np.diff(text_of[by_score]) != 0, True)]
            order = random.permutation(worst)
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            at, own = _spans(bag_starts, rows)
            kinds, kind = np.unique(words[at], return_inverse=True)
            entries, owner = _spans(word_starts, kinds)
            held = slot[entries]
            word_vectors = _sums(vectors[held], owner, len(kinds)) / width[kinds]
            hidden = _sums(word_vectors[kind] * share, own, len(rows))
            logits = hidden @ softmax + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), y[rows]] -= 1
            error *= weight[rows][:, None] / len(rows)
            word_back = _sums((error @ softmax.T)[own] * share, kind, len(kinds)) / width[kinds]
            grads = [_sums(word_back[owner], held, len(used)), hidden.T @ error, error.sum(axis=0)]
            step += 1
            rate = RATE * (1 - epoch / (WARM_EPOCHS + EPOCHS)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for param, grad, (first, second) in zip(params, grads, moments, strict=True):
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                param -= rate * first / (np.sqrt(second) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = vectors @ (softmax[:, 1] - softmax[:, 0]) * share
    return Model(weights, float(bias[1] - bias[0]))


def training_rows(
    documents: DataFrame,
    labels: DataFrame,
    most: int = TRAIN_ROWS,
    folds: int = FOLDS,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> tuple[list[str | None], list[int]]:
    """Texts and labels of about ``most`` rows at most, half of each class if it has so many.

    Rows of fold 0 are never read. A document labelled more than once is toxic
    if any label says so; null labels and ids are left out. The sample is by a
    hash of the id: each class is thinned at a rate from its count, so what
    reaches the driver is bounded whatever the tables hold.
    """
    known = (
        labels.select(F.col(doc_id).cast("long").alias("labelled"), F.col(label).cast("int").alias("label"))
        .where(F.col("labelled").isNotNull() & F.col("label").isNotNull() & (fold("labelled", folds) != 0))
        .groupBy("labelled")
        .agg(F.max("label").alias("label"))
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {k: min(1.0, most / 2 / totals.get(k, 1)) for k in (0, 1)}
    place = F.pmod(F.xxhash64(F.lit(SEED), "labelled"), F.lit(1 << 30))
    rate = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    chosen = known.where(place < rate * float(1 << 30))
    rows = (
        documents.select(F.col(doc_id).cast("long").alias("labelled"), F.col(text).alias("body"))
        .join(F.broadcast(chosen), "labelled")  # about `most` rows by construction
        .dropDuplicates(["labelled"])
        .collect()
    )
    rows = sorted(rows, key=lambda r: r["labelled"])
    return [r["body"] for r in rows], [r["label"] for r in rows]


def fold(doc_id: str, folds: int = FOLDS) -> F.Column:
    """Remainder of the CRC-32 of the id as text; a null id is in fold 1, so it isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(1))


def _scorer(shared, text: str, out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        known = Words(model)
        for batch in batches:
            scores = []
            for value in batch.column(text).to_pylist():
                worst = max(sum(map(known.__getitem__, bag)) for bag in windows(value)) + model.bias
                scores.append(1 / (1 + math.exp(-min(max(worst, -30.0), 30.0))))
            columns = {name: batch.column(name) for name in batch.schema.names} | {"toxicity": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in out], names=out)

    return run


def scored(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", keep_text: bool = True, **training
) -> DataFrame:
    """The documents with ``toxicity`` added, the probability of label 1 (fits the model: runs jobs).

    Null and empty texts get the score of the bias. Repeated rows get equal
    scores; a text of any length is read whole. ``keep_text`` tells whether the
    text column stays.
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = training_rows(documents, labels, doc_id=doc_id, text=text, label=label, **training)
    model = fit(*rows)
    shared = spark.sparkContext.broadcast((model.weights, model.bias))
    frame = documents.withColumn("toxicity", F.lit(0.0))
    out = frame if keep_text else frame.drop(text)
    return frame.mapInArrow(_scorer(shared, text, out.columns), out.schema)


def remove_toxic(
    documents: DataFrame, labels: DataFrame, limit: float = 0.5, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents that score below ``limit``, whatever their other columns are called.

    Rows travel whole beside their text, so a column named ``toxicity`` stays as it is.
    """
    packed = documents.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return scored(packed, labels, keep_text=False, **options).where(F.col("toxicity") < limit).select("row.*")
