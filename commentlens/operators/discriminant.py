"""Linear discriminant projection and classification of labelled token lists.

Features are capped, so everything the driver solves is bounded by the cap.
Spark does the passes over the data: term statistics, one sparse vector per
document (JVM transformers), and one pass that gives the sufficient statistics of
all folds and classes. A training set's statistics are the total less its fold.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.functions.text import one_per_row
from commentlens.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

HASHES = 1 << 20  # by which tokens are added up before they are counted
SPARE = 4  # hashes counted for each token that is wanted
MOST_FEATURES = 4096  # a Gram matrix of this width is 128 MB
MOST_CLASSES = 256
MOST_HELD = 512 << 20  # bytes of Gram matrices that a task, or the driver, holds at once
ROWS = 512  # made dense at a time
BLOCK = 64  # lines of a Gram matrix that travel together


def _marks(tokens: Column, hit: int, doc: int) -> Column:
    return F.transform(tokens, lambda t: F.struct(t.alias("term"), F.lit(hit).alias("hit"), F.lit(doc).alias("doc")))


def most_frequent(df: DataFrame, tokens: str, most: int) -> list:
    """The ``most`` tokens of highest ``total``, ties by name, and the number ``df`` of rows that have them (runs jobs).

    Exact, but not all tokens are moved: tokens are first added up by a hash, and no
    token has a higher total than its hash. So those of the highest hashes are
    counted, and if the last one chosen is not above all other hashes, those of all hashes
    from its total on.
    """

    def hashed(token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(HASHES)).cast("int")

    found = one_per_row(df, F.transform(tokens, hashed), [], "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    sums = cut_lineage(found, "hashes")
    least = sums.orderBy(F.desc("n")).limit(SPARE * most).agg(F.min("n")).first()[0] or 0
    # Each token counts for the total, each distinct token of a row for the
    # document frequency: one shuffle keyed by term, reduced map-side.
    marked = F.transform(F.array(F.col(tokens)), lambda t: F.concat(_marks(t, 1, 0), _marks(F.array_distinct(t), 0, 1)))[0]
    flat = one_per_row(df, marked, [], "m").select("m.*").withColumn("h", hashed(F.col("term")))
    while True:
        kept = F.broadcast(sums.where(F.col("n") >= least).select("h"))  # HASHES rows at most
        stats = flat.join(kept, "h", "left_semi").groupBy("term").agg(F.sum("hit").alias("total"), F.sum("doc").alias("df"))
        chosen = stats.orderBy(F.desc("total"), F.asc("term")).limit(most).collect()
        reached = chosen[-1]["total"] if len(chosen) == most else 0
        if least <= max(reached, 1):
            return chosen
        least = reached


def vectorise(df: DataFrame, tokens: str, max_features: int = 2000, passes: int = 2, out: str = "features") -> DataFrame:
    """Add a sparse, smoothed TF-IDF vector of the most frequent tokens (runs jobs)."""
    if max_features > MOST_FEATURES:
        raise ValueError(f"max_features is bounded by {MOST_FEATURES}")
    chosen = most_frequent(df, tokens, max_features)
    chosen.sort(key=lambda r: r["term"])
    docs = df.count()
    idf = [(np.log((1 + docs) / (1 + r["df"])) + 1) ** passes for r in chosen]
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in chosen], tokens, "_counts").transform(df)
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_weighted").transform(counts)
    return Normalizer(p=2.0, inputCol="_weighted", outputCol=out).transform(weighted).drop("_counts", "_weighted")


@dataclass
class Moments:
    """Sufficient statistics of a labelled vector set."""

    gram: np.ndarray
    sums: dict
    counts: dict

    def __add__(self, other: "Moments") -> "Moments":
        labels = set(self.sums) | set(other.sums)
        zero = np.zeros(self.gram.shape[0])
        return Moments(
            self.gram + other.gram,
            {c: self.sums.get(c, zero) + other.sums.get(c, zero) for c in labels},
            {c: self.counts.get(c, 0) + other.counts.get(c, 0) for c in labels},
        )


    def __sub__(self, other: "Moments") -> "Moments":
        """Moments of the rows that are not in ``other``, a part of these."""
        counts = {c: n - other.counts.get(c, 0) for c, n in self.counts.items()}
        zero = np.zeros(self.gram.shape[0])
        kept = [c for c, n in counts.items() if n > 0]
        return Moments(
            self.gram - other.gram, {c: self.sums[c] - other.sums.get(c, zero) for c in kept}, {c: counts[c] for c in kept}
        )


def moments_by(df: DataFrame, features: str, label: str, group: Column, groups: list) -> dict:
    """Gram matrix, class sums and class sizes of each of the listed groups of a vector column; empty ones are left out.

    One pass over the rows (a job): every task adds up its rows in NumPy, for
    all groups at once, and passes on the lines of the matrices from the
    diagonal on, which Spark adds line by line. There are no more tasks than
    cores. Very wide matrices of many groups take a pass for as many groups as a
    task can hold. Rows without a label or vector count nowhere.
    """
    parts = F.unwrap_udt(F.col(features))
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        group.cast("int").alias("g"), F.col(label).alias("c"), parts["indices"].alias("i"), parts["values"].alias("v"), parts["size"].alias("n")
    )
    first = rows.select(F.coalesce("n", F.size("v")).alias("n")).first()
    if first is None:
        return {}
    width = first["n"]
    if width > MOST_FEATURES:
        raise ValueError(f"vectors are wider than {MOST_FEATURES}")
    at_once = max(MOST_HELD // (8 * width * width), 1)
    found: dict = {}
    for k in range(0, len(groups), at_once):
        found |= _one_pass(rows.where(F.col("g").isin(groups[k : k + at_once])), width)
    return found


def _one_pass(rows: DataFrame, width: int) -> dict:
    spark = rows.sparkSession
    numbers = T.ArrayType(T.DoubleType())
    fields = [T.StructField("g", T.IntegerType()), rows.schema["c"], T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType())]
    kinds = [pa.int32(), _arrow(rows.schema["c"].dataType), pa.int32(), pa.int64()]

    def lines(g, c, first: int, n: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
        count = len(arrays)
        heads = [[g] * count, [c] * count, list(range(first, first + count)), [n] * count]
        offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        x = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
        return pa.RecordBatch.from_arrays([*[pa.array(h, k) for h, k in zip(heads, kinds)], x], ["g", "c", "k", "n", "x"])

    def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict = {}
        sums: dict = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                x = _dense(some, width)
                group, label = some.column(0).to_pylist(), some.column(1).to_pylist()
                members: dict = {}
                for row, key in enumerate(zip(group, label)):
                    members.setdefault(key, []).append(row)
                for key, own in members.items():
                    total, n = sums.get(key, (0.0, 0))
                    sums[key] = (total + x[own].sum(axis=0), n + len(own))
                for g in set(group):
                    own = [r for r, other in enumerate(group) if other == g]
                    product = x[own].T @ x[own]
                    grams[g] = grams[g] + product if g in grams else product
        if len(sums) > len(grams) * MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes")
        for (g, c), (total, n) in sums.items():
            yield lines(g, c, -1, n, [total])
        for g, gram in grams.items():
            for at in range(0, width, BLOCK):
                yield lines(g, None, at, 0, [gram[i, i:] for i in range(at, min(at + BLOCK, width))])

    partial = rows.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(add_rows, T.StructType([*fields, T.StructField("x", numbers)]))
    line = vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("x")
    added_up = cut_lineage(partial.groupBy("g", "c", "k").agg(F.sum("n").alias("n"), line), "moments")
    out: dict = {}
    for r in added_up.where("k < 0").limit(MOST_CLASSES * 1024).collect():
        own = out.setdefault(r["g"], Moments(np.zeros((width, width)), {}, {}))
        own.sums[r["c"]], own.counts[r["c"]] = np.array(r["x"]), r["n"]
    if any(len(m.sums) > MOST_CLASSES for m in out.values()):
        raise ValueError(f"more than {MOST_CLASSES} classes")
    for g, own in out.items():  # one matrix at a time reaches the driver
        table = added_up.where((F.col("g") == g) & (F.col("k") >= 0)).select("k", "x").toArrow()
        for k, x in zip(table.column("k").to_pylist(), table.column("x")):
            own.gram[k, k:] = own.gram[k:, k] = x.values.to_numpy()
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _dense(batch: pa.RecordBatch, width: int) -> np.ndarray:
    x = np.zeros((batch.num_rows, width))
    indices, values = batch.column(2), batch.column(3)
    if indices.null_count:
        for row, (i, v) in enumerate(zip(indices.to_pylist(), values.to_pylist())):
            x[row, slice(None) if i is None else i] = v
        return x
    counts = np.diff(indices.offsets.to_numpy())
    x[np.repeat(np.arange(batch.num_rows), counts), indices.flatten().to_numpy()] = values.flatten().to_numpy()
    return x


def moments(df: DataFrame, features: str, label: str) -> Moments | None:
    """Gram matrix, class sums and class sizes of a vector column (runs a job)."""
    return moments_by(df, features, label, F.lit(0), [0]).get(0)


@dataclass
class Discriminant:
    labels: list
    center: np.ndarray
    axes: np.ndarray  # features x components
    coef: np.ndarray  # classes x features
    intercept: np.ndarray


def solve(m: Moments, tol: float = 1e-4) -> Discriminant:
    """Discriminant axes from the moments: whiten within classes, then rotate to the class means."""
    labels = sorted(m.sums)
    sizes = np.array([m.counts[c] for c in labels], dtype=float)
    n, classes = sizes.sum(), len(labels)
    means = np.array([m.sums[c] for c in labels]) / sizes[:, None]
    priors = sizes / n
    center = priors @ means
    within = m.gram - (means.T * sizes) @ means
    std = np.sqrt(np.clip(np.diag(within), 0.0, None) / n)
    std[std < 1e-12] = 1.0
    scale = 1.0 / (n - classes)
    values, vectors = np.linalg.eigh(within / np.outer(std, std) * scale)
    singular = np.sqrt(np.clip(values, 0.0, None))
    good = singular > tol
    whiten = vectors[:, good] / std[:, None] / singular[good]
    spread = np.sqrt(n * priors * scale)[:, None] * ((means - center) @ whiten)
    _, strength, directions = np.linalg.svd(spread, full_matrices=False)
    rank = int(np.sum(strength > tol * strength[0])) if strength.size and strength[0] > 0 else 0
    axes = whiten @ directions.T[:, :rank]
    top = np.argmax(np.abs(axes), axis=0) if rank else []
    axes = axes * np.array([1.0 if axes[t, j] >= 0 else -1.0 for j, t in enumerate(top)]) if rank else axes
    placed = (means - center) @ axes
    coef = placed @ axes.T
    intercept = -0.5 * (placed**2).sum(axis=1) + np.log(priors) - coef @ center
    return Discriminant(labels, center, axes, coef, intercept)


def _dot(features: str, weights: np.ndarray) -> Column:
    """Inner product of a sparse vector column with fixed weights, inside the JVM."""
    parts = F.unwrap_udt(F.col(features))
    table = F.lit(np.asarray(weights, dtype=float))
    products = F.zip_with(parts["indices"], parts["values"], lambda i, v: v * F.element_at(table, i + 1))
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def project(df: DataFrame, features: str, model: Discriminant, k: int = 2, names: str = "LD_") -> DataFrame:
    """Add the first ``k`` discriminant coordinates; missing ones are zero."""
    out = df
    for i in range(k):
        if i < model.axes.shape[1]:
            value = _dot(features, model.axes[:, i]) - F.lit(float(model.center @ model.axes[:, i]))
        else:
            value = F.lit(0.0)
        out = out.withColumn(f"{names}{i + 1}", value)
    return out


def predicted_class(features: str, model: Discriminant) -> Column:
    """The class of highest linear score (nearest mean with priors)."""
    scored = [
        F.struct((_dot(features, w) + F.lit(float(b))).alias("score"), F.lit(c).alias("label"))
        for c, w, b in zip(model.labels, model.coef, model.intercept)
    ]
    return F.array_max(F.array(*scored))["label"]


def predict(df: DataFrame, features: str, model: Discriminant, name: str = "predicted") -> DataFrame:
    """Add the class of highest linear score."""
    return df.withColumn(name, predicted_class(features, model))


def accuracy(df: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """Share of right predictions, one row."""
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def hash_split(df: DataFrame, key: str, train_percent: int = 20, folds: int = 5, seed: int = 42) -> DataFrame:
    """Label every row ``train`` or ``test`` and give it a fold, by a hash of its key."""
    percent = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    fold = F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(folds)).cast("int")
    return df.withColumn("part", F.when(percent < train_percent, "train").otherwise("test")).withColumn("fold", fold)


def fold_moments(df: DataFrame, features: str, label: str, folds: int = 5) -> list:
    """Moments of each fold, None for empty ones, in one pass (runs a job)."""
    found = moments_by(df, features, label, F.col("fold"), list(range(folds)))
    return [found.get(f) for f in range(folds)]


def added(parts: list) -> Moments:
    """Moments of the union of some parts; empty parts are None."""
    present = [p for p in parts if p is not None]
    total = present[0]
    for p in present[1:]:
        total = total + p
    return total


def fold_models(parts: list) -> dict:
    """For each fold that has rows, the discriminant of all the others: their total less the fold."""
    present = {f: p for f, p in enumerate(parts) if p is not None}
    if len(present) < 2:
        return {}
    total = added(list(present.values()))
    trained = {f: total - own for f, own in present.items()}
    return {f: solve(m) for f, m in trained.items() if len(m.sums) > 1}


def held_out_accuracies(df: DataFrame, features: str, label: str, models: dict, group: Column) -> dict:
    """Share of right predictions of each group by its own model, all in one pass (runs a job)."""
    right = F.lit(None).cast("boolean")
    for g, model in models.items():
        right = F.when(group == g, F.col(label) == predicted_class(features, model)).otherwise(right)
    if not models:
        return {}
    per = df.where(group.isin(list(models))).groupBy(group.alias("g")).agg(F.avg(right.cast("double")).alias("accuracy"))
    return {r["g"]: r["accuracy"] for r in per.collect()}


def cross_validate(df: DataFrame, features: str, label: str, parts: list) -> list[float]:
    """Accuracy on each held-out fold, fitted on the moments of the others (runs a job)."""
    found = held_out_accuracies(df, features, label, fold_models(parts), F.col("fold"))
    return [found[f] for f in sorted(found)]
