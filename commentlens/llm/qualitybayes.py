"""Quality by hierarchical empirical Bayes over hosts and paths.

A logistic model of a document's own text gives its evidence. Hosts, and paths
within hosts, get posterior means of the evidence of all their documents: a
path shrinks to its host and a host to the global mean, the more the fewer
documents it has, with prior weights estimated from the spread of the means.
The posterior of a document joins its own evidence with its path's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentlens.llm.shared import SPACE
from commentlens.session import once

TRAIN_ROWS = 5000
STEPS = 60
RIDGE = 1e-2
LIMIT = 0.5
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6
SEED = 11
_EDGE = 1e-4

FEATURES = ("words", "symbols", "upper", "digits", "marks", "bars", "long_words", "common")
# Fixed value: short function words of the languages served.
_COMMON = "(?i)(?<![^\\\\s])(the|of|and|to|in|a|is|der|die|das|und|en|den|de|la|le|les|et|des|que|el|los|y|für|mit|un|une|por)(?![^\\\\s])".replace("\\\\", "\\")


def features(text: F.Column) -> F.Column:
    """Features of a text as an array of numbers; of an empty one if null."""
    whole = F.coalesce(text, F.lit(""))
    letters = F.greatest(F.length(whole), F.lit(1))
    words = F.regexp_count(whole, F.lit(f"[^{SPACE}]+"))
    some = F.greatest(words, F.lit(1))
    share = lambda pattern, of: F.regexp_count(whole, F.lit(pattern)) / of
    return F.array(
        F.log1p(words),
        F.sqrt(share(r"[#$%&*<>]", letters)),
        F.sqrt(share(r"[A-Z]", letters)),
        F.sqrt(share(r"[0-9]", letters)),
        F.sqrt(share(r"!", letters)),
        F.sqrt(share(r"\|", letters)),
        F.sqrt(share(rf"[^{SPACE}]{{20,}}", some)),
        share(_COMMON, some),
    )


def fit(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression by Newton steps; an even coin for no rows."""
    if not len(rows):
        return np.zeros(len(FEATURES)), 0.0
    middle, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    x = np.column_stack([(rows - middle) / spread, np.ones(len(rows))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([*[RIDGE * len(rows)] * len(middle), 1e-3])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    weights = w[:-1] / spread
    return weights, float(w[-1] - weights @ middle)


def sample(described: DataFrame, labels: DataFrame, most: int, doc_id: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``most`` labelled documents at most, chosen by a hash of the id."""
    known = (
        labels.select(F.col(doc_id).cast("string").alias("id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    rate = min(1.0, most / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < rate * float(1 << 30))
    rows = described.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("id", "x", "label").collect()  # about `most` rows
    rows.sort(key=lambda r: r["id"])
    return np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["label"] for r in rows])


def _weight(groups: DataFrame, mean: str) -> float:
    """Prior weight from the means' spread beyond what their documents' own spread explains.

    With variance v within groups and t between them, a group's mean has the
    weight ``v / t``; no spread beyond chance gives the largest weight.
    """
    row = groups.agg(
        F.sum("squares").alias("squares"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("sum") * F.col("sum") / F.col("n")).alias("between"),
        F.sum(F.col("n") * F.pow(F.col("sum") / F.col("n") - F.col(mean), 2)).alias("spread"),
    ).first()
    if not row["n"]:
        return MOST_WEIGHT
    within = max((row["squares"] - row["between"]) / max(row["n"] - row["groups"], 1), 1e-12)
    # On average a group's squared distance times its size is the variance within, plus its size times that between.
    between = (row["spread"] - row["groups"] * within) / row["n"]
    return float(min(MOST_WEIGHT, max(LEAST_WEIGHT, within / between))) if between > 0 else MOST_WEIGHT


def _odds(p: F.Column) -> F.Column:
    inside = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(inside / (1 - inside))


def posteriors(
    documents: DataFrame,
    labels: DataFrame,
    limit: float = LIMIT,
    most: int = TRAIN_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    label: str = "quality",
) -> DataFrame:
    """Rows ``doc_id, host, path, evidence, host_mean, path_mean, posterior, kept`` (runs jobs).

    The sums of hosts and paths combine within tasks before their shuffle, so a
    host with a third of all rows costs one row per task. Null hosts and paths
    are groups of their own, null and empty texts have the features of an
    empty text, repeated rows count and score each for themselves, and an empty
    table gives no rows. Without labels all evidence is even.
    """
    described = once(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(doc_id).cast("string").alias("id"),
            F.col(host).cast("string").alias("host"),
            F.col(path).cast("string").alias("path"),
            features(F.col(text)).alias("x"),
        ),
        "features",
    )
    weights, bias = fit(*sample(described, labels, most, doc_id, label))
    raw = F.lit(bias)
    for k, w in enumerate(weights):
        raw = raw + F.lit(float(w)) * F.element_at("x", k + 1)
    judged = described.select("doc_id", "host", "path", (1 / (1 + F.exp(-raw))).alias("evidence"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("sum"), F.sum(F.pow("evidence", F.lit(2))).alias("squares")]
    paths = once(judged.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).first()
    mean = total["sum"] / total["n"] if total["n"] else 0.5
    host_weight = _weight(hosts.withColumn("mean", F.lit(mean)), "mean")
    host_means = hosts.select(
        F.col("host").alias("_host"), ((F.col("sum") + host_weight * mean) / (F.col("n") + host_weight)).alias("host_mean")
    )
    nested = once(paths.join(host_means, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "nested")
    path_weight = _weight(nested, "host_mean")
    path_means = nested.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "host_mean",
        ((F.col("sum") + path_weight * F.col("host_mean")) / (F.col("n") + path_weight)).alias("path_mean"),
    )
    joined = judged.join(path_means, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    odds = _odds(F.col("evidence")) + _odds(F.col("path_mean")) - _odds(F.lit(mean))
    scored = joined.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return scored.select(
        "doc_id", "host", "path", "evidence", "host_mean", "path_mean", "posterior", (F.col("posterior") >= limit).alias("kept")
    )
