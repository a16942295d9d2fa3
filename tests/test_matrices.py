"""Components and discriminants against NumPy on small data."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from pyspark.sql import functions as F

from commentlens.operators import discriminant as ld
from commentlens.operators import gram, lowrank
from commentlens.operators.lowrank import components, dense_components
from commentlens.session import Buckets, cut_lineage


def _cells(spark, matrix):
    n, m = matrix.shape
    rows = [(i, f"c{j}", float(matrix[i, j])) for i in range(n) for j in range(m) if matrix[i, j] != 0]
    return spark.createDataFrame(rows, "r INT, c STRING, w DOUBLE")


def _sorted(df, k, prefix):
    rows = sorted(df.collect(), key=lambda r: r["r"])
    return np.array([[r[f"{prefix}{i + 1}"] for i in range(k)] for r in rows])


def _positive(scores):
    for i in range(scores.shape[1]):
        if scores[np.argmax(np.abs(scores[:, i])), i] < 0:
            scores[:, i] *= -1
    return scores


@pytest.mark.parametrize("shape", [(6, 9), (60, 40)])
def test_components_equal_svd(spark, shape):
    rng = np.random.default_rng(3)
    matrix = rng.random(shape) * (rng.random(shape) < 0.4)
    matrix[:, 0] += np.arange(shape[0]) % 3
    rows = spark.createDataFrame([(i,) for i in range(shape[0])], "r INT")
    scores, ratios = components(_cells(spark, matrix), "r", "c", "w", 2, rows=rows)
    centred = matrix - matrix.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    wanted = _positive(u[:, :2] * s[:2])
    assert np.allclose(_sorted(scores, 2, "PCA_"), wanted, atol=1e-5)
    got = [r["ratio"] for r in ratios.orderBy("component").collect()]
    assert np.allclose(got, (s**2 / (s**2).sum())[:2], atol=1e-8)


def test_uncentred_components(spark):
    rng = np.random.default_rng(5)
    matrix = rng.random((8, 12)) + 0.1
    scores, ratios = components(_cells(spark, matrix), "r", "c", "w", 3, center=False, names="pc")
    u, s, _ = np.linalg.svd(matrix, full_matrices=False)
    wanted = u[:, :3] * s[:3]
    assert np.allclose(_sorted(scores, 3, "pc"), _positive(wanted.copy()), atol=1e-6)
    got = [r["ratio"] for r in ratios.orderBy("component").collect()]
    assert np.allclose(got, wanted.var(axis=0) / matrix.var(axis=0).sum(), atol=1e-8)


def test_slices_are_independent(spark):
    rng = np.random.default_rng(7)
    first, second = rng.random((5, 6)), rng.random((7, 6))
    from pyspark.sql import functions as F

    both = _cells(spark, first).withColumn("y", F.lit(1)).unionByName(_cells(spark, second).withColumn("y", F.lit(2)))
    scores, _ = components(both, "r", "c", "w", 2, slice_by="y")
    for year, matrix in ((1, first), (2, second)):
        u, s, _ = np.linalg.svd(matrix - matrix.mean(axis=0), full_matrices=False)
        assert np.allclose(_sorted(scores.where(F.col("y") == year), 2, "PCA_"), _positive(u[:, :2] * s[:2]), atol=1e-6)


@pytest.mark.parametrize("center", [True, False])
@pytest.mark.parametrize("block", [3, 256])
def test_gram_components_equal_svd(spark, block, center):
    rng = np.random.default_rng(13)
    matrix = rng.random((11, 70)) * (rng.random((11, 70)) < 0.3)
    matrix[:, 0] = 1.0  # a column that every row has
    matrix[4] = 0.0  # a row without cells
    rows = spark.createDataFrame([(i,) for i in range(11)], "r INT")
    scores, ratios = gram.components(_cells(spark, matrix), "r", "c", "w", 3, rows=rows, center=center, block=block)
    u, s, _ = np.linalg.svd(matrix - matrix.mean(axis=0) if center else matrix, full_matrices=False)
    wanted = _positive(u[:, :3] * s[:3])
    assert np.allclose(_sorted(scores, 3, "PCA_"), wanted, atol=1e-10)
    got = [r["ratio"] for r in ratios.orderBy("component").collect()]
    assert np.allclose(got, wanted.var(axis=0) / matrix.var(axis=0).sum(), atol=1e-12)


@pytest.mark.parametrize("block", [3, 256])
def test_cells_alone_in_their_columns_are_not_moved(spark, monkeypatch, block):
    rng = np.random.default_rng(29)
    matrix = rng.random((7, 60)) * (rng.random((7, 60)) < 0.2)
    single = (matrix != 0).sum(axis=0) == 1
    cells = _cells(spark, matrix)
    marks = spark.createDataFrame([(f"c{i}",) for i in np.flatnonzero(single)], "c STRING").withColumn("alone", F.lit(True))
    marked = cells.join(marks, "c", "left")  # no mark counts as false
    moved = []
    products = gram._products
    monkeypatch.setattr(gram, "_products", lambda met, *rest: moved.append(met.count()) or products(met, *rest))
    rows = spark.createDataFrame([(i,) for i in range(7)], "r INT")
    scores, _ = gram.leading_components(marked, "r", "c", "w", 2, alone="alone", rows=rows, block=block)
    u, s, _ = np.linalg.svd(matrix - matrix.mean(axis=0), full_matrices=False)
    assert single.any() and moved == [int((matrix != 0).sum() - single.sum())]
    assert np.allclose(_sorted(scores, 2, "PCA_"), _positive(u[:, :2] * s[:2]), atol=1e-10)


def test_gram_cells_of_slices(spark):
    rng = np.random.default_rng(17)
    parts = {y: rng.integers(0, 4, (n, 25)).astype(float) for y, n in ((1, 5), (2, 9))}
    both = None
    for y, matrix in parts.items():
        cells = _cells(spark, matrix).withColumn("y", F.lit(y))
        both = cells if both is None else both.unionByName(cells)
    both = both.unionByName(both.limit(1).withColumn("w", F.lit(None).cast("double")))
    found = gram.gram_cells(both, "r", "c", "w", slice_by="y", block=2).collect()
    got = {(r["y"], r["row_a"], r["row_b"]): r["product"] for r in found}
    want = {
        (y, a, b): (m @ m.T)[a, b] for y, m in parts.items() for a in range(len(m)) for b in range(a, len(m)) if (m @ m.T)[a, b]
    }
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_gram_of_many_rows_is_refused_and_passes_take_over(spark):
    rng = np.random.default_rng(19)
    matrix = rng.random((30, 12)) + np.outer(np.arange(30), np.arange(12)) / 40
    cells = _cells(spark, matrix)
    with pytest.raises(ValueError, match="at most"):
        gram.gram_cells(cells, "r", "c", "w", most_rows=29)
    by_rows = gram.leading_components(cells, "r", "c", "w", 2)
    by_passes = gram.leading_components(cells, "r", "c", "w", 2, most_rows=29)
    assert np.allclose(_sorted(by_rows[0], 2, "PCA_"), _sorted(by_passes[0], 2, "PCA_"), atol=1e-6)
    first, second = ([r["ratio"] for r in x[1].orderBy("component").collect()] for x in (by_rows, by_passes))
    assert np.allclose(first, second, atol=1e-8)
    assert all(r["residual"] <= 1e-6 for r in by_passes[1].collect())


def test_gram_without_cells(spark):
    none = spark.createDataFrame([], "r INT, c STRING, w DOUBLE")
    for method in (gram.components, components):
        scores, ratios = method(none, "r", "c", "w", 2)
        assert scores.collect() == [] and ratios.collect() == []
    rows = spark.createDataFrame([(1,), (2,)], "r INT")
    scores, _ = gram.components(none, "r", "c", "w", 2, rows=rows)
    assert sorted(tuple(r) for r in scores.collect()) == [(1, 0.0, 0.0), (2, 0.0, 0.0)]


def test_unconverged_passes_fail(spark):
    rng = np.random.default_rng(23)
    cells = _cells(spark, rng.standard_normal((90, 80)))  # a flat spectrum
    with pytest.raises(lowrank.NotConverged, match="residual"):
        components(cells, "r", "c", "w", 2, oversample=1, max_passes=2)
    _, ratios = components(cells, "r", "c", "w", 2, oversample=1, max_passes=60)
    assert all(r["residual"] <= 1e-6 for r in ratios.collect())


def test_a_pass_reads_the_cells_in_place(spark):
    cells = lowrank.long_cells(_cells(spark, np.random.default_rng(29).random((20, 15))), "r", "c", "w")
    basis = cut_lineage(cells.select("_s", "_r").distinct().withColumn("q", F.array(F.lit(1.0), F.lit(2.0))))
    with Buckets(cells, ["_s", "_r"]) as by_row, Buckets(cells, ["_s", "_c"]) as by_column:
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = lowrank.one_pass(by_row, by_column, basis, 2)._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        lines = plan.split("\n")
        scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "_w" in line]
        assert len(scans) == 2 and all("Bucketed: true" in lines[i] for i in scans)
        # from either scan up to its join there is no exchange
        for i in scans:
            above = [line for line in lines[:i]][::-1]
            until = next(n for n, line in enumerate(above) if "Join" in line)
            assert not any("Exchange" in line for line in above[:until])
        assert lowrank.one_pass(by_row, by_column, basis, 2).count() == 20
    assert not [t for t in spark.catalog.listTables() if "buckets" in t.name]


def test_dense_components_are_centred(spark):
    rng = np.random.default_rng(1)
    x = rng.random((30, 4)) + 5
    df = spark.createDataFrame([(i, Vectors.dense(row)) for i, row in enumerate(x)], ["r", "features"])
    got = _positive(_sorted(dense_components(df, "features"), 2, "PCA_"))
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(got, _positive(u[:, :2] * s[:2]), atol=1e-8)


def _labelled(spark, n=120):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        c = i % 3
        x = rng.normal(size=5) + np.array([3 * (c == 0), 3 * (c == 1), 3 * (c == 2), 0, 0])
        rows.append((i, "abc"[c], Vectors.sparse(6, list(range(5)), x.tolist())))
    return spark.createDataFrame(rows, ["id", "label", "features"])


def test_discriminant_separates_classes(spark):
    df = _labelled(spark)
    model = ld.solve(ld.moments(df, "features", "label"))
    assert model.axes.shape == (6, 2)
    placed = ld.project(df, "features", model).toPandas()
    x = np.array([v.toArray() for v in placed["features"]])
    wanted = (x - model.center) @ model.axes
    assert np.allclose(placed[["LD_1", "LD_2"]].to_numpy(), wanted, atol=1e-9)
    # unit pooled within-class variance along each axis, no covariance between them
    pooled = sum(np.cov(wanted[placed["label"] == c].T) * ((placed["label"] == c).sum() - 1) for c in "abc") / (len(x) - 3)
    assert np.allclose(pooled, np.eye(2), atol=1e-6)
    assert ld.accuracy(ld.predict(df, "features", model), "label").first()["accuracy"] > 0.9


def test_split_and_folds(spark):
    df = ld.hash_split(_labelled(spark, 300), "id", 80)
    parts = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
    assert parts["train"] + parts["test"] == 300 and parts["train"] > parts["test"]
    scores = ld.cross_validate(df, "features", "label", ld.fold_moments(df, "features", "label"))
    assert len(scores) == 5 and min(scores) > 0.8


@pytest.mark.parametrize("hashes", [3, 40, 1 << 20])
def test_most_frequent_tokens_are_exact(spark, monkeypatch, hashes):
    """Whatever tokens share a hash; with many hashes, few tokens are counted by name."""
    from collections import Counter

    rng = np.random.default_rng(31)
    lists = [[f"w{int(x)}" for x in rng.zipf(1.3, 60) % 400] for _ in range(50)] + [[], None]
    df = spark.createDataFrame([(t,) for t in lists], "t ARRAY<STRING>")
    monkeypatch.setattr(ld, "HASHES", hashes)
    monkeypatch.setattr(ld, "SPARE", 1)
    total = Counter(w for t in lists for w in t or [])
    rows = Counter(w for t in lists for w in set(t or []))
    for most in (1, 12, 1000):
        want = sorted(total, key=lambda w: (-total[w], w))[:most]
        found = ld.most_frequent(df, "t", most)
        assert [(r["term"], r["total"], r["df"]) for r in found] == [(w, total[w], rows[w]) for w in want]


def test_one_pass_gives_all_folds(spark, monkeypatch):
    df = ld.hash_split(_labelled(spark, 200), "id", 80).withColumn("fold", F.when(F.col("fold") == 3, 2).otherwise(F.col("fold")))
    df = df.unionByName(df.limit(1).withColumn("label", F.lit(None).cast("string")))
    rows = [r for r in df.collect() if r["label"] is not None]
    for held in (ld.MOST_HELD, 700):  # all folds in a pass, then two at a time
        monkeypatch.setattr(ld, "MOST_HELD", held)
        parts = ld.fold_moments(df, "features", "label")
        assert parts[3] is None
        for f in (0, 1, 2, 4):
            x = np.array([r["features"].toArray() for r in rows if r["fold"] == f])
            labels = np.array([r["label"] for r in rows if r["fold"] == f])
            assert np.allclose(parts[f].gram, x.T @ x)
            assert parts[f].counts == {c: int((labels == c).sum()) for c in set(labels)}
            assert all(np.allclose(parts[f].sums[c], x[labels == c].sum(axis=0)) for c in set(labels))
    whole = ld.moments(df, "features", "label")
    assert np.allclose(whole.gram, ld.added(parts).gram)


def test_accuracies_equal_the_sequential_ones(spark):
    df = ld.hash_split(_labelled(spark, 300), "id", 80)
    parts = ld.fold_moments(df, "features", "label")
    one_by_one = []
    for f in range(5):
        others = ld.added([p for g, p in enumerate(parts) if g != f])
        held = ld.predict(df.where(F.col("fold") == f), "features", ld.solve(others))
        one_by_one.append(ld.accuracy(held, "label").first()["accuracy"])
    assert ld.cross_validate(df, "features", "label", parts) == one_by_one


def test_dense_vectors_count_too(spark):
    rows = [(i, "ab"[i % 2], Vectors.dense([i, 1.0, 0.0]) if i % 3 else Vectors.sparse(3, {0: float(i)})) for i in range(9)]
    found = ld.moments(spark.createDataFrame(rows, ["id", "label", "features"]), "features", "label")
    x = np.array([r[2].toArray() for r in rows])
    assert np.allclose(found.gram, x.T @ x) and found.counts == {"a": 5, "b": 4}
    none = spark.createDataFrame(rows, ["id", "label", "features"]).where("id < 0")
    assert ld.moments(none, "features", "label") is None


def test_gram_of_few_rows_groups_no_cells(spark):
    """Few rows are multiplied where a column's cells meet; columns go on over batches, and null ones are one column."""
    rng = np.random.default_rng(8)
    matrix = rng.random((7, 400)) * (rng.random((7, 400)) < 0.5)
    cells = _cells(spark, matrix)
    nulls = spark.createDataFrame([(0, None, 2.0), (1, None, 3.0)], "r INT, c STRING, w DOUBLE")
    both = cells.unionByName(nulls)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = gram.gram_cells(both, "r", "c", "w")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        got = {(r["row_a"], r["row_b"]): r["product"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "collect_list" not in plan
    full = np.hstack([matrix, np.array([[2.0], [3.0], *[[0.0]] * 5])])
    want = full @ full.T
    assert got.keys() == {(a, b) for a in range(7) for b in range(a, 7)}
    assert all(abs(v - want[a, b]) < 1e-9 for (a, b), v in got.items())
