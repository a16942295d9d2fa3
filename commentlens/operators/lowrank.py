"""Leading components of large sparse matrices in long form.

Block Krylov iteration with Rayleigh-Ritz (Musco and Musco 2015): every pass
multiplies a block of directions by the matrix and its transpose and keeps all
blocks, so flat spectra converge in few passes too. The matrix stays a table
``(row, col, w)``, stored once in buckets by row and once by column; a pass is
two joins with sums that read those buckets in place. Only a few numbers per row
or column move; the driver sees matrices as wide as the kept blocks. Several
slices (years) run in the same passes. A run ends when the residuals of the
wanted components are small, and fails if they never are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.session import Buckets, cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

MOST_SLICES = 1000  # the driver holds a few small matrices per slice


def _matrix(cells: pd.Series, width: int) -> np.ndarray:
    return np.vstack(cells.to_numpy()) if len(cells) else np.zeros((0, width))


def _moments(block: DataFrame, kept: int, width: int) -> dict:
    """Per slice: row count, column sums and cross products of ``[k, y]``.

    Each task adds up its rows in NumPy and emits one array per slice; Spark
    adds the arrays position by position.
    """
    total = kept + width

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in batches:
            for s, part in pdf.groupby("_s"):
                x = np.hstack([_matrix(part["k"], kept), _matrix(part["y"], width)])
                flat = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                sums[s] = sums[s] + flat if s in sums else flat
        if sums:
            yield pd.DataFrame({"_s": list(sums), "m": [v.tolist() for v in sums.values()]})

    kind = T.StructType([block.schema["_s"], T.StructField("m", T.ArrayType(T.DoubleType()))])
    parts = block.select("_s", "k", "y").mapInPandas(add_up, kind)
    added = parts.select("_s", F.posexplode("m").alias("i", "v")).groupBy("_s", "i").agg(F.sum("v").alias("v"))
    gathered = added.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("m"))
    out = {}
    for r in gathered.limit(MOST_SLICES + 1).collect():
        flat = np.array([e["v"] for e in r["m"]])
        out[r["_s"]] = (int(flat[0]), flat[1 : 1 + total], flat[1 + total :].reshape(total, total))
    if len(out) > MOST_SLICES:
        raise ValueError(f"more than {MOST_SLICES} slices")
    return out


def _inverse_root(gram: np.ndarray, floor: float, reference: float | None = None) -> np.ndarray:
    """Map that makes columns with this Gram matrix orthonormal; weak directions become zero."""
    if not gram.size:
        return np.zeros((0, 0))
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    top = max(values.max(), 0.0) if reference is None else reference
    good = values > max(top * floor, 1e-300)
    return vectors * np.where(good, 1.0 / np.sqrt(np.where(good, values, 1.0)), 0.0)


def _extend(block: DataFrame, steps: dict, kept: int, width: int) -> DataFrame:
    """Append the next orthonormal directions to every row: ``q = (y - mean - k c) r``."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s, part in pdf.groupby("_s"):
                mean, c, r = steps[s]
                k, y = _matrix(part["k"], kept), _matrix(part["y"], width)
                q = (y - mean - k @ c) @ r
                yield pd.DataFrame(
                    {"_s": part["_s"], "_r": part["_r"], "k": np.hstack([k, q]).tolist(), "q": q.tolist()}
                )

    numbers = T.ArrayType(T.DoubleType())
    kind = T.StructType([block.schema["_s"], block.schema["_r"], T.StructField("k", numbers), T.StructField("q", numbers)])
    return block.select("_s", "_r", "k", "y").mapInPandas(apply, kind)


def _weighted(name: str, width: int):
    sums = [F.sum(F.col("_w") * F.col(name)[j]).alias(f"_{j}") for j in range(width)]
    return sums, F.array(*[F.col(f"_{j}") for j in range(width)])


class NotConverged(RuntimeError):
    """Residuals stayed above the tolerance in all passes."""


def long_cells(entries: DataFrame, row: str, col: str, weight: str, slice_by: str | None = None) -> DataFrame:
    """Non-zero cells as ``_s, _r, _c, _w``."""
    sliced = F.col(slice_by) if slice_by else F.lit(0)
    return entries.select(
        sliced.alias("_s"), F.col(row).alias("_r"), F.col(col).alias("_c"), F.col(weight).cast("double").alias("_w")
    ).where(F.col("_w") != 0)


def one_pass(by_row: DataFrame, by_column: DataFrame, basis: DataFrame, width: int) -> DataFrame:
    """The matrix times its transpose times ``basis`` (``_s, _r, q``): ``_s, _r, y``.

    Both joins meet the cells in the buckets they are stored in.
    """
    sums_q, packed_q = _weighted("q", width)
    across = by_row.join(basis.select("_s", "_r", "q"), ["_s", "_r"]).groupBy("_s", "_c").agg(*sums_q)
    sums_z, packed_y = _weighted("z", width)
    back = by_column.join(across.select("_s", "_c", packed_q.alias("z")), ["_s", "_c"]).groupBy("_s", "_r").agg(*sums_z)
    return back.select("_s", "_r", packed_y.alias("y"))


def components(
    entries: DataFrame,
    row: str,
    col: str,
    weight: str,
    k: int = 2,
    slice_by: str | None = None,
    rows: DataFrame | None = None,
    center: bool = True,
    oversample: int = 8,
    max_passes: int = 12,
    tolerance: float = 1e-6,
    names: str = "PCA_",
) -> tuple[DataFrame, DataFrame]:
    """Scores per row and explained ratios of the leading ``k`` components (runs jobs).

    ``entries`` holds one row per non-zero cell. ``rows`` lists all matrix rows
    when some have no cell. ``center`` gives principal components, otherwise the
    plain singular directions. In each component the score of largest size is
    positive.

    The ratios carry each component's ``residual``: the length of ``A A' u - s² u``
    over the largest ``s²``. Passes go on until all are below ``tolerance`` (the
    error of a ratio is of the order of its square); after ``max_passes``
    :class:`NotConverged` is raised.
    """
    spark = entries.sparkSession
    width = k + oversample
    sliced = F.col(slice_by) if slice_by else F.lit(0)
    cells = cut_lineage(long_cells(entries, row, col, weight, slice_by), "cells")
    listed = cells.select("_s", "_r") if rows is None else rows.select(sliced.alias("_s"), F.col(row).alias("_r"))
    all_rows = cut_lineage(listed.distinct(), "rows")
    zeros = F.array(*[F.lit(0.0)] * width)

    # First block: random signs per column key, taken from the bits of one hash.
    bits = F.xxhash64("_c")
    signs = [
        F.sum(F.col("_w") * (F.shiftrightunsigned(bits, j).bitwiseAND(F.lit(1)) * 2 - 1)).alias(f"_{j}")
        for j in range(width)
    ]
    packed = F.array(*[F.col(f"_{j}") for j in range(width)]).alias("y")
    with Buckets(cells, ["_s", "_r"]) as by_row, Buckets(cells, ["_s", "_c"]) as by_column:
        start = by_row.groupBy("_s", "_r").agg(*signs).select("_s", "_r", packed)
        none = F.array().cast("array<double>").alias("k")
        block = cut_lineage(
            all_rows.join(start, ["_s", "_r"], "left").select("_s", "_r", none, F.coalesce("y", zeros).alias("y")), "block"
        )
        kept = 0
        operator: dict = {}  # per slice: K' A A' K, grown block by block
        fitted: dict = {}
        for step in range(max_passes + 1):
            moments = _moments(block, kept, width)
            steps, worst, spread = {}, 0.0, False
            for s, (n, sums, cross) in moments.items():
                mean = sums[kept:] / n if center else np.zeros(width)
                inner = cross[:kept, :kept]
                towards = cross[:kept, kept:] - (np.outer(sums[:kept], mean) if center else 0.0)
                square = cross[kept:, kept:] - (n * np.outer(mean, mean) if center else 0.0)
                root = _inverse_root(inner, 1e-8)
                inside = root @ (root.T @ towards)
                outside = square - towards.T @ inside  # of what A A' makes of the last block
                if kept:
                    known = operator.get(s, np.zeros((0, 0)))
                    grown = np.zeros((kept, kept))
                    grown[: len(known), : len(known)] = known
                    grown[:, kept - width :] = towards
                    grown[kept - width :, :] = towards.T
                    grown[kept - width :, kept - width :] = (towards[kept - width :] + towards[kept - width :].T) / 2
                    operator[s] = grown
                    values, vectors = np.linalg.eigh(root.T @ grown @ root)
                    order = np.argsort(values)[::-1][:k]
                    ritz = np.clip(values[order], 0.0, None)
                    mixed = root @ vectors[:, order]
                    # A A' maps all blocks but the last into the kept ones, so that block alone leaves a residual.
                    last = mixed[kept - width :]
                    left = np.sqrt(np.clip(np.einsum("ij,ik,kj->j", last, outside, last), 0.0, None))
                    residual = left / max(ritz.max(initial=0.0), 1e-300)
                    worst = max(worst, residual.max(initial=0.0))
                    fitted[s] = (mixed, ritz, n, sums[:kept], residual)
                r = _inverse_root(outside, 1e-9, max(np.trace(square), 0.0))
                spread = spread or bool(np.any(r != 0))
                steps[s] = (mean, inside, r)
            if kept and (worst <= tolerance or not spread):
                break
            if kept and step == max_passes:
                raise NotConverged(f"residual {worst:.1e} after {max_passes} passes; {tolerance:.1e} was asked for")
            if not moments:
                break
            basis = _extend(block, steps, kept, width)
            kept += width
            joined = basis.select("_s", "_r", "k").join(one_pass(by_row, by_column, basis, width), ["_s", "_r"], "left")
            block = cut_lineage(joined.select("_s", "_r", "k", F.coalesce("y", zeros).alias("y")), "block")
        found = _ratios(spark, cells, fitted, k, slice_by)

    return _scores(block, fitted, k, names, row, slice_by), found


def _scores(block: DataFrame, fitted: dict, k: int, names: str, row: str, slice_by: str | None) -> DataFrame:
    maps = {s: vectors * np.sqrt(values) for s, (vectors, values, *_) in fitted.items()}

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s, part in pdf.groupby("_s"):
                placed = np.zeros((len(part), k))
                found = _matrix(part["k"], len(maps[s])) @ maps[s]
                placed[:, : found.shape[1]] = found
                yield pd.DataFrame({"_s": part["_s"], "_r": part["_r"], "p": placed.tolist()})

    kind = T.StructType([block.schema["_s"], block.schema["_r"], T.StructField("p", T.ArrayType(T.DoubleType()))])
    scores = cut_lineage(block.select("_s", "_r", "k").mapInPandas(apply, kind), "scores")
    # One row per slice, so at most MOST_SLICES rows are broadcast.
    flips = scores.groupBy("_s").agg(
        *[F.max_by(F.col("p")[i], F.abs(F.col("p")[i])).alias(f"_f{i}") for i in range(k)]
    )
    signed = [F.when(F.col(f"_f{i}") < 0, -F.col("p")[i]).otherwise(F.col("p")[i]).alias(f"{names}{i + 1}") for i in range(k)]
    head = [F.col("_r").alias(row)] + ([F.col("_s").alias(slice_by)] if slice_by else [])
    return scores.join(F.broadcast(flips), "_s").select(*head, *signed)


def _ratios(spark, cells: DataFrame, fitted: dict, k: int, slice_by: str | None) -> DataFrame:
    """Variance of each score column over the total variance of the matrix columns."""
    totals = (
        cells.groupBy("_s", "_c")
        .agg(F.sum("_w").alias("_cs"), F.sum(F.col("_w") * F.col("_w")).alias("_ss"))
        .groupBy("_s")
        .agg(F.sum("_ss").alias("squares"), F.sum(F.col("_cs") * F.col("_cs")).alias("column_squares"))
    )
    rows = []
    for r in totals.limit(MOST_SLICES).collect():
        vectors, values, n, sums, residual = fitted[r["_s"]]
        variance = r["squares"] - r["column_squares"] / n
        offset = (sums @ vectors) * np.sqrt(values)
        explained = values - offset**2 / n
        rows += [
            (r["_s"], i + 1, float(explained[i] / variance) if variance > 0 else 0.0, float(residual[i]))
            for i in range(min(k, len(explained)))
        ]
    return ratio_frame(spark, rows, cells.schema["_s"].dataType, slice_by)


def ratio_frame(spark, rows: list[tuple], kind: T.DataType, slice_by: str | None) -> DataFrame:
    fields = [T.StructField("_s", kind), T.StructField("component", T.IntegerType())]
    numbers = [T.StructField(name, T.DoubleType()) for name in ("ratio", "residual")]
    ratios = spark.createDataFrame(rows, T.StructType([*fields, *numbers]))
    return ratios.withColumnRenamed("_s", slice_by) if slice_by else ratios.drop("_s")


def dense_components(df: DataFrame, features: str, k: int = 2, names: str = "PCA_") -> DataFrame:
    """Principal components of short dense vectors with MLlib, centred first (runs jobs)."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import vector_to_array

    centred = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df).transform(df)
    placed = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(centred).transform(centred)
    scores = vector_to_array("_pc")
    return placed.select(
        *[c for c in df.columns if c != features], *[scores[i].alias(f"{names}{i + 1}") for i in range(k)]
    )
