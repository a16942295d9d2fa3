"""Components of matrices with few rows and many columns, from the products of their rows.

With n rows the products of all pairs of rows (the Gram matrix) are at most n²
numbers, however many columns there are. While all rows make one block, the cells
of a column are sorted together and multiplied as they are. Else columns are grouped into vectors over
blocks of rows, and every pair of blocks that share a column is multiplied and
summed in NumPy, a few thousand columns at a time. A common column meets as
many block pairs as there are, and a vector never exceeds a block. Only row x row
cells leave this step; the driver centres them and solves the small eigenproblem.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.operators import lowrank
from commentlens.session import cut_lineage, once

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

MOST_ROWS = 4000  # of a slice; its products are 128 MB then
MOST_CELLS = 32_000_000  # of all slices together
BLOCK = 256
COLUMNS = 2048  # multiplied at a time
HELD = 32  # block products that a task holds before it passes them on


def row_codes(rows: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """Distinct rows ``_s, _r`` with a number ``_code`` from 0 in each slice (runs a job).

    A slice of more than ``most_rows`` rows is refused, so the numbering sorts
    no more than that many rows at once.
    """
    listed = cut_lineage(rows.select("_s", "_r").distinct(), "rows")
    sizes = listed.groupBy("_s").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(lowrank.MOST_SLICES + 1).collect()
    if len(sizes) > lowrank.MOST_SLICES:
        raise ValueError(f"more than {lowrank.MOST_SLICES} slices")
    if sizes and sizes[0]["n"] > most_rows:
        raise ValueError(f"{sizes[0]['n']} rows; products of rows are for {most_rows} at most")
    if sum(r["n"] ** 2 for r in sizes) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} products of rows in all slices")
    return listed.withColumn("_code", F.row_number().over(W.partitionBy("_s").orderBy("_r")) - 1)


def _products(cells: DataFrame, codes: DataFrame, block: int) -> DataFrame:
    """Sums of products ``_s, a, b, g`` of row numbers a <= b over all columns of ``cells`` (``_s, _r, _c, _w``)."""
    spark = cells.sparkSession
    width = (codes.agg(F.max("_code")).first()[0] or 0) + 1
    coded = cells.join(F.broadcast(codes), ["_s", "_r"])  # the numbers of rows were checked
    if width <= block:
        return _narrow_products(coded, width)
    item = F.struct((F.col("_code") % block).cast("int").alias("i"), F.col("_w").alias("w"))
    by_block = (
        coded
        .groupBy("_s", "_c", F.floor(F.col("_code") / block).cast("int").alias("k"))
        .agg(F.collect_list(item).alias("x"))
    )
    # A column's vectors are bounded by the number of rows, which was checked.
    vectors = by_block.groupBy("_s", "_c").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v"))
    pairs = F.flatten(
        F.transform("v", lambda x, n: F.transform(F.slice("v", n + 1, F.size("v")), lambda y: F.struct(x.alias("x"), y.alias("y"))))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Few block pairs are dealt to many tasks by a hash of the column.
    salted = vectors.select("_s", F.pmod(F.xxhash64("_c"), F.lit(parts)).alias("salt"), F.explode(pairs).alias("p"))
    met = salted.select(
        "_s", F.col("p.x.k").alias("a"), F.col("p.y.k").alias("b"), F.col("p.x.x").alias("x"), F.col("p.y.x").alias("y"), "salt"
    ).repartition(parts, "_s", "a", "b", "salt")
    slice_type = cells.schema["_s"].dataType

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for start in range(0, batch.num_rows, COLUMNS):
                _multiply(batch.slice(start, COLUMNS), block, held)
                if len(held) > HELD:
                    yield from _cells(held, block, kind)
                    held.clear()
        if held:
            yield from _cells(held, block, kind)

    schema = T.StructType(
        [T.StructField("_s", slice_type), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("g", T.DoubleType())]
    )
    kind = _arrow(slice_type)
    partial = met.select("_s", "a", "b", "x", "y").mapInArrow(add_up, schema)
    return partial.groupBy("_s", "a", "b").agg(F.sum("g").alias("g"))


def _narrow_products(coded: DataFrame, width: int) -> DataFrame:
    """The same when all rows of a slice are one block, as wide as there are rows.

    A column's cells are brought together by a shuffle and a sort, and multiplied
    where they are.
    """
    spark = coded.sparkSession
    slice_type = coded.schema["_s"].dataType
    kind = _arrow(slice_type)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.select("_s", "_c", "_code", "_w").repartition(parts, "_s", "_c").sortWithinPartitions("_s", "_c")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        last = None  # cells of the last column, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            now = batch.columns if last is None else [pa.concat_arrays(pair) for pair in zip(last, batch.columns)]
            cut = int(np.flatnonzero(_starts(now[:2]))[-1])
            last = [c.slice(cut) for c in now]
            _multiply_columns([c.slice(0, cut) for c in now], width, held)
            if len(held) * width * width > HELD * BLOCK * BLOCK:
                yield from _cells(held, width, kind)
                held.clear()
        if last is not None:
            _multiply_columns(last, width, held)
        if held:
            yield from _cells(held, width, kind)

    schema = T.StructType(
        [T.StructField("_s", slice_type), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("g", T.DoubleType())]
    )
    return dealt.mapInArrow(add_up, schema).groupBy("_s", "a", "b").agg(F.sum("g").alias("g"))


def _starts(keys: list[pa.Array]) -> np.ndarray:
    """Where the keys of sorted rows change; missing ones are alike."""
    new = np.ones(len(keys[0]), bool)
    same = np.ones(max(len(new) - 1, 0), bool)
    for key in keys:
        x, y = key.slice(0, len(same)), key.slice(1)
        alike = pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y)))
        same &= alike.to_numpy(zero_copy_only=False)
    new[1:] = ~same
    return new


def _multiply_columns(cells: list[pa.Array], width: int, held: dict) -> None:
    """Add the products of sorted cells ``_s, _c, _code, _w``, whole columns, to ``held``, a matrix per slice."""
    if not len(cells[0]):
        return
    code, weight = (c.to_numpy(zero_copy_only=False) for c in cells[2:])
    cuts = [*np.flatnonzero(_starts(cells[:1])), len(code)]
    column = np.cumsum(_starts(cells[:2])) - 1
    for a, b in zip(cuts, cuts[1:]):
        for k in range(column[a], column[b - 1] + 1, COLUMNS):
            at = slice(a + np.searchsorted(column[a:b], k), a + np.searchsorted(column[a:b], k + COLUMNS))
            here = column[at] - k
            x = np.bincount(here * width + code[at], weight[at], (here[-1] + 1) * width).reshape(-1, width)
            key = (cells[0][int(a)].as_py(), 0, 0)
            found = x.T @ x
            held[key] = held[key] + found if key in held else found


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _multiply(batch: pa.RecordBatch, block: int, held: dict) -> None:
    """Add the products of one batch's vectors to ``held``, a block x block matrix per slice and pair."""
    slices, a, b = (batch.column(i).to_pylist() for i in range(3))
    groups: dict = {}
    for row, key in enumerate(zip(slices, a, b)):
        groups.setdefault(key, []).append(row)
    sides = [_dense(batch.column(i), batch.num_rows, block) for i in (3, 4)]
    for key, rows in groups.items():
        found = sides[0][rows].T @ sides[1][rows]
        held[key] = held[key] + found if key in held else found


def _dense(column: pa.Array, rows: int, block: int) -> np.ndarray:
    out = np.zeros((rows, block))
    items = column.flatten()
    counts = np.diff(column.offsets.to_numpy())
    np.add.at(out, (np.repeat(np.arange(rows), counts), items.field(0).to_numpy()), items.field(1).to_numpy())
    return out


def _cells(held: dict, block: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for (s, a, b), matrix in held.items():
        if a == b:
            matrix = np.triu(matrix)
        i, j = np.nonzero(matrix)
        if len(i):
            columns = [pa.array([s] * len(i), kind), pa.array((a * block + i).astype(np.int32)), pa.array((b * block + j).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(matrix[i, j])], ["_s", "a", "b", "g"])


def gram_cells(
    entries: DataFrame, row: str, col: str, weight: str, slice_by: str | None = None, most_rows: int = MOST_ROWS, block: int = BLOCK
) -> DataFrame:
    """Products of all pairs of rows that share a column: ``row_a, row_b, product`` with ``row_a <= row_b`` (runs jobs).

    ``entries`` has a row per non-zero cell; null weights count as none.
    """
    cells = lowrank.long_cells(once(entries, "entries"), row, col, weight, slice_by)
    codes = cut_lineage(row_codes(cells, most_rows), "codes")
    found = _products(cells, codes, block)
    first = codes.select("_s", F.col("_code").alias("a"), F.col("_r").alias("row_a"))
    second = codes.select("_s", F.col("_code").alias("b"), F.col("_r").alias("row_b"))
    named = found.join(first, ["_s", "a"]).join(second, ["_s", "b"])
    head = [F.col("_s").alias(slice_by)] if slice_by else []
    return named.select(*head, "row_a", "row_b", F.col("g").alias("product"))


def centred(gram: np.ndarray) -> np.ndarray:
    """Products of the rows less their column means: every row's and column's mean is taken out, and the total put back."""
    mean = gram.mean(axis=0)
    return gram - mean[:, None] - mean[None, :] + mean.mean()


def solve(gram: np.ndarray, k: int, center: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Scores and explained ratios of the leading ``k`` components, from the products of all rows.

    A ratio is the variance of a score column over the total variance of the
    matrix columns. In each component the score of largest size is positive.
    """
    middle = centred(gram)
    values, vectors = np.linalg.eigh(middle if center else gram)
    order = np.argsort(values)[::-1][:k]
    kept = np.where(values[order] > max(values.max(initial=0.0), 0.0) * 1e-13, values[order], 0.0)
    scores = np.zeros((len(gram), k))
    scores[:, : len(order)] = vectors[:, order] * np.sqrt(kept)
    top = np.argmax(np.abs(scores), axis=0) if len(gram) else []
    scores *= np.array([-1.0 if len(gram) and scores[t, j] < 0 else 1.0 for j, t in enumerate(top)]) if len(gram) else 1.0
    variance = np.trace(middle)
    explained = (scores**2).sum(axis=0) - (scores.sum(axis=0) ** 2) / max(len(gram), 1)
    ratios = explained / variance if variance > 0 else np.zeros(k)
    return scores, ratios[: len(order)]


def components(
    entries: DataFrame,
    row: str,
    col: str,
    weight: str,
    k: int = 2,
    slice_by: str | None = None,
    rows: DataFrame | None = None,
    center: bool = True,
    names: str = "PCA_",
    most_rows: int = MOST_ROWS,
    block: int = BLOCK,
    alone: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scores per row and explained ratios of the leading ``k`` components (runs jobs).

    The same results as :func:`commentlens.operators.lowrank.components`, exact
    and in one pass, for at most ``most_rows`` rows a slice. The driver holds
    the products of one slice's rows at a time. ``alone`` names a column that is
    true for cells known to be the only ones of their columns: they are squared
    where they are, and only the others are brought together by columns.
    """
    spark = entries.sparkSession
    entries = once(entries, "entries")
    cells = lowrank.long_cells(entries, row, col, weight, slice_by)
    sliced = F.col(slice_by) if slice_by else F.lit(0)
    listed = cells if rows is None else rows.select(sliced.alias("_s"), F.col(row).alias("_r")).unionByName(cells.select("_s", "_r"))
    codes = cut_lineage(row_codes(listed, most_rows), "codes")
    if alone is None:
        products = _products(cells, codes, block)
    else:
        single = F.coalesce(F.col(alone), F.lit(False))
        met, own = (lowrank.long_cells(entries.where(part), row, col, weight, slice_by) for part in (~single, single))
        squares = own.groupBy("_s", "_r").agg(F.sum(F.col("_w") * F.col("_w")).alias("g")).join(codes, ["_s", "_r"])
        squares = squares.select("_s", F.col("_code").alias("a"), F.col("_code").alias("b"), "g")
        both = _products(met, codes, block).unionByName(squares)
        products = both.groupBy("_s", "a", "b").agg(F.sum("g").alias("g"))
    stored = cut_lineage(products, "gram")
    placed, ratios = [], []
    for s, n in [(r["_s"], r["n"]) for r in codes.groupBy("_s").agg(F.count(F.lit(1)).alias("n")).orderBy("_s").collect()]:
        part = stored.where(F.col("_s").eqNullSafe(F.lit(s))).select("a", "b", "g").toPandas()
        gram = np.zeros((n, n))
        gram[part["a"], part["b"]] = part["g"]
        gram[part["b"], part["a"]] = part["g"]
        scores, found = solve(gram, k, center)
        placed += [(s, code, *map(float, values)) for code, values in enumerate(scores)]
        ratios += [(s, i + 1, float(value), 0.0) for i, value in enumerate(found)]
    kind = cells.schema["_s"].dataType
    numbers = [T.StructField(f"{names}{i + 1}", T.DoubleType()) for i in range(k)]
    table = spark.createDataFrame(placed, T.StructType([T.StructField("_s", kind), T.StructField("_code", T.IntegerType()), *numbers]))
    head = [F.col("_r").alias(row)] + ([F.col("_s").alias(slice_by)] if slice_by else [])
    scores = codes.join(table, ["_s", "_code"]).select(*head, *[f.name for f in numbers])
    return scores, lowrank.ratio_frame(spark, ratios, kind, slice_by)


def leading_components(
    entries: DataFrame, row: str, col: str, weight: str, k: int = 2, most_rows: int = MOST_ROWS, alone: str | None = None, **options
):
    """Leading components by whichever way the number of rows allows (runs jobs).

    Products of rows while no slice has more than ``most_rows`` rows, else
    Krylov passes over the matrix. ``alone`` helps the first (:func:`components`).
    """
    slice_by, rows = options.get("slice_by"), options.get("rows")
    cells = once(entries, "entries")
    within = [slice_by] if slice_by else []
    listed = (cells if rows is None else rows).groupBy(*within).agg(F.countDistinct(row).alias("n")).select("n")
    sizes = listed.agg(F.max("n").alias("most"), F.sum(F.col("n") * F.col("n")).alias("all"), F.count(F.lit(1)).alias("slices")).first()
    few = (sizes["most"] or 0) <= most_rows and (sizes["all"] or 0) <= MOST_CELLS and sizes["slices"] <= lowrank.MOST_SLICES
    if few:
        return components(cells, row, col, weight, k, alone=alone, **options)
    return lowrank.components(cells, row, col, weight, k, **options)
