"""Steps whose cost must follow the input: what they move, and how it is dealt."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commentlens.functions import stem as stemming
from commentlens.operators import terms
from commentlens.operators.dedupe import first_per_key
from commentlens.plans import keyed
from commentlens.plans import loading as ld
from commentlens.plans import maps
from commentlens.session import cut_lineage, is_stored, known_size, once, spread
from commentlens.sources import tables as tb

RAW = "id LONG, ancestorId LONG, parentId LONG, authorId STRING, createdAt LONG, ft_id STRING, title STRING, bodyHtml STRING, likedBy STRING"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def raw(spark, ids):
    return spark.createDataFrame([(i, None, None, "a", 1, f"f{i}", "t", f"<b>{i}</b>", f"['x{i}', 'y']") for i in ids], RAW)


@pytest.mark.parametrize("kind", ["comments", "text", "titles"])
def test_a_repeated_load_orders_no_rows(spark, tmp_path, monkeypatch, kind):
    ordered = []
    first = ld.first_per_key
    monkeypatch.setattr(ld, "first_per_key", lambda df, *rest: ordered.append(df.count()) or first(df, *rest))
    assert [ld.load(raw(spark, ids), str(tmp_path), kind, ["createdAt"]) for ids in ((1, 2, 3, 3), (1, 2, 3), (3, 4))] == [3, 0, 1]
    assert ordered == [4, 0, 1]


@pytest.mark.parametrize("small", [0, ld.SMALL])
def test_new_rows_of_large_and_small_batches(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(ld, "SMALL", small)
    likes = "comment_id LONG, likedBy STRING"
    stored = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], likes)
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, "c"), (3, None), (None, None)], likes)
    new = {tuple(r) for r in ld.new_rows(batch, stored, ["comment_id", "likedBy"]).collect()}
    assert new == {(1, "b"), (None, "c"), (None, None)}
    root = str(tmp_path)
    assert [ld.load(raw(spark, ids), root, "likes") for ids in ((1, 1), (1, 2, 2), (1, 2))] == [2, 2, 0]
    assert tb.read_table(spark, "likes", root).count() == 4


def test_a_first_row_moves_once(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, None, "q"), (None, 5, "c")], "k LONG, place LONG, v STRING")
    picked = first_per_key(df, ["k"], ["place", "v"])
    assert "min_by" not in plan(picked)
    assert {tuple(r) for r in picked.select("k", "place", "v").collect()} == {(1, None, "q"), (None, 5, "c")}


def test_unseen_rows_carry_no_bits(spark, tmp_path):
    table = keyed.create(spark, str(tmp_path), "text", ["id"], buckets=4, expected_keys=100)
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id LONG, bodyHtml STRING")
    assert keyed.unseen(table, batch).columns == ["id", "bodyHtml", keyed.BUCKET]
    assert [keyed.append(table, batch) for _ in range(2)] == [2, 0]


def test_texts_are_dealt_in_pieces(spark):
    stored = cut_lineage(spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1), "texts")
    pieces = spread(stored, 20_000).rdd.getNumPartitions()
    assert pieces > spark.sparkContext.defaultParallelism
    assert spread(stored, 1 << 30).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(stored, 20_000).distinct().count() == 20_000


def test_norms_are_sent_by_their_size(spark):
    counts = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "x", 1)], "doc STRING, term STRING, n LONG")
    weighted = terms.smoothed_tfidf(counts, "doc")
    assert "BroadcastHashJoin" in plan(weighted) and "SortMergeJoin" not in plan(weighted)
    assert {(r["doc"], r["term"]) for r in weighted.collect()} == {("a", "x"), ("a", "y"), ("b", "x")}


def test_sparse_terms_go_before_they_are_weighted(spark):
    rows = [(1, "x", 1), (1, "y", 2), (2, "x", 3), (3, "x", 1), (None, "y", 1), (3, "z", 4)]
    matrix = spark.createDataFrame(rows, "id LONG, term STRING, n LONG")
    docs = spark.createDataFrame([(4,)], "docs LONG")
    early = terms.log2_tfidf(matrix, "id", docs, 0.6)
    late = terms.drop_sparse(terms.log2_tfidf(matrix, "id", docs), "id", docs, 0.6)
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.select("id", "term", "w").collect()))
    assert {r["term"] for r in early.collect()} == {"x"}
    assert "SortMergeJoin" not in plan(early)


def test_stems_come_by_pieces(spark, monkeypatch):
    """A word goes to the dictionary once a piece, and tokens move once, without those of other rows."""
    monkeypatch.setattr(terms, "PIECE", 2_000)
    odd = ["running dogs", None, "", "naïve", "Été", "ties"]
    rows = [(i, None if i == 5 else [] if i == 7 else odd + [f"x{i}ing", "running"] * 40, f"own {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "id LONG, t ARRAY<STRING>, v STRING").coalesce(2)
    found = terms.stem_lists(df, "t", "porter")
    assert plan(found).count("FlatMapCoGroupsInArrow") == 1 and "Join" not in plan(found) and found.columns == df.columns
    known = {"running dogs": "running dog", "running": "run", "ties": "tie", "naïve": "naïv", "Été": "Été"}
    stems = {r["word"]: r["stem"] for r in stemming.dictionary(df.select(F.explode("t").alias("word"))).collect()}
    assert stems["running"] == known["running"] and stems["running dogs"] == known["running dogs"]
    want = {i: (None if t is None else [stems.get(w) for w in t], v) for i, t, v in rows}
    assert {r["id"]: (r["t"], r["v"]) for r in found.collect()} == want


def test_words_are_told_once_a_piece():
    batches = [([1, 1, 4], ["a", "b", "b"]), ([], []), ([4, 4, 9], ["b", "a", "a"])]
    made = [pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(w, pa.string())], ["_piece", "word"]) for p, w in batches]
    found = [tuple(r.values()) for b in terms._words_of_pieces()(iter(made)) for r in b.to_pylist()]
    assert found == [(1, "a"), (1, "b"), (4, "b"), (4, "a"), (9, "a")]


@pytest.mark.parametrize("stem", [True, False])
def test_rows_of_a_term_are_brought_together_once(spark, monkeypatch, stem):
    stored = {}
    once = terms.once
    monkeypatch.setattr(terms, "once", lambda df, label, *codec: once(stored.setdefault(label, df), label, *codec))
    monkeypatch.setattr(terms, "HELD_ROWS", 5)
    texts = [(i, y, a, f"{a} runs and ran with {t}") for i, (y, a, t) in enumerate([(1, "x", "dogs"), (1, "y", "dogs"), (1, "y", "cats"), (2, "x", "dogs")])]
    rows = spark.createDataFrame([*texts, (9, 1, None, "runs home")], "id LONG, year INT, authorId STRING, bodyHtml STRING")
    found = maps.author_vectors(rows, 1, stem=stem, alone="alone")
    by_term = [line for df in stored.values() for line in plan(df).splitlines() if "Exchange hashpartitioning" in line and "term" in line]
    assert len(by_term) == 1 and is_stored(found)
    got = {(r["year"], r["authorId"], r["term"]): r["alone"] for r in found.collect()}
    run, dog, cat = ("run", "dog", "cat") if stem else ("runs", "dogs", "cats")
    assert got[(1, "x", run)] is False and got[(1, "y", dog)] is False and got[(1, "y", cat)] is True and got[(2, "x", dog)] is True
    assert {k[1] for k in got} == {"x", "y"} and len(got) == 4 + 4 + 4


def test_stored_words_take_less_room(spark):
    df = spark.range(30_000).select(F.sha2(F.col("id").cast("string"), 256).alias("t"))
    assert known_size(cut_lineage(df, "texts", "zstd")) < 0.8 * known_size(cut_lineage(df, "texts"))
    assert once(df, "texts", "zstd").exceptAll(df).count() == 0
