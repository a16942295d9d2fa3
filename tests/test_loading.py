"""Files, nested documents and loads."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commentlens.operators import nested as ns
from commentlens.plans import loading as ld
from commentlens.schemas import TABLES
from commentlens.sources import delimited as dl
from commentlens.sources import tables as tb
from commentlens.sources.documents import parse_trees
from commentlens.streaming.incremental import load_stream

RAW = [
    (1, None, None, "a@h", "<b>Hi</b>", 1459468800, "x1", "One", "['b@h', 'c@h']"),
    (2, 1, 1, "b@h", "two", 1459469099, "x1", "One", "[]"),
    (3, 1, 2, "a@h", None, 1459469100, "x1", None, None),
    (4, None, None, None, "no author", 1459469100, "x1", "One", None),
    (5, None, None, "c@h", "five", 1483228799, "x2", "Two", "['a@h']"),
    (5, None, None, "c@h", "five", 1483228799, "x2", "Two", "['a@h']"),
    (6, None, None, "d@h", "six", 1500000000, "x9", None, "['a@h', 'a@h']"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, TABLES["raw_comments"])


def test_loads_are_idempotent(spark, raw, tmp_path):
    root = str(tmp_path)
    sizes = {"comments": 5, "text": 5, "titles": 2, "likes": 4}
    for kind, size in sizes.items():
        assert ld.load(raw, root, kind) == size
        assert ld.load(raw, root, kind) == 0
    comments = tb.read_table(spark, "comments", root)
    assert comments.where("ancestorId = -1").count() == 3
    assert {r["bodyHtml"] for r in tb.read_table(spark, "text", root).collect()} == {"Hi", "two", "no author", "five", "six"}


def test_like_key_is_not_glued(spark, tmp_path):
    rows = [(1, "['23@h']"), (12, "['3@h']")]
    raw = spark.createDataFrame(rows, "id LONG, likedBy STRING")
    ld.append_new(ld.shaped(raw.limit(1), "likes"), str(tmp_path), "likes")
    ld.append_new(ld.shaped(raw, "likes"), str(tmp_path), "likes")
    assert tb.read_table(spark, "likes", str(tmp_path)).count() == 2


def test_first_raw_row_wins(spark):
    raw = spark.createDataFrame([("x", "b", 1), ("x", "a", 2), ("y", None, 3)], "ft_id STRING, title STRING, seq INT")
    assert [tuple(r) for r in ld.shaped(raw, "titles", ["seq"]).collect()] == [("x", "b")]


def test_stream_load_twice(spark, tmp_path):
    folder, root, marks = (str(tmp_path / n) for n in ("landed", "store", "marks"))
    rows = spark.createDataFrame([("a", 'He said "hi"\nthere'), ("b", "B")], TABLES["authors"])
    for _ in range(2):
        dl.write_semicolon(rows, folder, "append")
        load_stream(spark, folder, root, "authors", marks).awaitTermination()
    got = {tuple(r) for r in tb.read_table(spark, "authors", root).collect()}
    assert got == {("a", 'He said "hi"\nthere'), ("b", "B")}


def test_missing_table_is_a_clear_error(spark, tmp_path):
    with pytest.raises(tb.MissingTable):
        tb.read_table(spark, "nothing", str(tmp_path))
    with pytest.raises(tb.MissingTable):
        tb.read_table(spark, "no_such_table")


def test_drop_table(spark, tmp_path):
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("to_drop")
    assert tb.read_table(spark, "to_drop").count() == 3
    tb.drop_table(spark, "to_drop")
    assert not spark.catalog.tableExists("to_drop")


def test_parameters_are_bound(spark):
    df = spark.createDataFrame([("a",), ("b' OR 1=1 --",)], "authorId STRING")
    assert tb.run_sql(spark, "SELECT * FROM {t} WHERE authorId = :a", {"a": "b' OR 1=1 --"}, t=df).count() == 1


def test_link_lists(spark, tmp_path):
    (tmp_path / "Zoo.csv").write_text("aa-1\nbb-2\nhttp://s/x\n")
    (tmp_path / "Art.csv").write_text("aa-1\n")
    got = {tuple(r) for r in dl.read_link_lists(spark, str(tmp_path)).select("ft_hash", "topic").collect()}
    assert got == {("aa-1", "Art"), ("bb-2", "Zoo")}


def test_named_files(spark, tmp_path):
    (tmp_path / "Art_authors.csv").write_text(",id,displayName\n0,1,Ann\n1,2,Bob\n")
    (tmp_path / "Zoo_authors.csv").write_text(",id,displayName\n0,1,Ann\n")
    (tmp_path / "Zoo_content.csv").write_text(",x\n0,1\n")
    df = dl.read_named(spark, str(tmp_path), "id STRING, displayName STRING", "authors")
    assert {tuple(r) for r in dl.merge_authors([df]).collect()} == {("1", "Ann"), ("2", "Bob")}


def test_title_repair_does_not_multiply(spark):
    comments = spark.createDataFrame([(1, "abc", "old"), (2, "zz", "old")], "id INT, ft_id STRING, title STRING")
    clean = spark.createDataFrame([("abc", "T"), ("abc", "U")], "ft_id STRING, title STRING")
    addressed = spark.createDataFrame([("/content/zz.html?x", "Z"), ("bad", "B")], "ft_id STRING, title STRING")
    got = {(r["id"], r["title"]) for r in ld.repair_titles(comments, clean, addressed).collect()}
    assert got == {(1, "T"), (2, "Z")}


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a INT, b STRING")
    got = {r["column"]: (r["non_null"], r["total"]) for r in tb.profile(df).collect()}
    assert got == {"a": (2, 2), "b": (1, 2)}


def test_years_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "pca")
    first = spark.createDataFrame([("a", 1.0, 2016), ("a", 2.0, 2017)], "author_id STRING, v DOUBLE, year INT")
    tb.save_years(first, path)
    tb.save_years(first.where("year = 2017").withColumn("v", F.lit(9.0)), path)
    assert {(r["v"], r["year"]) for r in spark.read.parquet(path).collect()} == {(1.0, 2016), (9.0, 2017)}


# --- trees ----------------------------------------------------------------------------


def node(key, children=(), kind=0, **fields):
    return {"type": kind, "content": {"id": key, "authorId": f"a{key}", **fields}, "childContent": list(children)}


def flatten(spark, docs, max_depth=100):
    rows = [(str(i), "t", json.dumps(d)) for i, d in enumerate(docs)]
    return ns.flatten_tree(parse_trees(spark.createDataFrame(rows, "ft_id STRING, title STRING, j STRING"), "j"), max_depth)


def test_tree_fields_likes_and_odd_documents(spark):
    like = {"type": 1, "content": {"authorId": "z"}}
    leaf = {"type": 0, "content": {"id": "3"}}
    tree = node("1", [node("2", [leaf, like], bodyHtml="<p>x</p>", createdAt=5), like, like], annotations={"messagetag": "m"})
    got = {r["comment_id"]: r for r in flatten(spark, [{"content": [tree, dict(like)]}, {"content": "no list"}, {}]).collect()}
    assert set(got) == {"1", "2", "3", ""}
    assert got["1"]["liked_by"] == ["z", "z"] and got["1"]["messagetag"] == "m" and got["1"]["depth"] == 0
    assert got["2"]["comment"] == "x" and got["2"]["created_at"] == 5 and got["2"]["liked_by"] == ["z"]
    assert got["3"]["author_id"] == "" and got["3"]["created_at"] is None and got["3"]["depth"] == 2


def test_deep_trees_are_whole(spark):
    tree = node("0")
    for i in range(1, 40):
        tree = node(str(i), [tree])
    rows = flatten(spark, [{"content": [tree]}, {"content": [node("s")]}]).collect()
    assert len(rows) == 41 and max(r["depth"] for r in rows) == 39
    with pytest.raises(ValueError):
        flatten(spark, [{"content": [tree]}], max_depth=20)


@pytest.mark.parametrize("deepest, most, fails", [(13, 5, True), (9, 5, True), (5, 5, False), (12, 12, False), (250, 250, False), (250, 249, True)])
def test_depth_is_guarded_at_every_level(spark, deepest, most, fails):
    tree = node("0")
    for i in range(1, deepest + 1):
        tree = node(str(i), [tree, node(f"{i}b")])
    if fails:
        with pytest.raises(ValueError, match=f"max_depth={most}"):
            flatten(spark, [{"content": [tree]}], max_depth=most)
    else:
        assert flatten(spark, [{"content": [tree]}], max_depth=most).count() == 2 * deepest + 1


def test_stored_nodes_hold_no_subtrees(spark):
    wide = node("r", [node(str(i), [node(f"{i}-{j}", bodyHtml="x" * 500) for j in range(20)]) for i in range(20)])
    rows = flatten(spark, [{"content": [wide]}])
    assert "pending" not in str(rows.schema) and rows.count() == 421


def test_odd_fields_of_a_node(spark):
    rows = flatten(spark, [{"content": [
        {"type": 0, "content": {"id": 7, "createdAt": "no number", "annotations": "none", "bodyHtml": ["x"]}},
        {"type": 0, "content": "text", "childContent": {"no": "list"}},
        {"type": "0", "childContent": [{"content": {"id": "u"}}, None, 3]},
    ]}]).collect()
    assert sorted(r["comment_id"] for r in rows) == ["", "", "7"]
    assert {r["messagetag"] for r in rows} == {""} and {r["created_at"] for r in rows} == {None}


trees = st.recursive(st.just([]), lambda kids: st.lists(kids, max_size=3), max_leaves=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trees, min_size=1, max_size=3))
def test_flatten_returns_every_reply_once(spark, shapes):
    count = iter(range(10_000))

    def build(shape):
        return node(str(next(count)), [build(s) for s in shape])

    docs = [{"content": [build(s)]} for s in shapes]
    total = next(count)
    got = [r["comment_id"] for r in flatten(spark, docs).select("comment_id").collect()]
    assert sorted(got) == sorted(str(i) for i in range(total))


def test_pages_expected_and_missing(spark):
    meta = '{"collectionSettings":{"archiveInfo":{"nPages":2,"pageInfo":{"0":{"url":"/p0"},"1":{"url":"/p1"}}}}}'
    none = '{"collectionSettings":{"archiveInfo":{"nPages":0,"pageInfo":{}}}}'
    from commentlens.schemas import ARCHIVE_META

    df = spark.createDataFrame([("a", meta), ("b", none)], "ft_id STRING, j STRING")
    docs = df.select("ft_id", F.from_json("j", ARCHIVE_META).alias("x")).select("ft_id", "x.*")
    expected = ns.expected_pages(docs, ["ft_id"])
    assert {tuple(r) for r in expected.collect()} == {("a", 0, "/p0"), ("a", 1, "/p1")}
    landed = spark.createDataFrame([("/p1",)], "url STRING")
    assert [tuple(r) for r in ns.missing_pages(expected, landed).collect()] == [("a", 0, "/p0")]


def test_missing_keys_neither_lost_nor_repeated(spark, tmp_path):
    rows = [
        (None, None, None, "a", "one", 1, "x", "t", "['b']"),
        (None, None, None, "b", "two", 2, "x", "t", "['b']"),
        (None, None, None, "b", "two", 2, "x", "t", "['b']"),
        (7, None, None, "c", "three", 3, None, "u", "['b', 'c']"),
    ]
    raw = spark.createDataFrame(rows, TABLES["raw_comments"])
    for kind, n in (("comments", 3), ("text", 3), ("titles", 2), ("likes", 3)):
        assert [ld.load(raw, str(tmp_path), kind) for _ in range(3)] == [n, 0, 0]
        assert tb.read_table(spark, kind, str(tmp_path)).count() == n


# --- landing order and keyed tables -------------------------------------------------------


def test_first_landed_row_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("author_id;displayName\nk;z\nk;a\nm;c\n")
    (tmp_path / "b.csv").write_text("author_id;displayName\nm;a\nn;x\n")
    for multi_line in (True, False):
        rows = dl.read_semicolon(spark, str(tmp_path), TABLES["authors"], multi_line, batch=3)
        got = {tuple(r) for r in ld.shaped(rows, "authors", ["ingest"]).collect()}
        assert got == {("k", "z"), ("m", "c"), ("n", "x")}
        assert {r["ingest"]["batch"] for r in rows.collect()} == {3}


def test_order_within_the_blocks_of_a_split_file(spark, tmp_path):
    n = 30_000
    (tmp_path / "a.csv").write_text("author_id;displayName\n" + "".join(f"k{i % 100};{n - i:06d}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40_000)
    rows = dl.read_semicolon(spark, str(tmp_path), TABLES["authors"], False, batch=0)
    assert rows.rdd.getNumPartitions() > 3
    got = {r["author_id"]: int(r["displayName"]) for r in ld.shaped(rows, "authors", ["ingest"]).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"k{i}": n - i for i in range(100)}


def test_merged_authors_keep_the_first_landed(spark, tmp_path):
    (tmp_path / "Art_authors.csv").write_text(",id,displayName\n0,1,Zed\n1,2,Bob\n")
    (tmp_path / "Zoo_authors.csv").write_text(",id,displayName\n0,1,Ann\n")
    df = dl.read_named(spark, str(tmp_path), "id STRING, displayName STRING", "authors", batch=0)
    assert {tuple(r) for r in dl.merge_authors([df]).collect()} == {("1", "Zed"), ("2", "Bob")}


def test_stream_keeps_the_first_landed(spark, tmp_path):
    folder, root, marks = (tmp_path / n for n in ("landed", "store", "marks"))
    folder.mkdir()
    for name, rows in (("b", "k;y\nk;x\n"), ("a", "k;a\nm;b\nm;a\n")):  # a lands after b and holds smaller rows
        (folder / f"{name}.csv").write_text("author_id;displayName\n" + rows)
        load_stream(spark, str(folder), str(root), "authors", str(marks), index={"buckets": 4, "expected_keys": 100}).awaitTermination()
    from commentlens.plans import keyed

    got = {tuple(r) for r in keyed.read(spark, keyed.opened(spark, str(root), "authors")).select("author_id", "displayName").collect()}
    assert got == {("k", "y"), ("m", "b")}


def _people(spark, ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "author_id STRING, displayName STRING")


def test_keyed_appends_read_a_few_folders(spark, tmp_path):
    from commentlens.plans import keyed

    table = keyed.create(spark, str(tmp_path), "authors", ["author_id"], buckets=64, expected_keys=4000)
    assert keyed.append(table, _people(spark, map(str, range(4000)))) == 4000
    assert keyed.append(table, _people(spark, map(str, range(4000)))) == 0
    files = keyed.stored_keys(spark, table, list(range(64))).select(F.input_file_name()).distinct().count()
    # new keys only: the index knows none of them but for a few by chance
    batch = _people(spark, [f"new{i}" for i in range(64)]).withColumns(keyed._places(table))
    asked = keyed.flagged(table, batch, list(range(64)))
    looked_up = keyed._buckets(asked.where("_maybe"))
    assert len(looked_up) <= 8
    held = keyed.stored_keys(spark, table, looked_up or [0])
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "key_bucket" in plan.split("PartitionFilters")[1][:200]
    assert held.select(F.input_file_name()).distinct().count() <= files / 8
    assert keyed.append(table, _people(spark, ["7", "new1", None])) == 2
    assert keyed.append(table, _people(spark, ["7", "new1", None])) == 0
    assert keyed.read(spark, table).count() == 4002


def test_keyed_load_that_failed_between_index_and_rows(spark, tmp_path):
    from commentlens.plans import keyed

    table = keyed.create(spark, str(tmp_path), "authors", ["author_id"], buckets=4, expected_keys=100)
    batch = _people(spark, ["a", "b"])
    keyed.index_of(table, batch.withColumns(keyed._places(table))).write.partitionBy(keyed.BUCKET).parquet(table.index_path)
    assert keyed.append(table, batch) == 2
    assert keyed.append(table, batch) == 0


def test_reindex(spark, tmp_path):
    from commentlens.plans import keyed

    table = keyed.create(spark, str(tmp_path), "authors", ["author_id"], buckets=2, expected_keys=10)
    keyed.append(table, _people(spark, map(str, range(500))))
    larger = keyed.reindex(spark, table, 60_000)
    assert larger.segments > table.segments and keyed.opened(spark, str(tmp_path), "authors") == larger
    assert keyed.append(larger, _people(spark, map(str, range(400, 600)))) == 100
    assert keyed.create(spark, str(tmp_path), "authors", ["author_id"]) == larger


def test_terms_of_an_author_are_read_from_its_files(spark, tmp_path):
    from commentlens.plans import termtable as tt

    rows = [(f"a{i % 40}", f"w{i}", i, float(i)) for i in range(2000)]
    weighted = spark.createDataFrame(rows, "authorId STRING, word STRING, n INT, tf_idf DOUBLE")
    assert tt.store_terms(weighted, str(tmp_path), 16) == 1
    own = tt.terms_of(spark, str(tmp_path), "a7")
    assert {r["word"] for r in own.collect()} == {f"w{i}" for i in range(2000) if i % 40 == 7}
    plan = own._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "author_bucket" in scan.split("PartitionFilters")[1][:120] and "EqualTo(authorId,a7)" in plan
    files = own.select(F.input_file_name()).distinct().count()
    assert files == 1 < spark.read.parquet(f"{tmp_path}/tfidf").select(F.input_file_name()).distinct().count()
    # comments of two authors arrive: theirs are replaced, the others stay
    newer = weighted.where("authorId IN ('a7', 'a8') AND n > 1000").withColumn("tf_idf", F.lit(-1.0))
    assert tt.store_terms(newer, str(tmp_path), 99) == 2
    assert {(r["n"] > 1000, r["tf_idf"]) for r in tt.terms_of(spark, str(tmp_path), "a7").collect()} == {(True, -1.0)}
    assert tt.terms_of(spark, str(tmp_path), "a9").count() == 50
    assert tt.all_terms(spark, str(tmp_path)).count() == 38 * 50 + newer.count()
    assert tt.terms_of(spark, str(tmp_path), "nobody").count() == 0
