"""Relational operators on small frames, with skew, ties and gaps."""

import re
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commentlens.operators import aggregate as ag
from commentlens.operators import joins as jn
from commentlens.operators import likes as lk
from commentlens.operators import numbering as nb
from commentlens.operators import ranking as rk
from commentlens.operators import reshape as rs
from commentlens.operators import series
from commentlens.operators import terms
from commentlens.operators import threads as th
from commentlens.operators.dedupe import first_per_key
from commentlens.plans import activity as act
from commentlens.plans import people

SPARK_RUNS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def comments(spark):
    data = [
        (1, -1, "a@h", 1459468800, "x1"),
        (2, 1, "b@h", 1459469099, "x1"),
        (3, 1, "a@h", 1459469100, "x1"),
        (5, -1, "c@h", 1483228799, "x2"),
        (6, -1, "d@h", 1500000000, "x9"),
        (7, 5, "b@h", 1483228900, "x2"),
        (8, 5, "b@h", 1483228950, "x2"),
    ]
    return spark.createDataFrame(data, "id LONG, ancestorId LONG, authorId STRING, createdAt LONG, ft_id STRING")


@pytest.fixture(scope="module")
def authors(spark):
    data = [("a@h", "Ann"), ("b@h", "Bob"), ("c@h", "Cid"), ("e@h", "Eve")]
    return spark.createDataFrame(data, "author_id STRING, displayName STRING")


def test_first_per_key_keeps_the_first(spark):
    df = spark.createDataFrame([(1, 2, "late"), (1, 1, "first"), (2, 9, None), (None, 1, "n")], "k INT, seq INT, v STRING")
    assert rows(first_per_key(df, ["k"], ["seq"])) == rows(
        spark.createDataFrame([(1, 1, "first"), (2, 9, None), (None, 1, "n")], df.schema)
    )


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 4, 4, 4, 1, None])], "i INT, v INT")
    assert sorted(r["i"] for r in rk.top_n(df, "v", 2).collect()) == [0, 1, 2, 3]
    assert rk.top_n(df, "v", 99).count() == 5


def test_top_n_per_group_with_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 2)], "g STRING, v INT")
    assert rows(rk.top_n_per_group(df, "g", "v", 1)) == [("a", 3), ("a", 3), ("b", 2)]
    plan = rk.top_n_per_group(df, "g", "v", 1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@SPARK_RUNS
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_dense_codes_equal_dense_rank(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k INT")
    got = {r["k"]: r["code"] for r in nb.dense_codes(df, "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(set(keys)))}


def test_number_within_a_hot_group(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("g"), "id")
    got = nb.number_within(df, "g", ["id"])
    by_group = {}
    for r in got.collect():
        by_group.setdefault(r["g"], []).append((r["id"], r["position"]))
    for pairs in by_group.values():
        assert [p for _, p in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_concat_parts_rebuild_the_text(spark):
    df = spark.createDataFrame([("a", i, f"<{i}>") for i in range(25)] + [("b", 1, None), ("b", 2, "x")], "g STRING, i INT, t STRING")
    parts = sorted((r["g"], r["part"], r["text"]) for r in ag.concat_parts(df, "g", "t", ["i"], 10).collect())
    assert [p[:2] for p in parts] == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert "".join(p[2] for p in parts if p[0] == "a") == "".join(f"<{i}>" for i in range(25))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_join_equals_join(spark, how):
    facts = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id") % 9).alias("k"), "id")
    facts = facts.unionByName(spark.createDataFrame([(None, 999)], facts.schema))
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (5, "five")], "k LONG, name STRING")
    assert rows(jn.split_hot_join(facts, dim, "k", how, share=3)) == rows(facts.join(dim, "k", how))


def test_orphans_count_null_titles(spark, comments):
    titles = spark.createDataFrame([("x1", "T"), ("x1", "T2"), ("x2", None)], "ft_id STRING, title STRING")
    assert sorted(r["id"] for r in people.untitled(comments, titles).collect()) == [5, 6, 7, 8]


def test_top_authors(comments, authors):
    got = people.top_authors(comments, authors, 1).collect()
    assert [tuple(r) for r in got] == [("b@h", "Bob", 3)]
    everyone = people.top_authors(comments, authors, keep_unnamed=True).collect()
    assert ("d@h", None, 1) in [tuple(r) for r in everyone]
    assert all(r["displayName"] for r in people.top_authors(comments, authors).collect())


def test_thread_interactions_equal_the_self_join(comments):
    t = th.thread_rows(comments)
    for author in ("a@h", "b@h", "c@h", "zz"):
        own = t.where(F.col("authorId") == author).select("root_id")
        wanted = t.where(F.col("authorId") != author).join(own, "root_id").groupBy("authorId").count()
        assert rows(th.interactions_with(t, author)) == rows(wanted)


def test_thread_partners_names_and_distinct(comments, authors):
    assert rows(people.thread_partners(comments, authors, "b@h")) == [("Ann", 2), ("Cid", 2)]
    assert rows(people.thread_partners(comments, authors, "b@h", distinct=True)) == [("Ann", 2), ("Cid", 1)]


def test_likes_from_text(spark):
    raw = spark.createDataFrame([(1, "['b@h', 'c@h']"), (2, "[]"), (3, None), (6, "['a@h', 'a@h']")], "id LONG, likedBy STRING")
    assert rows(lk.likes_from_text(raw)) == [(1, "b@h"), (1, "c@h"), (6, "a@h"), (6, "a@h")]
    assert (2, "") in rows(lk.likes_from_text(raw, keep_empty=True))


@SPARK_RUNS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.lists(st.sampled_from("xyz"), max_size=4)), min_size=1, max_size=12))
def test_pair_counts_sum_to_liker_rows(spark, data):
    df = spark.createDataFrame(data, "author_id STRING, liked_by ARRAY<STRING>")
    pairs = lk.pair_counts(lk.likes_from_lists(df))
    total = pairs.agg(F.sum("like_count")).first()[0] or 0
    assert total == sum(len(x) for _, x in data)


def test_like_matrix_columns(spark):
    pairs = spark.createDataFrame(
        [("A", "z", 9), ("A", "x", 9), ("B", "y", 9), ("B", "w", 1)], "author_name STRING, liker_name STRING, like_count LONG"
    )
    wide = lk.like_matrix(pairs, 5)
    assert wide.columns == ["author_name", "x", "y"]
    assert rows(wide) == [("A", 9, None), ("B", None, 9)]
    assert rows(lk.like_matrix_cells(pairs, 5)) == [("A", "x", 1, 9), ("B", "y", 2, 9)]


def test_like_pairs_with_names(spark):
    v2 = spark.createDataFrame([("1", "a", ["b", "c"]), ("2", "a", ["b"]), ("3", "b", [])], "comment_id STRING, author_id STRING, liked_by ARRAY<STRING>")
    names = spark.createDataFrame([("a", "Ann"), ("b", "Bob"), ("c", "Cid")], "authorId STRING, authorName STRING")
    assert [tuple(r) for r in people.like_pairs(v2, names).collect()] == [("Ann", "Bob", 2), ("Ann", "Cid", 1)]
    assert rows(people.most_liked_comments(v2, 1).select("comment_id", "likes_count")) == [("1", 2)]


def test_row_totals_and_zero_columns(spark):
    df = spark.createDataFrame([("a", 1, 0, None), ("b", 0, 0, 2)], "k STRING, x INT, y INT, z INT")
    assert ag.drop_zero_columns(df, ["x", "y", "z"]).columns == ["k", "x", "z"]
    assert rows(ag.with_row_total(df, ["x", "y", "z"]).select("k", "total")) == [("a", 1), ("b", 2)]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i INT, s STRING")
    b = spark.createDataFrame([(2,)], "i INT")
    assert rows(rs.union_all([a, b])) == [(1, "x"), (2, None)]


@SPARK_RUNS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 20)), min_size=1, max_size=20))
def test_densify_keeps_totals(spark, data):
    start = date(2020, 1, 1)
    df = spark.createDataFrame([(g, start + timedelta(days=i)) for g, i in data], "g STRING, d DATE")
    counts = df.groupBy("g", "d").agg(F.count(F.lit(1)).alias("n"))
    slots = F.sequence(F.lit(start), F.lit(start + timedelta(days=14)), F.expr("INTERVAL 1 DAY"))
    dense = series.densify(counts, "g", "d", "n", slots, F.col("d") <= start + timedelta(days=14))
    assert dense.count() == 15 * len({g for g, _ in data})
    assert dense.agg(F.sum("n")).first()[0] == sum(1 for _, i in data if i <= 14)


def test_weekly_activity(comments, authors):
    got = act.weekly_activity(comments, authors, ["Ann", "Bob"], date(2016, 3, 30), date(2016, 4, 12)).collect()
    assert [tuple(r) for r in got] == [(date(2016, 3, 28), 2, 1), (date(2016, 4, 4), 0, 0), (date(2016, 4, 11), 0, 0)]


def test_intraday_activity(comments, authors):
    wide = act.intraday_activity(comments, authors, ["Ann", "Bob", "Cid"], datetime(2016, 4, 1, 3))
    assert wide.columns == ["slot", "Ann", "Bob"] and wide.count() == 289
    first = wide.limit(2).collect()
    assert [tuple(r) for r in first] == [(datetime(2016, 4, 1, 3, 0), 1, 1), (datetime(2016, 4, 1, 3, 5), 1, 0)]


def test_intraday_start_off_the_step(comments, authors):
    with pytest.raises(ValueError):
        act.intraday_series(comments, authors, ["Ann"], datetime(2016, 4, 1, 3, 2))


def test_cohort_vs_rest(spark, comments, authors):
    pairs = spark.createDataFrame([("Ann", "Bob", 5), ("Cid", "Eve", 9)], "author_name STRING, liker_name STRING, like_count LONG")
    got = act.cohort_vs_rest(comments, authors, pairs, ["Bob"], date(2016, 4, 1), date(2016, 4, 5)).collect()
    assert [tuple(r) for r in got] == [(date(2016, 3, 28), 2, 1), (date(2016, 4, 4), 0, 0)]


def test_profile(comments):
    got = {tuple(r) for r in act.profile(comments).where(F.col("authorId") == "a@h").collect()}
    assert got == {("a@h", "hour", 3, 2), ("a@h", "dow", 4, 2)}


def test_month_view_and_point(spark, comments, authors):
    titles = spark.createDataFrame([("x2", "Two")], "ft_id STRING, title STRING")
    text = spark.createDataFrame([(5, "body")], "id LONG, bodyHtml STRING")
    view = act.month_view(comments, titles, authors, text, None, 2017, 1, "CET")
    assert rows(view.select("id", "title", "bodyHtml", "monthday")) == [(5, "Two", "body", 1), (7, "Two", None, 1), (8, "Two", None, 1)]
    assert rows(act.month_point(view, 1, datetime(2019, 1, 1, 0, 59, 59))) == [(5, "body")]


def test_month_starts(spark):
    df = spark.createDataFrame([(date(2018, 11, 5), date(2019, 1, 1)), (date(2019, 1, 2), date(2019, 1, 10))], "a DATE, z DATE")
    got = [r[0] for r in df.select(series.month_starts(F.col("a"), F.col("z"))).collect()]
    assert got == [[date(2018, 11, 1), date(2018, 12, 1)], []]


def test_tidy_tfidf_formula(spark):
    import math

    counts = spark.createDataFrame([("a", "x", 2), ("a", "y", 2), ("b", "y", 1)], "authorId STRING, word STRING, n LONG")
    got = {(r["authorId"], r["word"]): r["tf_idf"] for r in terms.tidy_tfidf(counts, "authorId").collect()}
    assert got == {("a", "x"): pytest.approx(0.5 * math.log(2)), ("a", "y"): 0.0, ("b", "y"): 0.0}


def test_smoothed_tfidf_has_unit_length(spark):
    import math

    counts = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "y", 1)], "doc STRING, term STRING, n LONG")
    got = {(r["doc"], r["term"]): r["w"] for r in terms.smoothed_tfidf(counts, "doc").collect()}
    x, y = 2 * (math.log(3 / 2) + 1) ** 2, 1.0
    assert got[("a", "x")] == pytest.approx(x / math.hypot(x, y)) and got[("b", "y")] == pytest.approx(1.0)


def test_stopwords_meet_stems_by_default(spark):
    df = spark.createDataFrame([("a", "This was great")], "authorId STRING, bodyHtml STRING")
    grams = terms.gram_counts(df, ["authorId"], "bodyHtml", 1, ["this", "was"], "porter")
    assert {r["term"] for r in grams.collect()} == {"thi", "wa", "great"}
    before = terms.gram_counts(df, ["authorId"], "bodyHtml", 1, ["this", "was"], "porter", stop_before_stem=True)
    assert {r["term"] for r in before.collect()} == {"great"}


# --- n-grams across comments, search windows ------------------------------------------------


def _stitched(rows, n):
    from collections import Counter

    by_author = {}
    for author, at, key, tokens in sorted((r for r in rows if r[0] is not None and r[3]), key=lambda r: (r[0], r[1], r[2])):
        by_author.setdefault(author, []).extend(tokens)
    return Counter((a, " ".join(t[i : i + n])) for a, t in by_author.items() for i in range(len(t) - n + 1))


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_grams_across_comments(spark, n):
    import random
    from collections import Counter

    from commentlens.operators.stitch import grams_across

    rnd = random.Random(n)
    # one author writes nine tenths; many comments are empty or shorter than a gram
    rows = [("hot" if i % 10 else f"a{i % 30}", rnd.randint(0, 50), i, [rnd.choice("xyz") for _ in range(rnd.choice([0, 0, 1, 1, 2, 7]))])
            for i in range(400)]
    rows += [("n", 1, 999, None), (None, 1, 1000, ["x", "y"])]
    df = spark.createDataFrame(rows, "author STRING, at INT, id INT, tokens ARRAY<STRING>").where("author IS NOT NULL").repartition(5)
    found = Counter(tuple(r) for r in grams_across(df, ["author"], "tokens", ["at", "id"], n).collect())
    assert found == _stitched(rows, n)


def test_no_window_holds_an_author(spark):
    from commentlens.operators.stitch import crossing_grams

    df = spark.createDataFrame([("a", 1, ["x"]), ("a", 2, ["y"])], "author STRING, id INT, tokens ARRAY<STRING>")
    plan = crossing_grams(df, ["author"], "tokens", ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert not any("author" in line for line in windows)
    assert crossing_grams(df, ["author"], "tokens", ["id"], 1).count() == 0


def test_search_windows_meet_by_equality(spark):
    from datetime import date, datetime

    from commentlens.operators import series

    topics = spark.createDataFrame([("t", 0, ["x", "y"]), ("u", 1, ["y"])], "topic STRING, topic_no INT, terms ARRAY<STRING>")
    windows = series.search_windows(topics, date(2016, 1, 1), date(2016, 3, 31))
    assert windows.count() == 6
    row = windows.where("topic = 't' AND month = '2016-02-01'").first()
    assert row["search_query"] == "x OR y AND lastPublishDateTime:>2016-02-01T00:00:00Z AND lastPublishDateTime:<2016-03-02T00:00:00Z"
    articles = spark.createDataFrame(
        [(1, datetime(2016, 2, 1), ["x"]), (2, datetime(2016, 2, 1, 0, 0, 1), ["x", "y"]), (3, datetime(2016, 3, 2), ["y"]),
         (4, datetime(2015, 12, 31), ["y"]), (5, datetime(2016, 2, 5), ["z"]), (6, None, ["y"]), (7, datetime(2016, 2, 5), None)],
        "ft_id INT, moment TIMESTAMP_NTZ, tokens ARRAY<STRING>",
    )
    found = series.found_by(articles, windows)
    got = sorted((r["ft_id"], r["topic"], r["month"].month) for r in found.collect())
    assert got == [(1, "t", 1), (2, "t", 1), (2, "t", 2), (2, "u", 1), (2, "u", 2), (3, "t", 3), (3, "u", 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    first = {r["ft_id"]: (r["topic"], r["month"].month) for r in series.first_search(found).collect()}
    assert first == {1: ("t", 1), 2: ("u", 1), 3: ("u", 3)}


# --- spread groups, tables side by side ------------------------------------------------------


def test_a_hot_author_is_concatenated_by_many_tasks(spark):
    n = 4000
    df = spark.range(n).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("a"), F.col("id") % 70)).otherwise("hot").alias("g"), "id",
                               F.concat(F.lit("<"), "id", F.lit(">")).alias("t"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    found = ag.concat_parts(df, "g", "t", ["id"], 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    keys = [re.sub(r"#\d+L?", "", line.split("hashpartitioning(")[1].split(", ENSURE")[0]) for line in plan.split("\n") if "hashpartitioning(" in line]
    tasks = found.where("g = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    for k, value in before.items():
        spark.conf.set(k, value)
    # the texts are dealt by group and part, and before by range partition and group
    texts = [k for k in keys if k.startswith(("g, _groupingexpression", "g, part", "_part, g"))]
    assert len(texts) >= 2 and keys[0].startswith("g, ") and not keys[0].startswith("g, 4"), keys
    assert len(tasks) > 1 and max(r["n"] for r in tasks) < 72
    text = "".join(r["text"] for r in found.where("g = 'hot'").orderBy("part").collect())
    assert text == "".join(f"<{i}>" for i in range(n) if i % 10)


@pytest.mark.parametrize("a, b", [(50, 20), (3, 40), (0, 5), (7, 7), (0, 0)])
def test_side_by_side(spark, a, b):
    from commentlens.operators.reshape import side_by_side

    left = spark.range(a).select(F.col("id").alias("k"), (-F.col("id")).alias("x")).repartition(3)
    right = spark.range(b).select(F.col("id").alias("k"), F.lit("r").alias("y"))
    got = side_by_side(left, right, [F.desc("k")], ["k"], position="at").collect()
    want = []
    for i in range(max(a, b)):
        k = a - 1 - i if i < a else None
        want.append((i, k, -k if k is not None else None, i if i < b else None, "r" if i < b else None))
    assert sorted(tuple(r) for r in got) == want
    with pytest.raises(ValueError, match="clash"):
        side_by_side(left.withColumn("k_2", F.lit(1)), right, ["k"], ["k"])
