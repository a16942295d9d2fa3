"""Column functions on the hand-made cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from commentlens.functions import clock, links, stem
from commentlens.functions import text as words
from commentlens.functions.stopwords import NLTK_ENGLISH, SNOWBALL_ENGLISH, stopword_table
from tests.stemmers import STEMMERS


def values(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i INT, c {kind}")
    return [r["v"] for r in df.select("i", fn("c").alias("v")).orderBy("i").collect()]


def test_strip_tags_stops_at_line_ends(spark):
    rows = ["<b>Hi</b>", "<a\nx>y", "a<b and c>d", None, ""]
    assert values(spark, rows, words.strip_tags) == ["Hi", "<a\nx>y", "ad", None, ""]
    assert values(spark, rows, words.strip_markup) == ["Hi", "y", "ad", None, ""]


def test_normalise_keeps_emoticons(spark):
    rows = ["<b>Hi</b> :-) there =D", "Ünï-codé ПРИВЕТ", None]
    assert values(spark, rows, words.normalise) == ["hi there d:) =D", "ünï codé привет", None]


def test_tokens(spark):
    assert values(spark, ["  a b\tc ", ""], words.split_blanks) == [["a", "b", "c"], []]
    assert values(spark, ["This and Über x2 word"], words.alphabetic_words) == [["this", "über", "word"]]
    assert values(spark, ["Don't say 'hello', J.K."], words.tidy_words) == [["don't", "say", "hello", "j.k"]]


def test_digits_and_handles(spark):
    assert values(spark, [" a  1b @bob2 c "], words.drop_digits_and_handles) == ["a b c"]


def test_corpus_clean(spark):
    got = values(spark, ["The 3 Cats, and don't: stop!"], lambda c: words.corpus_clean(c, ["the", "and", *SNOWBALL_ENGLISH]))
    assert got == ["cats dont stop"]


def test_ngrams(spark):
    rows = [["a", "b", "c"], ["a"], []]
    assert values(spark, rows, lambda c: words.ngrams(c, 2), "array<string>") == [["a b", "b c"], [], []]
    assert values(spark, rows, lambda c: words.ngrams(c, 1), "array<string>") == rows


def test_url_rules(spark):
    rows = ["http://s/content/abc?x=1#y", "/content/c0ffee", "abc.html", "none", None]
    assert values(spark, rows, links.id_from_last_segment) == ["abc?x=1#y", "c0ffee", "abc", "none", None]
    assert values(spark, rows, links.id_between_slash_and_query) == ["/s/content/abc", None, None, None, None]


def test_short_collection_id(spark):
    assert values(spark, ["https://h/x/y/42/Zm9v/init"], links.short_collection_id) == ["42/Zm9v"]


def test_href_prefix_and_parity(spark):
    rows = ["/content/c0ffee", "/content/abc/"]
    assert values(spark, rows, links.id_from_href) == ["c0ffee", "abc"]
    assert values(spark, rows, lambda c: links.id_from_href(c, True)) == ["0ff", "ab"]


def test_collection_id(spark):
    got = values(spark, ["a", "x" * 100, "??>>"], links.collection_id)
    assert got[0] == "YQ.." and "\n" not in got[1] and got[2] == "Pz8-Pg.."


def test_clocks(spark):
    rows = [1459468800, 1483228799]
    assert values(spark, rows, lambda c: clock.wall_clock(c), "long") == [datetime(2016, 4, 1), datetime(2016, 12, 31, 23, 59, 59)]
    assert values(spark, rows, lambda c: clock.wall_clock(c, "CET"), "long") == [datetime(2016, 4, 1, 2), datetime(2017, 1, 1, 0, 59, 59)]
    assert values(spark, rows, lambda c: clock.week_start(clock.wall_clock(c)), "long") == [date(2016, 3, 28), date(2016, 12, 26)]
    assert values(spark, [1459469099, 1459469100], lambda c: clock.floor_seconds(c), "long") == [1459468800, 1459469100]
    assert values(spark, rows, lambda c: clock.on_reference_day(clock.wall_clock(c)), "long") == [
        datetime(2019, 1, 1), datetime(2019, 1, 1, 23, 59, 59)
    ]


def test_month_and_year_ranges_equal_calendar_parts(spark):
    df = spark.range(0, 800).select((F.lit(1451606400) + F.col("id") * 50000).alias("t"))
    by_range = df.where(clock.in_month("t", 2016, 12, "CET")).count()
    at = clock.wall_clock("t", "CET")
    assert by_range == df.where((F.year(at) == 2016) & (F.month(at) == 12)).count() > 0
    assert df.where(clock.in_years("t", [2016, 2017])).count() == df.where(F.year(clock.wall_clock("t")).isin(2016, 2017)).count()


def test_weekdays(spark):
    friday = [1459468800]
    assert values(spark, friday, lambda c: clock.weekday_monday0(clock.wall_clock(c)), "long") == [4]
    assert values(spark, friday, lambda c: clock.weekday_sunday0(clock.wall_clock(c)), "long") == [5]
    assert values(spark, friday, lambda c: clock.weekday_label(clock.wall_clock(c)), "long") == ["Fri"]


PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "feed": "feed", "agreed": "agre", "hopping": "hop", "filing": "file",
    "relational": "relat", "digitizer": "digit", "triplicate": "triplic", "adoption": "adopt", "controll": "control",
    "this": "thi", "was": "wa", "skies": "sky", "dies": "die", "enjoy": "enjoy",
}
ENGLISH = {
    "consignment": "consign", "consolatory": "consolatori", "knightly": "knight", "generously": "generous", "skies": "sky",
    "news": "news", "gas": "gas", "this": "this", "kiwis": "kiwi", "hoping": "hope", "cries": "cri", "dog's": "dog",
    "national": "nation", "boyish": "boyish",
}


def _dictionary(spark, listed, rules):
    df = spark.createDataFrame([(w,) for w in listed], "word STRING")
    return {r["word"]: r["stem"] for r in stem.dictionary(df, rules).collect()}


def test_known_stems(spark):
    assert _dictionary(spark, [*PORTER, *PORTER, None], "porter") == PORTER
    assert _dictionary(spark, ENGLISH, "english") == ENGLISH


@pytest.mark.parametrize("rules", ["porter", "english"])
def test_rewrites_equal_the_word_by_word_rules(spark, rules):
    import random

    import duckdb
    import pandas as pd

    rnd = random.Random(8)
    pairs = stem.PORTER_STEP2 + stem.PORTER_STEP3 + stem.P2_STEP2 + stem.P2_STEP3
    ends = [s for s, _ in pairs] + stem.PORTER_STEP4 + stem.P2_STEP4
    ends += "s es ied ies sses ed ing eed eedly edly ingly y ly e ll 's ' 's' us ss ative logi ogi li ion sion at bl iz".split()
    listed = {*stem.PORTER_IRREGULAR, *stem.P2_EXCEPTIONS, *stem.P2_KEEP_AFTER_1A, "’tis", "don’t", "'s", "''", "Running", "'yy", "yyy", "ayyed", ""}
    listed |= {p + s for p in stem.P2_R1_PREFIXES for s in ends}
    for _ in range(8000):
        word = "".join(rnd.choice("aeiouybcdlmnrstwxyzég") for _ in range(rnd.randint(0, 6)))
        listed.add(word + "".join(rnd.choice(ends) for _ in range(rnd.randint(0, 2))))
    want = {w: STEMMERS[rules](w) for w in listed}
    assert _dictionary(spark, listed, rules) == want
    con = duckdb.connect()
    con.register("src", pd.DataFrame({"w": sorted(listed)}))
    assert dict(con.execute(f"WITH {stem.dictionary_sql('src', rules)} SELECT w, stem FROM dict").fetchall()) == want


def test_lists_keep_their_order(spark):
    from commentlens.operators.terms import stem_lists

    rows = [(1, list(ENGLISH) * 2), (2, None), (3, []), (4, ["ties", "dies"])]
    df = spark.createDataFrame(rows, "id INT, t ARRAY<STRING>")
    got = {r["id"]: r["t"] for r in stem_lists(df, "t", "english").collect()}
    assert got == {1: list(ENGLISH.values()) * 2, 2: None, 3: [], 4: ["tie", "die"]}


def test_stop_lists(spark):
    assert len(NLTK_ENGLISH) == 179 and len(SNOWBALL_ENGLISH) == 174
    extra = spark.createDataFrame([("own", "xyz")], "list STRING, word STRING")
    table = stopword_table(spark, extra)
    assert {r["list"] for r in table.select("list").distinct().collect()} == {"nltk", "snowball", "own"}


@pytest.mark.parametrize("body", ["plain", "@a @b", "x@y.z"])
def test_handles_do_not_fail(spark, body):
    assert values(spark, [body], words.drop_digits_and_handles)[0] is not None


def test_tokens_are_made_once(spark):
    """Neither n-grams nor rows of tokens repeat the expression that makes the tokens."""
    df = spark.createDataFrame([(1, "a b  c"), (2, ""), (3, None), (4, "d")], "id INT, t STRING")
    rows = words.one_per_row(df, words.ngrams(words.split_blanks("t"), 2), ["id"], "term")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted(map(tuple, rows.collect())) == [(1, "a b"), (1, "b c")]
    kept = words.one_per_row(df.where("id = 1"), F.array(F.lit("x"), F.lit(None)), ["id"], "term")
    assert [r["term"] for r in kept.collect()] == ["x", None]


def test_stems_are_not_searched_in_a_map(spark):
    """A lookup in a map column runs over all its words for each token of a text."""
    from commentlens.operators.terms import stem_lists

    df = spark.createDataFrame([(1, ["running", "dogs", "running"]), (2, []), (3, None)], "id INT, t ARRAY<STRING>")
    found = stem_lists(df, "t", "porter")
    assert "map_from_entries" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: r["t"] for r in found.collect()} == {1: ["run", "dog", "run"], 2: [], 3: None}
