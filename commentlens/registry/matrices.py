"""Registered queries on matrices.

Products of rows, and leading components by powers of their matrix, have
an SQL form; the rest is compared with NumPy in unit tests.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from commentlens.functions.stem import dictionary_sql
from commentlens.operators import discriminant as ld
from commentlens.operators import gram
from commentlens.operators.lowrank import dense_components
from commentlens.plans import language as lang
from commentlens.plans import maps
from commentlens.registry import views as v
from commentlens.registry.language import FREQ, NLTK, TOKENS, _round
from commentlens.session import once

ENTRIES: dict = {}
YEARS = [2014, 2015, 2016, 2017, 2018]
DIGITS = 6


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


def _map(s, d):
    return maps.author_map(v.texts(s, d, None), None, YEARS, min_comments=1)  # stems deal the tokens in pieces


entry("p08_dense_components")(lambda s, d: dense_components(
    v.table(s, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")),
    "features",
))
entry("p13_word_space")(lambda s, d: maps.word_space(lang.word_frequencies(v.texts(s, d)), 15)[0])
entry("p13_explained_ratios")(lambda s, d: maps.word_space(lang.word_frequencies(v.texts(s, d)), 15)[1])

def _vectors(s, d):
    return maps.labelled_vectors(v.wide_table(s, d, "documents").select("doc_id", "lang", "text"), "text", 2, 2000)


entry("p14_discriminant")(lambda s, d: _coordinates(s, d))


def _coordinates(s, d):
    vectors = _vectors(s, d)
    model = ld.solve(ld.moments(vectors, "features", "lang"))
    return ld.project(vectors, "features", model).select("doc_id", "lang", "LD_1", "LD_2")


entry("q15_author_separation")(lambda s, d: maps.author_separation(_vectors(s, d), "doc_id", "lang")[0])
entry("p15_accuracy")(lambda s, d: maps.author_separation(_vectors(s, d), "doc_id", "lang")[1])
entry("p15_split_sizes")(lambda s, d: ld.hash_split(
    v.wide_table(s, d, "documents").select("doc_id"), "doc_id"
).groupBy("part", "fold").agg(F.count(F.lit(1)).alias("n")))

# --- products of rows, and components from them -----------------------------------------

# Weights of two-word terms of the authors with more than one comment in a year, without stems.
YEARLY = f"""WITH RECURSIVE t AS (SELECT doc_id, source AS r, year(DATE '2014-01-01' + CAST((doc_id * 97) % 1826 AS INT)) AS s, {TOKENS} AS all_toks
    FROM documents),
  busy AS (SELECT s, r FROM t GROUP BY 1, 2 HAVING count(*) > 1),
  k AS (SELECT s, r, list_filter(all_toks, lambda x: x NOT IN ({NLTK})) AS toks FROM t JOIN busy USING (s, r)),
  b AS (SELECT s, r, unnest(list_transform(range(1, CAST(len(toks) AS BIGINT)), lambda i: toks[i] || ' ' || toks[i + 1])) AS c FROM k),
  g AS (SELECT s, r, c, count(*) AS n FROM b GROUP BY ALL),
  df AS (SELECT s, c, count(*) AS df FROM g GROUP BY ALL),
  docs AS (SELECT s, count(DISTINCT r) AS docs FROM g GROUP BY 1),
  raw AS (SELECT g.s, r, c, n * pow(ln((1.0::DOUBLE + docs) / (1 + df)) + 1, 2) AS w FROM g JOIN df USING (s, c) JOIN docs USING (s)),
  nrm AS (SELECT s, r, sqrt(sum(w * w)) AS nrm FROM raw GROUP BY ALL),
  cells AS (SELECT s, r, c, w / nrm AS w FROM raw JOIN nrm USING (s, r)),
  listed AS (SELECT s, r FROM busy)"""
# The same with stems, as the map is made by default.
STEMMED = f"""WITH RECURSIVE t AS (SELECT doc_id, source AS r, year(DATE '2014-01-01' + CAST((doc_id * 97) % 1826 AS INT)) AS s, {TOKENS} AS all_toks
    FROM documents),
  busy AS (SELECT s, r FROM t GROUP BY 1, 2 HAVING count(*) > 1),
  src AS (SELECT s, r, doc_id, unnest(all_toks) AS w, generate_subscripts(all_toks, 1) AS i FROM t JOIN busy USING (s, r)),
  {dictionary_sql('src', 'porter')},
  k AS (SELECT s, r, doc_id, list(stem ORDER BY i) AS toks FROM src JOIN dict USING (w) WHERE stem NOT IN ({NLTK}) GROUP BY 1, 2, 3)""" + YEARLY[
    YEARLY.index(",\n  b AS") :
]
SHARES = "WITH RECURSIVE " + FREQ.removeprefix("WITH ").rstrip() + """,
  cells AS (SELECT 0 AS s, author AS r, word AS c, freq AS w FROM f), listed AS (SELECT DISTINCT s, r FROM cells)"""
PAIRED = """,
  pair AS (SELECT x.s, x.r AS ra, y.r AS rb, sum(x.w * y.w) AS g FROM cells x JOIN cells y ON x.s = y.s AND x.c = y.c GROUP BY ALL)
"""
SQUARINGS = 40


def _strongest_sql(name: str, source: str) -> str:
    """``name``: the first eigenvector ``u`` of each symmetric matrix ``m`` in ``source``, by squaring it over and over."""
    squared = "list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c)))"
    return f"""
  {name}_powers AS (SELECT s, 0 AS t, m FROM {source} UNION ALL
    SELECT s, t + 1, list_transform(x, lambda r: list_transform(r, lambda e: e / trace)) FROM
      (SELECT s, t, x, list_sum(list_transform(x, lambda r, i: r[i])) AS trace FROM
        (SELECT s, t, {squared} AS x FROM {name}_powers WHERE t < {SQUARINGS})) WHERE trace > 0),
  {name} AS (SELECT s, list_transform(line, lambda e: e / sqrt(list_dot_product(line, line))) AS u FROM
    (SELECT s, m[list_position(diagonal, list_max(diagonal))] AS line FROM
      (SELECT s, m, list_transform(m, lambda r, i: r[i]) AS diagonal FROM (SELECT s, arg_max(m, t) AS m FROM {name}_powers GROUP BY s))))"""


def _leading_sql(start: str, matrix: str) -> str:
    """The two leading components of each slice: ``matrix`` is the column that is decomposed, ``g`` or ``c``."""
    return (
        start + PAIRED + f""",
  square AS (SELECT x.s, x.r AS ra, y.r AS rb, coalesce(g, 0.0) AS g FROM listed x JOIN listed y ON x.s = y.s
    LEFT JOIN pair p ON p.s = x.s AND p.ra = x.r AND p.rb = y.r),
  mid AS (SELECT s, ra, rb, g, g - avg(g) OVER (PARTITION BY s, ra) - avg(g) OVER (PARTITION BY s, rb) + avg(g) OVER (PARTITION BY s) AS c
    FROM square),
  mat AS (SELECT s, list(line ORDER BY ra) AS m, list(ra ORDER BY ra) AS names
    FROM (SELECT s, ra, list({matrix} ORDER BY rb) AS line FROM mid GROUP BY s, ra) GROUP BY s),
  total AS (SELECT s, sum(c) FILTER (ra = rb) AS variance FROM mid GROUP BY s),
  {_strongest_sql('first', 'mat')},
  rest AS (SELECT s, list_transform(m, lambda r, i: list_transform(r, lambda e, j: e - top * u[i] * u[j])) AS m FROM
    (SELECT s, m, u, list_dot_product(u, list_transform(m, lambda r: list_dot_product(r, u))) AS top FROM mat JOIN first USING (s))),
  {_strongest_sql('second', 'rest')},
  both_ AS (SELECT s, 1 AS component, u AS v FROM first UNION ALL SELECT s, 2, u FROM second),
  strong AS (SELECT s, component, v, names, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS strength
    FROM both_ JOIN mat USING (s)),
  score AS (SELECT s, component, unnest(names) AS r,
      unnest(list_transform(v, lambda e: e * sqrt(strength) * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END)) AS x FROM strong)
"""
    )


def _ratio_sql(start: str, matrix: str, head: str = "") -> str:
    return _leading_sql(start, matrix) + f"""SELECT {head} CAST(component AS INT) AS component,
       round(strength * (1 - list_sum(v) ** 2 / len(v)) / variance, {DIGITS}) AS ratio
FROM strong JOIN total USING (s)"""


def _score_sql(start: str, matrix: str, head: str, names: list[str]) -> str:
    columns = ", ".join(f"round(max(x) FILTER (component = {i + 1}), {DIGITS}) AS {name}" for i, name in enumerate(names))
    return _leading_sql(start, matrix) + f"SELECT {head}, {columns} FROM score GROUP BY s, r"




def _six(df, *names):
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


PCA = ["PCA_1", "PCA_2"]
YEAR = "CAST(s AS INT) AS year"
entry("q14_author_map", _score_sql(STEMMED, "c", f"r AS author_id, {YEAR}", PCA))(lambda s, d: _six(_map(s, d)[0], *PCA))
entry("p08_explained_ratios", _ratio_sql(STEMMED, "c", f"{YEAR},"))(
    lambda s, d: _six(_map(s, d)[1].select("year", "component", "ratio"), "ratio")
)
NAMED = _score_sql(STEMMED, "c", f"r AS author_id, {YEAR}", PCA)
entry("p16_named_map", f"SELECT author_id, PCA_1, PCA_2, year, upper(author_id) AS displayName FROM ({NAMED}) WHERE year = 2016")(
    lambda s, d: _six(maps.map_of_year(
        _map(s, d)[0],
        v.wide_table(s, d, "documents").select(F.col("source").alias("author_id"), F.upper("source").alias("displayName")).distinct(),
        2016,
    ), *PCA)
)
entry("p13_leading_space", _score_sql(SHARES, "g", "r AS name", ["pc1", "pc2"]))(
    lambda s, d: _six(maps.word_space(_shares(s, d), 2)[0], "pc1", "pc2")
)


def _yearly(s, d):
    texts = maps.yearly_texts(v.texts(s, d), None, YEARS, 1)
    return maps.author_vectors(texts, stem=False)


entry(
    "p08_gram_cells",
    YEARLY + PAIRED + "SELECT CAST(s AS INT) AS year, ra AS row_a, rb AS row_b, round(g, 9) AS product FROM pair WHERE ra <= rb",
)(lambda s, d: _round(gram.gram_cells(_yearly(s, d), "authorId", "term", "w", "year"), "product"))
entry(
    "p13_gram_cells", SHARES + PAIRED + "SELECT ra AS row_a, rb AS row_b, round(g, 9) AS product FROM pair WHERE ra <= rb"
)(lambda s, d: _round(gram.gram_cells(_shares(s, d), "author", "word", "freq"), "product"))
entry("q14_yearly_ratios", _ratio_sql(YEARLY, "c", "CAST(s AS INT) AS year,"))(
    lambda s, d: maps.author_map(v.texts(s, d), None, YEARS, min_comments=1, stem=False)[1].select(
        "year", "component", F.round("ratio", DIGITS).alias("ratio")
    )
)
entry("p13_leading_ratios", _ratio_sql(SHARES, "g"))(
    lambda s, d: maps.word_space(_shares(s, d), 2)[1].select("component", F.round("ratio", DIGITS).alias("ratio"))
)


def _shares(s, d):
    return _round(lang.word_frequencies(v.texts(s, d)), "freq")


# Scores are centred, their components don't correlate, and their squares add up to the share of the variance.
entry(
    "p16_map_invariants",
    YEARLY + PAIRED + """SELECT CAST(s AS INT) AS year, count(*) AS authors, 0.0::DOUBLE AS center_1, 0.0::DOUBLE AS center_2,
       0.0::DOUBLE AS product, true AS ratios_fit
    FROM listed GROUP BY s""",
)(lambda s, d: _invariants(s, d))


def _invariants(s, d):
    texts = maps.yearly_texts(v.texts(s, d), None, YEARS, 1)
    vectors = once(maps.author_vectors(texts, stem=False), "vectors")
    scores, ratios = maps.map_of_vectors(vectors, texts)
    cells = gram.gram_cells(vectors, "authorId", "term", "w", "year")
    own, n = F.col("row_a") == F.col("row_b"), F.col("authors")
    total = F.sum(F.when(own, F.col("product")).otherwise(0.0))
    pairs = F.sum(F.when(own, F.col("product")).otherwise(2 * F.col("product")))
    sums = cells.groupBy("year").agg(total.alias("diagonal"), pairs.alias("pairs"))
    found = scores.groupBy("year").agg(
        F.count(F.lit(1)).alias("authors"),
        *[F.sum(f"PCA_{i}").alias(f"c{i}") for i in (1, 2)],
        *[F.sum(F.col(f"PCA_{i}") ** 2).alias(f"q{i}") for i in (1, 2)],
        F.sum(F.col("PCA_1") * F.col("PCA_2")).alias("xy"),
    )
    share = ratios.groupBy("year").agg(*[F.max(F.when(F.col("component") == i, F.col("ratio"))).alias(f"r{i}") for i in (1, 2)])
    variance = F.col("diagonal") - F.col("pairs") / n
    fits = [F.abs(F.col(f"q{i}") - F.col(f"r{i}") * variance) < 1e-9 for i in (1, 2)]
    zero = lambda name: F.round(F.abs(name), 9)
    return found.join(sums, "year").join(share, "year").select(
        "year", "authors", zero("c1").alias("center_1"), zero("c2").alias("center_2"), zero("xy").alias("product"),
        (fits[0] & fits[1]).alias("ratios_fit"),
    )


entry("p14_class_counts", "SELECT lang, count(*) AS n, true AS unit_variance FROM documents GROUP BY 1")(lambda s, d: _classes(s, d))


def _classes(s, d):
    """Rows per class, and whether the pooled within-class variance along each axis is one."""
    placed = _coordinates(s, d)
    axes = ["LD_1", "LD_2"]
    per = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[F.var_samp(a).alias(a) for a in axes])
    pooled = per.agg(*[(F.sum((F.col("n") - 1) * F.col(a)) / (F.sum("n") - F.count(F.lit(1)))).alias(a) for a in axes])
    fits = pooled.select((F.greatest(*[F.abs(F.col(a) - 1) for a in axes]) < 1e-6).alias("fits"))
    return per.select("lang", "n", fits.scalar().alias("unit_variance"))
