"""Registered queries on words and weights, with their SQL.

The rules of the stem dictionary are the same text in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.functions import text as words
from commentlens.functions.stem import dictionary_sql
from commentlens.functions.stopwords import NLTK_ENGLISH, SNOWBALL_ENGLISH
from commentlens.operators import aggregate as ag
from commentlens.operators import numbering as nb
from commentlens.operators import reshape as rs
from commentlens.operators import terms
from commentlens.plans import language as lang
from commentlens.plans import termtable as tt
from commentlens.registry import views as v
from commentlens.registry.columns import SQL_CORPUS, TM_STOP
from commentlens.session import once, scratch_path

ENTRIES: dict = {}
DIGITS = 9


def entry(name: str, sql: str | None = None):
    def add(fn):
        ENTRIES[name] = (fn, sql)
        return fn

    return add


NLTK = v.sql_list(NLTK_ENGLISH)
SNOWBALL = v.sql_list(SNOWBALL_ENGLISH)

# --- tidy words ----------------------------------------------------------------

CLEAN = v.SQL_WORDS.format(v.SQL_HANDLES.format("text"))
TIDY = f"""WITH t AS (SELECT source AS authorId, unnest({CLEAN}) AS word FROM documents),
  c AS (SELECT authorId, word, count(*) AS n FROM t WHERE word NOT IN ({SNOWBALL}) GROUP BY 1, 2),
  tot AS (SELECT authorId, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY 1),
  df AS (SELECT word, count(*) AS df FROM c GROUP BY 1),
  w AS (SELECT c.authorId, c.word, c.n, tot.total, CAST(c.n AS DOUBLE) / tot.total AS tf,
      ln(CAST((SELECT count(*) FROM tot) AS DOUBLE) / df.df) AS idf
    FROM c JOIN tot USING (authorId) JOIN df USING (word)),
  r AS (SELECT authorId, word, n, round(tf * idf, {DIGITS}) AS tf_idf FROM w)
"""


def _tidy(s, d, stem=None):
    return terms.author_words(v.texts(s, d), "authorId", "bodyHtml", stem, SNOWBALL_ENGLISH)


def _round(df, *names):
    for n in names:
        df = df.withColumn(n, F.round(n, DIGITS))
    return df


entry(
    "x03_one_word_per_row",
    f"SELECT id, word, count(*) AS n FROM (SELECT doc_id AS id, unnest({v.SQL_WORDS.format('text')}) AS word FROM documents) GROUP BY 1, 2",
)(lambda s, d: terms.word_counts(v.texts(s, d), "id", words.tidy_words("bodyHtml")))
entry("x04_term_counts_with_totals", TIDY + "SELECT authorId, word, n, total FROM w")(
    lambda s, d: terms.with_totals(_tidy(s, d), "authorId").select("authorId", "word", "n", "total")
)
entry(
    "x05_tidy_tfidf",
    TIDY + f"SELECT authorId, word, n, total, round(tf, {DIGITS}) AS tf, round(idf, {DIGITS}) AS idf, round(tf * idf, {DIGITS}) AS tf_idf FROM w",
)(lambda s, d: _round(terms.tidy_tfidf(_tidy(s, d), "authorId"), "tf", "idf", "tf_idf"))
TOP30 = TIDY + """SELECT authorId, word, n, tf_idf FROM r
  QUALIFY rank() OVER (PARTITION BY authorId ORDER BY tf_idf DESC) <= 30"""
for name in ("x06_top_terms_per_author", "q12_signature_terms"):
    entry(name, TOP30)(lambda s, d: lang.signature_terms(v.texts(s, d), stem=False, digits=DIGITS))
STEMMED = TIDY.replace(
    f"c AS (SELECT authorId, word, count(*) AS n FROM t WHERE word NOT IN ({SNOWBALL}) GROUP BY 1, 2)",
    f"""src AS (SELECT DISTINCT word AS w FROM t),
  {dictionary_sql('src', 'english')},
  c AS (SELECT authorId, stem AS word, count(*) AS n FROM t JOIN dict ON w = word WHERE stem NOT IN ({SNOWBALL}) GROUP BY 1, 2)""",
)
entry("q12_signature_terms_stemmed", STEMMED + TOP30.removeprefix(TIDY))(lambda s, d: lang.signature_terms(v.texts(s, d), digits=DIGITS))


def _stored_terms(s, d):
    """The signature terms of all authors, stored; then one author's stored again with other weights, and again as they are."""
    root = scratch_path(s, "terms")
    weighted = once(lang.signature_terms(v.texts(s, d), stem=False, digits=DIGITS), "weights")
    own = weighted.where("authorId = 'src1'")
    tt.store_terms(weighted, root, 16)
    tt.store_terms(own.withColumn("tf_idf", F.lit(9.0)).limit(50), root)
    tt.store_terms(own, root)
    return root


entry("x07_terms_of_one_author", f"SELECT * FROM ({TOP30}) WHERE authorId = 'src1'")(
    lambda s, d: tt.terms_of(s, _stored_terms(s, d), "src1")
)
entry("x07_stored_terms", TOP30)(lambda s, d: tt.all_terms(s, _stored_terms(s, d)))

# --- relative frequencies ---------------------------------------------------------

FREQ = f"""WITH t AS (SELECT source AS author, unnest({v.SQL_SPLIT.format('text')}) AS word FROM documents),
  c AS (SELECT author, word, count(*) AS n FROM t
    WHERE regexp_full_match(word, '\\p{{L}}+') AND length(word) > 3 AND word NOT IN ({NLTK}) GROUP BY 1, 2),
  f AS (SELECT author, word, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY author), {DIGITS}) AS freq FROM c)
"""
for name in ("a09_relative_word_frequency", "q13_word_frequencies"):
    entry(name, FREQ + "SELECT author, word, freq FROM f")(
        lambda s, d: _round(lang.word_frequencies(v.texts(s, d)), "freq")
    )
WIDE = ["src1", "src2", "src3"]
entry(
    "q13_word_frequency_matrix",
    FREQ
    + "SELECT word, "
    + ", ".join(f"coalesce(max(CASE WHEN author = '{a}' THEN freq END), 0.0::DOUBLE) AS {a}" for a in WIDE)
    + f" FROM f WHERE author IN ({v.sql_list(WIDE)}) GROUP BY 1",
)(lambda s, d: _round(lang.word_frequencies(v.texts(s, d), author_ids=WIDE, wide=True), *WIDE))
# The word vectors of all authors, joined outer: a column per author, words that one lacks are zero there.
SOURCES = [f"src{i}" for i in range(20)]
entry(
    "j06_outer_word_vectors",
    FREQ
    + "SELECT word, "
    + ", ".join(f"coalesce(max(CASE WHEN author = '{a}' THEN freq END), 0.0::DOUBLE) AS {a}" for a in SOURCES)
    + " FROM f GROUP BY 1",
)(lambda s, d: _vectors(s, d))


def _vectors(s, d):
    shares = _round(lang.word_frequencies(v.texts(s, d)), "freq")
    return rs.pivot_sum(shares, "word", "author", SOURCES, "freq", 0.0)


# --- document-term matrices ---------------------------------------------------------

DTM = f"""WITH docs AS (SELECT count(*) AS docs FROM documents),
  t AS (SELECT doc_id AS id, unnest({SQL_CORPUS.format('text', v.sql_list(TM_STOP))}) AS term FROM documents),
  m AS (SELECT id, term, count(*) AS n FROM t WHERE length(term) >= 3 GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM m GROUP BY 1),
  len AS (SELECT id, sum(n) AS len FROM m GROUP BY 1),
  w AS (SELECT m.id, m.term, CAST(m.n AS DOUBLE) / len.len * log2(CAST((SELECT docs FROM docs) AS DOUBLE) / df.df) AS w
    FROM m JOIN len USING (id) JOIN df USING (term))
"""
SPARSE = 0.95


def _dtm(s, d):
    return terms.document_term(v.texts(s, d), "id", "bodyHtml", TM_STOP)


def _docs(s, d):
    return v.texts(s, d).agg(F.count(F.lit(1)).alias("docs"))


KEEP = f"(SELECT term FROM df WHERE df > (SELECT docs FROM docs) * {1.0 - SPARSE}::DOUBLE)"
entry("x11_document_term_matrix", DTM + "SELECT id, term, n FROM m")(_dtm)
entry("x12_drop_sparse_terms", DTM + f"SELECT id, term, n FROM m WHERE term IN {KEEP}")(
    lambda s, d: terms.drop_sparse(_dtm(s, d), "id", _docs(s, d), SPARSE)
)
entry("x13_log2_tfidf", DTM + f"SELECT id, term, round(w, {DIGITS}) AS w FROM w")(
    lambda s, d: _round(terms.log2_tfidf(_dtm(s, d), "id", _docs(s, d)), "w")
)
entry("x14_top_terms_by_count", DTM + "SELECT term, CAST(sum(n) AS BIGINT) AS weight FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")(
    lambda s, d: terms.top_terms(_dtm(s, d), "n", 50)
)
entry(
    "x14_top_terms_by_weight",
    DTM + f"SELECT term, round(sum(w), 6) AS weight FROM w WHERE term IN {KEEP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30",
)(lambda s, d: lang.frequent_terms(v.texts(s, d), weighting="tfidf", sparse=SPARSE, n=30, digits=6))
entry("a12_term_totals", DTM + "SELECT term, CAST(sum(n) AS BIGINT) AS weight FROM m GROUP BY 1")(
    lambda s, d: terms.term_totals(_dtm(s, d))
)
entry("a13_frequent_terms", DTM + "SELECT term, CAST(sum(n) AS BIGINT) AS weight FROM m GROUP BY 1 HAVING sum(n) >= 200")(
    lambda s, d: terms.term_totals(_dtm(s, d), at_least=200)
)
ONE = DTM.replace("FROM documents", "FROM documents WHERE source = 'src1'")
KEEP99 = f"(SELECT term FROM df WHERE df > (SELECT docs FROM docs) * {1.0 - 0.99}::DOUBLE)"


def _one(s, d):
    return v.texts(s, d).where(F.col("authorId") == "src1")


entry(
    "q23_frequent_terms_by_count",
    ONE + f"SELECT term, CAST(sum(n) AS BIGINT) AS weight FROM m WHERE term IN {KEEP99} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50",
)(lambda s, d: lang.frequent_terms(_one(s, d)))
entry(
    "q23_frequent_terms_by_weight",
    ONE + f"SELECT term, round(sum(w), 6) AS weight FROM w WHERE term IN {KEEP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30",
)(lambda s, d: lang.frequent_terms(_one(s, d), weighting="tfidf", n=30, digits=6))
entry(
    "x15_matrix_slice",
    DTM
    + """, r AS (SELECT id, dense_rank() OVER (ORDER BY id) AS row_no FROM (SELECT DISTINCT id FROM m)),
    c AS (SELECT term, dense_rank() OVER (ORDER BY term) AS col_no FROM (SELECT DISTINCT term FROM m))
    SELECT id, term, n FROM m JOIN r USING (id) JOIN c USING (term) WHERE row_no BETWEEN 10 AND 150 AND col_no BETWEEN 10 AND 500""",
)(lambda s, d: _slice(s, d))


def _slice(s, d):
    matrix = once(_dtm(s, d), "matrix")
    rows = nb.dense_codes(matrix, "id", "row_no").where(F.col("row_no").between(10, 150))
    cols = nb.dense_codes(matrix, "term", "col_no").where(F.col("col_no").between(10, 500))
    return matrix.join(rows, "id").join(cols, "term").select("id", "term", "n")


entry("x16_corpus", "SELECT doc_id AS id, text AS bodyHtml FROM documents")(lambda s, d: v.texts(s, d).select("id", "bodyHtml"))

# --- n-gram vectors -------------------------------------------------------------------

TOKENS = f"list_filter(string_split_regex({v.SQL_NORMAL.format('text')}, '\\s+'), lambda x: x <> '')"
# The emoticon letters keep their case until the vectoriser lowers them.
TOKENS = TOKENS.replace(v.SQL_NORMAL.format("text"), f"lower({v.SQL_NORMAL.format('text')})")
GRAMS = f"""WITH k AS (SELECT doc_id, source AS authorId, list_filter({TOKENS}, lambda x: x NOT IN ({NLTK})) AS toks FROM documents),
  b AS (SELECT authorId, unnest(list_transform(range(1, CAST(len(toks) AS BIGINT)), lambda i: toks[i] || ' ' || toks[i + 1])) AS term FROM k),
  g AS (SELECT authorId, term, count(*) AS n FROM b GROUP BY 1, 2)
"""


def _grams(s, d, n=2, stem=None):
    texts = v.texts(s, d, None) if stem else v.texts(s, d)  # stems deal the tokens in pieces
    return terms.gram_counts(texts, ["authorId"], "bodyHtml", n, NLTK_ENGLISH, stem)


entry("x08_bigram_counts", GRAMS + "SELECT authorId, term, n FROM g")(_grams)
ACROSS = f"""WITH k AS (SELECT source AS authorId, (doc_id * 97) % 1826 AS day, doc_id, list_filter({TOKENS}, lambda x: x NOT IN ({NLTK})) AS toks
    FROM documents),
  a AS (SELECT authorId, flatten(list(toks ORDER BY day, doc_id)) AS toks FROM k GROUP BY 1),
  b AS (SELECT authorId, unnest(list_transform(range(1, CAST(len(toks) AS BIGINT) - SHORTER), lambda i: GRAM)) AS term FROM a)
  SELECT authorId, term, count(*) AS n FROM b GROUP BY 1, 2"""
for n, name in ((2, "bigrams"), (3, "trigrams")):
    gram = " || ' ' || ".join(f"toks[i + {k}]" for k in range(n))
    entry(f"x08_{name}_across_comments", ACROSS.replace("SHORTER", str(n - 2)).replace("GRAM", gram))(
        lambda s, d, n=n: terms.gram_counts(
            v.texts(s, d), ["authorId"], "bodyHtml", n, NLTK_ENGLISH, None, across=["createdAt", "id"]
        )
    )
SMOOTH = (
    GRAMS
    + """, df AS (SELECT term, count(*) AS df FROM g GROUP BY 1), docs AS (SELECT count(DISTINCT authorId) AS docs FROM g),
  r AS (SELECT authorId, g.term, n * pow(ln((1.0::DOUBLE + docs) / (1 + df)) + 1, 2) AS w FROM g JOIN df USING (term), docs),
  nrm AS (SELECT authorId, sqrt(sum(w * w)) AS nrm FROM r GROUP BY 1)
"""
)
entry("x08_smoothed_tfidf", SMOOTH + f"SELECT authorId, term, round(w / nrm, {DIGITS}) AS w FROM r JOIN nrm USING (authorId)")(
    lambda s, d: _round(terms.smoothed_tfidf(_grams(s, d), "authorId"), "w")
)
entry(
    "x08_capped_features",
    GRAMS + """, c AS (SELECT term, sum(n) AS t FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2000)
    SELECT authorId, term, n FROM g WHERE term IN (SELECT term FROM c)""",
)(lambda s, d: terms.cap_terms(_grams(s, d), 2000).select("authorId", "term", "n"))
STEM_TOKENS = f"""WITH src AS (SELECT doc_id, source AS authorId, unnest({TOKENS}) AS w, generate_subscripts({TOKENS}, 1) AS i FROM documents),
  {dictionary_sql('src', 'porter')},
  k AS (SELECT authorId, doc_id, list(stem ORDER BY i) AS toks FROM src JOIN dict USING (w) WHERE stem NOT IN ({NLTK}) GROUP BY 1, 2)"""
STEM_WORDS = STEM_TOKENS + ", g AS (SELECT authorId, term, count(*) AS n FROM (SELECT authorId, unnest(toks) AS term FROM k) GROUP BY 1, 2)\n"
STEM_GRAMS = STEM_TOKENS + GRAMS[GRAMS.index(",\n  b AS"):]
entry(
    "x08_stemmed_tfidf",
    STEM_WORDS + SMOOTH.removeprefix(GRAMS) + f"SELECT authorId, term, round(w / nrm, {DIGITS}) AS w FROM r JOIN nrm USING (authorId)",
)(lambda s, d: _round(terms.smoothed_tfidf(_grams(s, d, 1, "porter"), "authorId"), "w"))
entry("x08_stemmed_bigram_counts", STEM_GRAMS + "SELECT authorId, term, n FROM g")(lambda s, d: _grams(s, d, 2, "porter"))
entry(
    "x09_author_documents",
    f"""WITH c AS (SELECT source FROM documents GROUP BY 1 HAVING count(*) > 20),
    p AS (SELECT source AS authorId, doc_id, {v.SQL_NORMAL.format('text')} AS t,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE source IN (SELECT source FROM c))
    SELECT authorId, CAST((k - 1) // 50 AS BIGINT) AS part, md5(string_agg(t, '' ORDER BY doc_id)) AS text_md5 FROM p GROUP BY 1, 2""",
)(lambda s, d: _author_documents(s, d))


def _author_documents(s, d):
    busy = ag.having(ag.count_by(v.texts(s, d), ["authorId"]), "n", 20)
    kept = v.texts(s, d).join(busy, "authorId", "left_semi").withColumn("t", words.normalise("bodyHtml"))
    parts = ag.concat_parts(kept, "authorId", "t", ["id"], 50)
    return parts.select("authorId", "part", F.md5("text").alias("text_md5"))


entry(
    "x10_index_and_label",
    """SELECT doc_id AS id, source AS author, CAST(dense_rank() OVER (ORDER BY source) AS BIGINT) AS author_index FROM documents""",
)(lambda s, d: nb.with_dense_code(v.texts(s, d).select("id", F.col("authorId").alias("author")), "author", "author_index").select(
    "id", "author", "author_index"
))
