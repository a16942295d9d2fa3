"""Column functions on comment texts: cleaning, tokens, n-grams.

All of them are JVM expressions, so they stay in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns: word characters are Unicode letters, digits and underscore.
TAG_ONE_LINE = r"<[^\n]*?>"
TAG_ANY = r"<[^>]*>"
EMOTICON = r"[:;=]-?[()DP]"
NON_WORD = r"[^\p{L}\p{N}_]+"
WORD_INNER = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"
ASCII_PUNCT = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+"""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_tags(text: Column | str) -> Column:
    """Remove tags that do not cross a line end."""
    return F.regexp_replace(_col(text), TAG_ONE_LINE, "")


def strip_markup(text: Column | str) -> Column:
    """Remove tags, also those that cross lines."""
    return F.regexp_replace(_col(text), TAG_ANY, "")


def normalise(text: Column | str) -> Column:
    """Strip markup, lower, squeeze non-word runs to a blank, append the emoticons."""
    bare = strip_markup(text)
    faces = F.regexp_extract_all(bare, F.lit(EMOTICON), F.lit(0))
    words = F.regexp_replace(F.lower(bare), NON_WORD, " ")
    return F.concat(words, F.translate(F.array_join(faces, " "), "-", ""))


def split_blanks(text: Column | str) -> Column:
    """Whitespace tokens."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def split_words(text: Column | str) -> Column:
    """Lower-case tokens between non-word runs."""
    return F.filter(F.split(F.lower(_col(text)), NON_WORD), lambda w: w != "")


def alphabetic_words(text: Column | str, longer_than: int = 3) -> Column:
    """Lower-case words made of letters only and longer than a limit."""
    return F.filter(
        F.split(F.lower(_col(text)), NON_WORD),
        lambda w: w.rlike(r"^\p{L}+$") & (F.length(w) > longer_than),
    )


def tidy_words(text: Column | str) -> Column:
    """Lower-case words without punctuation; inner apostrophes and dots stay."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_INNER), F.lit(0))


def squish(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"\s+", " "))


def drop_digits_and_handles(text: Column | str) -> Column:
    """Squeeze blanks, then drop digits, then drop ``@name`` with the blanks after it."""
    without_digits = F.regexp_replace(squish(text), "[0-9]", "")
    return F.regexp_replace(without_digits, r"@[\p{L}\p{N}_]+ *", "")


def corpus_words(text: Column | str, stop: list[str]) -> Column:
    """Tokens after lower, digits out, ASCII punctuation out, listed words out."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(_col(text)), "[0-9]+", ""), ASCII_PUNCT, "")
    return F.filter(F.split(bare, r"\s+"), lambda w: (w != "") & ~w.isin(stop))


def corpus_clean(text: Column | str, stop: list[str]) -> Column:
    """The cleaned text of :func:`corpus_words`, blanks squeezed."""
    return F.array_join(corpus_words(text, stop), " ")


def without(tokens: Column | str, words: list[str]) -> Column:
    """Drop listed words from a token array."""
    return F.filter(_col(tokens), lambda w: ~w.isin(words))


def ngrams(tokens: Column | str, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens joined by a blank, built inside the row."""
    if n == 1:
        return _col(tokens)

    def joined(arr: Column) -> Column:
        count = F.greatest(F.size(arr) - F.lit(n - 1), F.lit(0))
        grams = F.slice(arr, F.lit(1), count)
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(arr, F.lit(k + 1), count), lambda a, b: F.concat_ws(" ", a, b))
        return grams

    # bound once: the tokens would be made anew wherever their expression stands
    return F.transform(F.array(_col(tokens)), joined)[0]


def one_per_row(rows: DataFrame, tokens: Column | str, keep: list[str], name: str) -> DataFrame:
    """A row per token; the tokens are made once.

    For a plain ``explode`` Spark infers a filter on the size of the list, which
    makes the list a second time.
    """
    return rows.select(*keep, F.posexplode_outer(_col(tokens)).alias("_place", name)).where("_place IS NOT NULL").drop("_place")
