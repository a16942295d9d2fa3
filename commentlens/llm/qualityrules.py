"""Quality rules: counts of a text, and its divergence from its language's reference.

The references are the summed character-class and common-word histograms of all
documents of a language. A document of enough words is compared with its
language's by the Jensen-Shannon distance; too large a distance in either
histogram rejects it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentlens.llm.shared import small_batches
from commentlens.session import once

LEAST_WORDS = 50
REPEATED_SHARE = 50
REFERENCE_WORDS = 30
CHARACTER_LIMIT = 0.30
WORD_LIMIT = 0.42
LANGUAGES_AT_ONCE = 256
KNOWN_WORDS = 500_000

# Characters that count as symbols, and the bytes of each class of characters.
_SYMBOLS = b"#*$%&|<>"
_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\n\r\x0b\x0c",
    b".,;:?'\"()-",
    bytes(range(0xC2, 0xF5)),  # first bytes of all characters beyond ASCII
    bytes(range(0x80, 0xC0)),  # their further bytes, which count for nothing
)
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS_OF[list(_bytes)] = _k
_NOTHING = len(_CLASSES) - 1
N_CLASSES = len(_CLASSES) + 1

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def classes(raw: bytes) -> np.ndarray:
    """Characters of each class: lower, upper, digit, space, punctuation, beyond ASCII, (none), other."""
    found = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=N_CLASSES)
    found[_NOTHING] = 0
    return found


def repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found more than once."""
    if len(words) < 4:
        return 0
    codes: defaultdict[bytes, int] = defaultdict()
    codes.default_factory = codes.__len__
    ids = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    base = len(codes)
    pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
    window = pairs[:-1] * base + ids[2:]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    often = count[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= often
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines and repeated words of a whole text."""
    if text is None:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    letters = sum(map(len, words)) - len(raw) + len(text)  # bytes in words, less the further bytes of characters
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), letters, symbols, len(lines) - len(set(lines)), repeated(words)


def _reference_rows(text: str, lang: str):
    """Partial histograms of every language: character classes under ``k``, words under ``word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters: dict = defaultdict(lambda: np.zeros(N_CLASSES, np.int64))
        words: dict = defaultdict(Counter)

        def rows() -> pa.RecordBatch:
            made = [(g, k, None, int(n)) for g, h in characters.items() for k, n in enumerate(h) if n]
            made += [(g, None, w.decode("utf-8", "replace"), n) for g, c in words.items() for w, n in c.items()]
            characters.clear()
            words.clear()
            columns = list(zip(*made, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "k", "word", "n"])

        for batch in batches:
            for value, group in zip(batch.column(text).to_pylist(), batch.column(lang).to_pylist(), strict=True):
                if value:
                    raw = value.encode("utf-8", "surrogatepass")
                    characters[group] += classes(raw)
                    words[group].update(raw.lower().split())
            if sum(map(len, words.values())) > KNOWN_WORDS:
                yield rows()
        yield rows()

    return run


def references(documents: DataFrame, n: int = REFERENCE_WORDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """Histograms of every language over all its documents: rows ``lang, characters, words, counts, total``.

    Documents without a language form one of their own. ``words`` are the
    language's ``n`` most frequent ones, ties by the word. Words are counted
    within tasks and flushed in bounded tables, so a language with most of the
    documents only costs sums.
    """
    own = documents.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    part = once(
        own.mapInArrow(_reference_rows("text", "lang"), "lang string, k int, word string, n long").groupBy("lang", "k", "word").agg(F.sum("n").alias("n")),
        "histograms",
    )
    characters = part.where(F.col("k").isNotNull()).groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("characters"))
    words = part.where(F.col("word").isNotNull())
    ranked = words.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("place") <= n)
    common = ranked.groupBy("lang").agg(
        F.collect_list(F.struct("place", "word", "n")).alias("common")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    key = lambda df, name: df.withColumnRenamed("lang", name)
    joined = characters.join(key(common, "_c"), F.col("lang").eqNullSafe(F.col("_c")), "left").join(key(totals, "_t"), F.col("lang").eqNullSafe(F.col("_t")), "left")
    return joined.select("lang", "characters", "common", "total")


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, with logarithms to base 2 (0 to 1)."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(parts.sum() / 2, 0.0)))


def _measurer(shared, text: str, lang: str, out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {
            group: (characters, {w: i for i, w in enumerate(common)}, histogram)
            for group, (characters, common, histogram) in shared.value.items()
        }
        for batch in batches:
            rows, by_class, by_word = [], [], []
            for value, group in zip(batch.column(text).to_pylist(), batch.column(lang).to_pylist(), strict=True):
                rows.append(counts(value))
                reference = known.get(group)
                if reference is None or not rows[-1][0]:
                    by_class.append(None)
                    by_word.append(None)
                    continue
                raw = value.encode("utf-8", "surrogatepass")
                characters, places, histogram = reference
                by_class.append(distance(classes(raw).astype(float), characters))
                words = raw.lower().split()
                own = np.zeros(len(places) + 1)
                for w, n in Counter(filter(places.__contains__, words)).items():
                    own[places[w]] = n
                own[-1] = len(words) - own.sum()
                by_word.append(distance(own, histogram))
            columns = {name: batch.column(name) for name in batch.schema.names}
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            columns |= {name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(names)}
            columns |= {"class_distance": pa.array(by_class, pa.float64()), "word_distance": pa.array(by_word, pa.float64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in out], names=out)

    return run


def judged(
    documents: DataFrame,
    least_words: int = LEAST_WORDS,
    character_limit: float = CHARACTER_LIMIT,
    word_limit: float = WORD_LIMIT,
    text: str = "text",
    lang: str = "lang",
    keep_text: bool = True,
) -> DataFrame:
    """The documents with their counts, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept`` (runs jobs).

    ``base_failed``: fewer than ``least_words`` words, or more than half of the
    words in repeated windows. Texts of fewer words are never judged by their
    distances, which need a minimum of evidence. Null, empty and blank texts
    have no words and no distances and fail; repeated rows get equal rows.
    Languages are referred to in blocks, so a broadcast holds a bounded number
    of them however many there are.
    """
    spark = documents.sparkSession
    small_batches(spark)
    base = documents.withColumn("_lang", F.col(lang).cast("string"))
    stored = once(references(documents, text=text, lang=lang), "references")
    blocks = -(-stored.count() // LANGUAGES_AT_ONCE) or 1
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    frames = []
    for k in range(blocks):
        shared = spark.sparkContext.broadcast({r["lang"]: _reference(r) for r in stored.where(block("lang") == k).collect()})
        full = base if blocks == 1 else base.where(block("_lang") == k)
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            full = full.withColumn(name, F.lit(0).cast("long"))
        full = full.withColumns({c: F.lit(None).cast("double") for c in ("class_distance", "word_distance")})
        out = full.drop("_lang") if keep_text else full.drop("_lang", text)
        frames.append(full.mapInArrow(_measurer(shared, text, "_lang", out.columns), out.schema))
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > character_limit) | (F.coalesce("word_distance", F.lit(0.0)) > word_limit)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def _reference(row) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    characters = np.zeros(N_CLASSES)
    for k, n in (row["characters"] or {}).items():
        characters[k] = n
    common = sorted(row["common"] or [], key=lambda c: c["place"])
    histogram = np.array([c["n"] for c in common] + [(row["total"] or 0) - sum(c["n"] for c in common)], float)
    return characters, [c["word"].encode() for c in common], histogram
