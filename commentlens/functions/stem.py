"""English stems (Porter 1980 with the usual later amendments, and Porter 2) as ordered column rewrites.

A rule set is a list of steps; a step is a few columns computed from those
before, in SQL text that Spark and the check engine read alike. Every step looks
at the end of the word so far and rewrites it by the first suffix that fits. The
rules run over the *distinct* words of a corpus, a stem dictionary, which is
joined back; so their cost follows the vocabulary, and all of it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Porter: fixed values ---------------------------------------------------

# Irregular forms of the amended Porter rules.
PORTER_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix pairs of steps 2 and 3 (replaced when the measure is positive).
PORTER_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
PORTER_STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
# Suffixes of step 4 (dropped when the measure exceeds one).
PORTER_STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()

# --- Porter 2: fixed values of the published algorithm ------------------------

P2_EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky",
    "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
P2_KEEP_AFTER_1A = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
P2_R1_PREFIXES = ["gener", "commun", "arsen"]
P2_DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
P2_LI = "cdeghkmnrt"
P2_STEP2 = [
    ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("entli", "ent"), ("izer", "ize"),
    ("ization", "ize"), ("ational", "ate"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("aliti", "al"),
    ("alli", "al"), ("fulness", "ful"), ("ousli", "ous"), ("ousness", "ous"), ("iveness", "ive"),
    ("iviti", "ive"), ("biliti", "ble"), ("bli", "ble"), ("fulli", "ful"), ("lessli", "less"),
]
P2_STEP3 = [
    ("tional", "tion"), ("ational", "ate"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
P2_STEP4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split()

# Letter classes; a y that counts as a consonant is written Y while the rules run.
V, C = "[aeiouy]", "[^aeiouy]"
VOWEL = V
MEASURE_1 = f"{V}{C}"  # one vowel run closed by a consonant, at least
MEASURE_2 = f"{V}{C}+{V}+{C}"
SHORT_END = f"({C}{V}[^aeiouywxY]|^{V}{C})$"


@dataclass(frozen=True)
class Dialect:
    """How an engine writes the few functions that differ."""

    matches: Callable[[str, str], str]
    replace_all: Callable[[str, str, str], str]


SPARK = Dialect(lambda x, p: f"({x} RLIKE '{p}')", lambda x, p, r: f"regexp_replace({x}, '{p}', '{r}')")
ORACLE = Dialect(
    lambda x, p: f"regexp_matches({x}, '{p}')", lambda x, p, r: f"regexp_replace({x}, '{p}', '{r.replace('$', chr(92))}', 'g')"
)

Step = dict[str, str]


def _ends(x: str, *suffixes: str) -> str:
    return "(" + " OR ".join(f"right({x}, {len(s)}) = '{s}'" for s in suffixes) + ")"


def _cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def _case(branches: list[tuple[str, str]], otherwise: str = "x") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {r}" for c, r in branches) + f" ELSE {otherwise} END"


def _if(condition: str, then: str, otherwise: str = "x") -> str:
    return _case([(condition, then)], otherwise)


def _first_suffix(pairs: list[tuple[str, str]], fits: Callable[[str, str], str]) -> list[tuple[str, str]]:
    """Branches that replace the first suffix found, if its stem fits; a suffix that is found but doesn't fit ends the search."""
    return [(_ends("x", s), _if(fits(_cut("x", len(s)), s), f"{_cut('x', len(s))} || '{new}'")) for s, new in pairs]


def _listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _marked(d: Dialect, x: str) -> str:
    """Write Y for y at the start, after a vowel, and after a y that is one."""
    start = _if(f"left({x}, 1) = 'y'", f"'Y' || substring({x}, 2)", x)
    return d.replace_all(d.replace_all(start, "([aeiou])y", "$1Y"), "yy", "yY")


def _irregular(pairs: dict[str, str]) -> str:
    return "CASE word " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs.items()) + " END"


def porter_steps(d: Dialect) -> list[Step]:
    """Steps from ``word`` to ``x``; ``done`` is the stem of words that the rules leave alone."""

    def measure(n: int) -> Callable[[str, str], str]:
        return lambda stem, _: d.matches(stem, MEASURE_1 if n == 1 else MEASURE_2)

    low = "lower(w)"
    double = "lower(right(x, 1)) = lower(left(right(x, 2), 1)) AND length(x) > 1 AND " + d.matches("x", f"{C}$")
    single = f"{d.matches('x', MEASURE_1)} AND NOT {d.matches('x', MEASURE_2)}"
    step4 = [(s, "") for s in sorted(PORTER_STEP4, key=len, reverse=True)]

    def fits4(stem: str, suffix: str) -> str:
        enough = d.matches(stem, MEASURE_2)
        return f"{enough} AND {_ends(stem, 's', 't')}" if suffix == "ion" else enough

    ed, ing = _cut("x", 2), _cut("x", 3)
    vowel = lambda stem: d.matches(stem, VOWEL)
    return [
        {"word": low},
        {"done": f"coalesce({_irregular(PORTER_IRREGULAR)}, {_if('length(word) <= 2', 'word', 'NULL')})", "x": _marked(d, "word")},
        # plurals
        {"x": _case([
            (_ends("x", "sses"), _cut("x", 2)),
            (_ends("x", "ies"), _if("length(x) = 4", _cut("x", 1), _cut("x", 2))),
            (f"{_ends('x', 's')} AND NOT {_ends('x', 'ss')}", _cut("x", 1)),
        ])},
        # past and continuous forms; cut says that a form was taken off
        {
            "x": _case([
                (_ends("x", "ied"), _if("length(x) = 4", _cut("x", 1), _cut("x", 2))),
                (_ends("x", "eed"), _if(d.matches(_cut("x", 3), MEASURE_1), _cut("x", 1))),
                (f"{_ends('x', 'ed')} AND {vowel(ed)}", ed),
                (f"{_ends('x', 'ing')} AND {vowel(ing)}", ing),
            ]),
            "cut": f"NOT {_ends('x', 'ied', 'eed')} AND (({_ends('x', 'ed')} AND {vowel(ed)}) OR ({_ends('x', 'ing')} AND {vowel(ing)}))",
        },
        {"x": _case([
            ("NOT cut", "x"),
            (_ends("x", "at", "bl", "iz"), "x || 'e'"),
            (double, _if(_ends("x", "l", "s", "z"), "x", _cut("x", 1))),
            (f"{single} AND {d.matches('x', SHORT_END)}", "x || 'e'"),
        ])},
        # final y
        {"x": _if("right(x, 1) = 'y' AND length(x) > 2", f"{_cut('x', 1)} || 'i'")},
        {"x": _if(f"{_ends('x', 'alli')} AND {d.matches(_cut('x', 4), MEASURE_1)}", _cut("x", 2))},
        {"x": _case([
            (_ends("x", "logi"), _if(d.matches(_cut("x", 3), MEASURE_1), _cut("x", 1))),
            *_first_suffix(PORTER_STEP2, measure(1)),
        ])},
        {"x": _case(_first_suffix(PORTER_STEP3, measure(1)))},
        {"x": _case(_first_suffix(step4, fits4))},
        # final e and double l
        {"x": _if(
            f"{_ends('x', 'e')} AND ({d.matches(_cut('x', 1), MEASURE_2)} OR ({d.matches(_cut('x', 1), MEASURE_1)} "
            f"AND NOT {d.matches(_cut('x', 1), SHORT_END)}))",
            _cut("x", 1),
        )},
        {"x": _if(f"{_ends('x', 'll')} AND {d.matches(_cut('x', 1), MEASURE_2)}", _cut("x", 1))},
        {"stem": "coalesce(done, lower(x))"},
    ]


def english_steps(d: Dialect) -> list[Step]:
    """Steps of Porter 2, with the starts ``r1`` and ``r2`` of its two regions."""
    quote = "chr(39)"
    start = f"^{C}*{V}+{C}"
    rest = "substring(x, r1 + 1)"
    prefix = f"^({'|'.join(P2_R1_PREFIXES)})"

    def region(x: str, otherwise: str) -> str:
        return _if(d.matches(x, start), f"length(regexp_extract({x}, '{start}', 0))", otherwise)

    def longest(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
        return sorted(pairs, key=lambda p: -len(p[0]))

    def within(r: str) -> Callable[[str, str], str]:
        return lambda stem, suffix: f"length(x) - {len(suffix)} >= {r}"

    def fits2(stem: str, suffix: str) -> str:
        inside = within("r1")(stem, suffix)
        extra = {"ogi": _ends(stem, "l"), "li": _ends(stem, *P2_LI)}.get(suffix)
        return f"{inside} AND {extra}" if extra else inside

    def fits3(stem: str, suffix: str) -> str:
        return f"{within('r1')(stem, suffix)} AND {within('r2')(stem, suffix)}" if suffix == "ative" else within("r1")(stem, suffix)

    def fits4(stem: str, suffix: str) -> str:
        inside = within("r2")(stem, suffix)
        return f"{inside} AND {_ends(stem, 's', 't')}" if suffix == "ion" else inside

    forms = ["eedly", "ingly", "edly", "eed", "ing", "ed"]
    found = [(_ends("x", s), s) for s in forms]
    taken = [
        (has, _if(f"length(x) - {len(s)} >= r1", f"{_cut('x', len(s))} || 'ee'"))
        if s.startswith("eed")
        else (has, _if(d.matches(_cut("x", len(s)), VOWEL), _cut("x", len(s))))
        for has, s in found
    ]
    cut = [(has, "false" if s.startswith("eed") else d.matches(_cut("x", len(s)), VOWEL)) for has, s in found]
    mark = f"{quote} || 's'"
    return [
        {"word": "replace(lower(w), '’', chr(39))"},
        {"short": "length(word) <= 2", "word": _if(f"length(word) > 2 AND left(word, 1) = {quote}", "substring(word, 2)", "word")},
        {"done": f"CASE WHEN short THEN word ELSE {_irregular(P2_EXCEPTIONS)} END", "x": _marked(d, "word")},
        {"r1": f"CASE WHEN {d.matches('x', prefix)} THEN length(regexp_extract(x, '{prefix}', 0)) "
               f"WHEN {d.matches('x', start)} THEN length(regexp_extract(x, '{start}', 0)) ELSE length(x) END"},
        {"r2": f"r1 + {region(rest, f'length({rest})')}"},
        {"x": _case([
            (f"right(x, 3) = {mark} || {quote}", _cut("x", 3)),
            (f"right(x, 2) = {mark}", _cut("x", 2)),
            (f"right(x, 1) = {quote}", _cut("x", 1)),
        ])},
        # plurals
        {"x": _case([
            (_ends("x", "sses"), _cut("x", 2)),
            (_ends("x", "ied", "ies"), _if("length(x) > 4", _cut("x", 2), _cut("x", 1))),
            (f"{_ends('x', 's')} AND NOT {_ends('x', 'us', 'ss')} AND length(x) > 2 AND {d.matches(_cut('x', 2), VOWEL)}", _cut("x", 1)),
        ])},
        {"done": f"coalesce(done, {_if(f'x IN {_listed(P2_KEEP_AFTER_1A)}', 'x', 'NULL')})"},
        # past and continuous forms
        {"x": _case(taken), "cut": _case(cut, "false")},
        {"x": _case([
            ("NOT cut", "x"),
            (_ends("x", "at", "bl", "iz"), "x || 'e'"),
            (_ends("x", *P2_DOUBLES), _cut("x", 1)),
            (f"r1 >= length(x) AND {d.matches('x', SHORT_END)}", "x || 'e'"),
        ])},
        # final y
        {"x": _if(f"length(x) > 2 AND {d.matches('x', f'{C}[yY]$')}", f"{_cut('x', 1)} || 'i'")},
        # derivational suffixes
        {"x": _case(_first_suffix(longest([*P2_STEP2, ("ogi", "og"), ("li", "")]), fits2))},
        {"x": _case(_first_suffix(longest([*P2_STEP3, ("ative", "")]), fits3))},
        {"x": _case(_first_suffix(longest([(s, "") for s in [*P2_STEP4, "ion"]]), fits4))},
        # final e and l
        {"x": _case([
            (_ends("x", "e"), _if(
                f"length(x) - 1 >= r2 OR (length(x) - 1 >= r1 AND NOT {d.matches(_cut('x', 1), SHORT_END)})", _cut("x", 1)
            )),
            (f"{_ends('x', 'll')} AND length(x) - 1 >= r2", _cut("x", 1)),
        ])},
        {"stem": "coalesce(done, replace(x, 'Y', 'y'))"},
    ]


RULES = {"porter": porter_steps, "english": english_steps}


def dictionary(words: DataFrame, rules: str = "porter", word: str = "word", *more: Column) -> DataFrame:
    """Stem of each distinct word: rows ``word, stem``. Nulls are left out.

    ``more`` are aggregates over the rows of a word, named, which follow its stem.
    """
    known = words.where(F.col(word).isNotNull())
    found = known.groupBy(F.col(word).alias("w")).agg(*more) if more else known.select(F.col(word).alias("w")).distinct()
    named = found.columns[1:]
    for step in RULES[rules](SPARK):
        # one projection a step, so no step's text is repeated inside the next
        found = found.withColumns({name: F.expr(text) for name, text in step.items()})
    return found.select(F.col("w").alias(word), "stem", *named)


def dictionary_sql(source: str, rules: str = "porter", name: str = "dict") -> str:
    """The same rules as common table expressions of the check engine: ``source`` has ``w``; the last one, ``name``, has ``w, stem``."""
    parts = [f"{name}_0 AS (SELECT DISTINCT w FROM {source} WHERE w IS NOT NULL)"]
    steps = RULES[rules](ORACLE)
    known: list[str] = ["w"]
    for k, step in enumerate(steps):
        last = k == len(steps) - 1
        kept = ["w"] if last else [c for c in known if c not in step]
        columns = ", ".join([*kept, *[f"{text} AS {c}" for c, text in step.items()]])
        own = name if last else f"{name}_{k + 1}"
        parts.append(f"{own} AS (SELECT {columns} FROM {name}_{k})")
        known = [*kept, *step]
    return ",\n".join(parts)
