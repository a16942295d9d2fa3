"""Stemmers word by word, against which the column rewrites are tested."""

from __future__ import annotations

from commentlens.functions.stem import (
    P2_DOUBLES,
    P2_EXCEPTIONS,
    P2_KEEP_AFTER_1A,
    P2_LI,
    P2_R1_PREFIXES,
    P2_STEP2,
    P2_STEP3,
    P2_STEP4,
    PORTER_IRREGULAR,
    PORTER_STEP2,
    PORTER_STEP3,
    PORTER_STEP4,
)

VOWELS = "aeiou"

# --- Porter ---------------------------------------------------------------

def _shape(word: str) -> str:
    """Letters as ``c``/``v``; ``y`` is a vowel after a consonant."""
    out = []
    for i, ch in enumerate(word):
        vowel = ch in VOWELS or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape[-3:] == "cvc" and word[-1] not in "wxy") or shape == "vc"


def _replace_first(word: str, pairs, minimum: int = 1) -> str:
    """Apply the first pair whose suffix fits; keep the word when its stem is too short."""
    for suffix, new in pairs:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) >= minimum else word
    return word


def _porter_step2(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _porter_step2(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace_first(word, PORTER_STEP2)


def _porter_step4(word: str) -> str:
    for suffix in sorted(PORTER_STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if fits else word
    return word


def porter(word: str) -> str:
    """Porter stem with the amendments common in Python toolkits."""
    word = word.lower()
    if word in PORTER_IRREGULAR:
        return PORTER_IRREGULAR[word]
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ies"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and continuous forms
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            stem = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                if stem.endswith(("at", "bl", "iz")):
                    word = stem + "e"
                elif _double_consonant(stem):
                    word = stem if stem[-1] in "lsz" else stem[:-1]
                elif _measure(stem) == 1 and _short_end(stem):
                    word = stem + "e"
                else:
                    word = stem
                break
    # final y
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    word = _porter_step2(word)
    word = _replace_first(word, PORTER_STEP3)
    word = _porter_step4(word)
    # final e and double l
    if word.endswith("e"):
        stem = word[:-1]
        size = _measure(stem)
        if size > 1 or (size == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


# --- Porter 2 (English Snowball) --------------------------------------------

P2_VOWELS = "aeiouy"  # a consonantal y is written Y


def _region(word: str, start: int) -> int:
    for i in range(start + 1, len(word)):
        if word[i] not in P2_VOWELS and word[i - 1] in P2_VOWELS:
            return i + 1
    return len(word)


def _p2_short_syllable(word: str) -> bool:
    if len(word) == 2:
        return word[0] in P2_VOWELS and word[1] not in P2_VOWELS
    return (
        len(word) > 2
        and word[-3] not in P2_VOWELS
        and word[-2] in P2_VOWELS
        and word[-1] not in P2_VOWELS + "wxY"
    )


def _longest(word: str, suffixes) -> str | None:
    fits = [s for s in suffixes if word.endswith(s)]
    return max(fits, key=len) if fits else None


def english(word: str) -> str:
    """Porter 2 stem."""
    word = word.lower().replace("’", "'")
    if len(word) <= 2:
        return word
    word = word.removeprefix("'")
    if word in P2_EXCEPTIONS:
        return P2_EXCEPTIONS[word]
    marked = []
    for i, ch in enumerate(word):
        marked.append("Y" if ch == "y" and (i == 0 or marked[-1] in P2_VOWELS) else ch)
    word = "".join(marked)
    prefix = next((p for p in P2_R1_PREFIXES if word.startswith(p)), None)
    r1 = len(prefix) if prefix else _region(word, 0)
    r2 = _region(word, r1)

    for suffix in ("'s'", "'s", "'"):
        if word.endswith(suffix):
            word = word[: -len(suffix)]
            break
    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")):
        if any(ch in P2_VOWELS for ch in word[:-2]):
            word = word[:-1]
    if word in P2_KEEP_AFTER_1A:
        return word
    # past and continuous forms
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if suffix in ("eed", "eedly"):
        if len(word) - len(suffix) >= r1:
            word = word[: -len(suffix)] + "ee"
    elif suffix and any(ch in P2_VOWELS for ch in word[: -len(suffix)]):
        word = word[: -len(suffix)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif word.endswith(tuple(P2_DOUBLES)):
            word = word[:-1]
        elif r1 >= len(word) and _p2_short_syllable(word):
            word += "e"
    # final y
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in P2_VOWELS:
        word = word[:-1] + "i"
    # derivational suffixes
    pairs = dict(P2_STEP2)
    suffix = _longest(word, list(pairs) + ["ogi", "li"])
    if suffix and len(word) - len(suffix) >= r1:
        stem = word[: -len(suffix)]
        if suffix == "ogi":
            word = word[:-1] if stem.endswith("l") else word
        elif suffix == "li":
            word = stem if stem[-1:] and stem[-1] in P2_LI else word
        else:
            word = stem + pairs[suffix]
    pairs = dict(P2_STEP3)
    suffix = _longest(word, list(pairs) + ["ative"])
    if suffix and len(word) - len(suffix) >= r1:
        if suffix == "ative":
            word = word[:-5] if len(word) - 5 >= r2 else word
        else:
            word = word[: -len(suffix)] + pairs[suffix]
    suffix = _longest(word, P2_STEP4 + ["ion"])
    if suffix and len(word) - len(suffix) >= r2:
        stem = word[: -len(suffix)]
        if suffix != "ion" or stem[-1:] in ("s", "t"):
            word = stem
    # final e and l
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _p2_short_syllable(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


STEMMERS = {"porter": porter, "english": english}
