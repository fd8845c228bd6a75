"""The stemmer word by word, to compare the column expressions with."""

from __future__ import annotations

import re

from termweave.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(word: str) -> str:
    """c or v per letter; y is a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _short(word: str) -> bool:
    """Ends consonant-vowel-consonant (not w, x, y), or is vowel-consonant."""
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _plural(word: str) -> str:
    if word.endswith("sses") or (word.endswith("ies") and len(word) > 4):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    base = re.sub("(ed|ing)$", "", word)
    if base == word or "v" not in _shape(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short(base) else base


def _swap(word: str, rules: dict[str, str]) -> str:
    for suffix, new in rules.items():
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            return base + new if _measure(base) > 0 else word
    return word


def _derivation(word: str) -> str:
    swapped = _swap(word, STEP_2)
    if word.endswith("alli") and swapped != word:
        return _derivation(swapped)
    if word.endswith("logi") and _measure(word[:-3]) > 0:
        return word[:-1]
    return swapped


def _ending(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            fits = _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t")))
            return base if fits else word
    return word


def _final(word: str) -> str:
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem_word(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    return _final(_ending(_swap(_derivation(word), STEP_3)))
