"""Suffix stripping after Porter (1980), with the usual later additions for short and irregular words.

A word is a struct of its letters `w` and its shape `s`, which has a c or v per letter. The shape of a
beginning of a word is the beginning of its shape, and no rule adds a y, so it is made once a word and cut
and lengthened with it. A measure above 0 is a shape with "vc" in it, one above 1 has it twice. The rules
are written as SQL, which Spark reads in one go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Irregular words and their stems.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# Suffixes of steps 2, 3 and 4, tried in this order.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _word(letters: str, shape: str) -> str:
    return f"named_struct('w', {letters}, 's', {shape})"


def _bind(value: str, name: str, use: Callable[[str], str]) -> str:
    """use(name), with `value` worked out once under that name."""
    return f"transform(array({value}), {name} -> {use(name)})[0]"


def _shape(letters: str) -> str:
    """c or v per letter; y is a vowel after a consonant."""
    plain = f"regexp_replace(regexp_replace({letters}, '[^aeiouy]', 'c'), '[aeiou]', 'v')"
    add = "a || CASE WHEN x = 'y' AND endswith(a, 'c') THEN 'v' WHEN x = 'y' THEN 'c' ELSE x END"
    return f"CASE WHEN contains({letters}, 'y') THEN aggregate(split({plain}, ''), '', (a, x) -> {add}) ELSE {plain} END"


def _cut(word: str, n: int) -> str:
    return _word(f"left({word}.w, length({word}.w) - {n})", f"left({word}.s, length({word}.s) - {n})")


def _add(word: str, end: str) -> str:
    shape = "".join("v" if letter in "aeiou" else "c" for letter in end)
    return _word(f"{word}.w || '{end}'", f"{word}.s || '{shape}'")


def _first(word: str, *cases: tuple[str, str]) -> str:
    """The word of the first case that holds, or the word as it is."""
    whens = " ".join(f"WHEN {holds} THEN {then}" for holds, then in cases)
    return f"CASE {whens} ELSE {word} END"


def _ends(word: str, *ends: str) -> str:
    return "(" + " OR ".join(f"endswith({word}.w, '{end}')" for end in ends) + ")"


def _above_0(word: str) -> str:
    return f"contains({word}.s, 'vc')"


def _above_1(word: str) -> str:
    return f"{word}.s LIKE '%vc%vc%'"


def _short(word: str) -> str:
    """Ends consonant-vowel-consonant (not w, x, y), or is vowel-consonant."""
    return f"({word}.s = 'vc' OR (endswith({word}.s, 'cvc') AND NOT {_ends(word, 'w', 'x', 'y')}))"


def _plural(word: str) -> str:
    two = f"{_ends(word, 'sses')} OR ({_ends(word, 'ies')} AND length({word}.w) > 4)"
    return _first(word, (two, _cut(word, 2)), (f"{_ends(word, 's')} AND NOT {_ends(word, 'ss')}", _cut(word, 1)))


def _repaired(base: str) -> str:
    """A word without its -ed or -ing."""
    double = f"length({base}.w) > 1 AND right({base}.w, 1) = substr({base}.w, -2, 1) AND endswith({base}.s, 'c')"
    return _first(
        base,
        (_ends(base, "at", "bl", "iz"), _add(base, "e")),
        (double, _first(_cut(base, 1), (_ends(base, "l", "s", "z"), base))),
        (f"{_above_0(base)} AND NOT {_above_1(base)} AND {_short(base)}", _add(base, "e")),
    )


def _past(word: str) -> str:
    def without(n: int) -> str:
        return _bind(_cut(word, n), "base", lambda base: _first(word, (f"contains({base}.s, 'v')", _repaired(base))))

    return _first(
        word,
        (_ends(word, "ied"), _first(_cut(word, 2), (f"length({word}.w) = 4", _cut(word, 1)))),
        (_ends(word, "eed"), _first(word, (_above_0(_cut(word, 3)), _cut(word, 1)))),
        (_ends(word, "ed"), without(2)),
        (_ends(word, "ing"), without(3)),
    )


def _last_y(word: str) -> str:
    after = f"length({word}.w) > 2 AND endswith({_cut(word, 1)}.s, 'c')"
    return _first(word, (f"{_ends(word, 'y')} AND {after}", _word(f"left({word}.w, length({word}.w) - 1) || 'i'", f"{word}.s")))


def _swap(word: str, rules: dict[str, str]) -> str:
    cases = []
    for suffix, new in rules.items():
        # The base is bound only where the suffix fits.
        swapped = _bind(_cut(word, len(suffix)), "base", lambda base, new=new: _first(word, (_above_0(base), _add(base, new))))
        cases.append((_ends(word, suffix), swapped))
    return _first(word, *cases)


def _derivation(word: str) -> str:
    """Step 2; what comes out of -alli is looked at again."""
    again = _bind(_swap(word, STEP_2), "swapped", lambda swapped: _swap(swapped, STEP_2))
    logi = f"{_ends(word, 'logi')} AND {_above_0(_cut(word, 3))}"
    return _first(_swap(word, STEP_2), (f"{_ends(word, 'alli')} AND {_above_0(_cut(word, 4))}", again), (logi, _cut(word, 1)))


def _ending(word: str) -> str:
    cases = []
    for suffix in STEP_4:
        fits = _above_1("base") + (f" AND {_ends('base', 's', 't')}" if suffix == "ion" else "")
        cases.append((_ends(word, suffix), _bind(_cut(word, len(suffix)), "base", lambda base, fits=fits: _first(word, (fits, base)))))
    return _first(word, *cases)


def _last_e(word: str) -> str:
    def without(base: str) -> str:
        return _first(word, (f"{_above_1(base)} OR ({_above_0(base)} AND NOT {_short(base)})", base))

    return _first(word, (_ends(word, "e"), _bind(_cut(word, 1), "base", without)))


def _last_l(word: str) -> str:
    return _first(word, (f"{_ends(word, 'll')} AND {_above_1(_cut(word, 1))}", _cut(word, 1)))


def stem(term: str) -> Column:
    """The stem of a lower-cased term (SQL: a column or an expression), null for null; meant for a distinct vocabulary."""
    word = _word(term, _shape(term))
    steps = [_plural, _past, _last_y, _derivation, lambda word: _swap(word, STEP_3), _ending, _last_e, _last_l]
    for k, step in enumerate(steps):
        word = _bind(word, f"word{k}", step)
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    return F.expr(f"CASE {term} {irregular} ELSE CASE WHEN length({term}) <= 2 THEN {term} ELSE {word}.w END END")
