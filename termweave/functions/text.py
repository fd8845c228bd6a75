"""Column expressions over text: tokens, typed tokens, markup and links."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token starts with a word character, # or @, and goes on with word characters, each of which
# may follow one ' or -. Letters, numbers and _ are the word characters, in every script.
TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"
SHORT_TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){0,24}"
# The word pattern of the corpus-wide vectorizer.
VECTORIZER_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column | str, stops: Sequence[str] = (), pattern: str = TOKEN_PATTERN) -> Column:
    """The tokens of a text in order, lower-cased, without the stop words.

    What may follow in a token is settled by the next character, so nothing is gained by giving characters back: in the
    patterns of this module the last quantifier is possessive, which Java runs as a loop.
    """
    java = pattern + "+" if pattern in (TOKEN_PATTERN, SHORT_TOKEN_PATTERN, VECTORIZER_PATTERN) else pattern
    found = F.regexp_extract_all(F.lower(text), F.lit(java), F.lit(0))
    return F.filter(found, lambda token: ~token.isin(list(stops))) if stops else found


def reaches_min_length(term: Column | str) -> Column:
    """Whether a token of the short pattern is also one of the 3-character pattern."""
    return F.length(F.regexp_replace(term, r"['\-]", "")) >= 3


def _month_day(months: str, days: str) -> tuple[str, str]:
    return rf"(?:{months})\s+(?:{days})\b", rf"(?:{days})\s+(?:{months})"


_LONG = r"Jan(?:uary)?|Mar(?:ch)?|May|July?|Aug(?:ust)?|Oct(?:ober)?|Dec(?:ember)?"
_THIRTY = r"Apr(?:il)?|June?|Sep(?:tember)?|Nov(?:ember)?"
_FEBRUARY = r"Feb(?:ruary)?"
_TO_29 = r"[12]\d|0?[1-9]"
_CALENDAR = [
    _month_day(_LONG, rf"3[01]|{_TO_29}"),
    _month_day(_THIRTY, rf"30|{_TO_29}"),
    _month_day(_FEBRUARY, _TO_29),
]
_MONTH_FIRST = "|".join(month_first for month_first, _ in _CALENDAR)
_DAY_FIRST = "|".join(day_first for _, day_first in _CALENDAR)
# A date ends where its year does; what it starts after is settled by the cut into pieces.
_DATE = rf"(?:{_MONTH_FIRST}),\s*\d{{4}}\b|(?:{_DAY_FIRST})\s+\d{{4}}\b"
_TIME = (
    r"(?:0\d|1[0-2])\.?[0-5]\d(?:[ap]\.m\.|[ap]m)"
    r"|(?:[01]?\d|2[0-3]):[0-5]\d:[0-5]\d"
)
_LETTER = r"[\p{L}\p{N}_]"
_AMOUNT = r"[+\-]?(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.\d+)?"

# Text is cut into tags, dates, opening brackets and chunks without spaces.
PIECES = rf"(?i)<[^<>]+>|{_DATE}|[^\s(<]+|\S"
# A piece is of the first type that fits it whole, less the closing signs at its end, which are tokens by themselves.
CLOSING = r"[.,:;!?)]*"
PIECE_TYPES = [
    ("HTMLTAG", r"<[^<>]+>"),
    ("DATE", rf"(?i)(?:{_DATE})"),
    ("TIME", rf"(?i)(?:{_TIME})"),
    ("PERCENT", rf"{_AMOUNT}%"),
    ("NUMBER", _AMOUNT),
    ("WORD", rf"{_LETTER}+(?:['\-]{_LETTER}+)*'*"),
]


def whole_piece(pattern: str) -> str:
    """The pattern of a piece: the token as group 1, closing signs as group 2."""
    return rf"^({pattern})({CLOSING})$"


def typed_tokens(text: Column | str) -> Column:
    """ARRAY<STRUCT<token, token_type>> of a text, in order and without spaces.

    A piece that fits no type is one OTHER token up to its closing signs. A piece is matched once: the types are branches of one
    pattern, each with a group of its own, and the groups are written one after the other. Between them stands a space and
    <, which no piece has, since spaces are in tags and dates only. Pieces of letters alone, most of them, are words as they are.
    """
    kinds = [name for name, _ in PIECE_TYPES]
    branches = "|".join(f"({pattern})" for _, pattern in [*PIECE_TYPES, ("OTHER", ".*?")])
    # A line separator at the very end is no part of a token; it goes with the match.
    groups = " <".join(f"${k}" for k in range(1, len(kinds) + 3))
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))

    def parts_of(parts: Column) -> Column:
        kind = F.lit("OTHER")
        for k in reversed(range(len(kinds))):
            kind = F.when(parts[k] != "", kinds[k]).otherwise(kind)
        token = F.array_join(F.slice(parts, 1, len(kinds) + 1), "")
        first = F.array(F.struct(token.alias("token"), kind.alias("token_type")))
        rest = parts[len(kinds) + 1]
        signs = F.transform(F.split(rest, ""), lambda x: F.struct(x.alias("token"), F.lit("OTHER").alias("token_type")))
        return F.when(rest == "", first).otherwise(F.concat(first, signs))

    def tokens_of(piece: Column) -> Column:
        cut = F.split(F.regexp_replace(piece, rf"^(?:{branches})({CLOSING})$[\s\S]*", groups), " <")
        fitting = F.filter(F.array(cut), lambda parts: F.size(parts) == len(kinds) + 2)
        plain = F.array(F.struct(piece.alias("token"), F.lit("WORD").alias("token_type")))
        return F.when(piece.rlike(r"^[\p{L}_]+\z"), plain).otherwise(F.flatten(F.transform(fitting, parts_of)))

    return F.filter(F.flatten(F.transform(pieces, tokens_of)), lambda x: x["token"] != "")


HTML_TITLE = r"(?is)<title>(.*?)</title>"
# Applied in this order; each match becomes the given text. Entities of letters come from the standard table.
_LETTER_ENTITIES = [(f"&{name};", chr(code)) for name, code in name2codepoint.items() if chr(code).isalpha() and code < 0x100]
HTML_MARKUP = [
    (r"(?is)<script\b.*?</script>", " "),
    (r"(?is)<style\b.*?</style>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"<[^>]*>", " "),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    *sorted(_LETTER_ENTITIES),
    (r"&(?:[b-zB-Z][A-Za-z]*|[aA](?:[a-ln-zA-Z][A-Za-z]*|m(?:[a-oq-zA-Z][A-Za-z]*|p[A-Za-z]+)?)?);", " "),
    (r"&amp;", "&"),
    (r"[ \t\r\n]+", " "),
]
# The same for all named entities but &amp;, in one pass over a text.
_NAMED = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', **{name[1:-1]: char for name, char in _LETTER_ENTITIES}}
_NUMERIC = r"(?i)^(x[0-9a-f]{1,6}|[0-9]{1,7});"


def decode_names(text: Column) -> Column:
    """`text` with named entities as their characters, other names as a space, and &amp; as it is.

    The text is cut at each & once, and the name that follows is looked up.
    """
    parts = F.split(text, "&")
    known = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])

    def decode(part: Column) -> Column:
        name = F.regexp_extract(part, "^([A-Za-z]+);", 1)
        char = F.coalesce(F.try_element_at(known, name), F.lit(" "))
        stays = (name == "") | name.isin("amp", "Amp")
        return F.when(stays, F.concat(F.lit("&"), part)).otherwise(F.concat(char, F.substring(part, F.length(name) + 2, F.length(part))))

    first, rest = F.slice(parts, 1, 1), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(text.contains("&"), F.array_join(F.concat(first, F.transform(rest, decode)), "")).otherwise(text)


def decode_numbers(text: Column) -> Column:
    """`text` with numeric entities (&#233; &#xe9;) as their characters; those of no character become a space."""
    parts = F.split(text, "&#")

    def decode(part: Column) -> Column:
        digits = F.lower(F.regexp_extract(part, _NUMERIC, 1))
        code = F.when(digits.startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).cast("long")
        is_char = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(is_char, code).otherwise(0x20)), 8, "0")), "UTF-32")
        return F.when(digits == "", F.concat(F.lit("&#"), part)).otherwise(F.concat(char, F.regexp_replace(part, _NUMERIC, "")))

    first, rest = F.slice(parts, 1, 1), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(text.contains("&#"), F.array_join(F.concat(first, F.transform(rest, decode)), "")).otherwise(text)


def html_title(html: Column | str) -> Column:
    """The title of an HTML page, empty when it has none."""
    return F.regexp_extract(html, HTML_TITLE, 1)


def strip_markup(html: Column | str) -> Column:
    """The text of an HTML page without scripts, comments, tags and entities."""
    text = F.col(html) if isinstance(html, str) else html
    named = False
    for pattern, replacement in HTML_MARKUP:
        if pattern == "&amp;":
            text = decode_numbers(text)
        if pattern.startswith("&") and pattern != "&amp;":
            text, named = (text if named else decode_names(text)), True
        else:
            text = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return F.trim(text)


HTML_LINK = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
# Text of a wiki between and at the signs of links; innermost templates, and links with what they show; quotes and tags.
_WIKI_PIECES = r"\[\[|\]\]|[^\[\]]+|[\[\]]"
_WIKI_TEMPLATE = r"\{\{[^{}]*\}\}"
_WIKI_INNER = r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]"
WIKI_MARKUP = r"'{2,}|<[^>]*>"
# Prefixes of pages that are no articles, and endings of media files.
NOT_AN_ARTICLE = r"(?i)^(?:file|image|media|category):|\.(?:jpe?g|png|gif|svg)$"
_URL = r"[A-Za-z][A-Za-z0-9+.\-]*://\S*"


def is_article(target: Column | str) -> Column:
    """False for an empty target, images and categories."""
    target = F.col(target) if isinstance(target, str) else target
    return (target != "") & ~target.rlike(NOT_AN_ARTICLE)


def _links(text: Column | str, pattern: str, clean_target, clean_anchor) -> Column:
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("target"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("anchor"),
    )
    return _articles(pairs, clean_target, clean_anchor)


def _articles(pairs: Column, clean_target, clean_anchor) -> Column:
    kept = F.filter(pairs, lambda pair: is_article(clean_target(pair["target"])))

    def finish(pair: Column) -> Column:
        target = clean_target(pair["target"])
        anchor = clean_anchor(pair["anchor"])
        anchor = F.when(anchor == "", target).otherwise(anchor)
        return F.struct(
            F.regexp_replace(target, "#.*$", "").alias("target"),
            F.regexp_replace(anchor, _URL, "").alias("anchor_text"),
        )

    done = F.transform(kept, finish)
    return F.filter(done, lambda link: (link["target"] != "") | (link["anchor_text"] != ""))


def html_links(html: Column | str) -> Column:
    """ARRAY<STRUCT<target, anchor_text>> of the links of an HTML page to articles."""
    return _links(
        html,
        HTML_LINK,
        lambda target: F.regexp_replace(target, "^/", ""),
        lambda anchor: F.regexp_replace(anchor, "<[^>]*>", ""),
    )


def _shown(wikitext: Column) -> Column:
    """A text without templates, and with nested links as what they show: from the innermost outwards."""
    nested = F.regexp_count(wikitext, F.lit(r"\[\[|\{\{"))

    def inwards(text: Column, _: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, _WIKI_TEMPLATE, ""), _WIKI_INNER, "$1")

    return F.when(nested > 0, F.aggregate(F.sequence(F.lit(1), nested), wikitext, inwards)).otherwise(wikitext)


def wiki_links(wikitext: Column | str) -> Column:
    """ARRAY<STRUCT<target, anchor_text>> of the [[target|anchor]] links of a wiki text to articles.

    Links may stand within links, as in the captions of files; they come in the order they open. An opening
    that nothing closes, and a closing without an opening, are text. Null for null.
    """
    pieces = F.regexp_extract_all(wikitext, F.lit(_WIKI_PIECES), F.lit(0))
    numbered = F.transform(pieces, lambda piece, i: F.struct(piece.alias("piece"), i.alias("at")))
    marks = F.filter(numbered, lambda x: x["piece"].isin("[[", "]]"))
    opened = F.expr("CAST(array() AS ARRAY<INT>)").alias("opened")
    start = F.struct(opened, F.expr("CAST(array() AS ARRAY<STRUCT<first: INT, size: INT>>)").alias("spans"))

    def read(state: Column, mark: Column) -> Column:
        opened, spans, at = state["opened"], state["spans"], mark["at"]
        last = F.element_at(opened, -1)
        span = F.struct((last + 2).alias("first"), (at - last - 1).alias("size"))
        pushed = F.struct(F.concat(opened, F.array(at)).alias("opened"), spans.alias("spans"))
        closed = F.struct(F.slice(opened, F.lit(1), F.size(opened) - 1).alias("opened"), F.concat(spans, F.array(span)).alias("spans"))
        return F.when(mark["piece"] == "[[", pushed).when(F.size(opened) > 0, closed).otherwise(state)

    def pair(inside: Column) -> Column:
        anchor = F.when(inside.contains("|"), F.regexp_replace(inside, r"(?s)^[^|]*\|", "")).otherwise("")
        return F.struct(F.substring_index(inside, "|", 1).alias("target"), anchor.alias("anchor"))

    # The pieces are cut once, and bound for all links.
    spans = F.array_sort(F.aggregate(marks, start, read)["spans"])
    insides = F.transform(
        F.array(F.struct(pieces.alias("pieces"), spans.alias("spans"))),
        lambda x: F.transform(x["spans"], lambda span: _shown(F.array_join(F.slice(x["pieces"], span["first"], span["size"]), ""))),
    )[0]
    return _articles(F.transform(insides, pair), lambda target: target, lambda anchor: F.regexp_replace(anchor, WIKI_MARKUP, ""))
