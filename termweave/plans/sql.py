"""Pieces of the SQL that the queries are checked against."""

from __future__ import annotations

from collections.abc import Sequence

from termweave.functions import stem as stem_fn
from termweave.functions import text as text_fn
from termweave.functions.stopwords import stop_words
from termweave.plans.tables import NAME, RELEVANT_SHARE, TITLE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(names: Sequence[str]) -> str:
    return ", ".join(quoted(name) for name in names)


def rounded(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits} + 0.5) / 1e{digits}"


def token_list(text: str, pattern: str = text_fn.TOKEN_PATTERN) -> str:
    return f"regexp_extract_all(lower({text}), {quoted(pattern)})"


def title_of(text: str = "text") -> str:
    return f"regexp_extract({text}, {quoted(TITLE)})"


def html_title(html: str = "html") -> str:
    return f"regexp_extract({html}, {quoted(text_fn.HTML_TITLE)}, 1)"


def stripped(html: str = "html") -> str:
    for pattern, new in text_fn.HTML_MARKUP:
        html = f"regexp_replace({html}, {quoted(pattern)}, {quoted(new)}, 'g')"
    return f"trim({html})"


def postings(
    name: str,
    source: str,
    text: str,
    key: str = "doc_id",
    stops: str = "all",
    pattern: str = text_fn.TOKEN_PATTERN,
) -> str:
    """CTEs {name}_tok and {name}(term, doc_id, tf)."""
    stop_list = stop_words(stops)
    keep = f"WHERE term NOT IN ({words(stop_list)})" if stop_list else ""
    return f"""
    {name}_tok AS (SELECT {key} AS doc_id, unnest({token_list(text, pattern)}) AS term FROM {source}),
    {name} AS (SELECT term, doc_id, count(*) AS tf FROM {name}_tok {keep} GROUP BY 1, 2)"""


def stats(name: str, source: str = "documents", key: str = "doc_id") -> str:
    """CTEs {name}_dl(doc_id, doc_len), {name}_df(term, df, term_total) and {name}_n(n_docs, avg_len)."""
    return f"""
    {name}_dl AS (SELECT s.{key} AS doc_id, coalesce(sum(p.tf), 0)::BIGINT AS doc_len
        FROM {source} s LEFT JOIN {name} p ON s.{key} = p.doc_id GROUP BY 1),
    {name}_df AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM {name} GROUP BY 1),
    {name}_n AS (SELECT count(*) AS n_docs, sum(doc_len)::DOUBLE / count(*) AS avg_len FROM {name}_dl)"""


BODY = postings("body", "documents", "text")
BODY_STATS = BODY + "," + stats("body")
TITLES = postings("title", "documents", title_of())
TITLE_STATS = TITLES + "," + stats("title")


def query_terms(source: str, key: str) -> str:
    """CTE q(query_id, term, qtf, query_len)."""
    return (
        postings("q0", source, "text", key)
        + """,
    q AS (SELECT doc_id AS query_id, term, tf AS qtf,
        (sum(tf) OVER (PARTITION BY doc_id))::BIGINT AS query_len FROM q0)"""
    )


BENCHMARK = query_terms("benchmark", "item_id")
QRELS = f"""
    qrels AS (SELECT h.query_id, h.doc_id, 2 - l.toxic AS grade
        FROM (SELECT query_id, doc_id, count(*) AS n FROM q JOIN body USING (term) GROUP BY 1, 2) h
        JOIN (SELECT query_id, count(*) AS n_terms FROM q GROUP BY 1) t USING (query_id)
        JOIN labels l USING (doc_id) WHERE l.quality = 1 AND h.n >= {RELEVANT_SHARE}e0 * t.n_terms)"""


def hits(field: str) -> str:
    """CTE hits: query terms, postings, lengths and statistics of a field."""
    return f"""
    hits AS (SELECT q.query_id, p.doc_id, p.term, q.qtf, q.query_len, p.tf, l.doc_len, f.df, n.n_docs, n.avg_len
        FROM q JOIN {field} p USING (term) JOIN {field}_dl l ON l.doc_id = p.doc_id
        JOIN {field}_df f ON f.term = p.term, {field}_n n)"""


def bm25_weight(tf: str = "tf", k1: str = "1.5e0", b: str = "0.75e0") -> str:
    return (
        f"ln(1 + (n_docs - df + 0.5e0) / (df + 0.5e0)) * {tf} * ({k1} + 1)"
        f" / ({tf} + {k1} * (1 - {b} + {b} * doc_len / avg_len))"
    )


def ranked(name: str, scores: str, n: int | None, by: str = "query_id") -> str:
    """CTE {name}: rows of `scores` with their rank, the n best of each query."""
    limit = f"WHERE rank <= {n}" if n else ""
    return f"""
    {name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, doc_id) AS rank
        FROM {scores}) {limit})"""


def bm25_scores(name: str) -> str:
    return f"""
    {name} AS (SELECT query_id, doc_id, {rounded("sum(qtf * " + bm25_weight() + ")", 5)} AS score
        FROM hits GROUP BY 1, 2)"""


def bucket(n_buckets: int, term: str = "term") -> str:
    return f"(('0x' || substr(md5({term}), 1, 8))::BIGINT % {n_buckets})::INT"


def _shape(word: str) -> str:
    """c or v per letter of an SQL string."""
    vowel = "x IN ('a', 'e', 'i', 'o', 'u') OR (x = 'y' AND a LIKE '%c')"
    return f"list_reduce(list_prepend('', string_split({word}, '')), lambda a, x: a || CASE WHEN {vowel} THEN 'v' ELSE 'c' END)"


def _cut(n: int, word: str = "w") -> str:
    return f"substr({word}, 1, length({word}) - {n})"


def _measure(word: str, least: int) -> str:
    return f"len(regexp_extract_all({_shape(word)}, 'v+c+')) >= {least}"


def _short(word: str) -> str:
    return f"regexp_matches({_shape(word)}, '^vc$|cvc$') AND ({_shape(word)} = 'vc' OR NOT regexp_matches({word}, '[wxy]$'))"


def _endings(cases: list[tuple[str, str, str]]) -> str:
    """CASE over (ending, condition, result): the first ending decides, the word stays where its condition fails."""
    whens = " ".join(f"WHEN w LIKE '%{end}' THEN CASE WHEN {holds} THEN {new} ELSE w END" for end, holds, new in cases)
    return f"CASE {whens} ELSE w END"


def stems(name: str, terms: str) -> str:
    """CTE {name}(term, stem) of the table `terms`(term), after CTEs for the steps."""
    step_2 = _endings([(a, _measure(_cut(len(a)), 1), f"{_cut(len(a))} || '{b}'") for a, b in stem_fn.STEP_2.items()])
    step_3 = _endings([(a, _measure(_cut(len(a)), 1), f"{_cut(len(a))} || '{b}'") for a, b in stem_fn.STEP_3.items()])
    after = {"ion": f" AND regexp_matches({_cut(3)}, '[st]$')"}
    step_4 = _endings([(a, _measure(_cut(len(a)), 2) + after.get(a, ""), _cut(len(a))) for a in stem_fn.STEP_4])
    base = f"CASE WHEN w LIKE '%ed' THEN {_cut(2)} ELSE {_cut(3)} END"
    steps = [
        f"""CASE WHEN w LIKE '%sses' OR (w LIKE '%ies' AND length(w) > 4) THEN {_cut(2)}
            WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {_cut(1)} ELSE w END AS w, false AS bare""",
        f"""CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {_cut(1)} ELSE {_cut(2)} END
            WHEN w LIKE '%eed' THEN CASE WHEN {_measure(_cut(3), 1)} THEN {_cut(1)} ELSE w END
            WHEN (w LIKE '%ed' OR w LIKE '%ing') AND {_shape(base)} LIKE '%v%' THEN {base} ELSE w END AS w,
            w NOT LIKE '%ied' AND w NOT LIKE '%eed' AND (w LIKE '%ed' OR w LIKE '%ing') AND {_shape(base)} LIKE '%v%' AS bare""",
        f"""CASE WHEN NOT bare THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'
            WHEN length(w) > 1 AND substr(w, -1) = substr(w, -2, 1) AND {_shape("w")} LIKE '%c'
                THEN CASE WHEN regexp_matches(w, '[lsz]$') THEN w ELSE {_cut(1)} END
            WHEN {_measure("w", 1)} AND NOT {_measure("w", 2)} AND {_short("w")} THEN w || 'e' ELSE w END AS w, false AS bare""",
        f"CASE WHEN w LIKE '%y' AND length(w) > 2 AND {_shape(_cut(1))} LIKE '%c' THEN {_cut(1)} || 'i' ELSE w END AS w, false AS bare",
        f"""CASE WHEN w LIKE '%logi' AND {_measure(_cut(3), 1)} THEN {_cut(1)} ELSE {step_2} END AS w,
            w LIKE '%alli' AND {_measure(_cut(4), 1)} AS bare""",
        f"CASE WHEN bare THEN {step_2} ELSE w END AS w, false AS bare",
        f"{step_3} AS w, false AS bare",
        f"{step_4} AS w, false AS bare",
        f"""CASE WHEN w LIKE '%e' AND ({_measure(_cut(1), 2)} OR ({_measure(_cut(1), 1)} AND NOT ({_short(_cut(1))})))
            THEN {_cut(1)} ELSE w END AS w, false AS bare""",
        f"CASE WHEN w LIKE '%ll' AND {_measure(_cut(1), 2)} THEN {_cut(1)} ELSE w END AS w, false AS bare",
    ]
    sql = f"{name}_0 AS (SELECT term, term AS w, false AS bare FROM {terms})"
    for i, step in enumerate(steps, 1):
        sql += f",\n    {name}_{i} AS MATERIALIZED (SELECT term, {step} FROM {name}_{i - 1})"
    irregular = " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in stem_fn.IRREGULAR.items())
    return f"""{sql},
    {name} AS (SELECT term, CASE term {irregular} ELSE CASE WHEN length(term) <= 2 THEN term ELSE w END END AS stem
        FROM {name}_{len(steps)})"""


LINK_NAME = f"regexp_extract(lower(target), {quoted(NAME)})"
LINKS = f"""
    raw_links AS (SELECT page_id, unnest(regexp_extract_all(html, {quoted(text_fn.HTML_LINK)}, 1)) AS t,
        unnest(regexp_extract_all(html, {quoted(text_fn.HTML_LINK)}, 2)) AS a FROM pages),
    clean_links AS (SELECT page_id, regexp_replace(t, '^/', '') AS t, regexp_replace(a, '<[^>]*>', '', 'g') AS a
        FROM raw_links),
    links AS (SELECT page_id, regexp_replace(t, '#.*$', '') AS target,
        regexp_replace(CASE WHEN a = '' THEN t ELSE a END, {quoted(text_fn._URL)}, '', 'g') AS anchor_text
        FROM clean_links WHERE t <> '' AND NOT regexp_matches(t, {quoted(text_fn.NOT_AN_ARTICLE)}))"""
PAGE_TITLES = f"page_titles AS (SELECT page_id, {html_title()} AS title FROM pages)"
def name_id(name: str) -> str:
    return f"('0x' || substr(md5({name}), 1, 15))::BIGINT"


RESOLVED = f"""{LINKS}, {PAGE_TITLES},
    resolved AS (SELECT page_id, {name_id("target")} AS target_id, anchor_text FROM links),
    named AS (SELECT DISTINCT {name_id("target")} AS target_id, p.page_id, p.title
        FROM links JOIN page_titles p ON regexp_extract(lower(title), {quoted(NAME)}) = {LINK_NAME}
        WHERE {LINK_NAME} <> '')"""


def pagerank(edges: str, rounds: int, digits: int = 5) -> str:
    """CTE pr(id, pagerank) over `edges`(src, dst), one CTE per round."""
    sql = f"""
    deg AS (SELECT src, count(*) AS degree FROM {edges} GROUP BY 1),
    v AS (SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges}),
    r0 AS (SELECT id, 1.0::DOUBLE AS r FROM v)"""
    for i in range(1, rounds + 1):
        sql += f""",
    r{i} AS (SELECT v.id, 0.15e0 + 0.85e0 * coalesce(m.s, 0) AS r FROM v LEFT JOIN (
        SELECT e.dst, sum(p.r / g.degree) AS s FROM {edges} e JOIN r{i - 1} p ON p.id = e.src
        JOIN deg g ON g.src = e.src GROUP BY 1) m ON m.dst = v.id)"""
    return (
        sql
        + f""",
    pr AS (SELECT id, {rounded(f"r * (SELECT count(*) / sum(r) FROM r{rounds})", digits)} AS pagerank
        FROM r{rounds})"""
    )
