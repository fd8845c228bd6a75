"""SQL for the queries that it can express: set joins by all pairs, preference formatting, dated lists, vectors by all pairs, and repeated passages."""

from __future__ import annotations

from termweave.llm.preference import PART

# The smallest id reachable over CTE pairs(a, b), which has each link in both directions, for the ids of CTE nodes(id).
REACHED = """
    reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, p.b FROM reach r JOIN pairs p ON p.a = r.other),
    labelled AS (SELECT id, min(other) AS component_id FROM reach GROUP BY 1)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SETS = f"""WITH RECURSIVE
    split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents),
    sets AS (SELECT doc_id AS id, CASE WHEN len(w) >= 3
        THEN list_distinct(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM split),
    nodes AS (SELECT id, len(s)::BIGINT AS n FROM sets),
    grams AS (SELECT id, unnest(s) AS g FROM sets),
    shared AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM grams x JOIN grams y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
    pairs AS (SELECT a, b FROM shared JOIN nodes m ON m.id = a JOIN nodes n ON n.id = b
        WHERE 100 * common >= 90 * (m.n + n.n - common)), {REACHED}
    SELECT id AS doc_id, n AS n_shingles, component_id FROM nodes JOIN labelled USING (id)"""

_TURN = "PARTITION BY pair_id, segment, part ORDER BY turn, role, text"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_PREFERENCE = f"""WITH
    chosen AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations),
    rejected AS (SELECT * FROM chosen WHERE turn < 1 + pair_id % 3
        UNION ALL SELECT pair_id - 1, turn, role, text FROM chosen WHERE pair_id >= 1 AND turn >= 1 + (pair_id - 1) % 3),
    both_sides AS (SELECT pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, side
        FROM (SELECT *, 'chosen' AS side FROM chosen UNION ALL SELECT *, 'rejected' FROM rejected)
        WHERE pair_id IS NOT NULL AND turn IS NOT NULL),
    lines AS (SELECT pair_id, turn, role, text, bool_or(side = 'chosen') AS on_chosen, bool_or(side = 'rejected') AS on_rejected
        FROM both_sides GROUP BY 1, 2, 3, 4),
    forks AS (SELECT pair_id, min(turn) AS fork FROM lines WHERE NOT (on_chosen AND on_rejected) GROUP BY 1),
    split AS (SELECT l.*, coalesce(turn < fork, true) AS shared FROM lines l LEFT JOIN forks USING (pair_id)),
    placed AS (SELECT pair_id, 'prompt' AS segment, turn, role, text FROM split WHERE shared
        UNION ALL SELECT pair_id, 'chosen', turn, role, text FROM split WHERE NOT shared AND on_chosen
        UNION ALL SELECT pair_id, 'rejected', turn, role, text FROM split WHERE NOT shared AND on_rejected),
    shown AS (SELECT *, turn // {PART} AS part, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM placed),
    begun AS (SELECT *, 5 + length(role) + coalesce(sum(length(line)) OVER ({_TURN} {_BEFORE}), 0) AS pos FROM shown),
    parts AS (SELECT pair_id, segment, part, string_agg(line, '' ORDER BY turn, role, text) AS text,
        coalesce(string_agg(CASE WHEN role = 'assistant' AND segment <> 'prompt' THEN pos::VARCHAR || ':' || (pos + length(begun.text))::VARCHAR END, ','
            ORDER BY turn, role, text), '') AS mask FROM begun GROUP BY 1, 2, 3)
    SELECT pair_id, segment, part, text, mask,
        coalesce(sum(length(text)) OVER (PARTITION BY pair_id, segment ORDER BY part {_BEFORE}), 0)::BIGINT AS start FROM parts"""

_HOST = r"""nullif(lower(regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^[^@]*@', ''), ':[0-9]*$', ''), '\.$', '')), '')"""
_LISTS = f"""WITH
    named AS (SELECT page_id, {_HOST} AS host,
        (SELECT min(ts) FROM events) + to_minutes(page_id * 7919 % 40000) AS fetched_at FROM pages),
    hosts AS (SELECT pattern, row_number() OVER (ORDER BY pattern) - 1 AS slot, count(*) OVER () AS n
        FROM (SELECT DISTINCT host AS pattern FROM named WHERE host IS NOT NULL)),
    listed AS (SELECT pattern, event_type, ts AS since FROM events
        JOIN hosts ON ((coalesce(user_id, 0) * 7919) % n + n) % n = slot),
    entries AS (SELECT CASE event_type WHEN 'view' THEN 'block' ELSE 'allow' END AS list, pattern, true AS active, since
            FROM listed WHERE event_type IN ('view', 'click')
        UNION ALL SELECT unnest(['block', 'allow']), pattern, false, since FROM listed WHERE event_type NOT IN ('view', 'click')),
    at_once AS (SELECT list, pattern, since, bool_or(active) AS active FROM entries GROUP BY 1, 2, 3),
    spans AS (SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM at_once),
    keys AS (SELECT page_id, fetched_at, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
        lambda k: array_to_string(string_split(host, '.')[k:], '.'))) AS domain FROM named),
    hits AS (SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, bool_or(list = 'allow') AS allowed,
        first(pattern ORDER BY length(pattern) DESC, pattern DESC) AS pattern
        FROM keys JOIN spans ON domain = pattern AND active AND fetched_at >= since AND (until IS NULL OR fetched_at < until) GROUP BY 1)
    SELECT page_id, host, fetched_at, coalesce(NOT allowed, false) AS blocked, coalesce(lists, '') AS lists, pattern
    FROM named LEFT JOIN hits USING (page_id)"""

_VECTORS = f"""WITH RECURSIVE
    nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
    usable AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM nodes
        WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    pairs AS (SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.id <> y.id AND list_dot_product(x.u, y.u) >= 0.9e0), {REACHED},
    counted AS (SELECT a AS id, count(*) AS n_links FROM pairs GROUP BY 1)
    SELECT id AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
    FROM nodes JOIN labelled USING (id) LEFT JOIN counted USING (id)"""

_PASSAGES = """WITH
    split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM split WHERE len(w) >= 13),
    windows AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS words FROM starts),
    firsts AS (SELECT words, min(doc_id) AS first_doc FROM windows GROUP BY 1),
    gone AS (SELECT DISTINCT doc_id, k + unnest(range(0, 13)) AS k FROM windows JOIN firsts USING (words) WHERE doc_id > first_doc),
    placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM split),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, k) GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)"""

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": _SETS,
    "op3_preference_format": _PREFERENCE,
    "op9_url_filters": _LISTS,
    "op10_embedding_dedup": _VECTORS,
    "op13_substring_dedup": _PASSAGES,
}
