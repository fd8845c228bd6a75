"""Retrieval and ranking. The benchmark texts are the queries, the documents the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.scoring import bm25_idf as bm25_idf_of
from termweave.functions.scoring import rounded
from termweave.functions.stopwords import stop_words
from termweave.operators import blend, index, rank
from termweave.operators.joins import BROADCAST_BYTES, plan_bytes
from termweave.plans import sql, tables
from termweave.plans.registry import query

TOP = 10
BASE = f"{sql.BENCHMARK}, {sql.BODY_STATS}, {sql.hits('body')}"
TITLE_BASE = f"{sql.BENCHMARK}, {sql.TITLE_STATS}, {sql.hits('title')}"
DOC_TITLES = f"doc_titles AS (SELECT doc_id, {sql.title_of()} AS title FROM documents)"
LOG_IDF = "log10(n_docs / df)"
QUERY_IDF = "log10(n_docs / (df + 1e-7))"


class Search:
    """Query terms matched with a field of the stored index."""

    def __init__(self, spark, sf_dir, field="body", terms=None, with_norm=False):
        stored = tables.search_index(spark, sf_dir)
        self.n_docs = stored.n_docs(field)
        self.avg_len = stored.avg_len(field)
        self.terms = tables.benchmark_terms(spark, sf_dir) if terms is None else terms
        # The terms of a query are more than the query, so what has a row for a query fits as well.
        self.fits = plan_bytes(self.terms) <= BROADCAST_BYTES
        enrich = (lambda known: rank.with_query_norm(known, self.n_docs)) if with_norm else None
        self.known, self.found = stored.match(self.terms, field, enrich=enrich, by_document=True)

    def bm25(self, **settings):
        return rank.bm25(self.found, self.n_docs, self.avg_len, **settings)


@query("query_terms", f"WITH {sql.BENCHMARK} SELECT query_id, term, qtf, query_len FROM q")
def query_terms(spark, sf_dir):
    return tables.benchmark_terms(spark, sf_dir).select("query_id", "term", "qtf", "query_len")


@query("candidates", f"WITH {BASE} SELECT DISTINCT query_id, doc_id FROM hits")
def candidates(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.candidates(search.found)


@query(
    "candidate_tfidf",
    f"WITH {BASE} SELECT query_id, doc_id, term, {sql.rounded(f'tf::DOUBLE / doc_len * {LOG_IDF}', 8)} AS tfidf FROM hits",
)
def candidate_tfidf(spark, sf_dir):
    search = Search(spark, sf_dir)
    scored = rank.candidate_tfidf(search.found, search.n_docs)
    return scored.withColumn("tfidf", rounded("tfidf", 8))


@query(
    "doc_tfidf_matrix",
    f"""WITH {BASE}, dl AS (SELECT query_id, doc_id, count(*) AS n_terms FROM hits GROUP BY 1, 2)
    SELECT query_id, doc_id, n_terms, term, {sql.rounded(f'tf::DOUBLE / doc_len * {LOG_IDF}', 8)} AS tfidf
    FROM hits JOIN dl USING (query_id, doc_id)""",
)
def doc_tfidf_matrix(spark, sf_dir):
    """Sparse rows of the document matrix for all candidates, with the number of terms in each row."""
    search = Search(spark, sf_dir)
    scored = rank.candidate_tfidf(search.found, search.n_docs)
    entry = F.struct("term", rounded("tfidf", 8).alias("tfidf"))
    lines = scored.groupBy("query_id", "doc_id").agg(F.collect_list(entry).alias("line"))
    return lines.select("query_id", "doc_id", F.size("line").cast("long").alias("n_terms"), F.inline("line"))


@query(
    "query_tfidf",
    f"""WITH {BASE} SELECT query_id, term, {sql.rounded(f'qtf::DOUBLE / query_len * {QUERY_IDF}', 8)} AS tfidf
    FROM q JOIN body_df USING (term), body_n""",
)
def query_tfidf(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.query_tfidf(search.known, search.n_docs).withColumn("tfidf", rounded("tfidf", 8))


COSINE = f"""{BASE},
    norms AS (SELECT query_id, sqrt(sum(w * w)) AS q_norm FROM (
        SELECT query_id, qtf::DOUBLE / query_len * {QUERY_IDF} AS w FROM q JOIN body_df USING (term), body_n) GROUP BY 1),
    sums AS (SELECT query_id, doc_id, sum(d * w) AS dot, sqrt(sum(d * d)) AS d_norm FROM (
        SELECT query_id, doc_id, tf::DOUBLE / doc_len * {LOG_IDF} AS d, qtf::DOUBLE / query_len * {QUERY_IDF} AS w
        FROM hits) GROUP BY 1, 2),
    scores AS (SELECT query_id, doc_id,
        {sql.rounded("CASE WHEN d_norm * q_norm = 0 THEN 0 ELSE dot / (d_norm * q_norm) END", 5)} AS score
        FROM sums JOIN norms USING (query_id))"""


@query(
    "cosine_topn",
    f"WITH {COSINE}, {sql.ranked('best', 'scores', 3)} SELECT query_id, doc_id, score, rank FROM best",
)
def cosine_topn(spark, sf_dir):
    search = Search(spark, sf_dir, with_norm=True)
    return rank.top_n(rank.cosine(search.found, search.n_docs), 3)


VECTOR = f"""{sql.postings("v", "documents", "text", stops="english", pattern=text_fn.VECTORIZER_PATTERN)},
    v_df AS (SELECT term, count(*) AS df FROM v GROUP BY 1),
    v_n AS (SELECT count(*) AS n FROM documents),
    v_raw AS (SELECT doc_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1) AS raw FROM v JOIN v_df USING (term), v_n),
    vectors AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM v_raw)"""


def _vectorizer(spark, sf_dir):
    """Postings, statistics and size of the corpus under the word pattern of the vectorizer."""
    postings = tables.vector_postings(spark, sf_dir)
    return postings, index.term_stats(postings), tables.read(spark, sf_dir, "documents", "doc_id").agg(F.count(F.lit(1))).scalar()


@query(
    "tfidf_vectorizer",
    f"WITH {VECTOR} SELECT doc_id, term, {sql.rounded('weight', 6)} AS weight FROM vectors",
)
def tfidf_vectorizer(spark, sf_dir):
    vectors = rank.tfidf_vectors(*_vectorizer(spark, sf_dir))
    return vectors.withColumn("weight", rounded("weight", 6))


@query(
    "cosine_matrix",
    f"""WITH {VECTOR},
    {sql.postings("w", "benchmark", "text", "item_id", "english", text_fn.VECTORIZER_PATTERN)},
    w_raw AS (SELECT doc_id AS query_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1) AS raw
        FROM w JOIN v_df USING (term), v_n),
    w_vec AS (SELECT query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS q_weight FROM w_raw)
    SELECT query_id, doc_id, {sql.rounded("sum(weight * q_weight)", 5)} AS score
    FROM vectors JOIN w_vec USING (term) GROUP BY 1, 2""",
)
def cosine_matrix(spark, sf_dir):
    postings, stats, n_docs = _vectorizer(spark, sf_dir)
    terms = rank.query_terms(
        tables.benchmark_queries(spark, sf_dir), stop_words("english"), text_fn.VECTORIZER_PATTERN
    )
    known, _ = rank.match(terms, postings, stats)
    fits = plan_bytes(terms) <= BROADCAST_BYTES
    return rank.cosine_of_postings(postings, stats, n_docs, rank.query_vectors(known, n_docs), fits)


@query(
    "top_n_documents",
    f"""WITH {BASE}, scores AS (SELECT query_id, doc_id, sum(qtf * tf)::BIGINT AS score FROM hits GROUP BY 1, 2),
    {sql.ranked("best", "scores", 100)} SELECT query_id, doc_id, score, rank FROM best""",
)
def top_n_documents(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.top_n(rank.match_count(search.found).drop("n_matched"), 100)


@query(
    "bm25_idf",
    f"""WITH {BASE} SELECT DISTINCT term, df, {sql.rounded("ln(1 + (n_docs - df + 0.5e0) / (df + 0.5e0))", 6)} AS idf
    FROM q JOIN body_df USING (term), body_n""",
)
def bm25_idf(spark, sf_dir):
    search = Search(spark, sf_dir)
    known = search.known.select("term", "df").distinct()
    return known.withColumn("idf", rounded(bm25_idf_of(search.n_docs), 6))


def _best(scores, n=TOP):
    return f"{sql.ranked('best', scores, n)} SELECT query_id, doc_id, score, rank FROM best"


@query(
    "bm25_naive",
    f"""WITH {BASE}, scores AS (SELECT query_id, doc_id,
        {sql.rounded("sum(qtf * qtf * " + sql.bm25_weight("(tf::DOUBLE / doc_len)") + ")", 5)} AS score
        FROM hits GROUP BY 1, 2), {_best("scores")}""",
)
def bm25_naive(spark, sf_dir):
    search = Search(spark, sf_dir)
    scores = rank.bm25_naive(search.found, search.n_docs, search.avg_len)
    return rank.top_n(scores, TOP)


@query("bm25_index", f"WITH {BASE}, {sql.bm25_scores('scores')}, {_best('scores')}")
def bm25_index(spark, sf_dir):
    return rank.top_n(Search(spark, sf_dir).bm25(), TOP)


SERVED = f"""{BASE},
    scores AS (SELECT query_id, doc_id,
        {sql.rounded(f"sum(qtf * qtf * {LOG_IDF} * {LOG_IDF} * tf)", 5)}
        / (any_value(n_docs)::DOUBLE * any_value(n_docs) * any_value(query_len)) AS score FROM hits GROUP BY 1, 2)"""


def _served(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.served_score(search.found, search.n_docs.cast("double"))


def _titled(spark, sf_dir, run, depth=None):
    """Results with titles; a run of `depth` results per query has a known bound."""
    max_rows = depth and depth * tables.benchmark_queries(spark, sf_dir).count()
    return rank.attach_titles(run, tables.stored_titles(spark, sf_dir), max_rows)


@query(
    "search_body",
    f"""WITH {SERVED}, {DOC_TITLES}, {sql.ranked("best", "scores", 100)}
    SELECT query_id, doc_id, score, rank, title FROM best JOIN doc_titles USING (doc_id)""",
)
def search_body(spark, sf_dir):
    return _titled(spark, sf_dir, rank.top_n(_served(spark, sf_dir), 100), 100)


@query("search_body_all", f"WITH {SERVED} SELECT query_id, doc_id, score FROM scores ORDER BY query_id, score DESC, doc_id")
def search_body_all(spark, sf_dir):
    return rank.in_order(_served(spark, sf_dir))


@query(
    "search_body_subset",
    f"""WITH {BASE},
    subset AS (SELECT query_id, count(*) AS n_subset FROM (SELECT DISTINCT query_id, doc_id, tf FROM hits) GROUP BY 1),
    w AS (SELECT query_id, term, qtf::DOUBLE / query_len * log10(n_subset / (df + 1e-7)) AS w
        FROM q JOIN body_df USING (term) JOIN subset USING (query_id)),
    norms AS (SELECT query_id, sqrt(sum(w * w)) AS q_norm FROM w GROUP BY 1),
    sums AS (SELECT query_id, doc_id, sum(tf * df * w) AS dot, sqrt(sum((tf * df)::DOUBLE * (tf * df))) AS d_norm
        FROM hits JOIN w USING (query_id, term) GROUP BY 1, 2),
    scores AS (SELECT query_id, doc_id,
        {sql.rounded("CASE WHEN d_norm * q_norm = 0 THEN 0 ELSE dot / (d_norm * q_norm) END", 5)} AS score
        FROM sums JOIN norms USING (query_id)), {_best("scores", 100)}""",
)
def search_body_subset(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.top_n(rank.subset_score(search.known, search.found, search.fits), 100)


@query(
    "fast_cosine",
    f"""WITH {BASE}, scores AS (SELECT query_id, doc_id, sum(qtf * tf)::BIGINT::DOUBLE / any_value(doc_len) AS score
        FROM hits GROUP BY 1, 2), {_best("scores", 100)}""",
)
def fast_cosine(spark, sf_dir):
    search = Search(spark, sf_dir)
    return rank.top_n(rank.fast_cosine(search.found), 100)


@query(
    "search_title",
    f"""WITH {TITLE_BASE}, {DOC_TITLES} SELECT query_id, doc_id, title,
        sum(qtf * tf)::BIGINT AS score, count(*) AS n_matched
    FROM hits JOIN doc_titles USING (doc_id) GROUP BY 1, 2, 3""",
)
def search_title(spark, sf_dir):
    """All documents with a query word in the title, by occurrences; n_matched counts the words."""
    search = Search(spark, sf_dir, "title")
    return rank.in_order(_titled(spark, sf_dir, rank.match_count(search.found)))


ANCHOR = f"""{sql.BENCHMARK}, {sql.RESOLVED}, {sql.postings("anchor", "resolved", "anchor_text", "target_id")}"""


@query(
    "search_title_by_words",
    f"""WITH {TITLE_BASE}, {DOC_TITLES}, scores AS (SELECT query_id, doc_id, count(*) AS score FROM hits GROUP BY 1, 2),
    {sql.ranked("best", "scores", 100)} SELECT query_id, doc_id, title, score, rank FROM best JOIN doc_titles USING (doc_id)""",
)
def search_title_by_words(spark, sf_dir):
    """The 100 titles with the most distinct words of a query."""
    matched = rank.match_count(Search(spark, sf_dir, "title").found)
    by_words = matched.select("query_id", "doc_id", F.col("n_matched").alias("score"))
    return _titled(spark, sf_dir, rank.top_n(by_words, 100), 100)


@query(
    "search_anchor",
    f"""WITH {ANCHOR} SELECT q.query_id, n.page_id AS doc_id, n.title, sum(q.qtf * a.tf)::BIGINT AS score,
        count(*) AS n_matched
    FROM q JOIN anchor a USING (term) JOIN named n ON n.target_id = a.doc_id GROUP BY q.query_id, n.page_id, n.title, n.target_id""",
)
def search_anchor(spark, sf_dir):
    """All pages with a query word in the text of links to their name; names that are no page's are left out."""
    search = Search(spark, sf_dir, "anchor")
    names = tables.stored_names(spark, sf_dir)
    found = rank.match_count(search.found).join(names, F.col("doc_id") == F.col("target_id"))
    return rank.in_order(found.select("query_id", F.col("page_id").alias("doc_id"), "title", "score", "n_matched"))


TWO_FIELDS = f"""{SERVED}, {sql.TITLE_STATS},
    title_scores AS (SELECT query_id, doc_id, sum(qtf * tf)::BIGINT AS score FROM q JOIN title USING (term)
        GROUP BY 1, 2),
    {sql.ranked("body_run", "scores", 100)}, {sql.ranked("title_run", "title_scores", 100)}"""


def _two_fields(spark, sf_dir):
    """The 100 best by body and by title."""
    body = rank.top_n(_served(spark, sf_dir), 100)
    titles = Search(spark, sf_dir, "title")
    return body, rank.top_n(rank.match_count(titles.found), 100)


@query(
    "search_blend",
    f"""WITH {TWO_FIELDS},
    kept AS (SELECT query_id, doc_id, rank, 0 AS part FROM body_run b
        JOIN (SELECT query_id, max(rank) AS size FROM body_run GROUP BY 1) USING (query_id) WHERE rank <= size - 20
        UNION ALL SELECT query_id, doc_id, rank, 1 FROM title_run WHERE rank <= 20)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY part, rank) AS rank, doc_id, part FROM kept""",
)
def search_blend(spark, sf_dir):
    return blend.blend(*_two_fields(spark, sf_dir), n=20)


@query(
    "search_blend3",
    f"""WITH {TWO_FIELDS}, {sql.bm25_scores("bm25_all")}, {sql.ranked("bm25_run", "bm25_all", 40)},
    kept AS (SELECT query_id, doc_id, rank, 0 AS part FROM bm25_run b
        JOIN (SELECT query_id, least(40, max(rank)) AS size FROM bm25_run GROUP BY 1) USING (query_id)
        WHERE rank <= size - 10 - 6
        UNION ALL SELECT query_id, doc_id, rank, 1 FROM body_run WHERE rank <= 10
        UNION ALL SELECT query_id, doc_id, rank, 2 FROM title_run WHERE rank <= 6 - 1)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY part, rank) AS rank, doc_id, part FROM kept""",
)
def search_blend3(spark, sf_dir):
    """BM25 with shares of 10 of the body score and 6 of the titles."""
    body, titles = _two_fields(spark, sf_dir)
    first = rank.top_n(Search(spark, sf_dir).bm25(), 40)
    return blend.blend3(first, body, 10, titles, 6)


def bm25_fields_sql(terms: str, depth: int) -> str:
    """CTEs body_run and title_run: BM25 of both fields for CTE q."""
    parts = [terms, sql.BODY_STATS, sql.TITLE_STATS]
    for field in ["body", "title"]:
        hits = sql.hits(field).replace("hits AS", f"{field}_hits AS")
        scores = sql.bm25_scores(f"{field}_scores").replace("FROM hits", f"FROM {field}_hits")
        parts += [hits, scores, sql.ranked(f"{field}_run", f"{field}_scores", depth)]
    return ", ".join(parts)


def bm25_fields(spark, sf_dir, depth):
    return [rank.top_n(Search(spark, sf_dir, field).bm25(), depth) for field in ["body", "title"]]


MERGED = f"""merged AS (SELECT query_id, doc_id,
        {sql.rounded("coalesce(t.score, 0) * 0.5e0 + coalesce(b.score, 0) * 0.5e0", 5)} AS score
        FROM title_run t FULL JOIN body_run b USING (query_id, doc_id))"""


@query(
    "merge_results",
    f"WITH {bm25_fields_sql(sql.BENCHMARK, 30)}, {MERGED}, {_best('merged', 3)}",
)
def merge_results(spark, sf_dir):
    body, title = bm25_fields(spark, sf_dir, 30)
    return blend.merge_results(title, body, 0.5, 0.5, 3)


@query(
    "attach_titles",
    f"""WITH {BASE}, {sql.bm25_scores('scores')}, {DOC_TITLES}, {sql.ranked("best", "scores", TOP)}
    SELECT query_id, doc_id, score, rank, title FROM best JOIN doc_titles USING (doc_id)""",
)
def attach_titles(spark, sf_dir):
    return _titled(spark, sf_dir, rank.top_n(Search(spark, sf_dir).bm25(), TOP), TOP)
