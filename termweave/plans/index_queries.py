"""Index build and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.scoring import rounded
from termweave.functions.stopwords import stop_words
from termweave.operators import index, stats
from termweave.plans import sql, tables
from termweave.plans.registry import query
from termweave.session import scratch_path
from termweave.sources import index_store, segments

# Terms in more documents than this are kept by filter_rare_postings.
MIN_DF = 50
SHORT = text_fn.SHORT_TOKEN_PATTERN


def _body_postings(spark, sf_dir):
    return index.build_postings(tables.documents(spark, sf_dir), "text", tables.STOPS)


@query("word_count", f"WITH {sql.BODY} SELECT term, doc_id, tf FROM body")
def word_count(spark, sf_dir):
    return _body_postings(spark, sf_dir).select("term", "doc_id", "tf")


@query(
    "posting_lists",
    f"""WITH {sql.BODY} SELECT term, doc_id, tf,
    row_number() OVER (PARTITION BY term ORDER BY doc_id) AS position FROM body""",
)
def posting_lists(spark, sf_dir):
    return index.posting_lists(tables.search_index(spark, sf_dir).postings("body"))


@query(
    "filter_rare_postings",
    f"""WITH {sql.BODY_STATS} SELECT term, doc_id, tf FROM body
    WHERE term IN (SELECT term FROM body_df WHERE df > {MIN_DF})""",
)
def filter_rare_postings(spark, sf_dir):
    """The postings of terms that are in more than MIN_DF documents."""
    stored = tables.search_index(spark, sf_dir)
    kept = index.drop_rare(stored.term_stats("body"), MIN_DF).select("term")
    return stored.postings("body").join(kept, "term", "left_semi").select("term", "doc_id", "tf")


@query("document_frequency", f"WITH {sql.BODY_STATS} SELECT term, df FROM body_df")
def document_frequency(spark, sf_dir):
    return index.term_stats(_body_postings(spark, sf_dir)).select("term", "df")


@query("term_total", f"WITH {sql.BODY_STATS} SELECT term, term_total FROM body_df")
def term_total(spark, sf_dir):
    return index.term_stats(_body_postings(spark, sf_dir)).select("term", "term_total")


@query(
    "add_documents",
    f"""WITH {sql.postings("b", "documents", "text")}, {sql.postings("c", "benchmark", "text", "item_id")}
    SELECT term, doc_id, sum(tf)::BIGINT AS tf FROM (SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY 1, 2""",
)
def add_documents(spark, sf_dir):
    """The body index with the benchmark texts added under their item ids."""
    more = tables.benchmark_queries(spark, sf_dir).withColumnRenamed("query_id", "doc_id")
    return index.add_documents(_body_postings(spark, sf_dir), more, "text", tables.STOPS)


@query(
    "segmented_index",
    f"""WITH grown AS (
        SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)
        UNION ALL SELECT item_id, text FROM benchmark),
    live AS (SELECT * FROM grown WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
    {sql.postings("b", "live", "text")}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM b GROUP BY 1""",
)
def segmented_index(spark, sf_dir):
    """Term statistics of the body index after the benchmark texts came in under their item ids, in place of documents
    with these ids, and the toxic documents went; both changes are segments, merged with each other but not with the base."""
    base = segments.start_segments(tables.search_index(spark, sf_dir), scratch_path(spark, "segments"), "body")
    more = tables.benchmark_queries(spark, sf_dir).withColumnRenamed("query_id", "doc_id")
    toxic = tables.read(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1")
    return base.add(more, text_fn.tokens("text", tables.STOPS)).delete(toxic).merge().term_stats()


@query(
    "doc_length",
    f"""WITH {sql.BODY_STATS}, {sql.TITLE_STATS}
    SELECT doc_id, b.doc_len AS body_len, t.doc_len AS title_len, b.doc_len + t.doc_len AS doc_len
    FROM body_dl b JOIN title_dl t USING (doc_id)""",
)
def doc_length(spark, sf_dir):
    """Length of body, title and both, counted in the row of the document."""
    text = F.regexp_extract("text", tables.TITLE, 0)
    body_len = F.size(text_fn.tokens("text", tables.STOPS)).cast("long")
    title_len = F.size(text_fn.tokens(text, tables.STOPS)).cast("long")
    lengths = tables.documents(spark, sf_dir).select(
        "doc_id", body_len.alias("body_len"), title_len.alias("title_len")
    )
    return lengths.withColumn("doc_len", F.col("body_len") + F.col("title_len"))


@query("doc_length_from_postings", f"WITH {sql.BODY_STATS} SELECT doc_id, doc_len FROM body_dl WHERE doc_len > 0")
def doc_length_from_postings(spark, sf_dir):
    return index.doc_lengths(tables.search_index(spark, sf_dir).postings("body"))


@query(
    "avg_doc_length",
    f"""WITH {sql.BODY_STATS} SELECT count(*) AS n_docs, sum(doc_len)::BIGINT AS n_tokens,
    {sql.rounded("sum(doc_len)::DOUBLE / count(*)", 5)} AS avg_len FROM body_dl""",
)
def avg_doc_length(spark, sf_dir):
    lengths = index.doc_stats(tables.documents(spark, sf_dir), text_fn.tokens("text", tables.STOPS))
    totals = lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("doc_len").alias("n_tokens"))
    return totals.withColumn("avg_len", rounded(F.col("n_tokens") / F.col("n_docs"), 5))


@query("max_tf", f"WITH {sql.BODY} SELECT doc_id, max(tf) AS max_tf FROM body GROUP BY 1")
def max_tf(spark, sf_dir):
    """Counted in the row of the document."""
    return index.max_tf(tables.documents(spark, sf_dir), text_fn.tokens("text", tables.STOPS))


@query(
    "normalized_tf",
    f"""WITH {sql.BODY_STATS} SELECT term, doc_id, tf::DOUBLE / doc_len AS norm_tf, doc_len, df
    FROM body JOIN body_dl USING (doc_id) JOIN body_df USING (term)""",
)
def normalized_tf(spark, sf_dir):
    stored = tables.search_index(spark, sf_dir)
    return index.normalized_tf(stored.postings("body"), stored.term_stats("body"))


@query(
    "merge_indices",
    f"""WITH {sql.postings("b", "documents", "text")}, {sql.postings("t", "documents", sql.title_of())},
    {sql.postings("c", "conversations", "text", "conv_id")}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM (
        SELECT term, doc_id, sum(tf) AS tf FROM (SELECT * FROM b UNION ALL SELECT * FROM t UNION ALL SELECT * FROM c)
        GROUP BY 1, 2) GROUP BY 1""",
)
def merge_indices(spark, sf_dir):
    """df and term_total of the merged index of bodies, titles and conversations."""
    stored = tables.search_index(spark, sf_dir)
    talks = tables.read(spark, sf_dir, "conversations", "conv_id", "text").withColumnRenamed("conv_id", "doc_id")
    talk_postings = index.build_postings(talks, "text", tables.STOPS)
    return index.term_stats(index.merge_postings(stored.postings("body"), stored.postings("title"), talk_postings))


@query(
    "batch_index",
    f"""WITH {sql.BODY}, batches AS (
        SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch FROM documents)
    SELECT batch, term, count(*) AS df, sum(tf)::BIGINT AS term_total
    FROM body JOIN batches USING (doc_id) GROUP BY 1, 2""",
)
def batch_index(spark, sf_dir):
    """df and term_total per batch of 100 documents."""
    parts = index.batch_indexes(tables.documents(spark, sf_dir), 100, "text", tables.STOPS)
    return index.term_stats(parts, by=["batch"])


@query("batch_index_merged", f"WITH {sql.BODY_STATS} SELECT term, df, term_total FROM body_df")
def batch_index_merged(spark, sf_dir):
    """The merged batches, which are the index built at once."""
    parts = index.batch_indexes(tables.documents(spark, sf_dir), 100, "text", tables.STOPS)
    return index.term_stats(index.merge_postings(parts))


@query(
    "title_index",
    f"""WITH {sql.PAGE_TITLES}, {sql.postings("t", "page_titles", "title", "page_id", "none", SHORT)}
    SELECT term, doc_id AS page_id, tf FROM t""",
)
def title_index(spark, sf_dir):
    titles = tables.pages(spark, sf_dir).select("page_id", "title")
    return index.build_postings(titles, "title", pattern=SHORT, keys=["page_id"]).select("term", "page_id", "tf")


@query(
    "body_index",
    f"""WITH bodies AS (SELECT page_id, {sql.stripped()} AS body FROM pages),
    {sql.postings("t", "bodies", "body", "page_id", "none", SHORT)}
    SELECT term, doc_id AS page_id, tf FROM t""",
)
def body_index(spark, sf_dir):
    bodies = tables.pages(spark, sf_dir).select("page_id", text_fn.strip_markup("html").alias("body"))
    return index.build_postings(bodies, "body", pattern=SHORT, keys=["page_id"]).select("term", "page_id", "tf")


@query(
    "anchor_index",
    f"""WITH {sql.RESOLVED}, {sql.postings("a", "resolved", "anchor_text", "target_id", "none", SHORT)}
    SELECT term, doc_id, tf FROM a""",
)
def anchor_index(spark, sf_dir):
    return index.anchor_postings(tables.resolved_links(spark, sf_dir), pattern=SHORT).select("term", "doc_id", "tf")


LOOKED_UP = ["thnt", "ndst", "anat", "sich", "elle"]


@query(
    "posting_lookup",
    f"WITH {sql.BODY} SELECT term, doc_id, tf FROM body WHERE term IN ({sql.words(LOOKED_UP)})",
)
def posting_lookup(spark, sf_dir):
    stored = tables.search_index(spark, sf_dir)
    found = index_store.posting_lookup(stored, LOOKED_UP, "body")
    return found.select("term", "doc_id", "tf")


@query("posting_scan", f"WITH {sql.BODY} SELECT term, doc_id, tf FROM body ORDER BY term, doc_id")
def posting_scan(spark, sf_dir):
    return tables.search_index(spark, sf_dir).postings("body").select("term", "doc_id", "tf").orderBy("term", "doc_id")


@query(
    "merge_posting_locations",
    f"""WITH {sql.BODY}, {sql.TITLES}, {sql.RESOLVED}, {sql.postings("anchor", "resolved", "anchor_text", "target_id")},
    fields AS (SELECT 'body' AS field, term FROM body UNION ALL SELECT 'title', term FROM title
        UNION ALL SELECT 'anchor', term FROM anchor)
    SELECT field, {sql.bucket(tables.SQL_BUCKETS)} AS bucket, count(DISTINCT term) AS n_terms, count(*) AS n_postings
    FROM fields GROUP BY 1, 2""",
)
def merge_posting_locations(spark, sf_dir):
    return index_store.bucket_manifest(tables.search_index(spark, sf_dir))


ALL_WORDS_TITLE = sql.postings("t", "documents", sql.title_of(), stops="none", pattern=SHORT)
ALL_WORDS_BODY = sql.postings("b", "documents", "text", stops="none", pattern=SHORT)
ALL_WORDS_STATS = f"""{ALL_WORDS_BODY},
    s AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM b GROUP BY 1)"""
CONTENT = f"length(term) > 2 AND term NOT IN ({sql.words(stop_words('english'))})"


def _all_words(spark, sf_dir, field):
    if field == "body":
        return index.build_postings(tables.documents(spark, sf_dir), pattern=SHORT)
    return index.build_postings(tables.document_titles(spark, sf_dir), "title", pattern=SHORT)


def _body_stats(spark, sf_dir):
    return index.term_stats(_all_words(spark, sf_dir, "body"))


@query(
    "count_words",
    f"""WITH {ALL_WORDS_BODY}, {ALL_WORDS_TITLE}
    SELECT term, sum(tf)::BIGINT AS n FROM (SELECT * FROM b UNION ALL SELECT * FROM t) GROUP BY 1""",
)
def count_words(spark, sf_dir):
    return stats.count_words(_all_words(spark, sf_dir, "title"), _all_words(spark, sf_dir, "body"))


def _field_stats(spark, sf_dir):
    """Term statistics of title, body and anchor text."""
    fields = {
        "title": _all_words(spark, sf_dir, "title").select("term", "tf"),
        "body": _all_words(spark, sf_dir, "body").select("term", "tf"),
        "anchor": index.anchor_postings(tables.resolved_links(spark, sf_dir), pattern=SHORT).select("term", "tf"),
    }
    rows = None
    for name, part in fields.items():
        named = index.term_stats(part).withColumn("field", F.lit(name))
        rows = named if rows is None else rows.unionByName(named)
    return rows


FIELD_STATS = f"""{ALL_WORDS_BODY}, {ALL_WORDS_TITLE}, {sql.RESOLVED},
    {sql.postings("a", "resolved", "anchor_text", "target_id", "none", SHORT)},
    f AS (SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM (
        SELECT 'title' AS field, * FROM t UNION ALL SELECT 'body' AS field, * FROM b
        UNION ALL SELECT 'anchor' AS field, * FROM a) GROUP BY 1, 2)"""


@query(
    "top_terms",
    f"""WITH {FIELD_STATS} SELECT field, rank, term, term_total AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY field ORDER BY term_total DESC, term) AS rank FROM f)
    WHERE rank <= 5""",
)
def top_terms(spark, sf_dir):
    return stats.top_terms(_field_stats(spark, sf_dir), "term_total", 5)


@query(
    "top_df_terms",
    f"""WITH {FIELD_STATS} SELECT field, rank, term, df AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY field ORDER BY df DESC, term) AS rank FROM f WHERE {CONTENT})
    WHERE rank <= 100""",
)
def top_df_terms(spark, sf_dir):
    return stats.top_terms(stats.content_words(_field_stats(spark, sf_dir), stop_words("english")), "df", 100)


@query(
    "corpus_stopwords",
    f"""WITH {ALL_WORDS_STATS} SELECT term, df FROM s
    WHERE {CONTENT} AND df::DOUBLE / (SELECT count(*) FROM documents) >= 0.25e0""",
)
def corpus_stopwords(spark, sf_dir):
    """Content words that are in a quarter of the documents."""
    n_docs = count_docs(spark, sf_dir).scalar()
    return stats.corpus_stopwords(_body_stats(spark, sf_dir), n_docs, 0.25, stop_words("english"))


def count_docs(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents", "doc_id").agg(F.count(F.lit(1)).alias("n_docs"))


@query(
    "zipf",
    f"""WITH {ALL_WORDS_STATS},
    z AS (SELECT row_number() OVER (ORDER BY term_total DESC) AS rank, term_total AS frequency FROM s WHERE {CONTENT})
    SELECT rank, frequency, {sql.rounded("ln(rank)", 6)} AS log_rank, {sql.rounded("ln(frequency)", 6)} AS log_frequency
    FROM z""",
)
def zipf(spark, sf_dir):
    ranks = stats.zipf(stats.content_words(_body_stats(spark, sf_dir), stop_words("english")))
    return ranks.select(
        "rank",
        "frequency",
        rounded("log_rank", 6).alias("log_rank"),
        rounded("log_frequency", 6).alias("log_frequency"),
    )


@query(
    "zipf_slope",
    f"""WITH {ALL_WORDS_STATS},
    z AS (SELECT row_number() OVER (ORDER BY term_total DESC) AS rank, term_total AS frequency FROM s WHERE {CONTENT})
    SELECT {sql.rounded("regr_slope(ln(frequency), ln(rank))", 5)} AS slope, count(*) AS n_ranks FROM z""",
)
def zipf_slope(spark, sf_dir):
    ranks = stats.zipf(stats.content_words(_body_stats(spark, sf_dir), stop_words("english")))
    return stats.zipf_slope(ranks).select(rounded("slope", 5).alias("slope"), "n_ranks")


@query("rare_words", f"WITH {ALL_WORDS_STATS} SELECT term, term_total FROM s WHERE {CONTENT} AND term_total < 3")
def rare_words(spark, sf_dir):
    return stats.rare_words(stats.content_words(_body_stats(spark, sf_dir), stop_words("english")))


@query(
    "freq_of_freq",
    f"""WITH {ALL_WORDS_STATS} SELECT term_total AS frequency, count(*) AS n_terms FROM s WHERE {CONTENT} GROUP BY 1""",
)
def freq_of_freq(spark, sf_dir):
    return stats.frequency_classes(stats.content_words(_body_stats(spark, sf_dir), stop_words("english")))


VARIANTS = f"""{ALL_WORDS_STATS},
    {sql.postings("long_words", "documents", "text")},
    s3 AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM long_words GROUP BY 1),
    s4 AS (SELECT * FROM s3 WHERE term_total > 2), {sql.stems("stems", "s4")},
    stemmed AS (SELECT stem AS term, doc_id, sum(tf)::BIGINT AS tf FROM long_words JOIN stems USING (term) GROUP BY 1, 2),
    v AS (SELECT 'all_words' AS variant, * FROM s UNION ALL SELECT 'stop_removed', * FROM s3
        UNION ALL SELECT 'stop_rare_removed', * FROM s4
        UNION ALL SELECT 'with_stemming', term, count(*), sum(tf)::BIGINT FROM stemmed GROUP BY term),
    variants AS (SELECT variant, count(*) AS n_terms, sum(df)::BIGINT AS n_postings,
        sum(term_total)::BIGINT AS n_tokens FROM v GROUP BY 1)"""


def _variants(spark, sf_dir):
    """Four variants: all words, without stop words, without rare words too, and the rest as stems."""
    return stats.index_variants(_body_stats(spark, sf_dir), tables.STOPS).unionByName(index_variant_stemmed(spark, sf_dir))


@query("index_variants", f"WITH {VARIANTS} SELECT * FROM variants")
def index_variants(spark, sf_dir):
    return _variants(spark, sf_dir)


@query("index_size", f"WITH {VARIANTS} SELECT variant, n_postings * 6 / 1e6 AS size_mb FROM variants ORDER BY 2 DESC")
def index_size(spark, sf_dir):
    return stats.index_size(_variants(spark, sf_dir))


@query("index_variant_stemmed", f"WITH {VARIANTS} SELECT * FROM variants WHERE variant = 'with_stemming'")
def index_variant_stemmed(spark, sf_dir):
    """The fourth variant: stop and rare words removed, the rest stemmed."""
    stored = tables.search_index(spark, sf_dir)
    return stats.stemmed_variant(stored.postings("body"), stored.term_stats("body"), tables.STOPS)
