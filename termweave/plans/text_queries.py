"""Sources and text preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.scoring import rounded
from termweave.functions.stopwords import stop_words
from termweave.operators import graph, index, stats
from termweave.operators.joins import dealt_parts
from termweave.plans import sql, tables
from termweave.plans.registry import query
from termweave.session import scratch_path
from termweave.sources import corpus, index_store


@query("scan_corpus", "SELECT doc_id, text FROM documents")
def scan_corpus(spark, sf_dir):
    return tables.documents(spark, sf_dir)


@query("count_corpus", "SELECT count(*) AS n_docs FROM documents")
def count_corpus(spark, sf_dir):
    return tables.read(spark, sf_dir, "documents", "doc_id").agg(F.count(F.lit(1)).alias("n_docs"))


@query("sample_limit", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 1000")
def sample_limit(spark, sf_dir):
    return corpus.first_rows(tables.read(spark, sf_dir, "documents", "doc_id", "lang", "n_chars"), "doc_id", 1000)


@query(
    "scan_dump",
    f"""SELECT page_id, {sql.html_title()} AS title, length(html)::BIGINT AS body_len FROM pages
    WHERE NOT contains(url, '?') AND NOT contains(url, '.net')""",
)
def scan_dump(spark, sf_dir):
    """The pages written as an XML dump and read back.

    In it urls with arguments are redirects and .net urls are talk pages.
    """
    pages = tables.read(spark, sf_dir, "pages", "page_id", "url", "html")
    dump = pages.select(
        F.col("page_id").alias("id"),
        F.when(F.col("url").contains(".net"), 1).otherwise(0).alias("ns"),
        text_fn.html_title("html").alias("title"),
        F.when(F.col("url").contains("?"), F.struct(F.col("url").alias("_title"))).alias("redirect"),
        F.struct(
            F.struct(F.col("html").alias("_VALUE"), F.length("html").cast("long").alias("_bytes")).alias("text")
        ).alias("revision"),
    )
    path = scratch_path(spark, "dump")
    dump.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    return corpus.read_dump(spark, path).select(
        "page_id", "title", F.length("body").cast("long").alias("body_len")
    )


@query("extract_title", f"SELECT page_id, {sql.html_title()} AS title FROM pages")
def extract_title(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("page_id", "title")


@query(
    "load_qrels",
    f"""WITH {sql.BENCHMARK}, {sql.BODY}, {sql.QRELS}
    SELECT text AS query, doc_id // 1000 AS file,
        (row_number() OVER (PARTITION BY text, doc_id // 1000 ORDER BY doc_id) - 1)::INT AS position, doc_id
    FROM qrels JOIN benchmark ON item_id = query_id""",
)
def load_qrels(spark, sf_dir):
    """The judgements written as JSON maps, one per 1000 document ids, and parsed again."""
    named = tables.qrels(spark, sf_dir).join(tables.benchmark_queries(spark, sf_dir), "query_id")
    lists = named.groupBy("text", F.floor(F.col("doc_id") / 1000).alias("file")).agg(
        F.sort_array(F.collect_list("doc_id")).alias("ids")
    )
    lines = lists.select("file", F.to_json(F.create_map("text", "ids")).alias("value"))
    return corpus.load_qrels(lines, "file")


@query(
    "write_index",
    f"""WITH {sql.postings("kept", "documents", "text", stops="full")}
    SELECT 'body' AS field, {sql.bucket(index_store.N_BUCKETS)} AS bucket, count(DISTINCT term) AS n_terms,
        count(*) AS n_postings FROM kept GROUP BY 2""",
)
def write_index(spark, sf_dir):
    """(bucket, n_terms, n_postings) of a body index written in 124 buckets and read back."""
    docs = tables.documents(spark, sf_dir)
    stops = stop_words("full")
    stored = index_store.write_documents(docs, text_fn.tokens("text", stops), scratch_path(spark, "written-index"), "body")
    return index_store.bucket_manifest(stored)


@query(
    "read_index",
    f"""WITH {sql.BODY_STATS} SELECT term, df, term_total FROM body_df""",
)
def read_index(spark, sf_dir):
    stored = tables.search_index(spark, sf_dir)
    return index_store.read_index(spark, stored.path).term_stats("body").select("term", "df", "term_total")


@query("delete_index", "SELECT 0::BIGINT AS n_postings, 0::BIGINT AS n_docs")
def delete_index(spark, sf_dir):
    """Rows left after an index over the titles is written and dropped."""
    titles = tables.document_titles(spark, sf_dir)
    stored = index_store.write_documents(titles, text_fn.tokens("title", tables.STOPS), scratch_path(spark, "dropped-index"), "title", 8)
    index_store.delete_index(stored)
    left = stored.doc_stats().agg(F.count(F.lit(1)).alias("n_docs"))
    return stored.postings().agg(F.count(F.lit(1)).alias("n_postings")).select(
        "n_postings", left.scalar().alias("n_docs")
    )


@query(
    "write_pagerank",
    f"""WITH edges AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem),
    {sql.pagerank("edges", 6)} SELECT id, pagerank FROM pr""",
)
def write_pagerank(spark, sf_dir):
    """Ranks written as sorted gzip CSV files and read back."""
    return tables.stored_ranks(spark, sf_dir)


@query(
    "bucket_stats",
    f"""WITH {sql.BODY_STATS}, sizes AS (SELECT {sql.bucket(tables.SQL_BUCKETS)} AS bucket, count(*) AS n FROM body_df GROUP BY 1)
    SELECT max(n) AS max_terms, min(n) AS min_terms, quantile_cont(n, 0.5)::DOUBLE AS median_terms FROM sizes""",
)
def bucket_stats(spark, sf_dir):
    return index_store.bucket_stats(tables.search_index(spark, sf_dir).postings("body"))


def _token_rows(spark, sf_dir, pattern, stops=()):
    """(doc_id, position, term) of every token."""
    return tables.documents(spark, sf_dir).select(
        "doc_id", F.posexplode(text_fn.tokens("text", stops, pattern)).alias("position", "term")
    )


def _token_sql(pattern, stops):
    stop_list = stop_words(stops)
    kept = sql.token_list("text", pattern)
    if stop_list:
        kept = f"list_filter({kept}, lambda t: t NOT IN ({sql.words(stop_list)}))"
    return f"""WITH t AS (SELECT doc_id, {kept} AS tokens FROM documents)
    SELECT doc_id, (unnest(range(len(tokens))))::INT AS position, unnest(tokens) AS term FROM t"""


@query("tokenize", _token_sql(text_fn.TOKEN_PATTERN, "english"))
def tokenize(spark, sf_dir):
    return _token_rows(spark, sf_dir, text_fn.TOKEN_PATTERN, stop_words("english"))


@query("tokenize_short", _token_sql(text_fn.SHORT_TOKEN_PATTERN, "none"))
def tokenize_short(spark, sf_dir):
    return _token_rows(spark, sf_dir, text_fn.SHORT_TOKEN_PATTERN)


def _stop_sql(stops):
    return f"""WITH {sql.postings("kept", "documents", "text", stops=stops)}
    SELECT doc_id, sum(tf)::BIGINT AS n_tokens, count(*) AS n_terms FROM kept GROUP BY 1"""


def _stop_counts(spark, sf_dir, stops):
    kept = tables.documents(spark, sf_dir).select("doc_id", F.explode(F.array(text_fn.tokens("text", stop_words(stops)))).alias("words"))
    counts = kept.select("doc_id", F.size("words").cast("long").alias("n_tokens"), F.size(F.array_distinct("words")).cast("long").alias("n_terms"))
    return counts.where("n_tokens > 0")


@query("stopwords_english", _stop_sql("english"))
def stopwords_english(spark, sf_dir):
    """(doc_id, n_tokens, n_terms) that each stop set leaves."""
    return _stop_counts(spark, sf_dir, "english")


@query("stopwords_all", _stop_sql("all"))
def stopwords_all(spark, sf_dir):
    return _stop_counts(spark, sf_dir, "all")


@query("stopwords_gcp", _stop_sql("full"))
def stopwords_gcp(spark, sf_dir):
    return _stop_counts(spark, sf_dir, "full")


@query(
    "filter_tokens",
    f"""WITH {sql.postings("all_words", "documents", "text", stops="none", pattern=text_fn.SHORT_TOKEN_PATTERN)},
    removed AS (SELECT DISTINCT term FROM (SELECT unnest({sql.token_list("text", text_fn.SHORT_TOKEN_PATTERN)}) AS term
        FROM benchmark))
    SELECT term, doc_id, tf FROM all_words WHERE term NOT IN (SELECT term FROM removed)""",
)
def filter_tokens(spark, sf_dir):
    """Postings without a given set of tokens, here the words of the benchmark texts."""
    removed = tables.benchmark_queries(spark, sf_dir).select(
        F.explode(text_fn.tokens("text", pattern=text_fn.SHORT_TOKEN_PATTERN)).alias("term")
    )
    postings = index.build_postings(tables.documents(spark, sf_dir), pattern=text_fn.SHORT_TOKEN_PATTERN)
    return index.remove_terms(postings, removed.distinct()).select("term", "doc_id", "tf")


@query(
    "filter_tokens_stemmed",
    f"""WITH {sql.postings("p", "documents", "text", stops="none", pattern=text_fn.SHORT_TOKEN_PATTERN)},
    removed AS (SELECT DISTINCT unnest({sql.token_list("text", text_fn.SHORT_TOKEN_PATTERN)}) AS term FROM benchmark),
    kept AS (SELECT * FROM p WHERE term NOT IN (SELECT term FROM removed)),
    vocabulary AS (SELECT DISTINCT term FROM kept), {sql.stems("stems", "vocabulary")}
    SELECT stem AS term, doc_id, sum(tf)::BIGINT AS tf FROM kept JOIN stems USING (term) GROUP BY 1, 2""",
)
def filter_tokens_stemmed(spark, sf_dir):
    """The same with the tokens that are left as stems; a document's words of one stem are one posting."""
    kept = filter_tokens(spark, sf_dir)
    return stats.stem_postings(kept, stats.stem_vocabulary(kept.select("term").distinct()))


@query(
    "stem_vocabulary",
    f"""WITH {sql.postings("body", "documents", "text")}, vocabulary AS (SELECT DISTINCT term FROM body),
    {sql.stems("stems", "vocabulary")} SELECT term, stem FROM stems""",
)
def stem_vocabulary(spark, sf_dir):
    """(term, stem) of the body vocabulary."""
    return stats.stem_vocabulary(tables.search_index(spark, sf_dir).term_stats("body"))


@query(
    "filter_short_stop",
    f"""WITH {sql.postings("p", "documents", "text", stops="none", pattern=text_fn.SHORT_TOKEN_PATTERN)}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM p
    WHERE length(term) > 2 AND term NOT IN ({sql.words(stop_words("english"))}) GROUP BY 1""",
)
def filter_short_stop(spark, sf_dir):
    postings = index.build_postings(tables.documents(spark, sf_dir), pattern=text_fn.SHORT_TOKEN_PATTERN)
    return stats.content_words(index.term_stats(postings), stop_words("english"))


def _typed_rows(spark, sf_dir):
    text = text_fn.strip_markup("html")
    pages = tables.read(spark, sf_dir, "pages", "page_id", "html")
    return pages.repartition(dealt_parts(pages)).select("page_id", F.inline(text_fn.typed_tokens(text)))


def _typed_sql() -> str:
    kinds = " ".join(f"WHEN regexp_matches(piece, {sql.quoted(text_fn.whole_piece(p))}) THEN '{name}'" for name, p in text_fn.PIECE_TYPES)
    closing = " ".join(
        f"WHEN regexp_matches(piece, {sql.quoted(text_fn.whole_piece(p))})"
        f" THEN length(regexp_extract(piece, {sql.quoted(text_fn.whole_piece(p))}, 2))"
        for _, p in text_fn.PIECE_TYPES
    )
    return f"""WITH bodies AS (SELECT page_id, {sql.stripped()} AS body FROM pages),
    pieces AS (SELECT page_id, unnest(regexp_extract_all(body, {sql.quoted(text_fn.PIECES)})) AS piece FROM bodies),
    kinds AS (SELECT page_id, CASE {kinds} ELSE 'OTHER' END AS token_type, length(piece) AS size,
        CASE {closing} ELSE length(regexp_extract(piece, '[.,:;!?)]*$')) END AS closing FROM pieces),
    typed AS (SELECT page_id, token_type, 1 AS n FROM kinds WHERE size > closing
        UNION ALL SELECT page_id, 'OTHER', closing FROM kinds WHERE closing > 0)"""


@query("typed_tokens", f"{_typed_sql()} SELECT page_id, token_type, sum(n)::BIGINT AS n FROM typed GROUP BY 1, 2")
def typed_tokens(spark, sf_dir):
    """(page_id, token_type, n) over the text of the pages."""
    return _typed_rows(spark, sf_dir).groupBy("page_id", "token_type").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_token_types", f"{_typed_sql()} SELECT page_id, count(DISTINCT token_type) AS n_types FROM typed GROUP BY 1")
def distinct_token_types(spark, sf_dir):
    return _typed_rows(spark, sf_dir).groupBy("page_id").agg(F.count_distinct("token_type").alias("n_types"))


@query("strip_markup", f"SELECT page_id, {sql.stripped()} AS body FROM pages")
def strip_markup(spark, sf_dir):
    return tables.pages(spark, sf_dir).select("page_id", text_fn.strip_markup("html").alias("body"))


@query("extract_links", f"WITH {sql.LINKS} SELECT page_id, target, anchor_text FROM links")
def extract_links(spark, sf_dir):
    return tables.page_links(spark, sf_dir)


# Each link of the pages stands in the caption of a file, after a template with a category.
_CAPTION = "[[File:page.png|thumb|{{note|[[Category:notes]]}} see [[$1|$2]] [1] ]]"


@query(
    "extract_wiki_links",
    f"""WITH raw AS (SELECT page_id, unnest(regexp_extract_all(html, {sql.quoted(text_fn.HTML_LINK)}, 1)) AS t,
        unnest(regexp_extract_all(html, {sql.quoted(text_fn.HTML_LINK)}, 2)) AS a FROM pages),
    clean AS (SELECT page_id, t, regexp_replace(a, {sql.quoted(text_fn.WIKI_MARKUP)}, '', 'g') AS a FROM raw)
    SELECT page_id, regexp_replace(t, '#.*$', '') AS target,
        regexp_replace(CASE WHEN a = '' THEN t ELSE a END, {sql.quoted(text_fn._URL)}, '', 'g') AS anchor_text
    FROM clean WHERE t <> '' AND NOT regexp_matches(t, {sql.quoted(text_fn.NOT_AN_ARTICLE)})""",
)
def extract_wiki_links(spark, sf_dir):
    """Links of wiki texts: the pages with their links in nested brackets."""
    wikitext = F.regexp_replace("html", F.lit(text_fn.HTML_LINK), F.lit(_CAPTION))
    return tables.pages(spark, sf_dir).select("page_id", F.inline(text_fn.wiki_links(wikitext)))


# The pages link to no images or categories, so each link is tried as one too.
_TARGETS = [
    ("link", "regexp_replace(href, '^/', '')"),
    ("image", "concat(regexp_replace(href, '^/', ''), '.jpg')"),
    ("category", "concat('Category:', regexp_replace(href, '^/', ''))"),
]


@query(
    "filter_article_links",
    f"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, {sql.quoted(text_fn.HTML_LINK)}, 1)) AS href
        FROM pages),
    t AS ({" UNION ALL ".join(f"SELECT page_id, '{k}' AS kind, {e} AS target FROM h" for k, e in _TARGETS)})
    SELECT page_id, kind, target FROM t
    WHERE target <> '' AND NOT regexp_matches(target, {sql.quoted(text_fn.NOT_AN_ARTICLE)})""",
)
def filter_article_links(spark, sf_dir):
    """Links to articles among the hrefs as they are, as image names and as categories."""
    hrefs = tables.pages(spark, sf_dir).select(
        "page_id", F.explode(F.regexp_extract_all("html", F.lit(text_fn.HTML_LINK), F.lit(1))).alias("href")
    )
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(e).alias("target")) for k, e in _TARGETS])
    return hrefs.select("page_id", F.inline(kinds)).where(text_fn.is_article("target"))
