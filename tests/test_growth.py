"""Work and memory of a task must not grow with the tables, and the rows must stay those of the plain way."""

import math

import pytest
from pyspark.sql import functions as F
from test_scale import SF_DIR, plan_of, rows

from termweave.functions import text as text_fn
from termweave.operators import index, joins, rank, stats
from termweave.plans import QUERIES, tables
from termweave.plans.rank_queries import Search
from termweave.sources import index_store


def test_sums_by_query_and_document_shuffle_postings_not_their_queries(spark):
    search = Search(spark, SF_DIR)
    plan = plan_of(rank.candidates(search.found))
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(query_id" not in plan
    stored = tables.search_index(spark, SF_DIR)
    _, plain = stored.match(tables.benchmark_terms(spark, SF_DIR), "body")
    columns = ["query_id", "term", "doc_id", "qtf", "tf", "df"]
    assert rows(search.found, *columns) == rows(plain, *columns)
    assert rows(rank.fast_cosine(search.found), "query_id", "doc_id", "score") == rows(rank.fast_cosine(plain), "query_id", "doc_id", "score")


@pytest.mark.parametrize("fits", [True, False])
def test_subset_counts_every_tf(spark, fits):
    """N is the number of distinct (document, tf), also of large tf, and rows without a document do not count."""
    of = [(1, 7, 1), (1, 7, 1), (1, 7, 62), (1, 7, 63), (1, 7, 63), (1, 7, 500), (1, 8, 1), (1, None, 4), (2, None, 1)]
    weights = [(2, 1), (50, 2)]
    found_rows = [(q, d, tf, *weights[i % 2], 3) for i, (q, d, tf) in enumerate(of)]
    found = spark.createDataFrame(found_rows, "query_id LONG, doc_id LONG, tf LONG, df LONG, qtf LONG, query_len LONG")
    known = spark.createDataFrame([(q, *w, 3) for q in (1, 2) for w in weights], "query_id LONG, df LONG, qtf LONG, query_len LONG")
    scores = rank.subset_score(known, found, fits)
    assert "count(distinct" not in plan_of(scores) and ("BroadcastHashJoin" in plan_of(scores)) >= fits

    def weight(df, qtf):
        return qtf / 3 * math.log10(5 / (df + 1e-7))

    norm = math.sqrt(sum(weight(*w) ** 2 for w in weights))
    got = {r.doc_id: r.score for r in scores.where("query_id = 1").collect()}
    for doc in (7, 8, None):
        own = [(tf * df, weight(df, qtf)) for _, d, tf, df, qtf, _ in found_rows[:-1] if d == doc]
        cosine = sum(d * w for d, w in own) / (math.sqrt(sum(d * d for d, _ in own)) * norm)
        assert got[doc] == pytest.approx(cosine, abs=1e-5)


def test_depths_meet_the_run_before_its_shuffle(spark):
    run = spark.createDataFrame([(q, d, float(d % 17) - 3) for q in (1, 2) for d in range(100)], "query_id LONG, doc_id LONG, score DOUBLE")
    depths = spark.createDataFrame([(1, 5), (2, 60)], "query_id LONG, depth INT")
    sent = rank.top_by(run, depths, True)
    assert "BroadcastExchange" in plan_of(sent)
    assert rows(sent, "query_id", "doc_id", "rank") == rows(rank.top_by(run, depths), "query_id", "doc_id", "rank")


def test_heavy_work_is_dealt_by_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "DEALT_BYTES", 2_000)
    n = joins.dealt_parts(tables.read(spark, SF_DIR, "pages", "page_id", "html"))
    assert n > 2 * spark.sparkContext.defaultParallelism
    for name in ("typed_tokens", "distinct_token_types"):
        assert f"RoundRobinPartitioning({n})" in plan_of(QUERIES[name](spark, SF_DIR))


PIECES = "a.\u2028 b\u2028c <a\nhref> x<y ( < <> p@q!? 12% 1,234.5 don't, May 5, 1999. 5 May 1999x 10:30:00 .,! déjà \u0085 -3 Ab_c"


def test_a_piece_is_matched_once(spark):
    """Tokens of pieces with line separators, brackets and signs: those of one pattern for each type."""
    df = spark.createDataFrame([(PIECES,), ("",), (None,)], "text STRING")
    got = [r.t and [tuple(x) for x in r.t] for r in df.select(text_fn.typed_tokens("text").alias("t")).collect()]
    want = []
    pieces = df.select(F.posexplode(F.regexp_extract_all("text", F.lit(text_fn.PIECES), F.lit(0))).alias("i", "piece"))
    kind, token, rest = F.lit("OTHER"), F.regexp_extract("piece", r"^(.*?)([.,:;!?)]*)$", 1), F.regexp_extract("piece", r"^(.*?)([.,:;!?)]*)$", 2)
    for name, pattern in reversed(text_fn.PIECE_TYPES):
        fits = F.col("piece").rlike(text_fn.whole_piece(pattern))
        kind = F.when(fits, name).otherwise(kind)
        token = F.when(fits, F.regexp_extract("piece", text_fn.whole_piece(pattern), 1)).otherwise(token)
        rest = F.when(fits, F.regexp_extract("piece", text_fn.whole_piece(pattern), 2)).otherwise(rest)
    for r in pieces.select("i", kind.alias("kind"), token.alias("token"), rest.alias("rest")).orderBy("i").collect():
        want += [(r.token, r.kind)] * (r.token != "") + [(x, "OTHER") for x in r.rest]
    assert len(want) > 25 and got == [want, [], None]


def test_possessive_tokens_are_the_same(spark):
    texts = [("a-b--c 'tis it's-o'k #tag @x- " + "w" * 60 + " x-" * 40 + " É-é's _a-_b ab- cd",), (None,)]
    df = spark.createDataFrame(texts, "text STRING").unionByName(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text"))
    for pattern in (text_fn.TOKEN_PATTERN, text_fn.SHORT_TOKEN_PATTERN, text_fn.VECTORIZER_PATTERN):
        plain = F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(0))
        both = df.select(text_fn.tokens("text", (), pattern).alias("a"), plain.alias("b"))
        assert both.where("NOT a <=> b").count() == 0


def test_merged_batches_shuffle_no_postings(spark, monkeypatch):
    monkeypatch.setattr(joins, "DEALT_BYTES", 2_000)
    docs = tables.read(spark, SF_DIR, "documents", "doc_id", "text")
    merged = index.merge_postings(index.batch_indexes(docs, 7))
    plan = plan_of(merged)
    assert "hashpartitioning(term" not in plan and f"hashpartitioning(doc_id#" in plan
    assert f", {joins.dealt_parts(docs)}), REPARTITION_BY_NUM" in plan
    assert rows(merged, "term", "doc_id", "tf") == rows(index.build_postings(docs), "term", "doc_id", "tf")


def test_stems_are_summed_in_parts_of_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "DEALT_BYTES", 2_000)
    docs = tables.read(spark, SF_DIR, "documents", "doc_id", "text")
    stored = index_store.write_documents(docs, text_fn.tokens("text", tables.STOPS), str(tmp_path), "body", 8)
    vocabulary = stats.stem_vocabulary(stored.term_stats("body"))
    summed = stats.stem_postings(stored.postings("body"), vocabulary)
    plan = plan_of(summed)
    assert f", {joins.dealt_parts(stored.postings('body'))}), REPARTITION_BY_NUM" in plan
    assert "hashpartitioning(term" not in plan.split("REPARTITION_BY_NUM")[0]
    plain = stored.postings("body").join(vocabulary, "term").groupBy(F.col("stem").alias("term"), "doc_id").agg(F.sum("tf").alias("tf"))
    assert rows(summed, "term", "doc_id", "tf") == rows(plain, "term", "doc_id", "tf")


def test_a_task_sorts_one_part_of_one_bucket(spark, tmp_path):
    """Files of a bucket are as many as its parts, each sorted, also where shuffles have fewer partitions than that."""
    of = [(i, f"w{i % 7} w{i % 7} x{i}") for i in range(60)] + [(100, ""), (101, None), (None, "w1 none none")]
    docs = spark.createDataFrame(of, "doc_id LONG, text STRING").repartition(3)
    path = str(tmp_path / "parts")
    stored = index_store.write_documents(docs, text_fn.tokens("text", pattern=text_fn.SHORT_TOKEN_PATTERN), path, "body", 2, 5)
    named = spark.read.parquet(f"{path}/postings").select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    of_file = named.where(f"bucket > {index_store.LENGTHS}").select("bucket", "file", "term", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "at").collect()
    files = {}
    for row in sorted(of_file, key=lambda r: r.at):
        files.setdefault((row.bucket, row.file), []).append((row.term, row.doc_id))
    assert all(found == sorted(found) for found in files.values())
    for bucket in (0, 1):
        assert sum(b == bucket for b, _ in files) == 5
    counted = {(r.term, r.doc_id, r.tf, r.doc_len) for r in stored.postings("body").collect()}
    want = {t for i in range(60) for t in ((f"w{i % 7}", i, 2, 3), (f"x{i}", i, 1, 3))} | {("w1", None, 1, 3), ("none", None, 2, 3)}
    assert counted == want and stored.postings("body").count() == len(want)
    assert {(r.doc_id, r.doc_len) for r in stored.doc_stats("body").where("doc_id >= 100").collect()} == {(100, 0), (101, None)}
    assert stored.doc_stats("body").count() == 63


def test_body_texts_are_dealt_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "dealt_parts", lambda df: 37)
    seen = {}

    def write(docs, tokens, path, field, *more):
        seen[field] = plan_of(docs)
        return index_store.write_documents(docs, tokens, path, field, *more)

    monkeypatch.setattr(tables, "write_documents", write)
    tables.build_search_index(spark, SF_DIR, str(tmp_path / "dealt"))
    assert "RoundRobinPartitioning(37)" in seen["body"]
