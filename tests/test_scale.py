"""Plans, skew paths and stored data: the ways a large job differs from a small one must not change results."""

import bz2
import json

import pytest
from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.stopwords import stop_words
from termweave.operators import graph, index, rank, stats
from termweave.plans import tables
from termweave.sources import corpus, index_store, segments

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return tables.documents(spark, SF_DIR)


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    return index_store.write_index(
        index.build_postings(docs, "text", tables.STOPS),
        index.doc_stats(docs, text_fn.tokens("text", tables.STOPS)),
        path,
        "body",
        n_buckets=16,
    )


def test_postings_need_no_shuffle_and_no_python(spark):
    plain = tables.read(spark, SF_DIR, "documents", "doc_id", "text")
    plan = plan_of(index.build_postings(plain, "text", stop_words("all")))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_term_statistics_shuffle_once(spark):
    plain = tables.read(spark, SF_DIR, "documents", "doc_id", "text")
    plan = plan_of(index.term_stats(index.build_postings(plain)))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_lookup_reads_only_its_buckets(stored):
    found = index_store.posting_lookup(stored, ["thnt", "ndst"], "body")
    plan = plan_of(found)
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(term, [ndst,thnt])" in plan
    everything = stored.postings("body").where(F.col("term").isin("thnt", "ndst"))
    assert rows(found, "term", "doc_id", "tf") == rows(everything, "term", "doc_id", "tf")


def test_matching_gives_the_same_rows_on_every_way(spark, stored):
    terms = tables.benchmark_terms(spark, SF_DIR)
    columns = ["query_id", "term", "doc_id", "qtf", "tf", "df"]
    _, sent = rank.match(terms, stored.postings("body"), stored.term_stats("body"))
    _, shuffled = rank.match(terms, stored.postings("body"), stored.term_stats("body"), broadcast_bytes=0)
    want = rows(stored.match(terms, "body")[1], *columns)
    assert len(want) > 1000
    assert rows(sent, *columns) == want
    assert rows(shuffled, *columns) == want
    assert "BroadcastHashJoin" in plan_of(sent)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(shuffled.select("*"))
        assert rows(shuffled.select("*"), *columns) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("sf, n_queries", [("sf0.001", 40), ("sf0.1", 200)])
def test_any_number_of_queries_prunes_buckets_without_a_job(spark, stored, sf, n_queries):
    """The same plan for few and many queries: the postings are not shuffled and only buckets of query terms are listed."""
    queries = tables.benchmark_queries(spark, f"/root/testdata/{sf}")
    assert queries.count() == n_queries
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job")
    _, found = stored.match(rank.query_terms(queries, tables.STOPS), "body")
    plan = plan_of(rank.bm25(found, 200, 100.0))
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("tests", "")
    scan = plan[plan.index("doc_len") :]
    assert "dynamicpruning" in scan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(query_id") == 1


def test_few_terms_read_few_files(spark, stored):
    """Buckets without a query term are not read at all."""
    queries = spark.createDataFrame([(1, "thnt ndst")], "query_id LONG, text STRING").where("query_id > 0")
    _, found = stored.match(rank.query_terms(queries), "body")
    n = found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert n == stored.postings("body").where(F.col("term").isin("thnt", "ndst")).count() > 0
    assert "dynamicpruning" in plan


def test_top_n_is_cut_before_the_shuffle(stored, spark):
    _, found = stored.match(tables.benchmark_terms(spark, SF_DIR), "body")
    plan = plan_of(rank.top_n(rank.bm25(found, 200, 100.0), 10))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Python" not in plan


def test_index_invariants(spark, docs, stored):
    postings, terms, lengths = stored.postings("body"), stored.term_stats("body"), stored.doc_stats("body")
    assert terms.agg(F.sum("df")).first()[0] == postings.count()
    assert terms.agg(F.sum("term_total")).first()[0] == lengths.agg(F.sum("doc_len")).first()[0]
    assert lengths.count() == docs.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert rows(index.doc_lengths(postings), "doc_id", "doc_len") == rows(
        lengths.where("doc_len > 0"), "doc_id", "doc_len"
    )
    again = index_store.read_index(spark, stored.path)
    assert again.n_buckets == 16
    placed = postings.where(F.col("bucket") != index_store.bucket_of("term", 16))
    assert placed.isEmpty()


def test_batches_make_the_same_index(docs):
    whole = index.build_postings(docs, "text", tables.STOPS)
    parts = index.batch_indexes(docs, 30, "text", tables.STOPS)
    assert parts.select("batch").distinct().count() == 7
    assert rows(index.merge_postings(parts), "term", "doc_id", "tf") == rows(whole, "term", "doc_id", "tf")


def test_block_size_does_not_matter(docs):
    postings = index.build_postings(docs, "text", tables.STOPS)
    columns = ["term", "position", "doc_id", "tf"]
    assert rows(index.posting_lists(postings, 7), *columns) == rows(index.posting_lists(postings), *columns)
    assert index.posting_blocks(postings, 7).agg(F.max(F.size("postings"))).first()[0] <= 7


def test_rows_with_sparse_ids_are_numbered_in_ranges(spark, docs):
    sparse = docs.select(F.xxhash64("doc_id").alias("doc_id"))
    numbered = index.number_rows(sparse)
    ids = sorted(r.doc_id for r in sparse.collect())
    assert rows(numbered, "doc_id", "row_number") == [(x, i + 1) for i, x in enumerate(ids)]
    offsets = index.number_rows(spark.range(100_000).select(F.xxhash64("id").alias("doc_id")))
    assert offsets.agg(F.max("row_number"), F.count_distinct("row_number")).first()[:] == (100_000, 100_000)


def test_cosine_shuffles_its_sums_only(spark, docs):
    from termweave.plans.rank_queries import Search

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        search = Search(spark, SF_DIR, with_norm=True)
        plan = rank.top_n(rank.cosine(search.found, search.n_docs), 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = plan.split("HashAggregate")[0]
    assert "Partial" in top and "SortMergeJoin" not in top


def test_zipf_pieces(docs, monkeypatch):
    terms = index.term_stats(index.build_postings(docs))
    want = rows(stats.zipf(terms), "rank", "frequency")
    monkeypatch.setattr(stats, "RANKS_PER_ROW", 10)
    assert rows(stats.zipf(terms), "rank", "frequency") == want
    assert [r for r, _ in want] == list(range(1, len(want) + 1))
    assert all(a >= b for (_, a), (_, b) in zip(want, want[1:]))


HUB = [(0, i) for i in range(1, 40)] + [(i, 0) for i in range(1, 40, 2)] + [(i, i + 1) for i in range(1, 30)]


def test_pagerank_of_a_hub_in_parts(spark):
    edges = spark.createDataFrame(HUB + HUB[:5], "src LONG, dst LONG")
    whole = dict(rows(graph.pagerank(edges, 5), "id", "pagerank"))
    parts = dict(rows(graph.pagerank(edges, 5, edges_per_part=4), "id", "pagerank"))
    assert parts == pytest.approx(whole)
    assert sum(whole.values()) == pytest.approx(len(whole))


def test_pagerank_layout_is_known_to_joins(spark):
    spark.sparkContext.setCheckpointDir(tables.shared_dir(spark))
    edges = spark.createDataFrame(HUB, "src LONG, dst LONG").withColumn("part", F.col("dst") % 2)
    laid_out = graph._lay_out(edges, 4, "src", "part")
    shares = spark.range(40).select(F.col("id").alias("src"), (F.col("id") % 2).alias("part"))
    plan = plan_of(laid_out.hint("merge").join(shares.hint("merge"), ["src", "part"]))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_rank_files_are_one_sorted_list(spark, tmp_path):
    ranks = spark.range(1000).select("id", (F.hash("id") % 50 / 7.0).alias("pagerank"))
    corpus.write_ranks(ranks, str(tmp_path / "pr"), files=4)
    files = sorted((tmp_path / "pr").glob("part-*.csv.gz"))
    assert len(files) == 4
    got = []
    for file in files:
        got += [tuple(r) for r in spark.read.schema("id LONG, pagerank DOUBLE").csv(str(file)).collect()]
    assert len(got) == 1000 and got == sorted(got, key=lambda row: (-row[1], row[0]))


DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/">
<page><title>Langnes</title><ns>0</ns><id>17</id><revision><id>1</id><text bytes="9">A [[town]]</text></revision></page>
<page><title>Old</title><ns>0</ns><id>18</id><redirect title="Langnes" /><revision><text>x</text></revision></page>
<page><title>Talk:Langnes</title><ns>1</ns><id>19</id><revision><text>y</text></revision></page>
</mediawiki>"""


def test_dump(spark, tmp_path):
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(DUMP.encode()))
    got = corpus.read_dump(spark, str(tmp_path / "dump.xml.bz2"))
    assert rows(got, "page_id", "title", "body") == [(17, "Langnes", "A [[town]]")]


def test_qrels_file(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"python": [5, 3], "best cat": [9]}, indent=1))
    got = rows(corpus.read_qrels(spark, str(tmp_path / "q.json")), "query", "position", "doc_id")
    assert got == [("best cat", 0, 9), ("python", 0, 5), ("python", 1, 3)]


def test_metrics_stay_in_range(spark):
    from termweave.operators import evaluate
    from termweave.plans.eval_queries import bm25_run

    metrics = evaluate.evaluate(bm25_run(spark, SF_DIR), tables.qrels(spark, SF_DIR), [1, 5, 40]).collect()
    assert metrics and all(0 <= row[m] <= 1 for row in metrics for m in evaluate.METRICS)


def test_documents_are_tokenized_once(spark, docs, stored, tmp_path):
    """One pass writes postings and lengths; they are those of two passes, also for documents without a token."""
    more = docs.unionByName(spark.createDataFrame([(-1, ""), (-2, " . ")], "doc_id LONG, text STRING"))
    tokens = text_fn.tokens("text", tables.STOPS)
    once = index_store.write_documents(more, tokens, str(tmp_path / "once"), "body", 16)
    twice = index_store.write_index(index.build_postings(more, "text", tables.STOPS), index.doc_stats(more, tokens), str(tmp_path / "twice"), "body", 16)
    for read in (lambda i: i.postings("body").drop("bucket"), lambda i: i.doc_stats("body"), lambda i: i.term_stats("body"), lambda i: i.corpus_stats("body")):
        assert rows(read(once), *read(once).columns) == rows(read(twice), *read(once).columns)
    assert once.doc_stats("body").where("doc_len = 0").count() >= 2
    plan = plan_of(once.doc_stats("body"))
    assert "(bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(stored.postings("body"), "term", "doc_id", "tf") == rows(once.postings("body").where("doc_id >= 0"), "term", "doc_id", "tf")


def test_indexes_open_by_their_path(spark, docs, tmp_path):
    """No index, an index without a manifest, one of another version, and a whole one."""
    path = str(tmp_path / "index")
    assert index_store.open_index(spark, path) is None
    index_store.write_documents(docs, text_fn.tokens("text"), path, "body", 16)
    assert index_store.open_index(spark, path, ["body"]).n_buckets == 16
    assert index_store.open_index(spark, path, ["body", "title"]) is None
    stats_of = spark.read.schema(index_store.SCHEMAS["manifest"]).parquet(f"{path}/manifest")
    stats_of.withColumn("version", F.lit(99)).write.partitionBy("field").parquet(str(tmp_path / "other" / "manifest"))
    assert index_store.open_index(spark, str(tmp_path / "other")) is None


def test_changed_files_have_another_name(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    first = corpus.file_digest(spark, [path])
    assert corpus.file_digest(spark, [path]) == first
    spark.range(4).write.mode("overwrite").parquet(path)
    assert corpus.file_digest(spark, [path]) != first


def test_depths_of_their_own_cut_before_the_shuffle(spark):
    """The best `depth` of each query, whatever the scores: ties, zeros, negative and very small ones."""
    run = [(q, d, s) for q in range(4) for d, s in enumerate([0.0, -1.0, 1e-12, 5.0, 5.0, 4.99, 1e9] * 20)]
    run = spark.createDataFrame(run, "query_id INT, doc_id INT, score DOUBLE")
    depths = spark.createDataFrame([(0, 1), (1, 45), (2, 10_000), (7, 3)], "query_id INT, depth INT")
    found = rank.top_by(run, depths)
    best = {}
    for q, d, s in sorted(map(tuple, run.collect()), key=lambda r: (-r[2], r[1])):
        best.setdefault(q, []).append((d, s))
    want = sorted((q, d, s, i + 1) for q, n in ((0, 1), (1, 45), (2, 10_000)) for i, (d, s) in enumerate(best[q][:n]))
    assert rows(found, "query_id", "doc_id", "score", "rank") == want


def test_settings_share_one_row_in_the_shuffle(spark, stored):
    _, found = stored.match(tables.benchmark_terms(spark, SF_DIR), "body")
    settings = [(1.4, 0.8), (1.6, 0.7), (2.0, 0.1)]
    grid = rank.bm25_grid(found, 200, 100.0, settings)
    assert plan_of(grid).count("Exchange hashpartitioning(query_id") == 1 and "partial_sum" in plan_of(grid)
    for k1, b in settings:
        one = rank.bm25(found, 200, 100.0, k1, b)
        assert rows(grid.where((F.col("k1") == k1) & (F.col("b") == b)), "query_id", "doc_id", "score") == rows(one, "query_id", "doc_id", "score")


def test_an_index_of_segments_equals_one_built_anew(spark, tmp_path):
    split = text_fn.tokens("text", tables.STOPS)
    make = lambda pairs: spark.createDataFrame(pairs, "doc_id LONG, text STRING")
    texts = {k: f"alpha{k % 7} beta{k % 3} beta{k % 3} gamma{k}" for k in range(400)}
    base = index_store.write_documents(make(list(texts.items())), split, str(tmp_path / "base"), "body", 8)
    grown = segments.start_segments(base, str(tmp_path / "grown"), "body")

    def same(index):
        anew = index_store.write_documents(make(list(texts.items())), split, str(tmp_path / f"anew{index.version}"), "body", 8)
        for table, columns in (("postings", ("term", "doc_id", "tf", "doc_len")), ("doc_stats", ("doc_id", "doc_len")), ("term_stats", ("term", "df", "term_total"))):
            assert rows(getattr(index, table)(), *columns) == rows(getattr(anew, table)("body"), *columns)

    # A new document, one that replaces another, one without words and one without text.
    added = {400: "delta delta", 5: "alpha0 delta", 6: "", 401: None}
    texts |= added
    grown = grown.add(make(list(added.items())), split)
    same(grown)
    for k in (5, 7, 400):
        del texts[k]
    grown = grown.delete(make([(5, ""), (7, ""), (400, ""), (9_999, ""), (None, "")]))
    same(grown)
    # A deleted document may come again.
    texts[7] = "epsilon"
    grown = grown.add(make([(7, "epsilon")]), split).add(make([]), split)
    same(grown)
    merged = grown.merge()
    # The base is not read or written again, and its folder stays that of the first version.
    assert [s.path for s in merged.segments][:1] == [base.path] and len(merged.segments) == 2
    same(merged)
    assert segments.open_segments(spark, str(tmp_path / "grown")) == merged
    assert segments.open_segments(spark, str(tmp_path / "grown"), grown.version) == grown
    whole = merged.merge_all()
    assert len(whole.segments) == 1 and whole.merge_all() == whole and whole.merge() == whole
    same(whole)
