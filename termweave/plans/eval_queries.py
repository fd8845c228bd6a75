"""Evaluation of BM25 runs against the judgements."""

from __future__ import annotations

from pyspark.sql import functions as F

from termweave.operators import blend, evaluate, index, rank
from termweave.plans import sql, tables
from termweave.plans.rank_queries import Search
from termweave.plans.registry import query

K = 40
# Fixed values.
KS = [1, 3, 5, 10, 20, 30, 40]
R3 = 3
# Ids of the log of query times.
LOGGED = 40

RUN = f"""{sql.BENCHMARK}, {sql.BODY_STATS}, {sql.QRELS}, {sql.hits("body")}, {sql.bm25_scores("scores")},
    {sql.ranked("run", "scores", None)}"""
N_DOCS = "(SELECT count(*) FROM documents)"


def mean_sql(name: str) -> str:
    """Mean of a 3-digit column, added up in whole thousandths."""
    return sql.rounded(f"sum(floor({name} * 1000 + 0.5e0)::BIGINT)::DOUBLE / (1000.0e0 * count(*))", 5)


def metrics_sql(ks: list[int], by: str = "", settings: str = "(SELECT 1)") -> str:
    """CTE metrics: one row per setting, query and k for CTEs run and qrels; `by` ends in a comma."""
    join = "".join(f" AND w.{c} IS NOT DISTINCT FROM m.{c}" for c in by.replace(" ", "").split(",") if c)
    values = ", ".join(f"({k})" for k in ks)

    def r3(value: str) -> str:
        return sql.rounded(value, R3)

    return f"""
    ks AS (SELECT * FROM (VALUES {values}) t(k)),
    rel AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY 1),
    judged_run AS (SELECT r.*, q.grade, (q.grade IS NOT NULL)::INT AS hit FROM run r LEFT JOIN qrels q USING (query_id, doc_id)),
    at_rank AS (SELECT *, sum(hit) OVER (PARTITION BY {by} query_id ORDER BY rank) AS seen FROM judged_run),
    whole AS (SELECT {by} query_id, sum(CASE WHEN rank <= n_rel THEN hit ELSE 0 END)::BIGINT AS r_hits
        FROM judged_run JOIN rel USING (query_id) GROUP BY ALL),
    inside AS (SELECT {by} query_id, k, sum(hit)::BIGINT AS hits, count(*) AS shown,
        min(CASE WHEN hit = 1 THEN rank END) AS first_hit,
        sum(CASE WHEN hit = 1 THEN floor(seen::DOUBLE / rank * 1000 + 0.5e0)::BIGINT END)::DOUBLE
            / (1000.0e0 * nullif(sum(hit), 0)) AS ap,
        avg(CASE WHEN hit = 1 THEN seen::DOUBLE / rank END) AS ap_exact,
        sum(CASE WHEN hit = 1 THEN grade / log2(rank + 1.0e0) END) AS dcg
        FROM at_rank, ks WHERE rank <= k GROUP BY ALL),
    best_grades AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc_id) AS place FROM qrels),
    ideal AS (SELECT query_id, k, sum(grade / log2(place + 1.0e0)) AS ideal FROM best_grades, ks WHERE place <= k
        GROUP BY 1, 2),
    base AS (SELECT rel.*, ks.k, s.* FROM rel, ks, {settings} s),
    joined AS (SELECT m.*, coalesce(w.hits, 0) AS hits, coalesce(w.shown, 0) AS shown, w.first_hit,
        coalesce(w.ap, 0) AS ap, coalesce(w.ap_exact, 0) AS ap_exact, coalesce(w.dcg, 0) AS dcg, coalesce(i.ideal, 0) AS ideal
        FROM base m LEFT JOIN inside w ON w.query_id = m.query_id AND w.k = m.k {join}
        LEFT JOIN ideal i ON i.query_id = m.query_id AND i.k = m.k),
    rounded_rp AS (SELECT m.*, {r3("hits::DOUBLE / n_rel")} AS recall, {r3("hits::DOUBLE / k")} AS precision,
        coalesce(w.r_hits, 0) AS r_hits FROM joined m LEFT JOIN whole w ON w.query_id = m.query_id {join}),
    metrics AS (SELECT {by} query_id, k, recall, precision,
        {r3("CASE WHEN recall + precision = 0 THEN 0 ELSE 2.0e0 * precision * recall / (recall + precision) END")} AS f_score,
        {r3("r_hits::DOUBLE / n_rel")} AS r_precision,
        {r3("coalesce(1.0e0 / first_hit, 0)")} AS reciprocal_rank,
        {r3("ap")} AS average_precision, {r3("ap_exact")} AS exact_average_precision,
        {r3(f"(shown - hits)::DOUBLE / ({N_DOCS} - n_rel)")} AS fallout,
        {r3("CASE WHEN ideal = 0 THEN 0 ELSE dcg / ideal END")} AS ndcg FROM rounded_rp)"""


EVALUATED = f"{RUN}, {metrics_sql([K])}"


def bm25_run(spark, sf_dir, ks=(K,)):
    """The BM25 run, each query as deep as its metrics look: the largest k, or all that could be relevant."""
    n_rel = tables.qrels(spark, sf_dir).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))
    depth = n_rel.select("query_id", F.greatest("n_rel", F.lit(max(ks))).alias("depth"))
    search = Search(spark, sf_dir)
    return rank.top_by(search.bm25(), depth, search.fits)


def _metrics(spark, sf_dir, ks=(K,), **options):
    n_docs = tables.search_index(spark, sf_dir).n_docs("body")
    return evaluate.evaluate(
        bm25_run(spark, sf_dir, ks), tables.qrels(spark, sf_dir), ks, collection_size=n_docs, **options
    )


def _metric(name, column, sql_column=None, **options):
    """Register the query of one metric."""
    text = f"WITH {EVALUATED} SELECT query_id, k, {sql_column or column} AS {column} FROM metrics"

    @query(name, text)
    def one_metric(spark, sf_dir):
        return _metrics(spark, sf_dir, **options).select("query_id", "k", column)


@query("intersection", f"WITH {RUN} SELECT DISTINCT query_id, doc_id FROM run JOIN qrels USING (query_id, doc_id)")
def intersection(spark, sf_dir):
    return evaluate.intersection(Search(spark, sf_dir).bm25(), tables.qrels(spark, sf_dir))


_metric("recall_at_k", "recall")
_metric("precision_at_k", "precision")
_metric("r_precision", "r_precision")
_metric("reciprocal_rank_at_k", "reciprocal_rank")
_metric("fallout_at_k", "fallout")
_metric("f_score_at_k", "f_score")
_metric("average_precision", "average_precision")
_metric("average_precision_exact", "average_precision", "exact_average_precision", ap_rounding=False)
_metric("ndcg_at_k", "ndcg")
_FOLD = "list_reduce(list_prepend(0.0::DOUBLE, {}), lambda g, x: CASE WHEN g = 0 THEN x ELSE x / log2(g + 1.0e0) END)"
_GAIN, _IDEAL = (_FOLD.format(f"list(grade::DOUBLE ORDER BY {o})") for o in ("rank", "grade DESC"))


@query(
    "ndcg_recursive",
    f"""WITH {RUN}, found AS (SELECT query_id, {_GAIN} AS gain, {_IDEAL} AS ideal
        FROM run JOIN qrels USING (query_id, doc_id) WHERE rank <= {K} GROUP BY 1)
    SELECT query_id, {K} AS k, {sql.rounded("coalesce(CASE WHEN ideal = 0 THEN 0 ELSE gain / ideal END, 0)", R3)} AS ndcg
    FROM (SELECT DISTINCT query_id FROM qrels) LEFT JOIN found USING (query_id)""",
)
def ndcg_recursive(spark, sf_dir):
    return _metrics(spark, sf_dir, ndcg="recursive").select("query_id", "k", "ndcg")


NAMES = ", ".join(evaluate.METRICS)
MEANS = ", ".join(f"{mean_sql(m)} AS {m}" for m in evaluate.METRICS)


@query("evaluate", f"WITH {EVALUATED} SELECT query_id, k, {NAMES} FROM metrics")
def evaluate_all(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query("evaluate_mean", f"WITH {EVALUATED} SELECT k, {MEANS} FROM metrics GROUP BY k")
def evaluate_mean(spark, sf_dir):
    return evaluate.mean_metrics(_metrics(spark, sf_dir), by=["k"])


@query(
    "map_at_40",
    f"""WITH {EVALUATED} SELECT {mean_sql("average_precision")} AS map FROM metrics""",
)
def map_at_40(spark, sf_dir):
    """Queries without a hit count as unanswered: their value is null and they stay in the divisor."""
    ap = F.when(F.col("average_precision") > 0, F.col("average_precision"))
    return evaluate.mean_ap_with_misses(_metrics(spark, sf_dir).select(ap.alias("ap")))


@query("avg_eval_speed", f"SELECT {sql.rounded('avg(abs(value))', 5)} AS avg_eval_speed FROM events WHERE event_type = 'click'")
def avg_eval_speed(spark, sf_dir):
    """Mean duration over a log; the value of a click event stands in for a query time."""
    log = tables.read(spark, sf_dir, "events", "event_type", "value").where("event_type = 'click'")
    return evaluate.mean_speed(log.select(F.abs("value").alias("duration")))


LOG = f"""log AS (SELECT event_id % {LOGGED} AS query_id, avg(abs(value)) AS duration FROM events WHERE event_type = 'click'
        GROUP BY 1)"""


@query(
    "eval_summary",
    f"""WITH {EVALUATED}, {LOG} SELECT {mean_sql("recall")} AS recall, {mean_sql("f_score")} AS f_score,
    {mean_sql("r_precision")} AS r_precision, {sql.rounded("avg(duration)", 5)} AS avg_eval_speed,
    {mean_sql("average_precision")} AS map FROM metrics LEFT JOIN log USING (query_id)""",
)
def eval_summary(spark, sf_dir):
    clicks = tables.read(spark, sf_dir, "events", "event_id", "event_type", "value").where("event_type = 'click'")
    log = clicks.groupBy((F.col("event_id") % LOGGED).alias("query_id")).agg(
        F.avg(F.abs("value")).alias("duration")
    )
    return evaluate.eval_summary(_metrics(spark, sf_dir), log)


@query(
    "train_test_split",
    f"""SELECT item_id AS query_id, text, CASE WHEN row_number() OVER (ORDER BY item_id)
        <= {tables.TRAIN_SHARE}e0 * count(*) OVER () THEN 'train' ELSE 'test' END AS part FROM benchmark""",
)
def train_test_split(spark, sf_dir):
    """The first two thirds of the benchmark queries train, the others test."""
    queries = tables.benchmark_queries(spark, sf_dir)
    n_train = queries.agg(F.count(F.lit(1)) * tables.TRAIN_SHARE).scalar()
    return evaluate.train_test_split(queries, n_train, index.number_rows(queries, "query_id"))


GRID_SETTINGS = ", ".join(
    f"({k1}e0, {b}e0, {t}e0, {w}e0)" for k1, b in tables.BM25_SETTINGS for t, w in tables.BLEND_WEIGHTS
)
GRID_BY = ["k1", "b", "title_weight", "body_weight"]
N_GRID = 30


def _grid_sql(part: str) -> str:
    side = "<=" if part == "train" else ">"
    queries = f"""(SELECT item_id, text FROM (SELECT *, row_number() OVER (ORDER BY item_id) AS place, count(*) OVER () AS n
        FROM benchmark) WHERE place {side} {tables.TRAIN_SHARE}e0 * n)"""
    parts = [sql.query_terms(queries, "item_id"), sql.BODY_STATS, sql.TITLE_STATS, sql.QRELS,
             f"grid AS (SELECT * FROM (VALUES {GRID_SETTINGS}) t(k1, b, title_weight, body_weight))",
             "bm AS (SELECT DISTINCT k1, b FROM grid)"]
    for field in ["body", "title"]:
        score = sql.rounded("sum(qtf * " + sql.bm25_weight(k1="k1", b="b") + ")", 5)
        parts += [
            sql.hits(field).replace("hits AS", f"{field}_hits AS"),
            f"{field}_scores AS (SELECT k1, b, query_id, doc_id, {score} AS score FROM {field}_hits, bm GROUP BY ALL)",
            sql.ranked(f"{field}_run", f"{field}_scores", N_GRID, "k1, b, query_id"),
        ]
    merged = sql.rounded("coalesce(t.score, 0) * title_weight + coalesce(y.score, 0) * body_weight", 5)
    parts += [
        f"""merged AS (SELECT k1, b, title_weight, body_weight, query_id, doc_id, {merged} AS score
        FROM title_run t FULL JOIN body_run y USING (k1, b, query_id, doc_id) JOIN grid USING (k1, b))""",
        sql.ranked("run", "merged", N_GRID, "k1, b, title_weight, body_weight, query_id"),
        metrics_sql([N_GRID], "k1, b, title_weight, body_weight,", "grid"),
    ]
    return ", ".join(parts)


def _means_sql(part: str) -> str:
    return f"""{_grid_sql(part)}, means AS (SELECT k1, b, title_weight, body_weight,
        {mean_sql("average_precision")} AS average_precision FROM metrics GROUP BY ALL)"""


BEST = "ORDER BY average_precision DESC, k1, b, title_weight, body_weight LIMIT 1"


def _grid_means(spark, sf_dir, part):
    """Mean average precision of the merged title and body run for every setting, over one part of the queries."""
    chosen = train_test_split(spark, sf_dir).where(F.col("part") == part).select("query_id")
    terms = tables.benchmark_terms(spark, sf_dir).join(chosen, "query_id", "left_semi")
    qrels = tables.qrels(spark, sf_dir).join(chosen, "query_id", "left_semi")
    runs = []
    for field in ["title", "body"]:
        search = Search(spark, sf_dir, field, terms)
        scores = rank.bm25_grid(search.found, search.n_docs, search.avg_len, tables.BM25_SETTINGS)
        runs.append(rank.top_n(scores, N_GRID, ["k1", "b", "query_id"]).drop("rank"))
    weights = F.array(*[
        F.struct(F.lit(t).alias("title_weight"), F.lit(w).alias("body_weight")) for t, w in tables.BLEND_WEIGHTS
    ])
    settings = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(GRID_BY, (*bm, *w))])
        for bm in tables.BM25_SETTINGS for w in tables.BLEND_WEIGHTS
    ])
    run = blend.merge_grid(*runs, weights, N_GRID, ["k1", "b", "query_id"])
    metrics = evaluate.evaluate(
        run, qrels, [N_GRID], GRID_BY, settings, tables.search_index(spark, sf_dir).n_docs("body")
    )
    return evaluate.mean_metrics(metrics, GRID_BY, ["average_precision"])


@query("grid_search", f"WITH {_means_sql('train')} SELECT * FROM means")
def grid_search(spark, sf_dir):
    """Every setting on the queries that train."""
    return _grid_means(spark, sf_dir, "train")


@query("grid_search_best", f"WITH {_means_sql('train')} SELECT * FROM means {BEST}")
def grid_search_best(spark, sf_dir):
    return evaluate.best_setting(_grid_means(spark, sf_dir, "train"), GRID_BY)


@query(
    "grid_search_test",
    f"""SELECT t.*, b.average_precision AS train_average_precision
    FROM (WITH {_means_sql("test")} SELECT * FROM means) t
    JOIN (WITH {_means_sql("train")} SELECT * FROM means {BEST}) b USING (k1, b, title_weight, body_weight)""",
)
def grid_search_test(spark, sf_dir):
    """The setting that was best on the queries that train, on those that test."""
    best = evaluate.best_setting(_grid_means(spark, sf_dir, "train"), GRID_BY)
    best = best.withColumnRenamed("average_precision", "train_average_precision")
    return _grid_means(spark, sf_dir, "test").join(best, GRID_BY)


@query("metrics_by_k", f"WITH {RUN}, {metrics_sql(KS)} SELECT k, {MEANS} FROM metrics GROUP BY k")
def metrics_by_k(spark, sf_dir):
    return evaluate.mean_metrics(_metrics(spark, sf_dir, KS), by=["k"])


LONG_NAMES = ["precision", "recall", "f_score", "reciprocal_rank", "fallout"]


@query(
    "metrics_by_query",
    f"WITH {EVALUATED} "
    + " UNION ALL ".join(f"SELECT query_id, '{m}' AS metric, {m} AS value FROM metrics" for m in LONG_NAMES),
)
def metrics_by_query(spark, sf_dir):
    return evaluate.long_form(_metrics(spark, sf_dir), LONG_NAMES, ["query_id"])
