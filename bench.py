"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
Each query is timed once, end to end, with its result written to the noop sink; the index
that the searches read is built first and timed as `build_index`.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from termweave.plans import QUERIES, tables  # noqa: E402
from termweave.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "tokenize", "word_count", "document_frequency", "write_index", "posting_lists", "merge_indices",
    "count_words", "zipf", "index_variants", "posting_lookup", "bm25_index", "cosine_topn", "search_body",
    "search_title", "search_blend", "tfidf_vectorizer", "cosine_matrix", "evaluate", "grid_search", "metrics_by_k",
    "link_edges", "pagerank", "most_viewed", "strip_markup", "typed_tokens", "stem_vocabulary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    # Built anew for the time of a build; the queries then open the index that belongs to the tables, building it if it is not there.
    times = {"build_index": timed(lambda: tables.build_search_index(spark, sf_dir, scratch_path(spark, "bench-index")))}
    tables.search_index(spark, sf_dir)
    for name in sys.argv[1:] or HEADLINE:
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    result = {
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
