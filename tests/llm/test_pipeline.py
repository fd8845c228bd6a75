"""The stages of the pipeline on a small corpus, against what each must keep."""

from __future__ import annotations

import corpus_pipeline
import pytest
from test_set_join import brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, mixed_rows, tmp_path_factory):
    """A folder with documents and benchmark."""
    path = str(tmp_path_factory.mktemp("corpus"))
    item = " ".join(f"item{k} word" for k in range(20))
    rows = [(d, t, "xx", s, n) for d, t, _, s, n in mixed_rows]
    rows += [(500, "kabar loden " * 5 + item + " kabar", "xx", "s", 1), (501, "kabar loden mifil write to x.y@z.org or pugom", "xx", "s", 1)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id LONG, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_keeps_what_it_must(spark, corpus, mixed_rows, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, corpus)
        assert k == 4 or out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        before, rows = rows, [tuple(r) for r in docs.collect()]
        ids = [r[0] for r in rows]
        if name == "language_id":
            prose = [r[0] for r in before if r[1] and len(r[1].split()) >= 10 and r[1].isascii()]
            assert set(prose) <= set(ids) and not {0, 1, 2} & set(ids)
        elif name == "ngram_jaccard_join":
            want = {d for d, (_, component) in brute_force(before, 5, 4, 5).items() if d == component}
            assert sorted(ids) == sorted(want)
        elif name == "decontamination":
            assert set(ids) == {r[0] for r in before} - {500}
        elif name == "pii":
            text = {r[0]: r[1] for r in rows}
            assert set(text) == {r[0] for r in before} and "<email>" in text[501] and "x.y@z.org" not in text[501]
            assert all(r[4] == len(r[1]) for r in rows)
        else:
            assert {r.doc_id for r in docs.collect()} == {r[0] for r in before}


def test_stages_on_an_empty_table(spark, corpus, empty, tmp_path):
    docs = empty
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0
