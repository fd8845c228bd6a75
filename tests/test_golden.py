"""Small cases with known results."""

import math
from collections import Counter

import pytest
from plain_stem import stem_word
from pyspark.sql import functions as F

from termweave.functions import text as text_fn
from termweave.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4, stem
from termweave.functions.stopwords import ENGLISH, stop_words
from termweave.operators import blend, evaluate, graph, index, rank, stats, views

# Golden inputs, and below the counts that they must give.
LITTLE_PRINCE = '''Oh, little prince! Bit by bit I came to understand the secrets of your sad little life...
For a long time you had found your only entertainment in the quiet pleasure of looking at the sunset.
I learned that new detail on the morning of the fourth day, when you said to me:
"I am very fond of sunsets. Come, let us go look at a sunset now".
"But we must wait," I said.
"Wait? For what?"
"For the sunset. We must wait until it is time.  "
At first you seemed to be very much surprised. And then you laughed to yourself. You said to me:
"I am always thinking that I am at home!"'''
SENTENCES = [
    "The sky is blue and we can see the blue sun.",
    "The sun is bright and yellow.",
    "here comes the blue sun",
    "Lucy in the sky with diamonds and you can see the sun in the sky",
    "sun sun blue sun here we come",
    "Lucy likes blue bright diamonds",
]
QUESTIONS = ["look the the blue sky", "He likes the blue the sun", "Lucy likes blue sky with diamonds"]


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def texts(spark, values, key="doc_id", first=0):
    return spark.createDataFrame([(i + first, v) for i, v in enumerate(values)], f"{key} LONG, text STRING")


def words(spark, docs):
    """Postings of {doc_id: [token, ...]}."""
    df = spark.createDataFrame(list(docs.items()), "doc_id LONG, tokens ARRAY<STRING>")
    return index.count_terms(df, F.col("tokens"))


# Golden inputs.
FIRST = {1: ["dog", "ate", "a", "dog"], 2: ["a", "cat", "ate", "a", "dog"]}
SECOND = {4: ["dog", "ate", "a", "dog"], 3: ["a", "giraffe", "ate", "a", "dog"]}


def test_tiny_index(spark):
    lists = index.posting_lists(words(spark, FIRST))
    assert rows(lists, "term", "position", "doc_id", "tf") == [
        ("a", 1, 1, 1), ("a", 2, 2, 2), ("ate", 1, 1, 1), ("ate", 2, 2, 1), ("cat", 1, 2, 1),
        ("dog", 1, 1, 2), ("dog", 2, 2, 1),
    ]


def test_merge(spark):
    merged = index.term_stats(index.merge_postings(words(spark, FIRST), words(spark, SECOND)))
    assert rows(merged, "term", "df", "term_total") == [
        ("a", 4, 6), ("ate", 4, 4), ("cat", 1, 1), ("dog", 4, 6), ("giraffe", 1, 1),
    ]


def test_merge_adds_the_same_document(spark):
    merged = index.merge_postings(words(spark, FIRST), words(spark, FIRST))
    assert rows(merged.where("term = 'dog'"), "doc_id", "tf") == [(1, 4), (2, 2)]


def test_word_count(spark):
    text = "This is a test to check the words count function actually count words"
    got = rows(index.build_postings(texts(spark, [text]), stops=stop_words("full")), "term", "tf")
    assert dict(got) == {"test": 1, "check": 1, "words": 2, "count": 2, "function": 1, "actually": 1}


def test_filter_tokens(spark):
    def count(stops):
        tokens = text_fn.tokens("text", stops, text_fn.SHORT_TOKEN_PATTERN)
        return texts(spark, [LITTLE_PRINCE]).select(tokens.alias("t")).first().t

    assert len(count([])) == 115
    assert len(count(ENGLISH)) == 51
    words = texts(spark, [LITTLE_PRINCE]).select(F.explode(text_fn.tokens("text", [], text_fn.SHORT_TOKEN_PATTERN)).alias("word"))
    assert words.select(stem("word")).distinct().count() == 69


def test_stem(spark):
    # Words and their stems.
    expected = [("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("agreed", "agre"), ("plastered", "plaster"),
     ("motoring", "motor"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
     ("relational", "relat"), ("vietnamization", "vietnam"), ("electricity", "electr"), ("adjustment", "adjust"),
     ("adoption", "adopt"), ("probate", "probat"), ("controlling", "control"), ("dying", "die"), ("skies", "sky"),
     ("is", "is"), ("formally", "formal")]
    got = texts(spark, [word for word, _ in expected]).select("text", stem("text")).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_stem_word_by_word(spark):
    """All words of the documents, all endings on stems of several shapes, runs of y, other scripts and none."""
    heads = ["", "a", "y", "tr", "hop", "fly", "yy", "syzygy", "plast", "motor", "controll", "ab", "élan", "x1", "日本"]
    ends = [*STEP_2, *STEP_3, *STEP_4, "sses", "ies", "s", "ss", "ied", "eed", "ed", "ing", "y", "logi", "e", "ll", "lling", "yyyyed"]
    words = spark.createDataFrame([(h + e,) for h in heads for e in ends] + [(w,) for w in IRREGULAR] + [(None,)], "word STRING")
    found = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.explode(text_fn.tokens("text", [])).alias("word"))
    got = words.union(found).distinct().select("word", stem("word").alias("stem")).collect()
    assert len(got) > 900
    assert [r for r in got if r.stem != (None if r.word is None else stem_word(r.word))] == []


def test_tokens_at_the_edges(spark):
    text = "A b's x-ray it's #tag @me don't--stop " + "y" * 30 + " élan ab"
    got = texts(spark, [text]).select(text_fn.tokens("text").alias("t")).first().t
    assert got == ["x-ray", "it's", "#tag", "@me", "don't", "stop", "y" * 25, "yyyyy", "élan"]


def test_links(spark):
    def links(text):
        got = texts(spark, [text]).select(F.inline(text_fn.wiki_links("text"))).collect()
        return [tuple(row) for row in got]

    assert links("[[Wikipedia]]") == [("Wikipedia", "Wikipedia")]
    assert links("[[Wikipedia|some text]]") == [("Wikipedia", "some text")]
    assert links("[[File:example.jpg|frame|caption]]") == []
    assert links("[[Wikipedia#Preview|preview]]") == [("Wikipedia", "preview")]
    assert links("[[Category:Towns]] [[File:a.png]] [[B|'''bold''']]") == [("B", "bold")]
    # Links within links and templates, brackets that are no links, and openings that nothing closes.
    assert links("[[File:a.png|thumb|see [[B|the [[C]] of B]] {{t|[[D]]}}]]") == [("B", "the C of B"), ("C", "C"), ("D", "D")]
    assert links("[[A|x {{t|y}} [z] w]] [1] ]] [[B|b|c]]") == [("A", "x  [z] w"), ("B", "b|c")]
    assert links("[[open [[A]] and {{open [[B]]") == [("A", "A"), ("B", "B")]
    assert links("") == links("]] [[") == []


def typed(spark, text):
    got = texts(spark, [text]).select(F.inline(text_fn.typed_tokens("text"))).collect()
    return [tuple(row) for row in got]


def test_typed_tokens(spark):
    # Golden inputs.
    got = typed(spark, "<b><i>hello</i></b>")
    assert [t for _, t in got].count("HTMLTAG") == 4
    assert ("<br />", "HTMLTAG") in typed(spark, "<br />")
    got = typed(spark, "dates in the format of January 29, 1984, Nov 3, 2020, or 3 Nov 2020.")
    assert {("January 29, 1984", "DATE"), ("Nov 3, 2020", "DATE"), ("3 Nov 2020", "DATE")} <= set(got)
    got = typed(spark, "Sep 29, 1984, Apr 33, 2020, or 30 feb 2020, 31 April 2020, 31 May 2020")
    assert [v for v, t in got if t == "DATE"] == ["Sep 29, 1984", "31 May 2020"]
    got = typed(spark, "12.12PM 1202a.m. 6:12:12")
    assert got == [("12.12PM", "TIME"), ("1202a.m.", "TIME"), ("6:12:12", "TIME")]
    got = typed(spark, "36.12PM 1272a.m. 1202a.m 12:12:12am 56:12:12 6:72:12")
    assert "TIME" not in [t for _, t in got]
    got = typed(spark, "12 +12 -12.0 -12,345.5466 +12,345,678,678 0.154")
    assert [t for _, t in got] == ["NUMBER"] * 6
    for text in ["(500 in value)", "is 500.", "is 500, but", "is 500: no"]:
        assert ("500", "NUMBER") in typed(spark, text)
    got = typed(spark, "the price rose 500%")
    assert ("500%", "PERCENT") in got and ("500", "NUMBER") not in got
    got = typed(spark, "12.A W12 +-12 -.12.0 -12,34.5466 +12,345,6+78,678 0.15,4")
    assert "NUMBER" not in [t for _, t in got]
    got = typed(spark, "Hello Bob! It's Mary, your mother-in-law, \n  the mistake is your parents'! --Mom")
    found = [v for v, t in got if t == "WORD"]
    assert found == ["Hello", "Bob", "It's", "Mary", "your", "mother-in-law", "the", "mistake", "is", "your", "parents'"]


def test_typed_tokens_keep_all_text(spark):
    text = "a\u001eb <i>x</i>, 5% of 12 -- Jan 3, 2020; \\ $1 é ß"
    assert "".join(v for v, _ in typed(spark, text)).replace(" ", "") == text.replace(" ", "")
    assert ("12.12PM", "TIME") in typed(spark, "at 12.12PM.") and ("Jan 3, 2020", "DATE") in typed(spark, "(Jan 3, 2020)")


def test_entities(spark):
    html = "<p>caf&eacute; &amp;lt; &#233;&#xE9; &Uuml;ber&nbsp;a&b &copy; &#0; &#x; &amp;amp;</p>"
    got = spark.createDataFrame([(html,)], "html STRING").select(text_fn.strip_markup("html")).first()[0]
    assert got == "café &lt; éé Über a&b &#x; &amp;"


def test_page_views(spark):
    lines = [
        "en.wikipedia Langnes 17324616 desktop 10 A1", "en.wikipedia Langnes 17324616 mobile-web 6 B1",
        "de.wikipedia X 17324616 desktop 4 A1", "en.wikipedia Y null desktop 3 A1", "en.wikipedia Z 5 desktop x A1",
        "en.wikipedia short",
    ]
    counted = views.aggregate_views(spark.createDataFrame([(line,) for line in lines], "value STRING"))
    assert rows(counted, "page_id", "views") == [(17324616, 16)]
    pages = spark.createDataFrame([(1, "a"), (17324616, "Langnes")], "page_id LONG, title STRING")
    assert [tuple(r) for r in views.most_viewed(pages, counted).collect()] == [(17324616, "Langnes", 16), (1, "a", 0)]


def vectorized(spark):
    # "see" is a stop word of the vectorizer and not of the English list.
    stops = [*ENGLISH, "see"]
    docs = index.build_postings(texts(spark, SENTENCES), "text", stops, text_fn.VECTORIZER_PATTERN)
    terms = rank.query_terms(texts(spark, QUESTIONS, "query_id"), stops, text_fn.VECTORIZER_PATTERN)
    return docs, index.term_stats(docs), terms


def test_tfidf_vectorizer(spark):
    docs, df, terms = vectorized(spark)
    vectors = rank.tfidf_vectors(docs, df, 6)
    got = vectors.collect()
    assert len({r.term for r in got}) == 10 and len(got) == 21
    assert round(max(r.weight for r in got), 3) == 0.798
    known, _ = rank.match(terms, docs, df)
    scores = rank.cosine_matrix(vectors, rank.query_vectors(known, 6)).collect()
    assert len(scores) == 16 and round(max(r.score for r in scores), 3) == 0.888


def searched(spark, queries=QUESTIONS):
    docs = index.build_postings(texts(spark, SENTENCES), "text", ENGLISH)
    df = index.term_stats(docs)
    terms = rank.query_terms(texts(spark, queries, "query_id"), ENGLISH)
    known, found = rank.match(terms, docs, df)
    avg_len = sum(r.doc_len for r in docs.select("doc_id", "doc_len").distinct().collect()) / 6
    return docs, df, known, found, avg_len


def test_bm25_naive(spark):
    docs, df, _, found, avg_len = searched(spark)
    assert df.where("term = 'blue'").first().df == 4
    scores = {(r.query_id, r.doc_id): r.score for r in rank.bm25_naive(found, 6, avg_len).collect()}
    totals = Counter()
    for (_, doc), score in scores.items():
        totals[doc] += score
    assert scores[0, 0] == scores[2, 0] and scores.get((0, 3)) != scores.get((2, 3))
    assert max(scores.values()) > 1
    assert max(range(6), key=totals.__getitem__) == 5 and min(range(6), key=totals.__getitem__) == 1


def test_bm25_by_hand(spark):
    _, _, _, found, avg_len = searched(spark, ["blue blue sky"])
    got = {r.doc_id: r.score for r in rank.bm25(found, 6, avg_len).collect()}

    def part(n, tf, dl):
        return math.log(1 + (6 - n + 0.5) / (n + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg_len))

    assert got[0] == pytest.approx(2 * part(4, 2, 5) + part(2, 1, 5), abs=1e-5)
    assert got[3] == pytest.approx(part(2, 2, 6), abs=1e-5)
    assert set(got) == {0, 2, 3, 4, 5}


def test_cosine_is_zero_for_zero_norms(spark):
    docs = words(spark, {1: ["same"], 2: ["same"]})
    terms = rank.query_terms(texts(spark, ["same"], "query_id"))
    _, found = rank.match(terms, docs, index.term_stats(docs), enrich=lambda known: rank.with_query_norm(known, 2))
    assert rows(rank.cosine(found, 2), "doc_id", "score") == [(1, 0.0), (2, 0.0)]


def run_of(spark, lists, score=None):
    data = [(q, d, float(100 - i), i + 1) for q, docs in lists.items() for i, d in enumerate(docs)]
    return spark.createDataFrame(data, "query_id LONG, doc_id LONG, score DOUBLE, rank INT")


def qrels_of(spark, grades):
    data = [(q, d, g) for q, docs in grades.items() for d, g in docs.items()]
    return spark.createDataFrame(data, "query_id LONG, doc_id LONG, grade INT")


def test_metrics_by_hand(spark):
    run = run_of(spark, {1: [5, 1, 9, 2, 7], 2: [4, 6]})
    qrels = qrels_of(spark, {1: {1: 2, 2: 1, 3: 1}, 2: {8: 1}, 3: {1: 1}})
    got = {r.query_id: r for r in evaluate.evaluate(run, qrels, [4]).collect()}
    one = got[1]
    assert (one.recall, one.precision, one.f_score) == (0.667, 0.5, 0.572)
    assert (one.r_precision, one.reciprocal_rank, one.average_precision) == (0.333, 0.5, 0.5)
    assert one.fallout == pytest.approx(round(2 / (9 - 3), 3))
    ideal = 2 + 1 / math.log2(3) + 1 / 2
    assert one.ndcg == pytest.approx((2 / math.log2(3) + 1 / math.log2(5)) / ideal, abs=6e-4)
    assert [got[2][m] for m in ["recall", "average_precision", "ndcg"]] == [0, 0, 0]
    assert [got[3][m] for m in evaluate.METRICS] == [0] * 8


def test_average_precision_variants(spark):
    run, qrels = run_of(spark, {1: [9, 8, 1, 7, 6, 2, 3]}), qrels_of(spark, {1: {1: 1, 2: 1, 3: 1}})
    rounded = evaluate.evaluate(run, qrels).first().average_precision
    exact = evaluate.evaluate(run, qrels, ap_rounding=False).first().average_precision
    assert rounded == round((0.333 + 0.333 + 0.429) / 3, 3) == 0.365
    assert exact == round((1 / 3 + 2 / 6 + 3 / 7) / 3, 3)


def test_recursive_ndcg(spark):
    run, qrels = run_of(spark, {1: [3, 1, 2]}), qrels_of(spark, {1: {1: 3, 2: 2, 3: 1}})
    got = evaluate.evaluate(run, qrels, ndcg="recursive").first().ndcg

    def fold(grades):
        gain = 0
        for grade in grades:
            gain = grade if gain == 0 else grade / math.log2(gain + 1)
        return gain

    assert got == pytest.approx(round(fold([1, 3, 2]) / fold([3, 2, 1]), 3))


def test_merge_results(spark):
    title, body = run_of(spark, {1: [1, 2]}), run_of(spark, {1: [2, 3]})
    got = blend.merge_results(title, body, 0.25, 0.75, 3)
    assert rows(got, "rank", "doc_id", "score") == [(1, 2, 99.75), (2, 3, 74.25), (3, 1, 25.0)]


def test_blend(spark):
    body, title = run_of(spark, {1: list(range(30)), 2: list(range(5))}), run_of(spark, {1: [50, 3], 2: [9]})
    got = rows(blend.blend(body, title, 20), "query_id", "rank", "doc_id")
    assert [d for q, _, d in got if q == 1] == [*range(10), 50, 3]
    assert [d for q, _, d in got if q == 2] == [9]
    once = rows(blend.blend(body, title, 20, dedupe=True), "query_id", "rank", "doc_id")
    assert [d for q, _, d in once if q == 1] == [*range(10), 50]


def test_blend3(spark):
    first, second = run_of(spark, {1: list(range(100, 150))}), run_of(spark, {1: [1, 2, 3, 4]})
    got = rows(blend.blend3(first, second, 3, run_of(spark, {1: [7, 8, 9]}), 2), "rank", "doc_id")
    assert [d for _, d in got] == [*range(100, 135), 1, 2, 3, 7]


def pagerank_by_hand(edges, rounds, normalize):
    edges = set(edges)
    ids = {v for edge in edges for v in edge}
    degree = Counter(src for src, _ in edges)
    ranks = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        ranks = {v: 0.15 + 0.85 * sum(ranks[s] / degree[s] for s, d in edges if d == v) for v in ids}
    scale = len(ids) / sum(ranks.values()) if normalize else 1
    return {v: r * scale for v, r in ranks.items()}


GRAPHS = [[(1, 2), (2, 3), (3, 1)], [(1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (3, 3), (1, 2)], [(1, 2), (3, 2), (2, 4)]]


@pytest.mark.parametrize("normalize", [True, False])
@pytest.mark.parametrize("edges", GRAPHS)
def test_pagerank(spark, edges, normalize):
    df = spark.createDataFrame(edges, "src LONG, dst LONG")
    got = {r.id: r.pagerank for r in graph.pagerank(df, 4, normalize=normalize).collect()}
    assert got == pytest.approx(pagerank_by_hand(edges, 4, normalize))


def test_zipf(spark):
    df = index.term_stats(words(spark, {1: ["a", "a", "a", "b", "c"], 2: ["b", "d"]}))
    assert rows(stats.zipf(df), "rank", "frequency") == [(1, 3), (2, 2), (3, 1), (4, 1)]


def test_short_tokens_of_min_length_are_the_long_tokens(spark):
    docs = texts(spark, ["#a ab x-y a'b'c it's --don't @@me ##tag a-b-c " + "q" * 27, SENTENCES[0]])
    short = text_fn.tokens("text", pattern=text_fn.SHORT_TOKEN_PATTERN)
    kept = F.filter(short, text_fn.reaches_min_length)
    for row in docs.select(kept.alias("kept"), text_fn.tokens("text").alias("long")).collect():
        assert row.kept == row.long


def test_r_precision_with_more_relevant_than_k(spark):
    """150 relevant documents, of which the first 120 and the last 30 of a run of 400 are found; R is 150, not 100."""
    hits = [*range(120), *range(370, 400)]
    scores = spark.createDataFrame([(1, d, float(1000 - d)) for d in range(400)], "query_id LONG, doc_id LONG, score DOUBLE")
    qrels = spark.createDataFrame([(1, d, 2) for d in hits], "query_id LONG, doc_id LONG, grade INT")
    depth = spark.createDataFrame([(1, 150)], "query_id LONG, depth LONG")
    run = rank.top_by(scores, depth)
    assert sorted(r["rank"] for r in run.collect()) == list(range(1, 151))
    got = evaluate.evaluate(run, qrels, [40], collection_size=400).first()
    assert got.r_precision == 0.8 and got.recall == round(40 / 150, 3)
    assert evaluate.intersection(scores, qrels).count() == 150


def test_articles_and_media(spark):
    names = ["Town", "", "File:a.JPG", "Image:b", "Category:c", "photo.jpeg", "xjpg", "The category: d"]
    frame = spark.createDataFrame([(n,) for n in names], "name STRING")
    assert [r[0] for r in frame.where(text_fn.is_article("name")).collect()] == ["Town", "xjpg", "The category: d"]
