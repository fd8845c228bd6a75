"""Each operator against a brute-force version, on rows with nulls, copies, ties, long texts and clashing columns."""

from __future__ import annotations


import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from termweave.llm import decontaminate, language_id, packing, pii, preference, repeats, toxicity, url_lists, vector_index
from termweave.llm.store import by_ids, components

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(10, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (50, 3), (3, 50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    want = {k: 10 for k in range(10, 41)} | {k: 100 for k in range(100, 130)} | {3: 3, 50: 3}
    assert got == want
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_rows_by_ids_take_nulls(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "x LONG")
    ids = spark.createDataFrame([(None,), (2,), (2,)], "i LONG")
    assert [r.x for r in by_ids(rows, "x", ids, "left_anti").collect()] == [1]
    assert by_ids(rows, "x", ids, "left_semi").count() == 2


# Operator 2

PRIVATE = [
    "mail a.b+c@x-y.co.uk or @x.y, a@b, q@w.e.r. a@b@c.d",
    "ip 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 00000000001.2.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559 1 2 3",
    "call +1 (663) 555-6869, +12, +49-30-1234567890123456",
    None,
    "",
    "é💡 +1 (663) 555-6869 é a@b.cd",
]


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in pii.PATTERNS.items() for m in p.finditer(text) if pii.passes(k, m.group())]


def test_base_spans_are_those_of_the_plain_patterns():
    for text in [*PRIVATE, "a@" * 50 + "b.c", "x" * 3_000 + "@y.z", "9" * 5_000, "1.1.1." * 90]:
        assert pii.base_spans(text or "") == plain_spans(text or "")


def test_spans_masks_and_digests(spark):
    rows = spark.createDataFrame([(k, t, 0, 0) for k, t in enumerate(PRIVATE)], "doc_id LONG, text STRING, kind INT, n_chars LONG")
    field = pii.fit(rows)
    got = {r.doc_id: r for r in pii.find_spans(rows, field).collect()}
    for k, text in enumerate(PRIVATE):
        assert [tuple(s) for s in got[k].base] == plain_spans(text or "")
        for s in got[k].added:
            assert all(s.end <= b.start or s.start >= b.end for b in got[k].base)
    digests = {r.doc_id: r for r in pii.digest_columns(pii.find_spans(rows, field)).collect()}
    assert (digests[0].n_email, digests[1].n_ip, digests[2].n_card, digests[3].n_phone) == (3, 4, 1, 1)
    assert digests[4].spans == "" and len(digests[5].base_sha256) == 64
    masked = {r.doc_id: r for r in pii.mask(rows, field).collect()}
    assert masked[4].text is None and "<email>" in masked[0].text and "+1 (663)" not in masked[6].text
    assert masked[6].n_chars == len(masked[6].text)
    assert pii.find_spans(rows.where("false"), field).count() == 0


def test_viterbi_finds_the_best_path_of_all():
    rng = np.random.default_rng(3)
    field = pii.Field()
    shapes = np.arange(4)
    field.positive[shapes], field.seen[shapes] = True, True
    for w in (field.own, field.before, field.after):
        w[:4] = rng.normal(size=(4, len(pii.LABELS)))
    field.step = rng.normal(size=field.step.shape)
    shape, line = rng.integers(0, 4, 7), np.array([1, 0, 0, 0, 1, 0, 0], bool)
    emit = field.emissions(shape, line)
    got = field.decode(shape, line)
    for a, b in ((0, 4), (4, 7)):
        paths = np.array(np.meshgrid(*[range(len(pii.LABELS))] * (b - a))).reshape(b - a, -1).T
        value = emit[np.arange(a, b), paths].sum(1) + field.step[paths[:, :-1], paths[:, 1:]].sum(1)
        assert got[a:b].tolist() == paths[value.argmax()].tolist()


# Operator 3


def test_preference_pairs(spark):
    schema = "pair_id LONG, turn LONG, role STRING, text STRING, part INT"
    chosen = spark.createDataFrame(
        [(1, 0, "user", "hi", 0), (1, 1, "assistant", "yes", 0), (1, 2, "user", None, 0), (1, 2, "user", None, 0), (2, 0, "user", "q", 0), (None, 0, "user", "q", 0), (3, 700, "assistant", "x", 0)],
        schema,
    )
    rejected = spark.createDataFrame([(1, 0, "user", "hi", 0), (1, 1, "assistant", "no!", 0), (2, 0, "user", "q", 0), (3, 1, "assistant", "y", 0)], schema)
    got = {(r.pair_id, r.segment, r.part): r for r in preference.preference_pairs(chosen, rejected).collect()}
    assert set(got) == {(1, "prompt", 0), (1, "chosen", 0), (1, "rejected", 0), (2, "prompt", 0), (3, "chosen", 1), (3, "rejected", 0)}
    assert got[1, "prompt", 0].text == "<|user|>\nhi<|end|>\n" and got[1, "prompt", 0].mask == []
    row = got[1, "chosen", 0]
    assert [row.text[s.start : s.end] for s in row.mask] == ["yes"] and row.text.endswith("<|user|>\n<|end|>\n")
    assert [got[1, "rejected", 0].text[s.start : s.end] for s in got[1, "rejected", 0].mask] == ["no!"]
    assert preference.preference_pairs(chosen.where("false"), rejected.where("false")).count() == 0


def test_long_conversations_come_in_parts(spark):
    turns = spark.range(1500).selectExpr("1L AS pair_id", "id AS turn", "'assistant' AS role", "concat('t', id) AS text")
    parts = sorted(preference.preference_pairs(turns, turns).collect(), key=lambda r: r.part)
    assert [r.start for r in parts] == [0, len(parts[0].text), len(parts[0].text) + len(parts[1].text)]
    assert "".join(r.text for r in parts) == "".join(f"<|assistant|>\nt{k}<|end|>\n" for k in range(1500))


# Operator 4


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(1)
    n, terms = 500, 40
    text, term = np.nonzero(rng.random((n, terms)) < 0.1)
    count = rng.integers(1, 5, text.size)
    idf = rng.random(terms) + 1
    index = toxicity.Index.build(np.arange(terms).astype(np.uint64), idf, text, term, count, rng.integers(0, 2, n))
    full = np.zeros((n, terms))
    full[text, term] = (1 + np.log(count)) * idf[term]
    full /= np.maximum(np.linalg.norm(full, axis=1, keepdims=True), 1e-12)
    for k in range(0, n, 25):
        of = text == k
        if not of.any():
            continue
        example, cosine = index.nearest(term[of], count[of], skip=k)
        want = full @ full[k]
        want[k] = 0
        assert np.allclose(np.sort(cosine)[::-1], cosine)
        assert np.allclose(cosine, np.sort(want)[::-1][: cosine.size]) and np.allclose(want[example], cosine)


def test_toxic_texts_are_told_apart(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(400):
        bad = k % 4 == 0
        chosen = list(rng.choice(words, 40)) + (list(rng.choice(["vilefoo", "vilebar", "nasty"], 2)) if bad else [])
        rows.append((k, " ".join(rng.permutation(chosen)), int(bad)))
    docs = spark.createDataFrame([(k, t, 1.0, 2) for k, t, _ in rows] + [(900, None, 1.0, 2), (901, "", 1.0, 2), (0, rows[0][1], 1.0, 2)], "doc_id LONG, text STRING, score DOUBLE, label INT")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k % 5] + [(5, None), (None, 1)], "doc_id LONG, toxic INT")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id < 400 and r.doc_id % 5 == 0]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held]) > 0.95
    assert all(r.score < 0.5 for r in got if r.doc_id >= 900)
    none = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


# Operator 5


def test_ids_are_those_of_the_tokenizer(mixed_rows):
    encoder, plain = packing.Encoder(TOKENIZER), packing.load_tokenizer(TOKENIZER)
    texts = [r[1] for r in mixed_rows] + ["it's don't I'LL 'tis ' s", "é à ×÷ ÿĀſ", "日本 a　b", "<|endoftext|> x", "a \n\n b  ", "\x1c\x85 y", "12a ²½ _x__ ..!?"]
    for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_a_fresh_tokenizer():
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(TOKENIZER)
    texts = ["<|endoftext|> x", "plain words", "a<|endoftext|><|endoftext|>b", "<|endof", "text|> z", None, "<|ENDOFTEXT|>", "é <|endoftext|>"]
    want = [fresh.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert want[0] == [50256, 2124]
    assert [ids.tolist() for ids in packing.Encoder(TOKENIZER).encode(pa.array(texts, pa.string()))] == want


@pytest.mark.parametrize("size, block", [(1024, 20_000), (64, 30)])
def test_packing_places_every_piece_once(mixed, mixed_rows, size, block):
    pieces = packing.token_pieces(mixed, TOKENIZER, size=size, with_ids=True).cache()
    packed = packing.pack(pieces, size, block).collect()
    plain = packing.load_tokenizer(TOKENIZER)
    want = Counter()
    for row in mixed_rows:
        ids = [*plain.encode(row[1] or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // size)
        cuts = [0, *(len(ids) - size * (n - 1 - k) for k in range(n))]
        for k in range(n):
            part = ids[cuts[k] : cuts[k + 1]]
            want[row[0], k, cuts[k], len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in packed) == want
    fills: dict[int, int] = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills.get(r.sequence_id, 0)
        fills[r.sequence_id] = r.offset + r.length
    assert max(fills.values()) <= size
    assert len(fills) <= 1.15 * -(-sum(r.length for r in packed) // size) + 1


def test_local_search_empties_bins():
    # Best fit gives 4 bins; exchanges of two for one reach 3.
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    assert len(packing.best_fit(lengths, 10)) >= 3
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = rng.integers(1, 100, 200)
        bins, offsets, fills = packing.pack_block(lengths, 100)
        assert len(set(bins)) <= len(packing.best_fit(lengths, 100))
        assert all(lengths[bins == b].sum() == fills[bins == b][0] <= 100 for b in set(bins))


def test_packing_an_empty_table(empty):
    assert packing.pack_documents(empty, TOKENIZER).collect() == []


# Operator 6


def removed_by_hand(texts: list[str | None], size: int) -> list[tuple[int, int, int, bytes]]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[k : k + size] for raw in raws for k in range(len(raw) - size + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - size + 1):
            if seen[raw[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int((np.diff(np.concatenate([[0], gone[:-1].astype(int)])) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, bytes(b for b, g in zip(raw, gone[:-1], strict=True) if not g)))
    return out


@pytest.mark.parametrize("size", [40, 100])
def test_repeats_are_cut_out(spark, mixed, mixed_rows, size):
    want = Counter((r[0], *x) for r, x in zip(mixed_rows, removed_by_hand([r[1] for r in mixed_rows], size), strict=True))
    got = Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(mixed, size=size).collect())
    assert got == want


def test_repeats_in_segments_and_crowded_halves(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SPREAD", ((3, 5), (6, 1)))
    rng = np.random.default_rng(8)
    middle = "".join(rng.choice(list("abcdefgh"), 70))
    texts = ["".join(rng.choice(list("abcdefgh"), 60)) + middle + "".join(rng.choice(list("abcdefgh"), 60)) for _ in range(12)] + ["ab" * 300, None, "x" * 99]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id LONG, text STRING, size INT")
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs, size=50).collect()}
    assert [got[k] for k in range(len(texts))] == removed_by_hand(texts, 50)
    assert repeats.remove_repeats(docs.where("false"), size=50).count() == 0


def test_a_row_without_an_id_shares_a_passage_between_other_surroundings(spark):
    rng = np.random.default_rng(13)
    some = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    middle = some(90)
    texts = {k: some(70) + middle + some(70) for k in (None, 1, 2)} | {3: some(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    want = dict(zip(texts, removed_by_hand(list(texts.values()), 50), strict=True))
    assert want[None][1] >= 90
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs, size=50).collect()}
    assert got == want


# Operator 7


def test_alignment_scores_are_those_of_the_plain_recurrence():
    rng = np.random.default_rng(4)
    passages = [rng.integers(0, 6, n) for n in (1, 9, 30, 17)]
    items = [rng.integers(0, 6, n) for n in (5, 9, 12, 3)]
    best, start, end = decontaminate.smith_waterman(passages, items)
    for k, (a, b) in enumerate(zip(passages, items, strict=True)):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.OTHER
                h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
        assert best[k] == h.max() and 0 <= start[k] <= end[k] <= len(a)


def test_edited_and_copied_items_are_found(spark, mixed_rows):
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiouxyz"]
    items = [" ".join(rng.choice(words, 40)) for _ in range(30)]
    noise = lambda n: " ".join(rng.choice(words, n))
    edited = " ".join("new" if k % 5 == 4 else w for k, w in enumerate(items[3].split()))
    texts = {1: noise(80) + " " + items[0] + " " + noise(80), 2: items[1].upper(), 3: noise(30) + " " + edited, 4: noise(300), 5: None, 6: "", 7: (items[5] + " " + noise(60) + " ") * 60}
    docs = spark.createDataFrame([(k, t, 9) for k, t in texts.items()] + [(2, texts[2], 9), (None, items[0], 9)], "doc_id LONG, text STRING, item_id INT")
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(90, None), (91, "too short")], "item_id LONG, text STRING")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 3), (7, 5)}
    assert got[1, 0].score == 1 and (got[1, 0].word_start, got[1, 0].word_end) == (80, 120) and 0.6 < got[3, 3].score < 0.9
    kept = decontaminate.clean_documents(docs, decontaminate.contaminated(docs, bench))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 4), (False, 5), (False, 6), (True, 0)]
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    # The join of shingles gives the same where seeds are too many to send.
    decontaminate.SENT_SEEDS, before = 0, decontaminate.SENT_SEEDS
    try:
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == set(got)
    finally:
        decontaminate.SENT_SEEDS = before


def test_copied_templated_short_and_cut_items_are_found(spark):
    rng = np.random.default_rng(17)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiouxyz"]
    noise = lambda n: " ".join(rng.choice(words, n))
    copied = noise(30)
    frame = [f"frame{k}" for k in range(24)]
    templated = [" ".join([*frame[:12], f"name{k % 3}", *frame[12:]]) for k in range(12)]
    items = [(k, copied) for k in range(9)] + [(20 + k, t) for k, t in enumerate(templated)] + [(50, "who wrote the iliad"), (51, "Yes indeed"), (52, " ")]
    # Two seeds of a passage stand before the place where regions are cut, and two behind it.
    seeded = [f"s{k}" for k in range(9)]
    items.append((60, " ".join(seeded)))
    lead = noise(4_092).split()
    passage = ["s0", "s1", "s2", "s3", "zz", "s5", "s6", "s7", "s8"]
    texts = {1: noise(50) + " " + copied + " " + noise(9), 2: templated[1], 3: noise(9) + " Who wrote the Iliad " + noise(9), 4: "who wrote the odyssey", 5: "yes indeed", 6: "yes indeed it is"}
    texts[7] = " ".join([*lead, *passage, *noise(40).split()])
    docs = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id LONG, text STRING")).collect()}
    assert {i for d, i in got if d == 1} == set(range(9)) and all(got[1, k].score == 1 and got[1, k].word_start == 50 for k in range(9))
    assert {i for d, i in got if d == 2} == set(range(20, 32))
    assert {(d, i) for d, i in got if d in (3, 4, 5, 6)} == {(3, 50), (5, 51)}
    assert {i for d, i in got if d == 7} == {60} and got[7, 60].n_seeds == 4


def test_passages_without_three_words_in_a_row_are_found_as_by_brute_force(spark):
    rng = np.random.default_rng(23)
    words = [f"{a}{b}{c}" for a in "bcdfghjklm" for b in "aeiou" for c in "nrst"]
    items = [" ".join(rng.choice(words, 40, replace=False)) for _ in range(40)]
    noise = lambda n: rng.choice(words, n).tolist()
    third = [[f"x{j}" if j % 3 == 2 else w for j, w in enumerate(t.split())] for t in items]
    # A word after each, and every fourth word left out.
    spread = [[w for x in t.split() for w in (x, "und")][:-1] for t in items[:10]]
    cut = [[w for j, w in enumerate(t.split()) if j % 4] for t in items[10:20]]
    edited = [*third, *spread, *cut]
    texts = [" ".join([*noise(30 + k), *e, *noise(60)]) for k, e in enumerate(edited)] + [" ".join(noise(200)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id LONG, text STRING")
    number = {w: k for k, w in enumerate({w for t in [*texts, *items] for w in t.split()})}
    coded = [[np.array([number[w] for w in t.split()]) for t in part] for part in (texts, items)]
    want = {}
    for d, passage in enumerate(coded[0]):
        best, _, _ = decontaminate.smith_waterman([passage] * len(items), coded[1])
        want |= {(d, i): int(b) / 80 for i, b in enumerate(best) if b >= 40}
    assert {(k, k) for k in range(40)} <= set(want) and len(want) >= len(edited)
    for limit in (decontaminate.SENT_SEEDS, 0):
        decontaminate.SENT_SEEDS, before = limit, decontaminate.SENT_SEEDS
        try:
            got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, bench).collect()}
        finally:
            decontaminate.SENT_SEEDS = before
        assert got == want


# Operator 8


def test_probabilities_add_up_and_back_off():
    data = np.frombuffer("abab abc cab bca".encode(), np.uint8)
    words = language_id.read_words(data, np.array([0, data.size]))
    counts = Counter()
    times = np.bincount(words.word, words.count, words.n_words)
    for gram, word in zip(words.grams.tolist(), words.gram_word.tolist(), strict=True):
        counts[gram] += times[word]
    model = language_id.Model(np.array(list(counts), np.uint64), np.array(list(counts.values())))
    history = (1 << 16) | ord("a")
    symbols = [1, ord("a"), ord("b"), ord("c")]
    total = np.exp(model.score(np.array([(history << 16) | s for s in symbols], np.uint64))).sum()
    assert 0.8 < total <= 1 + 1e-9
    assert np.isfinite(model.score(np.array([12345678901234], np.uint64))).all()


def test_languages_and_rejection(spark):
    rng = np.random.default_rng(9)
    sets = {"aa": ["kato", "lemi", "rosu", "tani"], "bb": ["schn", "ögel", "wurz", "ßent"]}
    rows = [(k, " ".join(rng.choice(sets[name], 30)), name) for k, name in enumerate(["aa", "bb"] * 40)]
    rows += [(200, None, "aa"), (201, "123 !!", "bb"), (202, "", None), (203, "qxzvj " * 40, None), (204, rows[0][1] * 500, None), (0, rows[0][1], "aa")]
    docs = spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id LONG, text STRING, lang STRING, score DOUBLE, rejected BOOLEAN")
    models = language_id.fit(docs)
    got = language_id.identify(docs.select("doc_id", "text", "lang"), models).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and not r.rejected for r in got if r.doc_id < 80)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 and by_id[k].rejected for k in (200, 201, 202))
    assert by_id[203].rejected and by_id[204].lang_pred == "aa" and not by_id[204].rejected
    assert sorted(r.doc_id for r in language_id.known_only(docs, models).collect()) == sorted([*range(80), 0, 204])
    nothing = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.known_only(docs, nothing).count() == 0


def test_no_language_is_cut_from_the_models_and_tables_score_like_arrays(spark, monkeypatch):
    rng = np.random.default_rng(12)
    letters = list("abcdefghijklmnop")
    rows = [(k, " ".join("".join(rng.choice(letters, 5)) for _ in range(40)), "large") for k in range(60)]
    rows += [(100 + k, " ".join(rng.choice(["wxyz", "zyxw", "yzwx"], 2)), "small") for k in range(3)] + [(200, None, "large"), (201, "1 2", "small"), (0, rows[0][1], "large"), (None, "wxyz zyxq", None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")

    def results():
        models = language_id.fit(docs)
        got = sorted(language_id.identify(docs.select("doc_id", "text"), models).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
        return models, got, sorted(map(str, language_id.known_only(docs, models).collect()))

    sent, got, kept = results()
    monkeypatch.setattr(language_id, "SENT_GRAMS", 100)
    # So named before: the most frequent 4-grams of all languages, which were all that a model kept.
    monkeypatch.setattr(language_id, "MODEL_GRAMS", 100, raising=False)
    monkeypatch.setattr(language_id, "HOT_SHARE", 0.01, raising=False)
    tables, joined, joined_kept = results()
    assert tables.names == ["large", "small"] and tables.models is None and sent.tables is None
    for name in ("mean", "limit", "strange", "floors"):
        assert np.allclose(getattr(sent, name), getattr(tables, name), rtol=1e-9)
    assert len(got) == len(joined) == len(rows) and kept == joined_kept
    for a, b in zip(got, joined, strict=True):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected)
        assert np.allclose((a.score, a.cross_entropy), (b.score, b.cross_entropy), rtol=1e-9)
    assert {r.lang_pred for r in joined if r.doc_id is None or r.doc_id in (100, 101, 102)} == {"small"}


# Operator 9


def test_lists_as_of_the_fetch_time(spark):
    entries = spark.createDataFrame(
        [
            ("block", "Evil.example", "add", "2024-01-10"), ("block", "evil.example", "remove", "2024-03-05"),
            ("block", "evil.example", "add", "2024-03-05"), ("block", "evil.example", "remove", "2024-05-01"),
            ("allow", "good.evil.example", "add", "2024-02-01"), ("block", None, "add", "2024-01-01"), ("block", "x.y", "add", None),
        ],
        "list STRING, pattern STRING, action STRING, day STRING",
    ).selectExpr("list", "pattern", "action", "cast(day AS timestamp) AS at")
    spans = sorted((r.list, r.pattern, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in url_lists.validity_intervals(entries).collect())
    assert spans == [
        ("allow", "good.evil.example", "2024-02-01", "None"),
        ("block", "evil.example", "2024-01-10", "2024-03-05"),
        ("block", "evil.example", "2024-03-05", "2024-05-01"),
    ]
    captures = spark.createDataFrame(
        [
            (1, "http://evil.example/a", "2024-01-09"), (2, "http://evil.example/a", "2024-01-10"), (3, "https://u:p@www.EVIL.example:80?x", "2024-04-30"),
            (4, "http://evil.example", "2024-05-01"), (5, "http://good.evil.example./", "2024-02-02"), (6, None, "2024-02-02"),
            (7, "no url", "2024-02-02"), (8, "http://evil.example/a", None), (9, "http://notevil.example/", "2024-02-02"), (2, "http://evil.example/a", "2024-01-10"),
        ],
        "page_id LONG, url STRING, day STRING",
    ).selectExpr("page_id", "url", "cast(day AS timestamp) AS fetched_at", "'x' AS pattern", "1 AS row")
    got = url_lists.filter_captures(captures, entries).collect()
    assert sorted(r.page_id for r in got if r.blocked) == [2, 2, 3] and len(got) == 10
    assert next(r for r in got if r.page_id == 5).lists == ["allow", "block"]
    assert url_lists.filter_captures(captures.where("false"), entries).count() == 0
    assert not any(r.blocked for r in url_lists.filter_captures(captures, entries.where("false")).collect())


# Operator 10


@pytest.mark.parametrize("block", [2_000, 7])
def test_vector_links_and_components(spark, block):
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(60, 16))
    vectors = np.concatenate([centres + 0.12 * rng.normal(size=centres.shape) for _ in range(4)] + [np.repeat(centres[:3], 5, 0)])
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (904, [1.0] * 5), (905, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame([(*r, 7, True) for r in rows + odd], "vec_id LONG, embedding ARRAY<FLOAT>, n INT, kept BOOLEAN")
    got = {r.id: r for r in vector_index.near_duplicates(table, block=block).collect()}
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[k].n_links for k in range(len(rows))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.95 * near.sum()
    if found.sum() == near.sum():
        label = np.arange(len(rows))
        for _ in range(50):
            label = np.array([min(label[k], label[near[k]].min(initial=label[k])) for k in range(len(rows))])
        assert [got[k].component for k in range(len(rows))] == label.tolist()
    assert all(got[k].n_links == 0 and got[k].component == k and got[k].kept for k in range(900, 906))
    assert len(got) == len(rows) + len(odd)


def links_by_hand(vectors: np.ndarray, threshold: float) -> list[int]:
    near = vectors @ vectors.T >= threshold
    return (near.sum(1) - 1).tolist()


def test_links_that_no_first_probe_has_are_found(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "PROBES", (4, 16, 4_096) if isinstance(vector_index.PROBES, tuple) else 4)
    rng = np.random.default_rng(14)
    vectors = rng.normal(size=(1_500, 16))
    vectors = vector_index.unit(np.concatenate([vectors, vectors[:40] + 0.35 * rng.normal(size=(40, 16))]))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    want = links_by_hand(vectors, 0.9)
    got = {r.id: r.n_links for r in vector_index.near_duplicates(table).collect()}
    assert sum(want) > 40 and sum(got.values()) >= 0.98 * sum(want)


def test_all_pairs_are_compared_where_no_traversal_is_long_enough(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "VISITS", (1,))
    monkeypatch.setattr(vector_index, "FURTHER", (2,), raising=False)
    vectors = vector_index.unit(np.random.default_rng(15).normal(size=(300, 8)))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = {r.id: r.n_links for r in vector_index.near_duplicates(table, threshold=0.5, block=70).collect()}
    assert [got[k] for k in range(300)] == links_by_hand(vectors, 0.5)


def test_few_links_are_weighed_with_turned_copies():
    vectors = vector_index.unit(np.random.default_rng(16).normal(size=(400, 16)))
    books = vector_index.Codebooks(vector_index.k_means(vectors[:, :8], 8), vector_index.k_means(vectors[:, 8:], 8))
    met = vector_index._met_by_turned(books, vectors, 0.9, 32)
    assert len(met) == vector_index.TURNED and vector_index._share(met, 1) < vector_index.TARGET


def test_vectors_of_an_empty_table(spark):
    table = spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert vector_index.near_duplicates(table).count() == 0


def test_vectors_of_other_lengths_and_with_large_components(spark):
    """Each length is compared with itself, and no square overflows or vanishes."""
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(30)]
    rows += [(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.0]), (102, [2.0, 4.0, 6.1]), (103, [-1.0, 0.0, 0.0])]
    rows += [(200, [1e200, 2e200, 0.0, 0.0, 0.0, 0.0]), (201, [1.1e200, 2e200, 0.0, 0.0, 0.0, 0.0]), (202, [1e-200, 2e-200, 0.0, 0.0, 0.0, 0.0])]
    rows += [(300, [5.0]), (301, [7.0]), (302, [-7.0]), (303, []), (304, [0.0, 0.0, 0.0])]
    got = {r.id: (r.n_links, r.component) for r in vector_index.near_duplicates(spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")).collect()}
    assert [got[k] for k in (100, 101, 102, 103)] == [(2, 100)] * 3 + [(0, 103)]
    assert [got[k] for k in (200, 201, 202)] == [(2, 200)] * 3
    assert [got[k] for k in (300, 301, 302, 303, 304)] == [(1, 300), (1, 300), (0, 302), (0, 303), (0, 304)]



def test_traversal_visits_cells_in_order():
    rng = np.random.default_rng(11)
    books = vector_index.Codebooks(rng.normal(size=(9, 3)), rng.normal(size=(7, 3)))
    points = rng.normal(size=(40, 6))
    got = books.cells(points, 16)
    one, two = vector_index.distances(points[:, :3], books.first), vector_index.distances(points[:, 3:], books.second)
    for k in range(40):
        total = (one[k][:, None] + two[k][None]).ravel()
        assert np.allclose(total[got[k]], np.sort(total)[:16])


