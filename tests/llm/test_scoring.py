"""Ranked search, hard negatives and token counts against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleethealth.llm import hard_negatives, ranked, token_counts
from fleethealth.llm.text import text_bytes

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def search(docs, items, k):
    """Every document scored for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    held = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        if item is None:
            continue
        scores = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m))
                        for t in terms(text) if t in b)
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_terms_of_many_texts():
    texts = ["It's a1-b2", None, "", "Ünï 漢字\x00x\x7fY", "-", "A", "bC"]
    words, first = ranked.terms_of(*text_bytes(pa.array(texts, pa.string())))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(first, first[1:])] == [terms(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6))
def test_sequential_reads_find_the_best(seed, k):
    rng = random.Random(seed)
    n, n_terms = rng.randint(1, 60), rng.randint(1, 6)
    rows = [(d, t, rng.choice([1, 5, 5, 80, 900])) for d in range(n) for t in range(n_terms) if rng.random() < 0.4]
    ids = np.array(rng.sample(range(1000), n))
    columns = [np.array(c, np.int64) for c in zip(*rows)] or [np.empty(0, np.int64)] * 3
    weights = [rng.choice([0, 1, 3, 50]) for _ in range(n_terms)]
    total = Counter()
    for d, t, impact in rows:
        total[ids[d]] += impact * weights[t]
    want = sorted((-s, i) for i, s in total.items() if s)[:k]
    index = ranked.Postings(ids, *columns, n_terms)
    got_ids, scores, _ = index.search(range(n_terms), weights, k)
    assert [(-s, i) for i, s in zip(got_ids.tolist(), scores.tolist())] == want


def test_reading_stops_early():
    n = 10_000
    impact = np.arange(n, 0, -1) ** 2
    index = ranked.Postings(np.arange(n), np.tile(np.arange(n), 2), np.repeat([0, 1], n), np.tile(impact, 2), 2)
    ids, scores, read = index.search([0, 1], [3, 2], 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scores[0] == 5 * n * n
    assert read < n  # of 2 n postings


def test_ranked_search_equals_brute_force(spark, awkward, nothing):
    items = [(1, "The cat sat, the CAT sat on one word"), (2, None), (3, ""), (4, "漢字 Ünïcödé x 1"), (5, "absent"), (None, "the"),
             (6, "one two words"), (7, "word " * 50)]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("kept"))
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    for k in (1, 3, 20):
        want = search(docs, items, k)
        for options in ({}, {"shard": 8}, {"block_bytes": 60}):
            assert sorted(tuple(r) for r in ranked.ranked(awkward, frame, k, **options).collect()) == want
    assert ranked.ranked(nothing, frame).collect() == []
    assert ranked.ranked(awkward, frame.limit(0)).collect() == []


def test_a_repeated_item_is_answered_each_time(spark, awkward):
    twice = spark.createDataFrame([(1, "cat"), (1, "cat")], "item_id long, text string")
    got = ranked.ranked(awkward, twice, 2).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in got) == [(1, 1), (1, 1), (2, 2), (2, 2)]


def mine(rows, anchors, positives=5, negatives=5, percent=80):
    out = []
    for a, label, x in anchors:
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other == label) for i, other, y in rows if i != a)
        for s, i, _ in [r for r in scored if r[2]][:positives]:
            fit = [(t, j) for t, j, same in scored if not same and percent * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j) in enumerate(fit)]
    return sorted(out)


def test_keys_sort_like_pairs():
    rng = random.Random(1)
    edge = [0, 1, -1, 5, (1 << 63) - 1, -(1 << 63)]
    pairs = [(rng.choice(edge), rng.choice(edge), rng.choice([0, 1]), rng.choice(edge)) for _ in range(300)]
    packed = sorted(hard_negatives.pack(*p) for p in pairs)
    assert [hard_negatives.unpack(k) for k in packed] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


@pytest.mark.parametrize("spread, segment", [(3, 16), (40, 7), (2, 10_000)])
def test_hard_negatives_equal_brute_force(spark, spread, segment):
    # Few different scores: many ties, zero and negative positives, repeated vectors.
    rng = random.Random(spread)
    rows = [(i * 3 - 30, rng.randint(0, 2), [float(rng.randint(-spread, spread)) for _ in range(3)]) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, terms array<double>").withColumn("rank", F.lit("kept"))
    anchors = rows[::4]
    got = hard_negatives.mined(frame.repartition(5), frame.where(F.col("vec_id").isin([a[0] for a in anchors])), segment=segment)
    assert sorted(tuple(r) for r in got.collect()) == mine(rows, anchors)


def test_the_iterator_needs_one_pass_and_no_list():
    keys = sorted([hard_negatives.pack(1, 100, 0, 7), hard_negatives.pack(1, 90, 0, 8), hard_negatives.pack(2, -5, 0, 9)]
                  + [hard_negatives.pack(1, 100 - i // 2, 1, i) for i in range(60)] + [hard_negatives.pack(2, -6, 1, 1)])
    rows = list(hard_negatives.windows(iter(keys), 2, 80))
    assert rows == [(1, 7, 1, 0, 100, 100), (1, 7, 2, 1, 100, 100), (1, 8, 1, 20, 90, 90), (1, 8, 2, 21, 90, 90)]


def test_large_components_stay_exact():
    x = np.array([[float(2 ** 60), 3.0], [7.0, 2.0 ** 30]])
    assert hard_negatives.products(x, np.array([[7.0, 1.0]])).tolist() == [[7 * 2 ** 60 + 3], [49 + 2 ** 30]]
    with pytest.raises(ValueError):
        hard_negatives.products(x, x)


def test_awkward_vectors_are_mined(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.8, 0.5]), (3, None, [9.0, 9.0]), (4, 2, None), (5, 1, [nan, 1.0]),
            (6, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (None, 1, [1.0, 1.0]), (100, 3, []), (200, 1, [1.0]), (2, 2, [0.8, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("terms", F.lit("kept"))
    got = hard_negatives.digest(frame).collect()
    assert [(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"]) for r in got] == []
    # 0 is divisible by 7, so its label is 2: its positives are the rows with id 2.
    moved = hard_negatives.digest(frame.withColumn("vec_id", F.col("vec_id") + 100)).collect()
    assert [(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"]) for r in moved] == [(100, 101, 1, 102), (100, 101, 2, 102)]
    assert hard_negatives.digest(frame.limit(0)).collect() == []


LIBRARY = Tokenizer.from_file(BYTES)
CUTS = token_counts.pre_tokens(BYTES)
PARTS = st.sampled_from([*" \n\t'sstmdrevla1!é漢", "\U0001F600", "\x1c", "\x85", "\xa0", "'re", "'ll", "<|endoftext|>", "\U00010d40", "  ", "''"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(PARTS, max_size=20).map("".join), st.text(st.characters(exclude_categories=["Cs"]), max_size=20)), max_size=4))
def test_pre_tokens_are_the_library_s(texts):
    found, first, special = CUTS.of(*text_bytes(pa.array(texts, pa.string())))
    found = found.to_pylist()
    for i, text in enumerate(texts):
        own = found[first[i]:first[i + 1]]
        assert own == [p for part in text.split("<|endoftext|>") if part for p in CUTS.of_library(part)]
        assert sum(map(CUTS.size, own)) + special[i] == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_kinds_of_all_assigned_code_points():
    kinds = token_counts.kinds()
    for a in range(0, 0x20000, 0x800):
        code = [c for c in range(a, a + 0x800) if not 0xD800 <= c < 0xE000 and kinds[c] != token_counts.UNKNOWN]
        for kind, mark in ((token_counts.LETTER, "a"), (token_counts.NUMBER, "1"), (token_counts.OTHER, "!")):
            own = [c for c in code if kinds[c] == kind]
            text = "\n".join(mark + chr(c) + mark for c in own)
            assert [p for p in CUTS.of_library(text) if p != "\n"] == (text.split("\n") if own else [])


def test_counts_are_the_library_s(spark, awkward, nothing):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for docs in (awkward, small):
        text = Counter((r["doc_id"], len(t.encode()), n := len(LIBRARY.encode(t, add_special_tokens=False).ids), n > 1024)
                       for r in docs.collect() for t in [r["text"] or ""])
        assert Counter(map(tuple, token_counts.digest(docs, BYTES).collect())) == text
        # Hardly anything broadcast: the counts come through the shuffle.
        few = token_counts.token_counts(docs, BYTES, hot=3).select("doc_id", "n_tokens").collect()
        assert Counter(map(tuple, few)) == Counter((k[0], k[2]) for k in text.elements())
    assert token_counts.digest(nothing, BYTES).collect() == []
    wide = token_counts.token_counts(awkward, BYTES, keep=("source", "row", "doc_id"))
    assert wide.columns == ["source", "row", "doc_id", "n_bytes", "n_tokens"] and wide.count() == 16


def test_each_distinct_pre_token_is_counted_once(spark):
    docs = spark.createDataFrame([("the cat the cat",), (" the cat",), (None,)], "text string")
    got = {r["piece"]: (r["n"], r["size"]) for r in token_counts.piece_sizes(docs, BYTES).collect()}
    assert got == {"the": (1, 1), " cat": (3, 1), " the": (2, 1)}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.PreTokens(public_tokenizers.path("word_bpe_49k.json"))
