"""Fingerprints, near-duplicates, repeated passages, top-k and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fleethealth.llm import minhash, quality, queries, secret_scan, substring, topk, winnow
from fleethealth.llm.components import components
from fleethealth.llm.fm_index import FMIndex
from fleethealth.llm.text import text_bytes
from fleethealth.session import scratch_dir

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# -- winnowing ---------------------------------------------------------------

def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    rows = winnow.with_fingerprint(df, "text", "fp").select("id", "fp").collect()
    return {r["id"]: [((1 << 31) - 1 - (x & ((1 << 31) - 1)), x >> 31) for x in r["fp"]] for r in rows}


def test_windows_choose_the_rightmost_least_hash(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "cc"]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 6, 7, 8, 20, 60)] + ["x" * 100]
    # k-gram hashes at every position: winnow with windows of one.
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    grams = {r["id"]: [(x >> 31) for x in r["fp"]] for r in winnow.with_fingerprint(df, "text", "fp", w=1).collect()}
    got = prints(spark, texts)
    for i, hashes in grams.items():
        want = set()
        for s in range(max(1, len(hashes) - winnow.W + 1) if hashes else 0):
            window = hashes[s:s + winnow.W]
            low = min(window)
            want.add((s + max(j for j, h in enumerate(window) if h == low), low))
        assert got[i] == sorted(want)


def test_shared_runs_share_a_fingerprint(spark):
    run = " ".join(f"w{i}" for i in range(winnow.K + winnow.W - 1))
    got = prints(spark, ["p q r " + run + " s", "z " + run, "other words altogether in this text here now"])
    hashes = [{h for _, h in got[i]} for i in range(3)]
    assert hashes[0] & hashes[1] and not hashes[0] & hashes[2]


def test_edited_text_and_neighbour(spark, awkward, nothing):
    rows = winnow.digest(awkward).collect()
    assert len(rows) == 16 and winnow.digest(nothing).collect() == []
    same = [r["fingerprint"] for r in rows if r["doc_id"] in (1, 14)]
    assert same[0] == same[1] != ""
    docs = spark.createDataFrame([(i, t) for i, t in ((5, "abcdé"), (3, None), (9, "qwertz uiop"), (1, "x"))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in winnow.digest(docs).collect()}
    edited = {9: "qwertz" + "abcdé", 5: "abc", 3: "", 1: "x"}
    for i, t in edited.items():
        assert got[i]["edited_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert got[3]["near_edited"] == 1.0 and got[3]["near_next"] == 0.0 and got[5]["n_chars"] == 5


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_next_rows_across_buckets(spark, size):
    ids = [3, 8, 1, 44, 7, 20, 21, 22, 5, 5]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    out = winnow.with_next(df, "doc_id", F.lit(0), {"doc_id": "after"}, rows_a_bucket=size).collect()
    order = sorted(ids, reverse=True)
    assert sorted((r["doc_id"], r["after"]) for r in out) == sorted(zip(order, order[1:] + order[:1]))


# -- near-duplicates ---------------------------------------------------------

def shingles(text):
    words = WORD.findall((text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return {i: (len(s), find(i)) for i, s in sets}


def varied(seed, groups=12, copies=9):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(groups):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 30, 60]))]
        for _ in range(rng.randrange(1, copies)):
            words = base.copy()
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(1000)}"
            rows.append((n, " ".join(words)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    rows = varied(seed)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_groups(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_chain_of_links_is_one_group(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(40)]
    want = plain_groups(rows)
    assert len({c for _, c in want.values()}) == 1
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_keys_left_open_are_compared_block_by_block(spark, monkeypatch):
    rows = varied(7, groups=4, copies=40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, leaders=0).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_groups(rows)


def test_distance_guarantee():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, (minhash.CHUNKS, minhash.PLACES))
        b = a.copy()
        for p in rng.choice(minhash.HASHES, 2 * minhash.CHUNKS - 1, replace=False):
            b.ravel()[p] ^= 1
        assert ((a != b).sum(axis=1) <= 1).any()


def test_awkward_texts_are_grouped(awkward, nothing):
    rows = minhash.near_duplicates(awkward).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 16
    assert got[2]["component_id"] == got[14]["component_id"] == 1 and got[7]["component_id"] == 6
    assert got[3]["n_shingles"] == got[5]["n_shingles"] == 0 and got[5]["component_id"] == 5
    assert got[None]["component_id"] is None
    kept = minhash.deduplicated(awkward).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 4, 5, 6, 6, 8, 9, 10, 11, 12, 13]
    assert minhash.near_duplicates(nothing).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201)]
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


# -- repeated passages -------------------------------------------------------

def plain_removed(rows, window=13):
    texts = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    first = {}
    for i, w in texts:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, w in texts:
        gone = {p for s in range(len(w) - window + 1) if first[tuple(w[s:s + window])] < i for p in range(s, s + window)}
        left = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return out


def quoting(seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(30)}" for _ in range(rng.randrange(10, 40))] for _ in range(5)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randrange(500)}" for _ in range(rng.randrange(1, 20))]
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    rows += [(60 + j, rows[j][1]) for j in range(5)] + [(70, "same " * 300), (71, "same " * 40), (72, "a b " * 100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [substring.HOT, 3])
def test_removed_words_equal_all_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    rows = quoting(5)
    got = substring.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == plain_removed(rows)


def test_a_hot_passage_is_in_no_group(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT", 20)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(300)] + [(400 + i, t) for i, (_, t) in enumerate(quoting(6))]
    largest, whole_groups = spark.sparkContext.accumulator(0), substring.whole_groups

    def counted(batches, keys, least=1):
        for group in whole_groups(batches, keys, least):
            most = max(np.unique(group["key"].to_numpy(), return_counts=True)[1])
            if most > 20:
                largest.add(1)
            yield group
    monkeypatch.setattr(substring, "whole_groups", counted)
    got = substring.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == plain_removed(rows)
    assert largest.value == 0


def test_awkward_texts_lose_passages(awkward, nothing):
    got = {r["doc_id"]: r for r in substring.digest(awkward).collect()}
    assert got[14]["n_removed"] == 16 and got[1]["n_removed"] == 0 and got[2]["n_removed"] == 14
    assert got[3]["n_words"] == 0 and got[10]["n_removed"] == 0 and got[None]["n_removed"] == 0
    assert substring.digest(nothing).collect() == []
    out = substring.without_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == 16
    assert {r["doc_id"]: r["text"] for r in out.collect()}[5] == " \n\t "


@pytest.mark.parametrize("window", [1, 2, 5, 13])
def test_matching_statistics_equal_brute_force(window):
    rng = np.random.default_rng(window)
    for _ in range(150):
        many, kinds = int(rng.integers(1, 12)), int(rng.integers(1, 4))
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 30, many))])
        symbols, owner = rng.integers(0, kinds, at[-1]), rng.integers(0, 8, many)
        texts = [tuple(symbols[a:b].tolist()) for a, b in zip(at, at[1:])]
        least = {}
        for t, o in zip(texts, owner):
            for s in range(len(t) - window + 1):
                least[t[s:s + window]] = min(o, least.get(t[s:s + window], o))
        found = [set() for _ in texts]
        for q, a, b in zip(*FMIndex(symbols, at, owner, kinds).matches(owner, window)):
            found[q].update(range(a, b))
        for q, t in enumerate(texts):
            starts = [s for s in range(len(t) - window + 1) if least[t[s:s + window]] < owner[q]]
            assert found[q] == {p for s in starts for p in range(s, s + window)}


# -- top-k -------------------------------------------------------------------

def test_top_k_equals_all_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(300)]
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (None, [1.0] * 8), (303, []), (350, [1.0, 2.0]), (0, [9.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    numbers = topk.whole_numbers(df).select("vec_id", "terms")
    got = topk.top_k(numbers, numbers.where("vec_id % 50 = 0 AND size(terms) = 8 AND terms[0] < 2000"), 5, segment=64, batch=3).collect()
    v = [(i, np.floor(np.float32(x).astype(np.float64) * 256).astype(int)) for i, x in rows if i is not None and x and None not in x and len(x) == 8 and not np.isnan(x).any()]
    for q, x in [(i, x) for i, x in v if i % 50 == 0 and x[0] < 2000]:
        want = sorted(((-int(x @ y), j) for j, y in v if j != q))[:5]
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [(s, j) for _, s, j in mine] == want
    assert topk.digest(df.limit(0)).collect() == []


def test_far_blocks_are_not_scored():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (20, 16))
    terms = np.concatenate([c + rng.integers(-3, 4, (128, 16)) for c in centres])
    blocks = topk.Blocks(np.arange(len(terms)), terms)
    scored = []
    blocks.ids, whole = blocks.ids, blocks.ids

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                scored.append(len(key))
            return np.asarray(self)[key]
    blocks.ids = whole.view(Counting)
    ids, scores = next(blocks.search(np.array([-1]), terms[:1], 5))
    every = terms @ terms[0]
    assert sorted(scores.tolist(), reverse=True) == sorted(every.tolist(), reverse=True)[:5]
    assert max(scored) < len(terms) / 2


# -- pipeline and queries ----------------------------------------------------

def test_pipeline_stages_keep_columns_and_decide(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == start
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.select("doc_id").distinct().count() == counts[4]
    assert len(corpus_pipeline.STAGES) == 5


def plain_chain(spark, rows, labels):
    """The first four stages on rows (doc_id, text, lang, source, n_chars), one document at a time."""
    frame = lambda r: spark.createDataFrame(r, DOCUMENTS)
    model = quality.fit(frame(rows), labels)
    rows = [r for r in rows if model.score(quality.features(*text_bytes(pa.array([r[1]], pa.string()))))[0] >= 0.3]
    groups = plain_groups([r[:2] for r in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    words = {r[0]: WORD.findall((r[1] or "").encode()) for r in rows}
    first = {}
    for i, w in words.items():
        for s in range(len(w) - 12):
            k = tuple(w[s:s + 13])
            first[k] = min(first.get(k, i), i)
    cut = []
    for r in rows:
        w = words[r[0]]
        gone = {p for s in range(len(w) - 12) if first[tuple(w[s:s + 13])] < r[0] for p in range(s, s + 13)}
        left = b" ".join(x for p, x in enumerate(w) if p not in gone).decode()
        cut.append((r[0], left if gone else r[1], *r[2:]))
    forest = secret_scan.fit_corpus(frame(cut))
    out = {}
    for i, text, _, source, _ in cut:
        for a, b in reversed(forest.secrets(text, source, secret_scan.candidates(text)) if text else []):
            text = text[:a] + secret_scan.MASK + text[b:]
        out[i] = text
    return out


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_equals_a_plain_chain(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    good = next(r for r in rows if r[1] and len(r[1]) > 400)
    rows += [(10_000 + i, f"{t} {good[1]}"[:3000], "en", "s1", 9) for i, t in quoting(5)]
    rows += [(20_000 + i, t, "en", "s2", 9) for i, t in varied(1)]
    turned = " ".join(random.Random(2).sample(words := good[1].split(), len(words)))
    secret = 'password = "correct-horse-battery" and token = "0123456789abcdef0123456789abcdef01234567"'
    rows += [(30_000, f"{turned}\n{secret} x", "en", "s1", 9), (30_001, None, "en", "s1", None), (30_002, "", None, None, 0)]
    labels = spark.read.parquet(f"{small}/labels.parquet")
    sf_dir = scratch_dir(spark, "small-corpus")
    spark.createDataFrame(rows, DOCUMENTS).repartition(5).write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    texts = plain_chain(spark, rows, labels)
    assert 100 < len(texts) < len(rows) and any(secret_scan.MASK in (t or "") for t in texts.values())
    library, want, sizes = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}, []
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want[i, n] = (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            sizes.append(len(part))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [a for a, _ in sorted(own)] == ends[:-1] and ends[-1] <= 2048
    # No more sequences than best fit decreasing on one machine needs.
    room = []
    for n in sorted(sizes, reverse=True):
        fit = min((k for k in range(len(room)) if room[k] >= n), key=lambda k: room[k], default=None)
        if fit is None:
            room.append(2048 - n)
        else:
            room[fit] -= n
    assert -(-sum(sizes) // 2048) <= len(places) <= len(room)


def test_n_chars_follows_the_text(spark):
    shared = " ".join(f"word{i}" for i in range(40))
    rows = [(1, f"{shared} first", "en", "s", 5), (2, f"{shared} zweite \u00e4\U0001f600", "de", "s", 5), (3, None, "en", "s", None),
            (4, 'password = "correct-horse-battery" here', "en", "s", 39), (5, "", "en", None, 0), (6, None, "en", "s", 7)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    sf = "/root/testdata/sf0.001"
    cut = corpus_pipeline.repeated_passages(spark, docs, sf)
    for out in (cut, corpus_pipeline.secrets(spark, cut, sf)):
        assert out.dtypes == docs.dtypes
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
        assert got[3] == (None, None) and got[6] == (None, 7)
        assert all(n == len(t) for t, n in got.values() if t is not None)
        assert got[2] == ("zweite \u00e4\U0001f600", 9)
    assert secret_scan.MASK in got[4][0]
    plain = docs.drop("n_chars")
    assert corpus_pipeline.repeated_passages(spark, plain, sf).columns == plain.columns


def test_every_operator_has_one_query():
    names = sorted(queries.QUERIES)
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    from oracle import compare, connect

    ok, message = compare(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), connect("/root/testdata/sf0.001"), queries.SQL[name])
    assert ok, message
