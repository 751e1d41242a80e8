"""Sharding, token files and packing."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleethealth.llm import packing, sharding, token_files
from fleethealth.llm.tokens import WordTokenizer
from fleethealth.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_places_are_a_permutation_with_an_inverse(n):
    rows = np.arange(n)
    place = sharding.place_of(rows, n, seed=3)
    assert sorted(place.tolist()) == list(range(n))
    assert (sharding.row_at(place, n, seed=3) == rows).all()
    if n > 100:
        assert (place != sharding.place_of(rows, n, seed=4)).any()


def test_shards_are_even_and_slots_gapless(awkward, nothing):
    rows = sharding.digest(awkward, 5).collect()
    assert len(rows) == 16
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(5)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert {len(v) for v in slots.values()} <= {3, 4}
    text = dict((r["doc_id"], r["text"]) for r in awkward.collect())
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), None)
    assert sharding.digest(nothing, 5).collect() == []
    keep = sharding.shard(awkward.withColumn("text_crc32", F.crc32("text")).withColumn("shard", F.lit("x")), 5)
    assert keep.count() == 16 and dict(keep.dtypes)["shard"] == "int" and "item" in keep.columns


def test_shards_do_not_depend_on_partitions(awkward):
    one, two = (sharding.digest(awkward.repartition(n), 4).collect() for n in (1, 5))
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_written_shards(spark, awkward):
    path = scratch_dir(spark, "shards")
    sharding.write_shards(awkward.withColumn("text_crc32", F.crc32("text")), path, 3)
    back = spark.read.parquet(path)
    assert back.count() == 16 and back.select("shard").distinct().count() == 3


WORDS = st.text(st.sampled_from("aAbé'ß.,!%1 \n\t\xa0\x1cΣ<|>漢") | st.characters(exclude_categories=["Cs"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_word_cache_gives_the_library_ids(text):
    library = Tokenizer.from_file(PATH)
    assert ENCODER.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


ENCODER = WordTokenizer(PATH)


def test_token_files_round_trip(spark, awkward, nothing):
    library = Tokenizer.from_file(PATH)
    folder = scratch_dir(spark, "tokens")
    token_files.write(awkward, folder, PATH, end_id=2)
    back = token_files.read(spark, folder)
    rows = sorted(back.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted([r["doc_id"] for r in awkward.collect()], key=lambda i: (i is not None, i))
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    start = 0
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        start += len(ids)
    sums = {(r["start"], r["ids_crc32"]) for r in token_files.digest(back).collect()}
    assert sums == {(r["start"], zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())) for r in rows}
    plan = back.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    empty = scratch_dir(spark, "tokens")
    token_files.write(nothing, empty, PATH, end_id=2)
    assert token_files.digest(token_files.read(spark, empty)).collect() == []


def fewest_bins(sizes, capacity):
    best = len(sizes)
    for k in range(1, len(sizes) + 1):
        def place(i, room):
            if i == len(sizes):
                return True
            for b in range(k):
                if room[b] >= sizes[i] and room[b] not in room[:b]:
                    room[b] -= sizes[i]
                    if place(i + 1, room):
                        return True
                    room[b] += sizes[i]
            return False
        if place(0, [capacity] * k):
            return k
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_and_best_fit_enclose_the_optimum(sizes):
    sizes = sorted(sizes, reverse=True)
    optimum = fewest_bins(sizes, 12)
    bins, offsets, used = packing.best_fit(np.array(sizes), 12)
    assert packing.lower_bound(np.bincount(sizes, minlength=13)) <= optimum <= len(used)
    for b, group in itertools.groupby(sorted(zip(bins.tolist(), offsets.tolist(), sizes)), key=lambda x: x[0]):
        at = 0
        for _, offset, size in group:
            assert offset == at
            at += size
        assert at == used[b] <= 12


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_awkward_texts(awkward, nothing):
    pieces = packing.cut_pieces(awkward, PATH, end_id=0, capacity=512)
    rows = packing.pack(pieces, 512).collect()
    check_packing(rows, 512)
    library = Tokenizer.from_file(PATH)
    want = []
    for r in awkward.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want += [(r["doc_id"], i, a, zlib.crc32(np.array(ids[a:a + 512], dtype="<u4").tobytes()))
                 for i, a in enumerate(range(0, len(ids), 512))]
    got = [(r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert packing.pack(packing.cut_pieces(nothing, PATH, 0, 512), 512).collect() == []


def test_exchange_between_partitions_saves_sequences(spark):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 1500, 3000)
    df = spark.createDataFrame([(int(x),) for x in sizes], "length long")
    apart = check_packing(packing.pack(df, 2048, rounds=0, part_items=100).collect(), 2048)
    together = check_packing(packing.pack(df, 2048, part_items=100).collect(), 2048)
    bound = packing.lower_bound(np.bincount(sizes, minlength=2049))
    assert bound <= together < apart and together <= bound * 1.02


def test_sequences_hold_all_ids(spark):
    df = spark.createDataFrame([([i] * (i % 7 + 1),) for i in range(50)], "ids array<int>").withColumn(
        "length", F.size("ids").cast("long"))
    out = packing.sequences(packing.pack(df, 16)).collect()
    assert sorted(i for r in out for i in r["ids"]) == sorted(i for i in range(50) for _ in range(i % 7 + 1))
    assert all(len(r["ids"]) <= 16 for r in out)
