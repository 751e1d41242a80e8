"""Winnowed fingerprints of texts, with DataFrame functions only.

The unit is a token: up to 8 characters of a word (a run without 0x20 and
0x09-0x0D), so long unspaced text has units too. The hash of k consecutive
tokens is rolled up by doubling (two neighbouring hashes of j tokens give one of
2j), then the smallest hash of every window of w neighbouring k-grams is chosen,
the rightmost of equal ones, again by doubling. Chosen (position, hash) pairs
are kept in order of position: any run of w + k - 1 equal tokens of two texts
shares a fingerprint, and its positions tell where.

A text of fewer than k tokens has one k-gram, all of it; one of fewer than w
k-grams has one window. Null and empty texts have no fingerprint. k and w are
powers of two. Likeness is the share of common hashes among all distinct hashes
of two texts: 1 if both have none, 0 if only one has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth.llm.store import numbered

K, W = 4, 4
TOKEN = r"[^\x20\x09-\x0D]{1,8}"
_PLACE_BITS = 31
_PLACE = (1 << _PLACE_BITS) - 1


def _shifted(a: Column, by: int, op) -> Column:
    """op(a[i], a[i + by]) for every i that has both."""
    n = F.size(a) - by
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(by + 1), n), op)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``name``: array<long>, each entry hash * 2^31 + (2^31 - 1 - position).

    One ``withColumn`` per step, so that no array expression is computed twice.
    """
    a = F.col("__a")
    out = df.withColumn("__a", F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)),
                                           lambda t: F.xxhash64(t)))
    step = 1
    while step < k:
        # Shorter texts: what is there becomes one k-gram below.
        out = out.withColumn("__a", F.when(F.size(a) > step, _shifted(a, step, lambda x, y: F.xxhash64(x, y)))
                             .otherwise(F.when(F.size(a) > 0, F.array(F.xxhash64(a))).otherwise(a)))
        step *= 2
    out = out.withColumn("__a", F.transform(a, lambda h, i: F.shiftleft(
        F.shiftrightunsigned(h, 64 - 32), _PLACE_BITS).bitwiseOR(F.lit(_PLACE) - i.cast("long"))))
    step = 1
    while step < w:
        out = out.withColumn("__a", F.when(F.size(a) > step, _shifted(a, step, lambda x, y: F.least(x, y)))
                             .otherwise(F.when(F.size(a) > 0, F.array(F.array_min(a))).otherwise(a)))
        step *= 2
    # Neighbouring windows choose the same entry again and again; positions only grow.
    return out.withColumn(name, F.array_distinct(a)).drop("__a")


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, _PLACE_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def written(fingerprint: Column) -> Column:
    """``position:hash`` in hex, by position."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(
        F.hex(F.lit(_PLACE) - x.bitwiseAND(F.lit(_PLACE))), F.lit(":"), F.hex(F.shiftright(x, _PLACE_BITS)))), " ")


def with_next(df: DataFrame, key: str, tie: Column, carried: dict[str, str], rows_a_bucket: int = 2000,
              most_buckets: int = 65_536) -> DataFrame:
    """``df`` with columns of the next row in falling ``key`` order (ties by ``tie``;
    after the last comes the first); ``carried`` maps columns to their new names.

    Ids alone are numbered first; every ``rows_a_bucket``-th id begins a bucket
    (at most ``most_buckets`` bounds, one number each, come to the driver). Rows
    then move once, to their bucket; the first row of a bucket also goes to the
    bucket before, as a guest, so that no neighbour is missed. Null keys come last.
    """
    base = df.withColumn("__key", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))
    ids = numbered(base.select("__key"), [F.desc("__key")], "id-order", "__row")
    size = max(rows_a_bucket, -(-ids.count() // most_buckets))
    heads = sorted({r[0] for r in ids.where(F.col("__row") % size == 0).select("__key").collect()}, reverse=True)
    if not heads:
        return base.drop("__key").select("*", *[F.col(c).alias(n) for c, n in carried.items()])
    bounds = F.from_json(F.lit(str(heads)), "array<bigint>")  # folded to one literal
    # Binary search for the last bound that is not below the key.
    out = base.withColumn("__b", F.lit(0))
    step = 1 << (len(heads).bit_length() - 1)
    while step:
        ahead = F.col("__b") + step
        out = out.withColumn("__b", F.when(
            (ahead < len(heads)) & (F.get(bounds, F.least(ahead, F.lit(len(heads) - 1))) >= F.col("__key")), ahead
        ).otherwise(F.col("__b")))
        step //= 2
    own = F.struct(F.col("__b").alias("bucket"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("__b") - 1, F.lit(len(heads))).alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.get(bounds, F.col("__b")) == F.col("__key"), F.array(own, before)).otherwise(F.array(own))
    dealt = out.withColumn("__tie", tie).withColumn("__at", F.explode(places))
    w = Window.partitionBy("__at.bucket").orderBy("__at.guest", F.desc("__key"), "__tie")
    dealt = dealt.select("*", *[F.lead(c).over(w).alias(n) for c, n in carried.items()])
    return dealt.where(~F.col("__at.guest")).drop("__key", "__b", "__tie", "__at")


def digest(documents: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edited text (the last half replaced by
    the beginning of the next document), and their likeness."""
    text = F.coalesce("text", F.lit(""))
    own = with_fingerprint(documents.select("doc_id", text.alias("text")), "text", "fp", k, w)
    both = with_next(own, "doc_id", F.xxhash64("text"), {"text": "next_text", "fp": "next_fp"})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = both.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    every = with_fingerprint(edited, "edited", "edited_fp", k, w)
    for name in ("fp", "edited_fp", "next_fp"):
        every = every.withColumn(f"{name}_h", hashes(F.col(name)))
    return every.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("fp")).alias("fingerprint"),
        written(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp_h"), F.col("edited_fp_h")).alias("near_edited"),
        likeness(F.col("fp_h"), F.col("next_fp_h")).alias("near_next"))
