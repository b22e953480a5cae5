"""Near-duplicates in a group whose members are neither copies nor strangers."""

import numpy as np
from pyspark.sql import functions as F

from cartoloom.llm import minhash

DOCS = "doc_id long, text string, bits string, band long, n long"


def group(seed, size, low, high, words=120):
    """Variants of one text: each has some words replaced, so that pairs lie between about ``low`` and ``high``."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(words)]
    out = []
    for _ in range(size):
        share = rng.uniform(low, high)
        out.append(" ".join(w if rng.random() > share else f"x{rng.integers(10**9)}" for w in base))
    return out


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 1) for i, t in enumerate(texts)], DOCS)


def test_group_between_half_and_nine_tenths(spark):
    texts = group(1, 300, 0.0, 0.2)
    got = minhash.near_duplicates(rows(spark, texts), width=2).collect()
    want = minhash.brute_force(list(enumerate(texts)), 2)
    assert {r["id"]: r["component_id"] for r in got} == want
    assert 20 < len(set(want.values())) < 280


def test_signature_test_separates(spark):
    """Of a group without links hardly a pair passes; pairs at the threshold do."""
    texts = group(2, 150, 0.13, 0.13)
    grams = [minhash.shingles(t.encode(), 2) for t in texts]
    bits = [minhash.long_bits(g).tolist() for g in grams]
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "id long, bits array<long>")
    other = frame.select(F.col("id").alias("o"), F.col("bits").alias("o_bits"))
    passed = {(r["id"], r["o"]) for r in frame.join(other, (F.col("id") < F.col("o")) & minhash.may_agree(F.col("bits"), F.col("o_bits"), 80)).collect()}
    near = set()
    for i in range(150):
        for j in range(i + 1, 150):
            both = len(np.intersect1d(grams[i], grams[j]))
            if 100 * both >= 80 * (len(grams[i]) + len(grams[j]) - both):
                near.add((i, j))
    assert near <= passed and len(passed) < 0.1 * 150 * 149 / 2


def test_differing_bits_are_counted(spark):
    rng = np.random.default_rng(3)
    one, other = (rng.integers(-(2**63), 2**63 - 1, minhash.LONG // 64) for _ in range(2))
    differ = sum(int(x).bit_count() for x in (one ^ other).view(np.uint64))
    frame = spark.createDataFrame([(one.tolist(), other.tolist())], "a array<long>, b array<long>")
    got = frame.select(*[minhash.may_agree(F.col("a"), F.col("b"), p).alias(str(p)) for p in range(-20, 100)]).first().asDict()
    assert got == {str(p): differ <= minhash.most_differing(p) for p in range(-20, 100)} and len(set(got.values())) == 2


def test_long_signatures_follow_the_short_ones():
    grams = minhash.shingles(" ".join(f"w{k}" for k in range(3_000)).encode(), 5)
    assert (minhash.signature(grams, minhash.LONG)[: minhash.ROWS * minhash.BANDS] == minhash.signature(grams)).all()
