"""Near-duplicate documents by circulant MinHash.

A document is the set of its word shingles. One permutation (a keyed hash) scatters the shingles over a ring of
``RING`` places; a second, fixed permutation of the ring is shifted by 0, 1, 2 ... places to give every coordinate of the
signature: coordinate k is the least ``order[(place + k) mod RING]`` over the set. The coordinates of one shingle are thus a
run of neighbours in one table. Bands of ``ROWS`` coordinates meet in buckets; links are confirmed on the full sets.

Documents of one set are joined first, by a hash of the set; only the first document of each set goes on. A bucket is not
turned into all of its pairs: its members meet its first document, then the first documents of all their buckets, then
one more of the largest component of each bucket that still holds several, and last the members outside the largest
component meet the rest. Pairs of one component are never compared, and no partner or candidate is dropped.

In that last step a pair is made only if the long signatures of its texts, one bit of each of ``LONG`` coordinates, differ
seldom enough: the test is part of the join, so a bucket of many texts of similarity 0.7 doesn't turn into all of its pairs,
and no text moves for them. Long signatures are made for the members of these buckets alone.

With 42 bands of 6 a pair of Jaccard 0.8 shares no bucket with a probability of 3e-6, one of 0.85 with 2e-9; the long
signatures of a pair of 0.8 fail their test with one of 1e-6, those of a pair of 0.7 pass it in 2 cases of 100.

Cases: null, empty and blank texts have no shingles and are linked with nothing; a text of fewer words than a shingle has
one shingle, all its words; rows that share a ``doc_id`` are one node; a null ``doc_id`` is linked with nothing; other
columns pass through and are never shuffled with the signatures.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

RING = 1 << 20
ROWS = 6
BANDS = 42
SEED = 20_240_501
PERCENT = 80
#: Coordinates of a long signature, 64 to a long.
LONG = 2_048

_TABLE: dict[str, np.ndarray] = {}


def _ring() -> np.ndarray:
    """The fixed permutation as runs: row i has ``order[i], order[i + 1], ...`` for all coordinates."""
    if "ring" not in _TABLE:
        order = np.random.default_rng(SEED).permutation(RING).astype(np.uint32)
        _TABLE["ring"] = np.lib.stride_tricks.sliding_window_view(np.concatenate((order, order[: LONG - 1])), LONG)
    return _TABLE["ring"]


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The set of shingles as sorted 64-bit hashes."""
    words = common.lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = common.word_hashes(words)
    # the number of words goes in: a short text never equals a shingle of a longer one
    return np.unique(common.gram_hashes(hashes, min(width, len(words))) + np.uint64(min(width, len(words))))


def signature(grams: np.ndarray, count: int = ROWS * BANDS) -> np.ndarray:
    places = (common.mix(grams ^ np.uint64(SEED)) & np.uint64(RING - 1)).astype(np.int64)
    ring, least = _ring()[:, :count], None
    step = 1 << 19 >> count.bit_length()  # places at a time, in bounded memory
    for i in range(0, len(places), step):
        part = ring[places[i : i + step]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def long_bits(grams: np.ndarray) -> np.ndarray:
    """One bit of each coordinate of the long signature; they are mixed first, as least values have small leading bits."""
    bits = common.mix(signature(grams, LONG).astype(np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def most_differing(percent: int) -> int:
    """Bits that may differ: five deviations more than those of a pair at the threshold do on average."""
    p = (1 - percent / 100) / 2
    return int(LONG * p + 5 * (LONG * p * (1 - p)) ** 0.5) + 1


def may_agree(a, b, percent: int):
    """Whether two long signatures differ seldom enough."""
    differing = F.lit(0)
    for i in range(LONG // 64):
        differing = differing + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return differing <= most_differing(percent)


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = common.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def _sketches(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts, first, second, keys = [], [], [], []
            for value in common.texts_of(batch, "text"):
                grams = shingles(value, width)
                counts.append(len(grams))
                if len(grams):
                    digest = xxhash.xxh3_128_digest(grams.tobytes())
                    first.append(int.from_bytes(digest[:8], "little", signed=True))
                    second.append(int.from_bytes(digest[8:], "little", signed=True))
                    keys.append(bands(signature(grams)))
                else:
                    first.append(None)
                    second.append(None)
                    keys.append(np.empty(0, np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                names=["id", "n", "h1", "h2", "bands"],
            )

    return run


def _long_signatures(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            bits = [long_bits(shingles(value, width)) for value in common.texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bits, pa.list_(pa.int64()))], names=["id", "bits"])

    return run


def _confirm(width: int, percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            kept = []
            for k, (x, y) in enumerate(zip(common.texts_of(batch, "text_a"), common.texts_of(batch, "text_b"))):
                one, other = shingles(x, width), shingles(y, width)
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(other) - both):
                    kept.append(k)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[k] for k in kept], pa.int64()), "b": pa.array([b[k] for k in kept], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, n, component_id)`` for every row of ``docs``: size of its set and the smallest id that links lead to."""
    spark = docs.sparkSession
    common.prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketch = common.materialise(rows.mapInArrow(_sketches(width), "id long, n long, h1 long, h2 long, bands array<long>"), "minhash-sketch")
    same = sketch.where("n > 0 AND id IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("first"))
    # the first document of each set stands for it
    members = common.materialise(sketch.where("n > 0 AND id IS NOT NULL").select("id", "h1", "h2").join(same, ["h1", "h2"]).select("id", "first").distinct(), "minhash-members")
    firsts = sketch.where("n > 0").join(same, ["h1", "h2"]).where("id = first").select("id", "n", F.explode("bands").alias("band"))
    buckets = firsts.groupBy("band").agg(F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("last")).where("head.id < last")
    shared = firsts.join(buckets.select("band", F.col("head.id").alias("head"), F.col("head.n").alias("head_n")), "band")
    shared = common.materialise(shared, "minhash-buckets")
    ids = shared.select("id").distinct()
    texts = common.materialise(rows.join(ids, "id", "left_semi"), "minhash-texts")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        """Pairs (a, b) of ids whose full sets are similar enough."""
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return common.materialise(both.mapInArrow(_confirm(width, percent), "a long, b long").distinct(), label)

    def may_link(n, m):
        """The larger set is not too large for the smaller."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * percent

    def labelled(links: DataFrame) -> DataFrame:
        known = components(links)
        return common.materialise(shared.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")), "minhash-labels")

    # each member and the first of all the heads of its buckets
    tried = shared.where((F.col("id") != F.col("head")) & may_link(F.col("n"), F.col("head_n"))).groupBy(F.col("id").alias("a")).agg(F.min("head").alias("b"))
    tried = common.materialise(tried, "minhash-pairs")
    links = confirmed(tried, "minhash-links")
    # each member and all the heads that are in other components
    state = labelled(links)
    heads = state.where("id = head").select("band", F.col("root").alias("head_root"))
    more = state.join(heads, "band").where((F.col("root") != F.col("head_root")) & may_link(F.col("n"), F.col("head_n")))
    more = common.materialise(more.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "minhash-pairs")
    links, tried = links.union(confirmed(more, "minhash-links")), tried.union(more)
    # in buckets of several components, all outside the largest: first with one more of its members, then with the rest
    def opened(state: DataFrame) -> DataFrame:
        sizes = state.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "n")).alias("one"))
        open_ = sizes.groupBy("band").agg(F.max(F.struct("size", "root", "one")).alias("most"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
        inside = state.join(open_.select("band", F.col("most.root").alias("most"), F.col("most.one").alias("one")), "band")
        return common.materialise(inside.select("band", "id", "n", "root", "most", "one"), "minhash-open")

    def untried(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        before = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return common.materialise(ordered.join(before, ["a", "b"], "left_anti"), "minhash-pairs")

    inside = opened(labelled(links))
    more = untried(inside.where((F.col("root") != F.col("most")) & may_link(F.col("n"), F.col("one.n"))).select(F.col("id").alias("a"), F.col("one.id").alias("b")))
    links, tried = links.union(confirmed(more, "minhash-links")), tried.union(more)
    # a pair that shares several of these buckets is made in the first of them alone
    inside = opened(labelled(links))
    own = inside.groupBy("id").agg(F.collect_set("band").alias("own"))  # of one document: at most BANDS
    signed = texts.join(own.select("id"), "id", "left_semi").where("text IS NOT NULL").mapInArrow(_long_signatures(width), "id long, bits array<long>")
    # an id with several texts goes by one of them, the same in every run
    signed = common.materialise(own.join(signed.groupBy("id").agg(F.min("bits").alias("bits")), "id"), "minhash-signed")
    inside = inside.join(signed, "id")
    outside = inside.where("root <> most").select(F.col("band").alias("a_band"), *[F.col(c).alias("a" if c == "id" else f"a_{c}") for c in ("id", "n", "root", "own", "bits")])
    rest = inside.join(
        outside,
        (F.col("band") == F.col("a_band"))
        & (F.col("root") != F.col("a_root"))
        & ((F.col("root") == F.col("most")) | (F.col("id") < F.col("a")))
        & may_link(F.col("n"), F.col("a_n"))
        & may_agree(F.col("bits"), F.col("a_bits"), percent)
        & (F.array_min(F.array_intersect("own", "a_own")) == F.col("band")),
    )
    rest = untried(rest.select("a", F.col("id").alias("b")))
    links = links.union(confirmed(rest, "minhash-links"))
    # rows of one set follow its first document
    root = components(links.union(members.select(F.col("id").alias("a"), F.col("first").alias("b"))))
    out = sketch.select("id", "n").join(root.select(F.col("node").alias("id"), "root"), "id", "left")
    return out.select("id", "n", F.coalesce("root", "id").alias("component_id"))


def query(spark, sf_dir):
    out = near_duplicates(common.table(spark, sf_dir, "documents"), width=2)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def stage(spark, docs, sf_dir):
    """One document of each group of near copies stays, that of the smallest id; rows without an id all stay."""
    columns = docs.columns
    gone = near_duplicates(docs).where("id <> component_id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*columns)


def brute_force(rows: list[tuple[int, str | None]], width: int, percent: int = PERCENT) -> dict[int, int]:
    """Component of each id, from all pairs."""
    sets = []
    for key, text in rows:
        words = [w.decode() for w in common.lower_words((text or "").encode())]
        sets.append((key, {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())))
    parent = {key: key for key, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {key: find(key) for key in parent}
