"""Substring dedup by fingerprints of passages of at least ``WINDOW`` words, in place of relative Lempel-Ziv parsing.

Nothing is parsed and no longest match is sought: a passage matters only if it holds a whole window of words, so all
documents are indexed by fingerprints in hash partitions, and a document meets only what shares one with it:

1. Anchors: of every window its least ``GRAM``-word hash (a minimiser). Equal windows have equal anchors, so a window
   whose anchor lies in no other document is in no passage. About one word in eighteen is an anchor.
2. Long passages: the words from one anchor up to ``WINDOW - 1`` words beyond the next, as one fingerprint. Where a document
   of a smaller id has it, all its windows are settled by that single match.
3. Their boundaries: the windows that hold a shared anchor but lie in no long passage are looked up one by one.

Spans are the union of the windows found. The steps count by ``min(doc_id)`` per fingerprint, which is combined before the
shuffle: a passage that a third of all documents share is a few rows per task, not a group. Documents of one word
sequence are settled first by its digest. Fingerprints have 64 bits over words of 64-bit hashes
and are not compared word by word afterwards, so chance equality can remove text in very large tables.

Cases: a null, empty or blank text has no words; a document of fewer words than a window loses nothing; rows that share a
``doc_id`` don't count against each other; rows without an id neither lose words nor take them from others; other columns
pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 50
GRAM = 16


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest value of each run of ``width``, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(values) - width + 1], out[width - done : len(values) - done + 1]) if done < width else out


class Parsed:
    """Fingerprints of one document."""

    def __init__(self, words: list[bytes], window: int = WINDOW, gram: int = GRAM):
        self.n = len(words)
        self.window, self.gram = window, min(gram, window)
        self.hashes = common.word_hashes(words)
        if self.n < window:
            self.anchors = np.empty(0, np.int64)
            return
        self.grams = common.gram_hashes(self.hashes, self.gram)
        reach = window - self.gram + 1  # grams of a window
        self.least = _sliding(self.grams, reach, np.minimum)
        # a gram is an anchor if it is the least of a window that it lies in: the greatest of their minima is its own
        padded = np.concatenate((np.zeros(reach - 1, np.uint64), self.least, np.zeros(reach - 1, np.uint64)))
        self.anchors = np.flatnonzero(_sliding(padded, reach, np.maximum)[: len(self.grams)] == self.grams)

    def anchor_keys(self) -> np.ndarray:
        return np.unique(self.grams[self.anchors]).view(np.int64) if len(self.anchors) else np.empty(0, np.int64)

    def long_factors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, fingerprint) from each anchor on: neighbours overlap by a window less one word."""
        if len(self.anchors) < 2:
            none = np.empty(0, np.int64)
            return none, none, none
        starts = self.anchors[:-1]
        need = self.anchors[1:] + self.window - 1
        ends_at = np.searchsorted(self.anchors + self.gram, need)
        ok = ends_at < len(self.anchors)
        starts, ends = starts[ok], self.anchors[ends_at[ok]] + self.gram
        return starts, ends, self._range_hashes(starts, ends)

    def _range_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of word ranges from those of runs of a power of two (two overlapping runs, and the length)."""
        out = np.empty(len(starts), np.uint64)
        sizes = ends - starts
        power = 1
        while power * 2 <= (sizes.max() if len(sizes) else 0):
            power *= 2
        while len(starts) and power >= 1:
            mine = (sizes >= power) & (sizes < 2 * power)
            if mine.any():
                runs = common.gram_hashes(self.hashes, power)
                a, b = runs[starts[mine]], runs[ends[mine] - power]
                out[mine] = common.mix(common.mix(a) * np.uint64(0x9E3779B97F4A7C15) + b + sizes[mine].astype(np.uint64))
            power //= 2
        return out.view(np.int64)

    def boundary_windows(self, shared: np.ndarray, settled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, fingerprint) of windows whose anchor is shared and that no settled window start covers."""
        if self.n < self.window:
            none = np.empty(0, np.int64)
            return none, none
        wanted = np.isin(self.least, shared.view(np.uint64)) & ~settled
        places = np.flatnonzero(wanted)
        return places, common.gram_hashes(self.hashes, self.window)[places].view(np.int64)


def _settled(parsed: Parsed, factors: set[int]) -> np.ndarray:
    """Window starts that lie in a long factor which a smaller document has."""
    mark = np.zeros(max(parsed.n - parsed.window + 1, 0) + 1, np.int64)
    if factors and len(mark) > 1:
        starts, ends, keys = parsed.long_factors()
        own = np.isin(keys, np.fromiter(factors, np.int64, len(factors)))
        np.add.at(mark, starts[own], 1)
        np.add.at(mark, np.minimum(ends[own] - parsed.window + 1, len(mark) - 1), -1)
    return np.cumsum(mark)[:-1] > 0


def spans_of(starts: np.ndarray, window: int) -> list[list[int]]:
    """Union of the windows at sorted starts, as word ranges."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    return np.column_stack((starts[np.concatenate(([0], breaks + 1))], starts[np.concatenate((breaks, [len(starts) - 1]))] + window)).tolist()


def _lists(values: list[np.ndarray]):
    import pyarrow as pa

    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, np.int64), pa.int64()))


def _parse(window: int, gram: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts, digests, anchors, factors = [], [], [], []
            for value in common.texts_of(batch, "text"):
                words = value.split() if value else []
                parsed = Parsed(words, window, gram)
                counts.append(parsed.n)
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                anchors.append(parsed.anchor_keys())
                factors.append(np.unique(parsed.long_factors()[2]) if len(parsed.anchors) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), _lists(anchors), _lists(factors)],
                names=["id", "n_words", "digest", "anchors", "factors"],
            )

    return run


def _windows(window: int, gram: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, digests, starts, keys = [], [], [], []
            for key, digest, value, shared, factors in zip(
                batch.column("id").to_pylist(), batch.column("digest").to_pylist(), common.texts_of(batch, "text"), batch.column("shared").to_pylist(), batch.column("earlier").to_pylist()
            ):
                parsed = Parsed(value.split() if value else [], window, gram)
                places, marks = parsed.boundary_windows(np.array(shared or [], np.int64), _settled(parsed, set(factors or ())))
                ids.append(key)
                digests.append(digest)
                starts.append(places.astype(np.int64))
                keys.append(marks)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), _lists(starts), _lists(keys)], names=["id", "digest", "starts", "keys"])

    return run


def _finish(window: int, gram: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spans, kept = [], []
            for value, factors, found in zip(common.texts_of(batch, "text"), batch.column("earlier").to_pylist(), batch.column("found").to_pylist()):
                words = value.split()
                starts = np.flatnonzero(_settled(Parsed(words, window, gram), set(factors or ())))
                own = spans_of(np.union1d(starts, np.array(found or [], np.int64)), window)
                rest = [w for a, b in zip([0, *(s[1] for s in own)], [*(s[0] for s in own), len(words)]) for w in words[a:b]]
                spans.append(own)
                kept.append(hashlib.sha256(b" ".join(rest)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.string())], names=["id", "digest", "spans", "kept_sha256"]
            )

    return run


def duplicate_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, n_words, spans, kept_sha256)`` for every row: word ranges that documents of smaller ids have, and what is left."""
    spark = docs.sparkSession
    common.prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    parsed = rows.mapInArrow(_parse(window, gram), "id long, n_words long, digest binary, anchors array<long>, factors array<long>")
    parsed = common.materialise(parsed, "substring-parsed")
    # documents of one word sequence: only those of the smallest id go on
    long_ = parsed.where(F.col("id").isNotNull() & (F.col("n_words") >= window))
    first = long_.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    copies = long_.select("id", "digest").join(first.where("first < last").select("digest", "first"), "digest").where("id > first").select("id", "digest").distinct()
    copies = common.materialise(copies, "substring-copies")
    alone = long_.join(copies, ["id", "digest"], "left_anti")

    def spread(column: str) -> DataFrame:
        return alone.select("id", "digest", F.explode(column).alias("key"))

    def least(frame: DataFrame) -> DataFrame:
        return frame.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first")

    anchors = spread("anchors")
    anchors = anchors.join(least(anchors).select("key"), "key").groupBy("id", "digest").agg(F.collect_set("key").alias("shared"))  # of one document
    factors = spread("factors")
    factors = factors.join(least(factors), "key").where("id > first").groupBy("id", "digest").agg(F.collect_set("key").alias("earlier"))
    marks = common.materialise(anchors.join(factors, ["id", "digest"], "left"), "substring-marks")
    # the texts that share an anchor, written once: the boundary windows and the last step read them
    sha = F.unhex(F.sha2(F.regexp_replace(F.btrim(F.col("text"), F.lit(common.SPACE)), common.SPACE_RUN, " "), 256))
    sharing = rows.join(marks, "id").where(sha == F.col("digest"))
    sharing = common.materialise(sharing.dropDuplicates(["id", "digest"]), "substring-sharing")
    windows = common.materialise(sharing.mapInArrow(_windows(window, gram), "id long, digest binary, starts array<long>, keys array<long>"), "substring-windows")
    each = windows.select("id", "digest", F.explode(F.arrays_zip("starts", "keys")).alias("w")).select("id", "digest", F.col("w.starts").alias("start"), F.col("w.keys").alias("key"))
    found = each.join(least(each), "key").where("id > first").groupBy("id", "digest").agg(F.collect_set("start").alias("found"))  # of one document
    cut = sharing.join(found, ["id", "digest"], "left").where("earlier IS NOT NULL OR found IS NOT NULL").select("id", "digest", "text", "earlier", "found")
    spans = cut.mapInArrow(_finish(window, gram), "id long, digest binary, spans array<array<long>>, kept_sha256 string")
    out = parsed.select("id", "n_words", "digest").join(spans, ["id", "digest"], "left").join(copies.withColumn("is_copy", F.lit(True)), ["id", "digest"], "left")
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))
    return out.select(
        "id",
        "n_words",
        F.when(F.col("is_copy"), whole).otherwise(F.coalesce("spans", F.array().cast("array<array<bigint>>"))).alias("spans"),
        F.when(F.col("is_copy"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )


def query(spark, sf_dir):
    found = duplicate_spans(common.table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    return found.select(F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"), "kept_sha256")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(regexp_extract_all(text, '[^ \\t-\\r]+'), []) AS words FROM documents),
place AS (
  SELECT row_id, doc_id, i, md5(array_to_string(words[i : i + {WINDOW - 1}], ' ')) AS w
  FROM (SELECT row_id, doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM d WHERE len(words) >= {WINDOW} AND doc_id IS NOT NULL)
),
again AS (SELECT row_id, i FROM (SELECT row_id, doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM place) WHERE first < doc_id),
gone AS (SELECT DISTINCT row_id, unnest(generate_series(i, i + {WINDOW - 1})) AS pos FROM again),
word AS (SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
kept AS (SELECT row_id, string_agg(word, ' ' ORDER BY pos) AS rest, count(*) AS n FROM word ANTI JOIN gone USING (row_id, pos) GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row_id)
"""
