"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``TABLES`` tables turns the unit vectors by a fast pseudo-rotation (three rounds of random signs and a Hadamard
transform) and puts a vector at the nearest signed axis. A query looks at its own axis and the next ``PROBES - 1`` in every
table. What it meets there is reranked by the exact cosine of the original vectors, in double precision.

Buckets grow with the data, so neither side is ever gathered whole: both are packed into blocks of bounded bytes, dealt by a
hash of the id inside their bucket, and blocks of one bucket meet by an equi-join. A pair of blocks leaves the best ``k`` of
each query only, which is enough for the best of the union. Equal vectors are one entry with their ``k + 1`` smallest ids, so
a vector with very many copies costs as much as one. A query that met fewer than ``k`` candidates, as in tables of a few
rows, looks at all axes of the first table, that is at every row.

Cases: vectors that are null, zero or hold a null or non-finite component, and rows without an id, take no part; rows that
share an id count as one, the one of the smallest bytes; vectors are compared with those of their own length; equal scores
go by the smaller id; fewer candidates than ``k`` are all returned; empty tables give no rows; other columns take no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Few tables with many probes: a row is copied once per table, only queries once per probe. Measured on vectors without
#: near neighbours (64 axes, best cosines of 0.3 to 0.5), where 20 probes in 8 tables meet seven rows of ten.
TABLES = 8
PROBES = 20
K = 5
SEED = 1_507
BLOCK_BYTES = 1 << 18
QUERY_BYTES = 1 << 16

_SIGNS: dict[tuple[int, int], np.ndarray] = {}


def _signs(width: int, tables: int) -> np.ndarray:
    """Random signs of all tables and rounds for vectors padded to ``width``; the same in every process."""
    key = (width, tables)
    if key not in _SIGNS:
        _SIGNS[key] = np.random.default_rng([SEED, width]).choice(np.array([-1.0, 1.0]), (tables, 3, width))
    return _SIGNS[key]


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, by halves: width * log2(width) additions."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, width // (2 * step), 2, step)
        rows = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(n, width)
        step *= 2
    return rows / np.sqrt(width)


def axes(vectors: np.ndarray, table: int, tables: int, probes: int = 1) -> np.ndarray:
    """The ``probes`` nearest signed axes of every unit vector in one table, nearest first; axis i is 2i, its opposite 2i + 1."""
    width = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    turned = np.zeros((len(vectors), width))
    turned[:, : vectors.shape[1]] = vectors
    for signs in _signs(width, tables)[table]:
        turned = hadamard(turned * signs)
    probes = min(probes, 2 * width)
    both = np.stack((turned, -turned), axis=2).reshape(len(turned), 2 * width)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes].astype(np.int32)


def _unit(packed: list[bytes], dtype: str) -> np.ndarray:
    rows = np.frombuffer(b"".join(packed), dtype).reshape(len(packed), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square over- or underflows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _valid(dtype: str):
    """Usable vectors as bytes."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, found = [], []
            for key, vector in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist()):
                if key is None or not vector or None in vector:
                    continue
                row = np.array(vector, dtype=dtype)
                if np.isfinite(row).all() and row.any():
                    ids.append(key)
                    found.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["id", "vector"])

    return run


def _hashed(dtype: str, tables: int, probes: int | None):
    """Buckets of every vector: its ``probes`` nearest axes in each table, or all axes of the first table if None."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            packed = batch.column("vector").to_pylist()
            sizes = np.array([len(v) for v in packed], dtype=np.int64)
            keys = [None] * len(packed)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for low in range(0, len(at), 2_048):
                    some = at[low : low + 2_048]
                    unit = _unit([packed[i] for i in some], dtype)
                    count = 2 << max(0, int(unit.shape[1] - 1).bit_length())
                    if probes is None:
                        found = np.tile(np.arange(count), (len(some), 1))
                    else:
                        found = np.concatenate([t * count + axes(unit, t, tables, probes) for t in range(tables)], axis=1)
                    for i, row in zip(some, found):
                        keys[i] = row
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            buckets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("vector"), buckets], names=["ids", "vector", "buckets"])

    return run


def _best(dtype: str, k: int):
    """Pairs of blocks to the best ``k`` of each query, by the exact cosine."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                queries, entries = row["queries"], row["entries"]
                left, right = _unit([q["vector"] for q in queries], dtype), _unit([e["vector"] for e in entries], dtype)
                near = left @ right.T
                cut = max(0, len(entries) - k)
                least = np.partition(near, cut, axis=1)[:, cut] - 1e-12
                for i, query in enumerate(queries):
                    at = np.flatnonzero(near[i] >= least[i])
                    # summed row by row in one order, so that a pair has one score wherever it is met
                    scores = (right[at] * left[i]).sum(axis=1)
                    found = sorted((-s, e) for s, j in zip(scores.tolist(), at) for e in entries[j]["ids"])[:k]
                    out += [(query["ids"][0], e, -s) for s, e in found]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["asker", "vec_id", "score"])

    return run


def _blocks(hashed: DataFrame, limit: int, name: str) -> DataFrame:
    """``(bucket, size, name)``: the entries of every bucket in blocks of about ``limit`` bytes."""
    rows = hashed.select(F.explode("buckets").alias("bucket"), F.octet_length("vector").alias("size"), "ids", "vector")
    counts = hashed.select(F.explode("buckets").alias("bucket"), F.octet_length("vector").alias("size")).groupBy("bucket", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = common.materialise(counts, "neighbours-counts")  # a row per bucket
    dealt = F.pmod(F.xxhash64(F.col("ids")[0]), F.ceil(F.col("n") * F.col("size") / limit))
    rows = rows.join(counts, ["bucket", "size"]).withColumn("block", dealt)
    return rows.groupBy("bucket", "size", "block").agg(F.collect_list(F.struct("ids", "vector")).alias(name)).drop("block")


def _ranked(rows: DataFrame, of: str, k: int) -> DataFrame:
    """The best ``k`` rows of every ``of`` with their rank; the limit is applied before the shuffle, too."""
    order = Window.partitionBy(of).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: Column, k: int = K, tables: int = TABLES, probes: int = PROBES, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` found for every row that ``queries`` holds for, by ``vec_id``."""
    spark = vectors.sparkSession
    common.prepare(spark)
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    dtype = "<f4" if single else "<f8"
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"), queries.alias("asks"))
    wanted = rows.where("asks AND id IS NOT NULL").select("id").distinct()
    packed = rows.select("id", "vector").mapInArrow(_valid(dtype), "id long, vector binary")
    packed = common.materialise(packed.groupBy("id").agg(F.min("vector").alias("vector")), "neighbours-vectors")
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    entries = packed.withColumn("i", first).where(F.col("i") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    schema = "ids array<long>, vector binary, buckets array<long>"
    entries = common.materialise(entries.select("ids", "vector").mapInArrow(_hashed(dtype, tables, 1), schema), "neighbours-entries")
    # queries of one vector ask once, under its smallest id
    askers = packed.join(wanted, "id", "left_semi").join(entries.select("vector", F.col("ids")[0].alias("asker")), "vector")
    askers = common.materialise(askers, "neighbours-queries")
    asking = askers.groupBy("vector").agg(F.array(F.min("asker")).alias("ids")).select("ids", "vector")

    def search(asking: DataFrame, probes: int | None) -> DataFrame:
        asked = common.materialise(asking.mapInArrow(_hashed(dtype, tables, probes), schema), "neighbours-asked")
        pairs = _blocks(entries, BLOCK_BYTES, "entries").join(_blocks(asked, QUERY_BYTES, "queries"), ["bucket", "size"])
        met = pairs.select("queries", "entries").mapInArrow(_best(dtype, k + 1), "asker long, vec_id long, score double")
        return common.materialise(_ranked(met.groupBy("asker", "vec_id").agg(F.max("score").alias("score")), "asker", k + 1), "neighbours-found")

    found = search(asking, probes)
    enough = found.where(F.col("rank") == k + 1).select("asker")
    short = common.materialise(asking.join(enough, F.col("ids")[0] == F.col("asker"), "left_anti"), "neighbours-short")
    if not short.isEmpty():
        again = search(short, None)
        found = found.join(again.select("asker").distinct(), "asker", "left_anti").unionByName(again)
    out = askers.select("asker", F.col("id").alias("query_id")).join(found.drop("rank"), "asker").where("vec_id <> query_id")
    return _ranked(out, "query_id", k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def brute_force(rows: list[tuple[int, list[float] | None]], k: int = K) -> dict[int, list[tuple[int, float]]]:
    """The nearest of every usable row of distinct ids, by all cosines."""
    usable = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all() and any(v)]
    out = {}
    for i, v in usable:
        near = [(-float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), j) for j, w in usable if j != i and len(w) == len(v)]
        out[i] = [(j, -s) for s, j in sorted(near)[:k]]
    return out
