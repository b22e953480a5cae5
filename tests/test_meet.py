"""Pairs of points and features are dealt to tasks by their number."""

from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import query


def crowd(spark, n):
    points = spark.range(n).select(F.col("id").alias("pid"), (F.col("id") % 10 * 0.001).alias("lon"), F.lit(10.0).alias("lat")).coalesce(1)
    spots = spark.range(n).select(F.lit("spot").alias("layer"), (F.col("id") + n).alias("fid"), g.point(F.col("id") % 7 * 100.0, F.lit(1_118_889.0)).alias("geom"))
    box = spark.range(1).select(F.lit("box").alias("layer"), "id", g.polygon(g.box_ring(*[F.lit(c) for c in (-1e5, 1e6, 1e5, 1.2e6)])).alias("geom"))
    return points, g.with_bounds(spots.union(box).coalesce(1))


def test_a_crowded_cell_is_cut(spark, monkeypatch):
    points, features = crowd(spark, 300)
    want = {tuple(r) for r in query.query_many(points, features, 600.0, fields=[]).select("pid", "fid", "distance").collect()}
    monkeypatch.setattr(query, "RANK_PAIRS", 10_000)
    hits = query.query_many(points, features, 600.0, fields=[])
    parts = hits.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert {tuple(r) for r in hits.select("pid", "fid", "distance").collect()} == want and hits.count() == len(want) > 300
    assert len(parts) >= 4 and max(r["count"] for r in parts) < len(want) * 0.6
