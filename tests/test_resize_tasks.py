"""Several sizes in one pass, dealt over as many tasks as there are cells."""

from pyspark.sql import functions as F

from cartoloom.operators import raster
from cartoloom.plans import QUERIES


def images(spark, n):
    cells = spark.range(n * 48).select((F.col("id") / 48).cast("int").alias("img_id"), (F.col("id") % 8).cast("int").alias("x"), (F.col("id") % 48 / 8).cast("int").alias("y"))
    return cells.withColumn("v", (F.hash("img_id", "x", "y") % 1000).cast("double"))


def test_ways_in_one_pass_are_those_one_by_one(spark):
    ways = [("lanczos", 12, 5), ("gaussian", 3, 9), ("gaussian", 3, 2)]
    together = raster.resize_kernels(images(spark, 5), ways)
    for method, w, h in ways:
        one = {(r.img_id, r.x, r.y): round(r.v, 6) for r in raster.resize_kernel(images(spark, 5), w, h, method).collect()}
        of_all = together.where((F.col("method") == method) & (F.col("size") == f"{w}x{h}")).collect()
        assert len(one) == 5 * w * h and {(r.img_id, r.x, r.y): round(r.v, 6) for r in of_all} == one


def test_no_task_gets_more_cells_with_more_images(spark, monkeypatch):
    monkeypatch.setattr(raster, "TASK_CELLS", 100)
    for n in (10, 40):
        out = raster.resize_kernels(images(spark, n), [("lanczos", 12, 5), ("gaussian", 3, 9)]).groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in out.collect()) <= 300


def test_registered_query_is_no_union_of_branches(spark):
    plan = QUERIES["r14_resize_kernel"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
