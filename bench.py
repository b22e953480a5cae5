"""Run the headline queries on ``$BENCH_SF_DIR`` and print one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from cartoloom.plans import QUERIES

HEADLINE = [
    "s07_extent", "f04_extent_filter", "g08_reproject", "q07_query_many", "q07_query_many_lines", "q09_hit_features", "q10_nearest_hit",
    "t05_pyramid", "t08_clip_points_lines", "t10_simplify", "t13_fill_rule_cover", "t15_tile_from_features", "t22_pack_tiles", "t25_tile_info",
    "t29_composite_same", "t35_validity_report", "u02_rasterize_polygons", "u03_rasterize_lines", "u05_encode_utf",
    "r13_resize_bilinear", "r15_convolve", "r18_composite_porter_duff", "r22_blend_stack",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g")).config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["s08_feature_count"](spark, sf_dir).collect()  # start the session
    only = os.environ.get("BENCH_ONLY", "").split(",") if os.environ.get("BENCH_ONLY") else HEADLINE
    times = {}
    for name in only:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
