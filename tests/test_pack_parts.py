"""Packed parts against plain Python, wherever a part lies in its batches, and what tasks hold of them."""

import pytest

from cartoloom.functions import geom as g
from cartoloom.operators import pack
from cartoloom.plans import QUERIES


def table(spark, n):
    layers = ("b", "a", None)
    rows = [(1, i % 2, 0, layers[i % 3], i % 3, i // 2 if i % 5 else None, 1, {f"k{j}": f"{(i * j) % 4}" for j in range(i % 4)} if i % 7 else None,
             (g.POINT, [[[{"x": float(i), "y": -1.0}]]])) for i in range(n)]
    return spark.createDataFrame(rows, f"z int, x int, y int, layer string, layer_ord int, fid bigint, gtype int, props map<string,string>, tgeom {g.GEOM_TYPE}")


@pytest.mark.parametrize("batch", [2, 10_000])
def test_parts_hold_their_features_and_words(spark, batch):
    df, per_row = table(spark, 100).cache(), 7
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = pack.pack_tiles(df, per_row, {"k1": "bigint"}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    given = {}
    for r in df.withColumn("c", pack.commands("tgeom")).collect():
        given.setdefault((r["x"], r["layer"]), []).append((r["fid"], sorted((r["props"] or {}).items()), r["c"]))
    found = {}
    for r in sorted(got, key=lambda r: r["part"]):
        words = {k for f in r["features"] for k in f["tags"][::2]}, {v for f in r["features"] for v in f["tags"][1::2]}
        assert words == (set(range(len(r["keys"]))), set(range(len(r["values"])))) and r["keys"] == sorted(set(r["keys"]))
        values = [(v["kind"], v["text"]) for v in r["values"]]
        assert values == sorted(set(values)) and len(r["features"]) <= per_row
        for f in r["features"]:
            pairs = [(r["keys"][k], r["values"][v]) for k, v in zip(f["tags"][::2], f["tags"][1::2])]
            assert all(v["kind"] == ("bigint" if k == "k1" else "string") for k, v in pairs)
            found.setdefault((r["x"], r["layer"]), []).append((f["id"], [(k, v["text"]) for k, v in pairs], f["geometry"]))
        assert len(found[r["x"], r["layer"]]) == min((r["part"] + 1) * per_row, len(given[r["x"], r["layer"]]))
    for at, rows in given.items():
        assert sorted(found[at], key=repr) == sorted(rows, key=repr)
        assert [f[0] for f in found[at]] == sorted((f[0] for f in rows), key=lambda i: -1 if i is None else i)
    assert pack.pack_tiles(df.limit(0)).isEmpty()


@pytest.mark.parametrize("name", ["t22_pack_tiles", "t23_unpack_tiles"])
def test_a_task_holds_one_part(spark, name):
    """Features were collected by a hash table of up to 128 parts, which no limit on memory sees."""
    assert "collect_list" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
