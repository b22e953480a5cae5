"""Geometry collections read from GeoJSON and written again."""

import json

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import export, features
from cartoloom.sources import readers

LINE = {"type": "LineString", "coordinates": [[10, 15], [20, 30]]}
POINT = {"type": "Point", "coordinates": [10, 15]}
AREA = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]]]}


def collection(*inner):
    return {"type": "GeometryCollection", "geometries": list(inner)}


def feature(geometry, fid=1):
    return {"type": "Feature", "id": fid, "geometry": geometry, "properties": {"a": "b"}}


def read(spark, *geometries):
    texts = spark.createDataFrame([(json.dumps(feature(q, i)),) for i, q in enumerate(geometries)], "t string")
    return export.from_geojson_table(texts, "t")


def test_collections_there_and_back(spark):
    deep = POINT
    for _ in range(export.MAX_NESTING):
        deep = collection(deep)
    rows = read(spark, collection(LINE, POINT), collection(collection(AREA), collection(POINT, collection(LINE))), collection(), LINE, deep)
    got = {r["fid"]: r for r in rows.collect()}
    assert [got[i]["geom"]["type"] for i in range(5)] == [g.COLLECTION, g.COLLECTION, g.COLLECTION, g.LINE, g.COLLECTION]
    assert [[s["type"] for s in got[i]["members"]] for i in (0, 1, 2, 4)] == [[g.LINE, g.POINT], [g.POLYGON, g.POINT, g.LINE], [], [g.POINT]]
    assert got[3]["members"] is None and got[2]["minx"] is None
    assert [got[1][c] for c in g.BOX] == [0, 0, 20, 30]
    wkt = {r["fid"]: r["wkt"] for r in export.to_wkt_table(rows).collect()}
    assert wkt[1] == "GEOMETRYCOLLECTION(POLYGON((0 0,4 0,4 4,0 0)),POINT(10 15),LINESTRING(10 15,20 30))"
    written = {r["fid"]: json.loads(r["geojson"])["geometry"] for r in export.to_geojson_table(rows.drop("props")).collect()}
    assert written == {0: collection(LINE, POINT), 1: collection(AREA, POINT, LINE), 2: collection(), 3: LINE, 4: collection(POINT)}
    again = {r["fid"]: r["wkt"] for r in export.to_wkt_table(read(spark, *(written[i] for i in range(5)))).collect()}
    assert again == wkt


def test_members_are_reprojected(spark):
    out = export.to_geojson_table(read(spark, collection(POINT)).drop("props"), transform=(4326, 3857), digits=2).first()["geojson"]
    at = json.loads(out)["geometry"]["geometries"][0]["coordinates"]
    assert at == pytest.approx([1113194.91, 1689200.14])


def test_bad_members_are_errors(spark):
    too_deep = POINT
    for _ in range(export.MAX_NESTING + 2):
        too_deep = collection(too_deep)
    for bad in (collection(POINT, {"type": "Circle"}), {"type": "GeometryCollection"}, collection(collection({"type": "GeometryCollection"})), too_deep, collection(None)):
        with pytest.raises(Exception, match="Failed to read GeoJSON feature"):
            read(spark, bad).collect()


def test_collections_in_files(spark, tmp_path):
    docs = [{"type": "FeatureCollection", "features": [feature(collection(LINE, POINT), 1), feature(AREA, 2)]}, feature(collection(collection(POINT)), 3)]
    (tmp_path / "in.json").write_text("\n".join(json.dumps(d) for d in docs))
    rows = readers.read_geojson(spark, str(tmp_path))
    assert {r["fid"]: None if r["members"] is None else len(r["members"]) for r in rows.collect()} == {1: 2, 2: None, 3: 1}
    assert "members" not in features.attribute_names(rows)
    assert rows.where(F.col("geom.type") == g.COLLECTION).count() == 2


def test_texts_are_read_again_only_where_they_name_a_collection(spark):
    """Levels of nesting cost nothing where there are none; a name in escapes is still one."""
    point = '{"type":"Point","coordinates":[1,2]}'
    escaped = '{"type":"Geometry\\u0043ollection","geometries":[' + point + ']}'
    deep = point
    for _ in range(7):
        deep = '{"type":"GeometryCollection","geometries":[' + deep + "," + point + "]}"
    rows = spark.createDataFrame([([point, escaped, deep],), ([],), (["1", None],)], "t array<string>")
    got = [r[0] for r in rows.select(export.parse_members(F.col("t"))).collect()]
    assert [m["parts"][0][0][0]["x"] for m in got[0]] == [1.0] * 10 and got[1] == [] and got[2] == [None, None]
    plan = rows.select(export.parse_members(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("contains(") >= export.MAX_NESTING
