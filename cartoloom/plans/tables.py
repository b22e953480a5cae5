"""Queries on sources, features, projections and viewports (S, F, G, V)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions.skew import shared_path
from ..operators import export, features as ft, grid, project, tiles as tl
from ..sources import readers, writers
from .registry import query

NUM = "regexp_replace(cast(cast(round({0}, 6) as decimal(38,6)) as varchar), '\\.?0+$', '')"
LON, LAT = NUM.format("lon"), NUM.format("lat")
WORLD = (64, 32, (-180.0, -90.0, 180.0, 90.0))


def bbox(df, digits=6):
    return [F.round(n, digits).alias(n) for n in ("minx", "miny", "maxx", "maxy")]


@query("s01_read_points_csv", "select fid, event_type, value, lon as x, lat as y from ev")
def _(v):
    path = shared_path(v.spark, "csv")
    v.ev.write.option("header", True).csv(path)
    schema = "fid bigint, event_type string, value double, lon double, lat double"
    rows = readers.read_points_csv(v.spark, path, "lon", "lat", "fid", schema=schema)
    return rows.select("fid", "event_type", "value", F.col("minx").alias("x"), F.col("miny").alias("y"))


@query("s02_read_geojson", "select fid, event_type, round(lon, 6) as x, round(lat, 6) as y from ev")
def _(v):
    path = shared_path(v.spark, "geojson")
    writers.write_geojson(v.ev_points, path, digits=6)
    rows = readers.read_geojson(v.spark, path)
    return rows.select("fid", F.col("props")["event_type"].alias("event_type"), F.col("minx").alias("x"), F.col("miny").alias("y"))


@query("s03_read_features", "select fid, event_type, 1 as type, lon as x, lat as y from ev")
def _(v):
    rows = readers.read_features(v.ev, "lon", "lat", "fid")
    return rows.select("fid", "event_type", "geom.type", F.col("maxx").alias("x"), F.col("maxy").alias("y"))


@query("s04_sql_source", "select fid, lon, lat, value * 2 as scaled from ev where event_type = 'click' and value >= 100")
def _(v):
    return readers.sql_source(
        v.spark, "SELECT fid, lon, lat, value * :factor AS scaled FROM {ev} WHERE event_type = :kind AND value >= :low",
        {"kind": "click", "low": 100, "factor": 2}, ev=v.ev,
    )


@query("s05_describe", """
select layer, 'vector' as type, 'utf-8' as encoding, 'point' as geometry_type, field, field_type
from (select distinct event_type as layer from ev), (values ('event_type','String'), ('value','Number')) f(field, field_type)
union all
select layer, 'vector', 'utf-8', 'polygon', field, field_type
from (select distinct 'nation' as layer from np), (values ('name','String'), ('region','Number')) f(field, field_type)""")
def _(v):
    return ft.describe(v.ev_points).unionByName(ft.describe(v.np_polys))


@query("s07_extent", "select event_type as layer, min(lon) as minx, min(lat) as miny, max(lon) as maxx, max(lat) as maxy from ev group by 1")
def _(v):
    return ft.extent(v.ev_points, ["layer"])


@query("s08_feature_count", "select event_type as layer, count(*) as features from ev group by 1")
def _(v):
    return ft.feature_count(v.ev_points, ["layer"])


@query("s09_write_geojson", "select fid, name, minx, miny, maxx, maxy, 5 as vertices from np")
def _(v):
    path = shared_path(v.spark, "geojson")
    writers.write_geojson(v.np_polys, path, per_document=10)
    rows = readers.read_geojson(v.spark, path)
    return rows.select("fid", F.col("props")["name"].alias("name"), "minx", "miny", "maxx", "maxy",
                       F.size(F.flatten(F.flatten("geom.parts"))).alias("vertices"))


@query("s10_write_read_tiles", "select z, x, y, layer, fid, event_type, tx, ty from tf")
def _(v):
    path = shared_path(v.spark, "tiles")
    writers.write_tiles(v.tiles2, path)
    rows = readers.read_tiles(v.spark, path)
    at = F.col("tgeom.parts")[0][0][0]
    return rows.select("z", "x", "y", "layer", "fid", F.col("props")["event_type"].alias("event_type"),
                       at["x"].cast("bigint").alias("tx"), at["y"].cast("bigint").alias("ty"))


GRID_CTE = """
with c as (
  select cast(floor((lon + 180) * 64 / 360) as bigint) as x, cast(floor((90 - lat) * 32 / 180) as bigint) as y, max_by(fid, cast(layer_ord as bigint) * 1000000000 + fid) as fid
  from ev group by 1, 2),
d as (
  select xs.x, ys.y, coalesce(cast(c.fid as varchar), '') as key
  from (select unnest(range(0, 64, 4)) as x) xs cross join (select unnest(range(0, 32, 4)) as y) ys left join c on c.x = xs.x and c.y = ys.y),
k as (select key, min(y * 64 + x) as first from d group by key),
o as (select key, row_number() over (order by first) - 1 as key_ord from k),
code as (select key, key_ord, key_ord + case when key_ord < 2 then 32 when key_ord < 59 then 33 else 34 end as code from o),
lines as (select y, string_agg(chr(cast(code as integer)), '' order by x) as line from d join code using (key) group by y)
"""


@query("s11_write_grid_json", GRID_CTE + "select cast(row_number() over (order by y) - 1 as integer) as row, line from lines")
def _(v):
    path = shared_path(v.spark, "grid")
    cells = grid.rasterize_points(v.ev_points, WORLD)
    writers.write_grid_json(cells, 64, 32, path)
    doc = F.from_json("value", "grid array<string>, keys array<string>")
    return v.spark.read.text(path).select(doc.alias("d")).select(F.posexplode("d.grid").alias("row", "line"))


# --- features -------------------------------------------------------------------------------------

@query("f01_attributes", "select fid, 'event_type=' || event_type || ';value=' || cast(value as varchar) as attributes from ev")
def _(v):
    rows = ft.attributes(v.ev_points)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return rows.select("fid", text.alias("attributes"))


@query("f02_select_fields", "select fid, event_type as layer, value from ev")
def _(v):
    return ft.select_fields(v.ev_points, ["value"]).select("fid", "layer", "value")


@query("f03_feature_extent", "select fid, min(lon) as minx, min(lat) as miny, max(lon) as maxx, max(lat) as maxy from ln group by fid")
def _(v):
    return ft.feature_extent(v.ln_lines)


@query("f04_extent_filter", """
select fid, n as vertices from (select fid, count(*) as n, min(lon) x0, max(lon) x1, min(lat) y0, max(lat) y1 from ln group by fid)
where x0 <= 10 and x1 >= -30 and y0 <= 40 and y1 >= 5""")
def _(v):
    return ft.extent_filter(v.ln_lines, (-30, 5, 10, 40)).select("fid", F.size(F.flatten(F.flatten("geom.parts"))).cast("bigint").alias("vertices"))


@query("f05_geometry_type", """
select 'ev' as source, 1 as geometry_type, 'Point' as type_name, count(*) as n from ev
union all select 'ln', 2, 'LineString', count(distinct fid) from ln
union all select 'np', 3, 'Polygon', count(*) from np""")
def _(v):
    parts = [ft.geometry_type(df).withColumn("source", F.lit(n)) for n, df in (("ev", v.ev_points), ("ln", v.ln_lines), ("np", v.np_polys))]
    return reduce(DataFrame.unionByName, parts).groupBy("source", "geometry_type", "type_name").agg(F.count(F.lit(1)).alias("n"))


@query("f06_evaluate", "select fid, value * 3 + 1 as v, (event_type = 'click' and value > 50) as hit from ev")
def _(v):
    rows = ft.evaluate(v.ev_points, "value * :k + 1", {"k": 3.0}, "v")
    return ft.evaluate(rows, "event_type = :kind AND value > :low", {"kind": "click", "low": 50}, "hit").select("fid", "v", "hit")


@query("f07_filter_expr", "select fid, event_type, value from ev where event_type <> 'view' and value between 20 and 60")
def _(v):
    rows = ft.filter_expr(v.ev_points, "event_type <> :kind AND value BETWEEN :lo AND :hi", {"kind": "view", "lo": 20, "hi": 60})
    return rows.select("fid", "event_type", "value")


RULES = [("large", "value > 150"), ("purchases", "event_type = 'purchase'"), ("small", "value < 10")]


@query("f08_classify_first", """
select fid, case when value > 150 then 'large' when event_type = 'purchase' then 'purchases' when value < 10 then 'small' else 'other' end as rule from ev""")
def _(v):
    return ft.classify(v.ev_points, RULES, "first", "other").select("fid", "rule")


@query("f08_classify_all", """
select fid, 'large' as rule from ev where value > 150 union all select fid, 'purchases' from ev where event_type = 'purchase'
union all select fid, 'small' from ev where value < 10
union all select fid, 'other' from ev where not (value > 150 or event_type = 'purchase' or value < 10)""")
def _(v):
    return ft.classify(v.ev_points, RULES, "all", "other").select("fid", "rule")


@query("f09_visible_layers", "select layer, ord from ly where active and 2500e0 >= min_sd - 1e-6 and 2500e0 < max_sd + 1e-6")
def _(v):
    return ft.visible_layers(v.layers, 2500).select("layer", "ord")


@query("f10_active_layers", "select layer, active, queryable from ly where active union all select layer, active, queryable from ly where queryable")
def _(v):
    return ft.active_layers(v.layers).unionByName(ft.queryable_layers(v.layers)).select("layer", "active", "queryable")


@query("f11_layer_at", "select fid, 'name' as how from ev where event_type = 'signup' union all select fid, 'index' from ev where event_type = 'purchase'")
def _(v):
    by_name = ft.layer_at(v.ev_points, "signup").select("fid", F.lit("name").alias("how"))
    return by_name.unionByName(ft.layer_at(v.ev_points, 2).select("fid", F.lit("index").alias("how")))


@query("f12_layers", "select cast(row_number() over (order by min(layer_ord)) - 1 as integer) as position, event_type as layer, count(*) as features from ev group by event_type")
def _(v):
    return ft.layers(v.ev_points)


@query("f13_union_layers", """
select event_type as layer, 0 as layer_ord, fid, event_type, cast(null as varchar) as name from ev where event_type <> 'error'
union all select 'nation', 1, fid, null, name from np""")
def _(v):
    both = ft.union_layers(v.ev_points, v.np_polys)
    return ft.drop_layer(both, "error").select("layer", "layer_ord", "fid", "event_type", "name")


# --- geometry text and projection -----------------------------------------------------------------

@query("g01_to_wkt", f"""
select fid, 'LINESTRING(' || string_agg({LON} || ' ' || {LAT}, ',' order by seq) || ')' as wkt from ln group by fid
union all select fid, 'POINT(' || {LON} || ' ' || {LAT} || ')' from ev
union all select fid, 'POLYGON((' || minx::bigint || ' ' || miny::bigint || ',' || maxx::bigint || ' ' || miny::bigint || ',' || maxx::bigint || ' ' || maxy::bigint
  || ',' || minx::bigint || ' ' || maxy::bigint || ',' || minx::bigint || ' ' || miny::bigint || '))' from np""")
def _(v):
    return reduce(DataFrame.unionByName, [export.to_wkt_table(df, 6) for df in (v.ln_lines, v.ev_points, v.np_polys)])


@query("g03_to_geojson", f"""
select fid, '{{"type":"Feature","id":' || fid || ',"geometry":{{"type":"Point","coordinates":[' || {LON} || ',' || {LAT}
  || ']}},"properties":{{"event_type":"' || event_type || '","value":' || cast(value as varchar) || '}}}}' as geojson from ev""")
def _(v):
    return export.to_geojson_table(v.ev_points, digits=6)


@query("g03_to_geojson_reprojected", f"""
select fid, '{{"type":"Feature","id":' || fid || ',"geometry":{{"type":"Point","coordinates":[' || {NUM.format('round(mx, 2)')} || ',' || {NUM.format('round(my, 2)')}
  || ']}},"properties":{{"event_type":"' || event_type || '","value":' || cast(value as varchar) || '}}}}' as geojson from evm""")
def _(v):
    return export.to_geojson_table(v.ev_points, transform=(4326, 3857), digits=2)


@query("g04_from_geojson", "select fid, event_type, 1 as type, round(lon, 6) as x, round(lat, 6) as y from ev")
def _(v):
    rows = export.from_geojson_table(export.to_geojson_table(v.ev_points, digits=6), "geojson")
    return rows.select("fid", F.col("props")["event_type"].alias("event_type"), "geom.type", F.col("minx").alias("x"), F.col("miny").alias("y"))


@query("g04_collections", f"""
with l as (select fid, string_agg({LON} || ' ' || {LAT}, ',' order by seq) as w, string_agg('[' || {LON} || ',' || {LAT} || ']', ',' order by seq) as j,
  round(min(lon), 6) as minx, round(max(lat), 6) as maxy from ln group by fid),
p as (select fid, {LON} as lon, {LAT} as lat from ln where seq = 0)
select fid, 'GEOMETRYCOLLECTION(LINESTRING(' || w || '),POINT(' || lon || ' ' || lat || '))' as wkt, minx, maxy,
  '{{"type":"Feature","id":' || fid || ',"geometry":{{"type":"GeometryCollection","geometries":[{{"type":"LineString","coordinates":[' || j
  || ']}},{{"type":"Point","coordinates":[' || lon || ',' || lat || ']}}]}},"properties":{{}}}}' as geojson from l join p using (fid)""")
def _(v):
    """Lines and their first points in a collection within a collection, read, and written again."""
    start = g.geometry(g.POINT, F.array(F.array(F.slice(g.vertices("geom"), 1, 1))))
    within = lambda *texts: F.concat(F.lit('{"type":"GeometryCollection","geometries":['), F.concat_ws(",", *texts), F.lit("]}"))
    nested = within(export.geojson("geom", digits=6), within(export.geojson(start, digits=6)))
    texts = v.ln_lines.select(F.concat(F.lit('{"type":"Feature","id":'), F.col("fid").cast("string"), F.lit(',"geometry":'), nested, F.lit(',"properties":{}}')).alias("t"))
    rows = export.from_geojson_table(texts, "t").drop("props")
    return rows.select("fid", export.wkt("geom", "members", 6).alias("wkt"), "minx", "maxy",
                       export.feature_json("fid", "geom", F.lit("{}"), 6, "members").alias("geojson"))


@query("g05_forward", "select fid, round(mx, 2) as x, round(my, 2) as y from evm")
def _(v):
    return project.forward(v.ev).select("fid", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query("g06_inverse", """
select fid, round(mx / 20037508.342789244e0 * 180, 6) as lon,
  round((atan(exp(my / 6378137e0)) * 2 - pi() / 2) * (180 / pi()), 6) as lat from evm""")
def _(v):
    merc = project.forward(v.ev).select("fid", "x", "y")
    return project.inverse(merc).select("fid", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("g07_forward_box", "select fid, round(minx, 2) as minx, round(miny, 2) as miny, round(maxx, 2) as maxx, round(maxy, 2) as maxy from npm")
def _(v):
    return project.forward_box(v.np_boxes).select("fid", *bbox(None, 2))


@query("g07_inverse_box", "select fid, round(minx, 6) as minx, round(miny, 6) as miny, round(maxx, 6) as maxx, round(maxy, 6) as maxy from np")
def _(v):
    return project.inverse_box(project.forward_box(v.np_boxes)).select("fid", *bbox(None, 6))


@query("g08_reproject", "select fid, seq, round(mx, 2) as x, round(my, 2) as y from lnm")
def _(v):
    vertices = tl.vertex_table(v.ln_merc, "geom")
    return vertices.select("fid", F.col("seq").cast("bigint").alias("seq"), F.round("vx", 2).alias("x"), F.round("vy", 2).alias("y"))


# --- viewports ------------------------------------------------------------------------------------

@query("v01_zoom_all", """
select round(min(x0), 2) as minx, round(min(y0), 2) as miny, round(max(x1), 2) as maxx, round(max(y1), 2) as maxy from (
  select min(mx) x0, min(my) y0, max(mx) x1, max(my) y1 from evm union all select min(minx), min(miny), max(maxx), max(maxy) from npm)""")
def _(v):
    return project.zoom_all([(v.ev_points, "epsg:4326"), (v.np_merc, "epsg:3857")]).select(*bbox(None, 2))


@query("v02_zoom_to_box", """
with s as (select *, width * 1e0 / height as c, (maxx - minx) / (maxy - miny) as b, maxx - minx as bw, maxy - miny as bh from vw,
  (values ('GROW_BBOX'),('SHRINK_BBOX'),('ADJUST_BBOX_WIDTH'),('ADJUST_BBOX_HEIGHT'),('GROW_CANVAS'),('SHRINK_CANVAS'),('ADJUST_CANVAS_WIDTH'),('ADJUST_CANVAS_HEIGHT'),('RESPECT')) m(mode)),
t as (select *,
  case when mode = 'ADJUST_BBOX_WIDTH' or (mode = 'GROW_BBOX' and b <= c) or (mode = 'SHRINK_BBOX' and b > c) then bh * c else bw end as nw,
  case when mode = 'ADJUST_BBOX_HEIGHT' or (mode = 'GROW_BBOX' and b > c) or (mode = 'SHRINK_BBOX' and b <= c) then bw / c else bh end as nh,
  case when mode = 'ADJUST_CANVAS_WIDTH' or (mode = 'GROW_CANVAS' and b > c) or (mode = 'SHRINK_CANVAS' and b <= c) then cast(floor(height * b + 0.5e0) as integer) else width end as cw,
  case when mode = 'ADJUST_CANVAS_HEIGHT' or (mode = 'GROW_CANVAS' and b <= c) or (mode = 'SHRINK_CANVAS' and b > c) then cast(floor(width / b + 0.5e0) as integer) else height end as ch from s)
select view_id, mode, cast(cw as integer) as width, cast(ch as integer) as height, round((minx + maxx) / 2 - nw / 2, 6) as minx, round((miny + maxy) / 2 - nh / 2, 6) as miny,
  round((minx + maxx) / 2 + nw / 2, 6) as maxx, round((miny + maxy) / 2 + nh / 2, 6) as maxy from t""")
def _(v):
    fitted = [project.zoom_to_box(v.viewports, m).withColumn("mode", F.lit(m)) for m in project.ASPECT_MODES]
    return reduce(DataFrame.unionByName, fitted).select("view_id", "mode", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), *bbox(None, 6))


@query("v03_scale", "select view_id, round((maxx - minx) / width, 9) as scale from vw")
def _(v):
    return project.scale(v.viewports).select("view_id", F.round("scale", 9).alias("scale"))


@query("v04_scale_denominator", """
select view_id, round((maxx - minx) / width / 0.00028e0, 4) as projected, round((maxx - minx) / width / 0.00028e0 * 111319.49079327358e0, 2) as geographic from vw""")
def _(v):
    flat = project.scale_denominator(v.viewports).withColumnRenamed("scale_denominator", "projected")
    both = project.scale_denominator(flat, geographic=True)
    return both.select("view_id", F.round("projected", 4).alias("projected"), F.round("scale_denominator", 2).alias("geographic"))


@query("v05_buffered_extent", """
select view_id, round(minx - 16 * s, 6) as minx, round(miny - 16 * s, 6) as miny, round(maxx + 16 * s, 6) as maxx, round(maxy + 16 * s, 6) as maxy
from (select *, (maxx - minx) / width as s from vw)""")
def _(v):
    return project.buffered_extent(v.viewports, 16).select("view_id", *bbox(None, 6))


@query("v06_clip_to_max_extent", """
select fid, round((least(maxx, 40) - greatest(minx, -60)) * (least(maxy, 50) - greatest(miny, -30)), 6) as area from np
where minx < 40 and maxx > -60 and miny < 50 and maxy > -30""")
def _(v):
    from ..functions.geom import polygon_area

    cut = tl.clip_to_max_extent(v.np_polys, (-60, -30, 40, 50))
    return cut.select("fid", F.round(polygon_area(F.col("geom.parts")[0]), 6).alias("area")).where(F.col("area") > 0)


@query("v07_screen", """
select fid, round((lon + 180) * (1024e0 / 360), 6) as px, round((90 - lat) * (512e0 / 180), 6) as py, round(lon, 6) as x, round(lat, 6) as y from ev""")
def _(v):
    view = (1024, 512, (-180, -90, 180, 90))
    there = project.to_screen(v.ev, view, "lon", "lat")
    return project.from_screen(there, view).select("fid", *[F.round(c, 6).alias(c) for c in ("px", "py", "x", "y")])


