"""Queries on tiles (T)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import skew
from ..operators import burn, compose, outline, pack, reports, tiles as tl
from .registry import query
from .views import LAYERS

U = "(mx + 20037508.342789244e0) / (2*20037508.342789244e0)"
V = "(20037508.342789244e0 - my) / (2*20037508.342789244e0)"
WIDTH = "(2*20037508.342789244e0 / pow(2, z))"
TILE6 = f"select fid, 6 as z, cast(floor({U} * 64) as integer) as x, cast(floor({V} * 64) as integer) as y from evm"


def first_vertex(name="tgeom"):
    v = F.col(f"{name}.parts")[0][0][0]
    return v["x"].cast("bigint").alias("tx"), v["y"].cast("bigint").alias("ty")


def box_columns(digits=2):
    return [F.round(c, digits).alias(c) for c in g.BOX]


@query("t01_tile_of", TILE6)
def _(v):
    return tl.valid_tiles(tl.tile_of(v.ev, 6)).select("fid", "z", "x", "y")


def tile_boxes(pad):
    return f"""
select z, x, y, round(-20037508.342789244e0 + x * w - w * {pad}, 2) as minx, round(20037508.342789244e0 - y * w - w - w * {pad}, 2) as miny,
  round(-20037508.342789244e0 + x * w + w + w * {pad}, 2) as maxx, round(20037508.342789244e0 - y * w + w * {pad}, 2) as maxy
from (select distinct z, x, y, 2*20037508.342789244e0 / pow(2, z) as w from ({TILE6}))"""


@query("t02_tile_extent", tile_boxes("0"))
def _(v):
    return tl.tile_extent(tl.tile_of(v.ev, 6).select("z", "x", "y").distinct()).select("z", "x", "y", *box_columns())


@query("t03_tile_buffered_extent", tile_boxes("0.03125e0"))
def _(v):
    return tl.tile_buffered_extent(tl.tile_of(v.ev, 6).select("z", "x", "y").distinct()).select("z", "x", "y", *box_columns())


@query("t04_assign_tiles", """
select 'nation' as source, fid, x, y from tb union all select 'ev', fid, x, y from tf""")
def _(v):
    out = [tl.assign_tiles(df, 2).select(F.lit(n).alias("source"), "fid", "x", "y") for n, df in (("nation", v.np_merc), ("ev", v.ev_merc))]
    return reduce(DataFrame.unionByName, out)


@query("t05_pyramid", f"""
with zs as (select unnest(range(0, 6)) as z),
p as (select z, cast(pow(2, z) as bigint) as n, {U} * pow(2, z) as u, {V} * pow(2, z) as v from evm, zs)
select cast(z as integer) as z, cast(x as integer) as x, cast(y as integer) as y, count(*) as n from (
  select z, v, n, unnest(range(greatest(cast(floor(u - 0.03125e0) as bigint), 0), least(cast(floor(u + 0.03125e0) as bigint), n - 1) + 1)) as x from p) a,
  lateral (select unnest(range(greatest(cast(floor(v - 0.03125e0) as bigint), 0), least(cast(floor(v + 0.03125e0) as bigint), n - 1) + 1)) as y) b
group by 1, 2, 3""")
def _(v):
    return tl.pyramid(v.ev_merc, 0, 5).groupBy("z", "x", "y").agg(F.count(F.lit(1)).alias("n"))


@query("t06_quantize", """
select 'ev' as source, x, y, fid, tx, ty from tf union all select 'nation', x, y, fid, cast(qx0 as bigint), cast(qy1 as bigint) from tb""")
def _(v):
    out = [tl.quantize(tl.assign_tiles(df, 2)).select(F.lit(n).alias("source"), "x", "y", "fid", *first_vertex()) for n, df in (("nation", v.np_merc), ("ev", v.ev_merc))]
    return reduce(DataFrame.unionByName, out)


@query("t07_dequantize", """
select z, x, y, fid, round((-20037508.342789244e0 + (x + tx / 4096e0) * w) / 20037508.342789244e0 * 180, 6) as lon,
  round((atan(exp((20037508.342789244e0 - (y + ty / 4096e0) * w) / 6378137e0)) * 2 - pi() / 2) * (180 / pi()), 6) as lat
from (select *, 2*20037508.342789244e0 / 4 as w from tf)""")
def _(v):
    at = F.col("geom.parts")[0][0][0]
    return tl.dequantize(v.tiles2).select("z", "x", "y", "fid", F.round(at["x"], 6).alias("lon"), F.round(at["y"], 6).alias("lat"))


CLIP = """
with q as (select x, y, fid, seq, floor((u - x) * 4096 + 0.5e0) as qx, floor((v - y) * 4096 + 0.5e0) as qy from (
    select fid, seq, (mx + 20037508.342789244e0) / (2*20037508.342789244e0) * 2 as u, (20037508.342789244e0 - my) / (2*20037508.342789244e0) * 2 as v from lnm),
    (select unnest(range(2)) as x), (select unnest(range(2)) as y)),
s as (select x, y, fid, qx as ax, qy as ay, lead(qx) over w - qx as dx, lead(qy) over w - qy as dy from q window w as (partition by x, y, fid order by seq)),
t as (select *, greatest(0, case when dx > 0 then (-128 - ax) / dx when dx < 0 then (4224 - ax) / dx else 0 end, case when dy > 0 then (-128 - ay) / dy when dy < 0 then (4224 - ay) / dy else 0 end) as lo,
  least(1, case when dx > 0 then (4224 - ax) / dx when dx < 0 then (-128 - ax) / dx else 1 end, case when dy > 0 then (4224 - ay) / dy when dy < 0 then (-128 - ay) / dy else 1 end) as hi
  from s where dx is not null and (dx <> 0 or ax between -128 and 4224) and (dy <> 0 or ay between -128 and 4224))
"""


@query("t08_clip_points_lines", CLIP + """
select cast(x as integer) as x, cast(y as integer) as y, fid, round(sum((hi - lo) * sqrt(dx*dx + dy*dy)), 3) as length
from t where lo < hi group by 1, 2, 3 having sum((hi - lo) * sqrt(dx*dx + dy*dy)) > 0""")
def _(v):
    cut = tl.clip_points_lines(tl.quantize(tl.assign_tiles(v.ln_merc, 1)), (-128, -128, 4224, 4224))
    segs = F.flatten(F.transform(F.flatten("tgeom.parts"), g.segments))
    length = F.aggregate(segs, F.lit(0.0), lambda t, s: t + g.distance(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]))
    return cut.select("x", "y", "fid", F.round(length, 3).alias("length")).where(F.col("length") > 0)


@query("t09_clip_polygons", "select x, y, fid, (cx1 - cx0) * (cy1 - cy0) as area from tb where cx1 > cx0 and cy1 > cy0")
def _(v):
    cut = tl.clip_polygons(tl.quantize(tl.assign_tiles(v.np_merc, 2)), (-128, -128, 4224, 4224))
    return cut.select("x", "y", "fid", g.polygon_area(F.col("tgeom.parts")[0]).alias("area")).where(F.col("area") > 0)


KEPT = """
with recursive q as (select fid, seq, n, floor((mx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4096 + 0.5e0) as px,
    floor((20037508.342789244e0 - my) / (2*20037508.342789244e0) * 4096 + 0.5e0) as py from lnm),
c(fid, lo, hi) as (
  select fid, cast(0 as bigint), cast(n - 1 as bigint) from q where seq = 0 and n > 1
  union all
  select fid, unnest([lo, mid]), unnest([mid, hi]) from (
    select c.fid, c.lo, c.hi, (
      select case when max(d) > 400 then arg_max(seq, d * 1000 - seq * 1e-6) end from (
        select m.seq, sqrt(pow(m.px - (a.px + t.t * (b.px - a.px)), 2) + pow(m.py - (a.py + t.t * (b.py - a.py)), 2)) as d
        from q m, q a, q b, lateral (select case when a.px = b.px and a.py = b.py then 0e0 else
          least(greatest(((m.px - a.px) * (b.px - a.px) + (m.py - a.py) * (b.py - a.py)) / ((b.px - a.px) * (b.px - a.px) + (b.py - a.py) * (b.py - a.py)), 0e0), 1e0) end as t) t
        where m.fid = c.fid and a.fid = c.fid and b.fid = c.fid and a.seq = c.lo and b.seq = c.hi and m.seq > c.lo and m.seq < c.hi)) as mid
    from c) where mid is not null),
kept as (select fid, lo as seq from c union select fid, hi from c union select fid, seq from q where n = 1)
"""


@query("t10_simplify", KEPT + "select fid, seq from kept")
def _(v):
    rows = tl.quantize(tl.assign_tiles(v.ln_merc, 0, buffer=0))
    return tl.simplify_vertices(tl.vertex_table(rows), 400.0).select("fid", F.col("seq").cast("bigint").alias("seq"))


@query("t10_simplify_features", KEPT + """
select fid, count(*) as vertices, string_agg(cast(px as bigint) || ' ' || cast(py as bigint), ',' order by seq) as path from kept join q using (fid, seq) group by fid""")
def _(v):
    """Whole features, with the vertices that stay in their order."""
    out = tl.simplify(tl.quantize(tl.assign_tiles(v.ln_merc, 0, buffer=0)), 400.0)
    at = lambda p: F.concat(p["x"].cast("bigint").cast("string"), F.lit(" "), p["y"].cast("bigint").cast("string"))
    return out.select("fid", F.size(g.vertices("tgeom")).alias("vertices"), F.array_join(F.transform(g.vertices("tgeom"), at), ",").alias("path"))


RING_AREA = """(select fid, n, abs(sum(ax * ey - ex * ay)) / 2 as area from (
  select fid, n, floor((ax + 180) * 4096 / 360 + 0.5e0) as ax, floor((90 - ay) * 4096 / 180 + 0.5e0) as ay,
    floor((ex + 180) * 4096 / 360 + 0.5e0) as ex, floor((90 - ey) * 4096 / 180 + 0.5e0) as ey from rg) group by fid, n)"""


def flat_rings(v):
    """Order rings on a plain 4096 grid over the world."""
    flat = g.map_vertices("geom", lambda x, y: (F.floor((x + 180) * 4096 / 360 + 0.5), F.floor((90 - y) * 4096 / 180 + 0.5)))
    return v.pg_polys.withColumn("tgeom", flat)


@query("t11_drop_small_polygons", f"select fid from {RING_AREA} where area >= 250000")
def _(v):
    return tl.drop_small_polygons(flat_rings(v), 250000.9, truncate=True).select("fid")


@query("t12_drop_degenerate", f"""
select 'off' as mode, fid, cast(2 as bigint) as rings from {RING_AREA} where area > 0 and n >= 3
union all select 'on', fid, cast(case when area > 0 and n >= 3 then 2 else 1 end as bigint) from {RING_AREA}""")
def _(v):
    # every ring gets one good hole
    square = g.box_ring(*[F.lit(float(c)) for c in (10, 10, 20, 20)])
    rows = flat_rings(v).withColumn("tgeom", g.geometry(g.POLYGON, F.array(F.array(F.col("tgeom.parts")[0][0], square))))
    out = [tl.drop_degenerate(rows, m == "on").select(F.lit(m).alias("mode"), "fid", F.size(F.flatten("tgeom.parts")).cast("bigint").alias("rings")) for m in ("off", "on")]
    return reduce(DataFrame.unionByName, out)


COVER_VIEW = (24, 12, (-180.0, -90.0, 180.0, 90.0))
COVER = """
with o as (select fid, case when sum(ax * ey - ex * ay) > 0 then 1 when sum(ax * ey - ex * ay) < 0 then -1 else 0 end as turn from rg group by fid),
e as (select rg.fid, turn, (ax + 180) * 24 / 360 as ax, (90 - ay) * 12 / 180 as ay, (ex + 180) * 24 / 360 as ex, (90 - ey) * 12 / 180 as ey from rg join o on o.fid = rg.fid),
x as (select fid, y, (ex-ax)*(y + 0.5e0 - ay)/(ey-ay) + ax as cx, case when ey > ay then turn else -turn end as d
  from e, (select unnest(range(12)) as y) where (ay > y + 0.5e0) <> (ey > y + 0.5e0)),
w as (select fid, xs.x, y, sum(d) as w from x, (select unnest(range(24)) as x) xs where cx <= xs.x + 0.5e0 group by 1, 2, 3)
"""


@query("t13_fill_rule_cover", COVER + """
select rule, fid, count(*) as cells, cast(sum(y * 24 + x) as bigint) as checksum from w, (values ('evenOdd'), ('nonZero'), ('positive'), ('negative')) r(rule)
where case rule when 'evenOdd' then w % 2 <> 0 when 'nonZero' then w <> 0 when 'positive' then w > 0 else w < 0 end group by 1, 2""")
def _(v):
    rows = burn.to_cells(v.pg_polys, COVER_VIEW)
    return burn.fill_rule_cover(rows, 24, 12, burn.FILL_RULES).groupBy("rule", "fid").agg(F.count(F.lit(1)).alias("cells"), F.sum(F.col("y") * 24 + F.col("x")).alias("checksum"))


@query("t15_fill_rule_rings", COVER + """
select rule, fid, count(*) as cells, cast(sum(y * 24 + x) as bigint) as checksum, cast(count(*) as double) as area from w, (values ('evenOdd'), ('nonZero'), ('positive'), ('negative')) r(rule)
where case rule when 'evenOdd' then w % 2 <> 0 when 'nonZero' then w <> 0 when 'positive' then w > 0 else w < 0 end group by 1, 2""")
def _(v):
    """Rings drawn around the cover of each rule, filled again: the cells and the area of the cover."""
    cover = burn.fill_rule_cover(burn.to_cells(v.pg_polys, COVER_VIEW), 24, 12, burn.FILL_RULES)
    rings = skew.stored(outline.cover_rings(cover, ["rule", "fid"]), "rings")
    area = rings.select("rule", "fid", (F.aggregate(F.flatten("_cells.parts"), F.lit(0.0), lambda t, r: t + g.ring_area(r))).alias("area"))
    filled = burn.polygon_cells(rings, 24, 12, ["rule", "fid"], "positive", True).groupBy("rule", "fid").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.col("y") * 24 + F.col("x")).alias("checksum"))
    return filled.join(area.hint("merge"), ["rule", "fid"])


def grown_regions(v):
    """Per region, a multipolygon of its boxes grown by 24.5 degrees, so that they overlap."""
    ring = g.box_ring(F.col("minx") - 24.5, F.col("miny") - 24.5, F.col("maxx") + 24.5, F.col("maxy") + 24.5)
    # five boxes per region
    parts = v.np_boxes.groupBy(F.col("region").cast("bigint").alias("fid")).agg(F.array_sort(F.collect_list(F.struct("fid", F.array(ring).alias("r")))).alias("p"))
    rows = parts.select("fid", g.geometry(g.MULTIPOLYGON, F.transform("p", lambda s: s["r"])).alias("geom"))
    return burn.to_cells(rows, (90, 45, (-180.0, -90.0, 180.0, 90.0)))


@query("t14_union_cover", """
with c as (select x, y, -180 + (x + 0.5e0) * 4 as lon, 90 - (y + 0.5e0) * 4 as lat from (select unnest(range(90)) as x), (select unnest(range(45)) as y)),
h as (select region as fid, x, y, count(*) as n from np, c where lon > minx - 24.5e0 and lon < maxx + 24.5e0 and lat > miny - 24.5e0 and lat < maxy + 24.5e0 group by 1, 2, 3)
select 'off' as mode, fid, cast(sum(n) as bigint) as cells from h group by 2 union all select 'positive', fid, count(*) from h group by 2
union all select 'evenOdd', fid, count(*) from h where n % 2 = 1 group by 2""".replace("region as fid", "cast(region as bigint) as fid"))
def _(v):
    rows = grown_regions(v)
    out = [
        burn.union_cover(rows, 90, 45, rule, union).groupBy("fid").agg(F.count(F.lit(1)).alias("cells")).withColumn("mode", F.lit(mode))
        for mode, rule, union in (("off", "positive", False), ("positive", "positive", True), ("evenOdd", "evenOdd", True))
    ]
    return reduce(DataFrame.unionByName, out).select("mode", "fid", "cells")


@query("t15_union_rings", """
with c as (select x, y, -180 + (x + 0.5e0) * 4 as lon, 90 - (y + 0.5e0) * 4 as lat from (select unnest(range(90)) as x), (select unnest(range(45)) as y)),
h as (select cast(region as bigint) as fid, x, y, np.fid as box, count(*) over (partition by region, x, y) as n from np, c where lon > minx - 24.5e0 and lon < maxx + 24.5e0 and lat > miny - 24.5e0 and lat < maxy + 24.5e0)
select 'off' as mode, fid, count(*) as cells, cast(sum(y * 90 + x) as bigint) as checksum from h group by 2
union all select 'positive', fid, count(*), cast(sum(y * 90 + x) as bigint) from (select distinct fid, x, y from h) group by 2
union all select 'evenOdd', fid, count(*), cast(sum(y * 90 + x) as bigint) from (select distinct fid, x, y from h where n % 2 = 1) group by 2""")
def _(v):
    """Rings around overlapping boxes, apart and united, filled again."""
    rows, out = grown_regions(v), []
    for mode, rule, union in (("off", "positive", False), ("positive", "positive", True), ("evenOdd", "evenOdd", True)):
        cover = burn.union_cover(rows, 90, 45, rule, union)
        cover = cover.withColumn("piece", F.lit(0)) if union else cover.withColumnRenamed("part", "piece")
        filled = burn.polygon_cells(outline.cover_rings(cover, ["fid", "piece"]), 90, 45, ["fid", "piece"], "positive", True)
        out.append(filled.groupBy("fid").agg(F.count(F.lit(1)).alias("cells"), F.sum(F.col("y") * 90 + F.col("x")).alias("checksum")).withColumn("mode", F.lit(mode)))
    return reduce(DataFrame.unionByName, out)


@query("t15_tile_from_features", """
select z, x, y, layer, layer_ord, fid, 1 as gtype, tx, ty, 2 as n_props from tf
union all select z, x, y, 'nation', 0, fid, 3, cast(cx0 as bigint), cast(cy0 as bigint), 2 from tb where (cx1 - cx0) * (cy1 - cy0) >= 0.1""")
def _(v):
    both = v.tiles2.unionByName(v.nation_tiles2)
    low = lambda c: F.array_min(F.transform(g.vertices("tgeom"), lambda p: p[c])).cast("bigint").alias("t" + c)
    return both.select("z", "x", "y", "layer", "layer_ord", "fid", "gtype", low("x"), low("y"), F.size("props").alias("n_props"))


@query("t16_scale_geometry", "select x, y, fid, tx * 2e0 + 7 as px, ty * 2e0 - 3 as py from tf")
def _(v):
    at = F.col("tgeom.parts")[0][0][0]
    return tl.scale_geometry(v.tiles2, 2.0, 7.0, -3.0).select("x", "y", "fid", at["x"].alias("px"), at["y"].alias("py"))


@query("t17_names", "select z, x, y, string_agg(layer, ',' order by layer_ord) as names from (select distinct z, x, y, layer, layer_ord from tf) group by 1, 2, 3")
def _(v):
    return compose.names(v.tiles2).select("z", "x", "y", F.array_join("names", ",").alias("names"))


@query("t18_extract_layer", "select x, y, fid, tx, ty from tf where layer = 'click'")
def _(v):
    return compose.extract_layer(v.tiles2, "click").select("x", "y", "fid", *first_vertex())


def requested(v):
    asked = F.explode(F.array(*[F.lit(n) for n in (*LAYERS, "missing")]))
    return v.tiles2.select("z", "x", "y").distinct().select("z", "x", "y", asked.alias("layer"))


REQUESTED = """(select z, x, y, layer, count(fid) as n from (select z, x, y, layer from (select distinct z, x, y from tf), (values ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('missing')) l(layer)) r
  left join (select z, x, y, layer, fid from tf) t using (z, x, y, layer) group by 1, 2, 3, 4)"""


@query("t19_painted_empty_layers", f"select z, x, y, layer, case when n > 0 then 'painted' else 'empty' end as state from {REQUESTED}")
def _(v):
    paint = compose.painted_layers(v.tiles2, requested(v)).withColumn("state", F.lit("painted"))
    return paint.unionByName(compose.empty_layers(v.tiles2, requested(v)).withColumn("state", F.lit("empty")))


@query("t19_tile_flags", f"select z, x, y, max(n) > 0 as painted, max(n) = 0 as empty from {REQUESTED} where layer in ('error', 'missing') group by 1, 2, 3")
def _(v):
    some = requested(v).where(F.col("layer").isin("error", "missing"))
    return compose.tile_flags(v.tiles2, some)


@query("t20_clear", "select x, y, fid from tf where not (x + y) % 2 = 0")
def _(v):
    ids = v.tiles2.where((F.col("x") + F.col("y")) % 2 == 0)
    return compose.clear(v.tiles2, ids).select("x", "y", "fid")


ZZ = "(case when {0} >= 0 then 2 * {0} else -2 * {0} - 1 end)"
DX, DY = ZZ.format("cast(cx1 - cx0 as bigint)"), ZZ.format("cast(cy1 - cy0 as bigint)")


@query("t21_geometry_commands", f"""
select x, y, fid, 1 as gtype, '9,' || {ZZ.format('tx')} || ',' || {ZZ.format('ty')} as commands from tf""")
def _(v):
    rows = pack.geometry_commands(v.tiles2)
    return rows.select("x", "y", "fid", "gtype", F.array_join(F.transform("commands", lambda c: c.cast("string")), ",").alias("commands"))


@query("t21_polygon_commands", f"""
select fid, '9,' || {ZZ.format('x0')} || ',' || {ZZ.format('y1')} || ',26,' || {ZZ.format('(x1 - x0)')} || ',0,0,' || {ZZ.format('(y0 - y1)')} || ',' || {ZZ.format('(x0 - x1)')} || ',0,15' as commands
from (select fid, cast(floor((minx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4096 + 0.5e0) as bigint) as x0, cast(floor((maxx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4096 + 0.5e0) as bigint) as x1,
  cast(floor((20037508.342789244e0 - maxy) / (2*20037508.342789244e0) * 4096 + 0.5e0) as bigint) as y0, cast(floor((20037508.342789244e0 - miny) / (2*20037508.342789244e0) * 4096 + 0.5e0) as bigint) as y1 from npm)""")
def _(v):
    rows = pack.geometry_commands(tl.quantize(tl.assign_tiles(v.np_merc, 0)))
    return rows.select("fid", F.array_join(F.transform("commands", lambda c: c.cast("string")), ",").alias("commands"))


@query("t22_pack_tiles", """
with vals as (select x, y, layer, part, fid, unnest(['event_type', 'value']) as k, unnest([event_type, cast(value as varchar)]) as t
  from (select *, (row_number() over (partition by x, y, layer order by fid) - 1) // 10000 as part from tf)),
r as (select *, case when k = 'value' then 'double' else 'string' end as kind from vals),
d as (select *, dense_rank() over (partition by x, y, layer, part order by kind, t) - 1 as vi from r),
n as (select x, y, layer, part, max(vi) + 1 as n_values, count(distinct fid) as features from d group by 1, 2, 3, 4)
select x, y, layer, part, n_values, features, fid, string_agg((case when k = 'value' then 1 else 0 end) || ',' || vi, ',' order by k) as tags, 'event_type,value' as keys
from d join n using (x, y, layer, part) group by 1, 2, 3, 4, 5, 6, 7""")
def _(v):
    packed = pack.pack_tiles(v.tiles2, prop_types={"value": "double"})
    # sizes first: a row of a feature that carries its layer's arrays makes the work grow with their square
    sized = packed.select("x", "y", "layer", "part", F.size("values").cast("bigint").alias("n_values"), F.size("features").cast("bigint").alias("features"),
                          F.array_join("keys", ",").alias("keys"), F.transform("features", lambda f: F.struct(f["id"].alias("id"), f["tags"].alias("tags"))).alias("_f"))
    rows = sized.select("x", "y", "layer", "part", "n_values", "features", "keys", F.explode("_f").alias("f"))
    tags = F.array_join(F.transform("f.tags", lambda t: t.cast("string")), ",")
    return rows.select("x", "y", "layer", "part", "n_values", "features", F.col("f.id").alias("fid"), tags.alias("tags"), "keys")


@query("t23_unpack_tiles", """
select x, y, layer, fid, 1 as gtype, event_type || '/' || cast(value as varchar) as props, tx, ty, 1 as vertices from tf
union all select x, y, 'nation', fid, 3, name || '/' || region, cast(cx0 as bigint), cast(cy0 as bigint), 5 from tb where (cx1 - cx0) * (cy1 - cy0) >= 0.1""")
def _(v):
    back = pack.unpack_tiles(pack.pack_tiles(v.tiles2.unionByName(v.nation_tiles2)))
    low = lambda c: F.array_min(F.transform(g.vertices("tgeom"), lambda p: p[c])).cast("bigint").alias("t" + c)
    props = F.when(F.col("gtype") == 1, F.concat_ws("/", F.col("props")["event_type"], F.col("props")["value"])).otherwise(
        F.concat_ws("/", F.col("props")["name"], F.col("props")["region"]))
    return back.select("x", "y", "layer", "fid", "gtype", props.alias("props"), low("x"), low("y"), F.size(F.array_distinct(g.vertices("tgeom"))).alias("vertices")) \
        .withColumn("vertices", F.when(F.col("gtype") == 3, F.col("vertices") + 1).otherwise(F.col("vertices")).cast("int"))


GJ = """select z, x, y, layer, layer_ord, fid, '{"type":"Feature","id":' || fid || ',"geometry":{"type":"Point","coordinates":[' || LONS || ',' || LATS
  || ']},"properties":{"event_type":"' || event_type || '","value":"' || cast(value as varchar) || '"}}' as text
from (select *, (-20037508.342789244e0 + (x + tx / 4096e0) * w) / 20037508.342789244e0 * 180 as lon,
  (atan(exp((20037508.342789244e0 - (y + ty / 4096e0) * w) / 6378137e0)) * 2 - pi() / 2) * (180 / pi()) as lat
  from (select *, 2*20037508.342789244e0 / 4 as w from tf))"""
NUM = "regexp_replace(cast(cast(round({0}, 5) as decimal(38,5)) as varchar), '\\.?0+$', '')"
GJ = GJ.replace("LONS", NUM.format("lon")).replace("LATS", NUM.format("lat"))


@query("t24_tiles_to_geojson_all", f"""
select x, y, part, count(*) as features, '{{"type":"FeatureCollection","features":[' || string_agg(text, ',' order by layer_ord, fid) || ']}}' as geojson
from (select *, (row_number() over (partition by x, y order by layer_ord, fid) - 1) // 10000 as part from ({GJ})) group by 1, 2, 3""")
def _(v):
    return compose.tiles_to_geojson(v.tiles2, "__all__", digits=5).select("x", "y", "part", "features", "geojson")


@query("t24_tiles_to_geojson_array", f"""
select x, y, layer, part, count(*) as features, '{{"type":"FeatureCollection","name":"' || layer || '","features":[' || string_agg(text, ',' order by fid) || ']}}' as geojson
from (select *, (row_number() over (partition by x, y, layer order by fid) - 1) // 10000 as part from ({GJ})) group by 1, 2, 3, 4""")
def _(v):
    return compose.tiles_to_geojson(v.tiles2, "__array__", digits=5).select("x", "y", "layer", "part", "features", "geojson")


@query("t24_tiles_to_geojson_index", f"""
select 'name' as how, x, y, layer, count(*) as features from tf where layer = 'click' group by 2, 3, 4 union all
select 'index', x, y, layer, n from (select x, y, layer, count(*) as n, row_number() over (partition by x, y order by min(layer_ord)) as k from tf group by 1, 2, 3) where k = 2""")
def _(v):
    # a layer of many features has several documents
    count = lambda how, mode: compose.tiles_to_geojson(v.tiles2, mode).groupBy(F.lit(how).alias("how"), "x", "y", "layer").agg(F.sum("features").alias("features"))
    return count("name", "click").unionByName(count("index", 1))


@query("t25_tile_info", """
select x, y, layer, count(*) as features, count(*) as point_features, 0::bigint as polygon_features, 0::bigint as linestring_features from tf group by 1, 2, 3
union all select x, y, 'nation', count(*), 0, count(*), 0 from tb where (cx1 - cx0) * (cy1 - cy0) >= 0.1 group by 1, 2""")
def _(v):
    info = compose.tile_info(v.tiles2.unionByName(v.nation_tiles2))
    return info.select("x", "y", "layer", "features", "point_features", "polygon_features", "linestring_features")


HEADERS = """(select z, x, y, layer_ord as pos, case when layer_ord = 4 then 'click' else layer end as layer,
  cast((count(*) + x * 2 + y) % 4 as integer) as version, case when count(*) % 3 = 0 then 0 else count(*) end as features from tf group by z, x, y, layer_ord, layer)"""


@query("t26_tile_errors", f"""
with h as (select *, first_value(version) over (partition by z, x, y order by pos) as fv, first_value(pos) over (partition by z, x, y order by pos) as fp,
  min(version) over (partition by z, x, y) as lo, max(version) over (partition by z, x, y) as hi from {HEADERS})
select x, y, cast(pos as integer) as pos, layer, 'Vector Tile Layer message has an unsupported version' as error from h where pos <> fp and (fv > 2 or fv < 1)
union all select x, y, cast(pos as integer), layer, 'Vector Tile Layer message has no features' from h where features = 0
union all select distinct x, y, cast(null as integer), cast(null as varchar), 'Vector Tile message has two or more layers with the same name' from h group by x, y, layer having count(*) > 1
union all select distinct x, y, cast(null as integer), cast(null as varchar), 'Vector Tile message has layers with different versions' from h where lo <> hi""")
def _(v):
    per_layer = compose.layer_headers(v.tiles2)
    headers = per_layer.select(
        "z", "x", "y", "pos", F.when(F.col("pos") == 4, "click").otherwise(F.col("layer")).alias("layer"),
        ((F.col("features") + F.col("x") * 2 + F.col("y")) % 4).cast("int").alias("version"),
        F.when(F.col("features") % 3 == 0, 0).otherwise(F.col("features")).alias("features"),
    )
    return compose.tile_errors(headers).select("x", "y", "pos", "layer", "error")


def halves(v):
    """Two overlapping tile sets: a has the low layers, b the high ones and shifted ids."""
    a = v.tiles2.where(F.col("layer_ord") <= 2)
    b = v.tiles2.where((F.col("layer_ord") >= 2) & (F.col("x") > 0)).withColumn("fid", F.col("fid") + 1_000_000)
    return a, b


@query("t27_merge_tiles", "select x, y, layer, fid from tf where layer_ord <= 2 union all select x, y, layer, fid + 1000000 from tf t where layer_ord >= 2 and x > 0 and not exists (select 1 from tf a where a.layer_ord <= 2 and a.x = t.x and a.y = t.y and a.layer = t.layer)")
def _(v):
    return compose.merge_tiles(*halves(v), validate=True).select("x", "y", "layer", "fid")


@query("t27_merge_upgrade", """
with f as (select x, y, layer, layer_ord, count(*) as features from tf group by all)
select x, y, layer, 2 as version, features from f where layer_ord <= 2
union all select x, y, layer, 2, features from f t where layer_ord >= 2 and x > 0 and not exists (select 1 from f a where a.layer_ord <= 2 and a.x = t.x and a.y = t.y and a.layer = t.layer)""")
def _(v):
    """Packed tiles of versions 1 and 2 and layers without features are merged into others."""
    a, b = (pack.pack_tiles(df) for df in halves(v))
    b = b.withColumn("version", F.col("layer_ord") % 2 + 1)
    void = b.where("part = 0 and layer_ord = 3").withColumns({"layer": F.lit("void"), "version": F.lit(None).cast("int"), "features": F.slice("features", 1, 0)})
    merged = compose.merge_tiles(a, b.unionByName(void), validate=True, upgrade=True)
    return merged.groupBy("x", "y", "layer", "version").agg(F.sum(F.size("features")).alias("features"))


@query("t28_replace_tiles", "select x, y, layer, fid + 1000000 as fid from tf where layer_ord >= 2 and x > 0 union all select x, y, layer, fid from tf t where layer_ord <= 2 and not exists (select 1 from tf b where b.layer_ord >= 2 and b.x > 0 and b.x = t.x and b.y = t.y)")
def _(v):
    return compose.replace_tiles(*halves(v)).select("x", "y", "layer", "fid")


@query("t29_composite_same", "select x, y, layer, fid from tf where layer_ord <= 2 union all select x, y, layer, fid + 1000000 from tf t where layer_ord >= 2 and x > 0 and not exists (select 1 from tf a where a.layer_ord <= 2 and a.x = t.x and a.y = t.y and a.layer = t.layer)")
def _(v):
    a, b = halves(v)
    return compose.composite_same(a, [b, a]).select("x", "y", "layer", "fid")


#: Mercator box that cuts through the tiles of zoom 2 off their grid.
EXTENT = (-12_000_000.0, -9_500_000.0, 14_000_000.0, 11_000_000.0)
EXTENT_SQL = ", ".join(
    f"{side}(floor((({v}e0 {sign} 20037508.342789244e0) * {unit} / (2*20037508.342789244e0) * 4 - {axis}) * 4096 + 0.5e0), {limit}) as {name}"
    for name, side, v, sign, unit, axis, limit in (
        ("e0", "greatest", EXTENT[0], "+", 1, "x", -128), ("e1", "greatest", EXTENT[3], "-", -1, "y", -128),
        ("e2", "least", EXTENT[2], "+", 1, "x", 4224), ("e3", "least", EXTENT[1], "-", -1, "y", 4224)))


@query("t29_composite_options", f"""
with box as (select *, {EXTENT_SQL} from (select unnest(range(4)) as x), (select unnest(range(4)) as y)),
p as (select x, y, layer, fid, floor(tx * 1.5e0 - 700 + 0.5e0) as ax, floor(ty * 1.5e0 + 40 + 0.5e0) as ay from tf),
q as (select x, y, 'nation' as layer, fid, floor(cx0 * 1.5e0 - 700 + 0.5e0) as ax, floor(cy0 * 1.5e0 + 40 + 0.5e0) as ay, floor(cx1 * 1.5e0 - 700 + 0.5e0) as bx, floor(cy1 * 1.5e0 + 40 + 0.5e0) as "by" from tb where (cx1 - cx0) * (cy1 - cy0) >= 0.1),
c as (select x, y, layer, fid, greatest(ax, e0) as ax, greatest(ay, e1) as ay, least(bx, e2) as bx, least("by", e3) as "by" from q join box using (x, y))
select x, y, layer, fid, cast(ax as bigint) as tx0, cast(ay as bigint) as ty0, cast(ax as bigint) as tx1, cast(ay as bigint) as ty1 from p join box using (x, y) where ax between e0 and e2 and ay between e1 and e3
union all select x, y, layer, fid, cast(ax as bigint), cast(ay as bigint), cast(bx as bigint), cast("by" as bigint) from c where bx > ax and "by" > ay and (bx - ax) * ("by" - ay) >= 90000""")
def _(v):
    """Points and boxes of one zoom, rebuilt with a scale, offsets, a maximum extent and an area threshold."""
    sources = [(v.tiles2, 2), (v.nation_tiles2, 2)]
    out = compose.composite(v.tiles2.where("false"), sources, 2, reencode=True, max_extent=EXTENT, area_threshold=90_000, process_all_rings=True, scale_factor=1.5, offset_x=-700.0, offset_y=40.0)
    low, high = F.array_min, F.array_max
    ends = [f(F.transform(g.vertices("tgeom"), lambda p: p[c])).cast("bigint").alias(f"t{c}{i}") for i, f in enumerate((low, high)) for c in "xy"]  # noqa: B023
    return out.select("x", "y", "layer", "fid", *ends)


def tf_sql(z):
    """Point features cut into the tiles of a zoom, with the coordinates that the tiles hold."""
    n = 2**z
    return f"""(select {z} as z, cast(xs.x as integer) as x, cast(ys.y as integer) as y, event_type as layer, layer_ord, fid,
  cast(floor((u - xs.x) * 4096 + 0.5e0) as bigint) as tx, cast(floor((v - ys.y) * 4096 + 0.5e0) as bigint) as ty
from (select *, (mx + 20037508.342789244e0) / (2*20037508.342789244e0) * {n} as u, (20037508.342789244e0 - my) / (2*20037508.342789244e0) * {n} as v from evm) p
join (select unnest(range({n})) as x) xs on xs.x between floor(u - 0.03125e0) and floor(u + 0.03125e0)
join (select unnest(range({n})) as y) ys on ys.y between floor(v - 0.03125e0) and floor(v + 0.03125e0))"""


@query("t29_composite_mixed_zooms", f"""
with s as (select 0 as src, z, x, y, z as oz, x as ox, y as oy, layer, fid, tx, ty from {tf_sql(3)} where layer_ord = 0 and x < 4
union all select 1, z, x, y, z, x, y, layer, fid + 3000000, tx, ty from {tf_sql(3)} where layer_ord = 1 and y < 4
union all select 1, 3, x * 4 + cx, y * 4 + cy, z, x, y, layer, fid + 1000000, tx * 4 - cx * 4096, ty * 4 - cy * 4096 from {tf_sql(1)}, (select unnest(range(4)) as cx), (select unnest(range(4)) as cy) where layer_ord <= 2 and x = 0
union all select 2, 3, x // 2, y // 2, z, x, y, layer, fid + 4000000, cast(floor(tx / 2 + (x % 2) * 2048 + 0.5e0) as bigint), cast(floor(ty / 2 + (y % 2) * 2048 + 0.5e0) as bigint) from {tf_sql(4)}),
c as (select *, min((src, oz, ox, oy)) over (partition by x, y, layer) as win from s where tx between -128 and 4224 and ty between -128 and 4224)
select z, cast(x as integer) as x, cast(y as integer) as y, layer, fid, tx, ty from c where (src, oz, ox, oy) = win""")
def _(v):
    """A target of zoom 3, one source of zooms 1 and 3 and one of zoom 4."""
    at = lambda z, keep, add: tl.tile_from_features(v.ev_merc, z).where(keep).withColumn("fid", F.col("fid") + add * 1_000_000)
    target = at(3, "layer_ord = 0 and x < 4", 0)
    both = at(3, "layer_ord = 1 and y < 4", 3).unionByName(at(1, "layer_ord <= 2 and x = 0", 1))
    return compose.composite(target, [both, (at(4, "true", 4), 4)], 3).select("z", "x", "y", "layer", "fid", *first_vertex())


@query("t29_composite_rasters", """
with s as (select 5 + img_id % 3 as z, img_id * 7 % 32 as tx, img_id * 13 % 32 as ty, case when img_id % 2 = 0 then 'even' else 'odd' end as layer, x as cx, y as cy, v, img_id from gy),
g as (select *, img_id % 5 % 2 + 1 as src, tx * 8 + cx as gx, ty * 8 + cy as gy from s),
m as (select src, z, tx, ty, layer, gx, gy, v, img_id from g where z = 6
union all select src, z, tx, ty, layer, gx * 2 + i, gy * 2 + j, v, img_id from g, (select unnest(range(2)) as i), (select unnest(range(2)) as j) where z = 5
union all select src, z, tx, ty, layer, gx // 2, gy // 2, v, img_id from g where z = 7 and gx % 2 = 1 and gy % 2 = 1),
w as (select *, min((src, z, tx, ty)) over (partition by gx // 8, gy // 8, layer) as win from m)
select cast(gx // 8 as integer) as x, cast(gy // 8 as integer) as y, layer, cast(gx % 8 as integer) as cx, cast(gy % 8 as integer) as cy, v, img_id from w where (src, z, tx, ty) = win""")
def _(v):
    """Images of zooms 5 to 7 in two sources, brought to zoom 6."""
    i = F.col("img_id")
    cells = v.gray.select(
        (i % 3 + 5).cast("int").alias("z"), (i * 7 % 32).cast("int").alias("x"), (i * 13 % 32).cast("int").alias("y"),
        F.when(i % 2 == 0, "even").otherwise("odd").alias("layer"), F.col("x").alias("cx"), F.col("y").alias("cy"), "v", "img_id")
    sources = [cells.where(i % 5 % 2 == k) for k in (0, 1)]
    return compose.composite_rasters(cells.where("false"), sources, 6, 8).select("x", "y", "layer", "cx", "cy", "v", "img_id")


@query("t30_composite_overzoom", """
select 4 as z, cast(x * 4 + cx as integer) as x, cast(y * 4 + cy as integer) as y, layer, fid, tx * 4 - cx * 4096 as tx, ty * 4 - cy * 4096 as ty
from tf, (select unnest(range(4)) as cx), (select unnest(range(4)) as cy)
where tx * 4 - cx * 4096 between -128 and 4224 and ty * 4 - cy * 4096 between -128 and 4224""")
def _(v):
    return compose.composite_overzoom(v.tiles2, 4).select("z", "x", "y", "layer", "fid", *first_vertex())


@query("t31_composite_underzoom", """
with w as (select *, x // 2 as ax, y // 2 as ay, dense_rank() over (partition by x // 2, y // 2, layer order by x, y) as k from tf)
select 1 as z, cast(ax as integer) as x, cast(ay as integer) as y, layer, fid, cast(floor(tx / 2 + (x - ax * 2) * 2048 + 0.5e0) as bigint) as tx, cast(floor(ty / 2 + (y - ay * 2) * 2048 + 0.5e0) as bigint) as ty
from w where k = 1 and floor(tx / 2 + (x - ax * 2) * 2048 + 0.5e0) between -128 and 4224 and floor(ty / 2 + (y - ay * 2) * 2048 + 0.5e0) between -128 and 4224""")
def _(v):
    return compose.composite_underzoom(v.tiles2, 1).select("z", "x", "y", "layer", "fid", *first_vertex())


@query("t32_reencode", "select x, y, layer, fid, tx, ty from tf where tx between -64 and 4160 and ty between -64 and 4160")
def _(v):
    return compose.reencode_tiles(v.tiles2, buffer=64).select("x", "y", "layer", "fid", *first_vertex())


@query("t33_add_raster_layer", """
select 'embedding' as layer, 9 as z, cast(img_id % 512 as integer) as x, cast(img_id // 512 as integer) as y, cast(xs as integer) as cx, cast(ys as integer) as cy, round(v, 6) as v
from gy, (select unnest(range(16)) as xs), (select unnest(range(16)) as ys) where gy.x = xs // 2 and gy.y = ys // 2""")
def _(v):
    placement = v.gray.select("img_id").distinct().select(
        "img_id", F.lit(9).alias("z"), (F.col("img_id") % 512).cast("int").alias("x"), F.expr("cast(img_id div 512 as int)").alias("y"))
    out = compose.add_raster_layer(None, v.gray, placement, "embedding", 16)
    return out.select("layer", "z", "x", "y", "cx", "cy", F.round("v", 6).alias("v"))


def side(p, q, r):
    return f"sign(({q}x - {p}x) * ({r}y - {p}y) - ({q}y - {p}y) * ({r}x - {p}x))"


def pairs(source):
    """Brute-force pairs of segments that cross or touch other than as neighbours."""
    return f"""
with s as (select fid, seq, n, count(*) over (partition by fid) as m, floor((ax + 180) * 4096 / 360 + 0.5e0) as ax, floor((90 - ay) * 4096 / 180 + 0.5e0) as ay,
  floor((ex + 180) * 4096 / 360 + 0.5e0) as ex, floor((90 - ey) * 4096 / 180 + 0.5e0) as ey from {source}),
p as (select a.fid, a.m, a.n, a.seq as i, b.seq as j, a.ax, a.ay, a.ex as bx, a.ey as "by", b.ax as cx, b.ay as cy, b.ex as dx, b.ey as dy
  from s a join s b on a.fid = b.fid and a.seq < b.seq),
o as (select *, sign((bx-ax)*(cy-ay)-("by"-ay)*(cx-ax)) as d1, sign((bx-ax)*(dy-ay)-("by"-ay)*(dx-ax)) as d2, sign((dx-cx)*(ay-cy)-(dy-cy)*(ax-cx)) as d3, sign((dx-cx)*("by"-cy)-(dy-cy)*(bx-cx)) as d4 from p),
x as (select *, case
  when j = i + 1 then d2 = 0 and (ax - bx) * (dx - bx) + (ay - "by") * (dy - "by") > 0
  when i = 0 and j = m - 1 and ax = dx and ay = dy then sign((dx-cx)*("by"-cy)-(dy-cy)*(bx-cx)) = 0 and (cx - ax) * (bx - ax) + (cy - ay) * ("by" - ay) > 0
  else (d1 * d2 < 0 and d3 * d4 < 0)
    or (d1 = 0 and cx between least(ax, bx) and greatest(ax, bx) and cy between least(ay, "by") and greatest(ay, "by"))
    or (d2 = 0 and dx between least(ax, bx) and greatest(ax, bx) and dy between least(ay, "by") and greatest(ay, "by"))
    or (d3 = 0 and ax between least(cx, dx) and greatest(cx, dx) and ay between least(cy, dy) and greatest(cy, dy))
    or (d4 = 0 and bx between least(cx, dx) and greatest(cx, dx) and "by" between least(cy, dy) and greatest(cy, dy)) end as bad from o)
"""


def flat_lines(v):
    flat = g.map_vertices("geom", lambda x, y: (F.floor((x + 180) * 4096 / 360 + 0.5), F.floor((90 - y) * 4096 / 180 + 0.5)))
    return v.ln_lines.withColumn("tgeom", flat)


@query("t34_simplicity_report", pairs("sg") + "select distinct 'lines' as layer, fid from x where bad")
def _(v):
    return reports.simplicity_report(flat_lines(v))


@query("t35_validity_report", pairs("rg") + """
select distinct 'rings' as layer, fid, 'self-intersection' as message from x where bad
union all select 'rings', fid, 'too few points' from (select fid, max(n) as n from ln group by fid) where n < 3
union all select 'rings', fid, 'wrong ring orientation' from s group by fid having sum(ax * ey - ex * ay) < 0""")
def _(v):
    return reports.validity_report(flat_rings(v)).select("layer", "fid", "message")


def flat_multi(v):
    """Four orders are the parts of one polygon; each part has its own ring, turned and moved aside, as a hole."""
    rows = flat_rings(v).select((F.col("fid") - F.col("fid") % 4).alias("multi"), "fid", F.col("tgeom.parts")[0][0].alias("ring"))
    hole = F.transform(F.reverse("ring"), lambda p: g.vertex(p["x"] + 8192, p["y"]))
    parts = F.sort_array(F.collect_list(F.struct("fid", F.array("ring", hole).alias("rings"))))
    whole = rows.groupBy("multi").agg(parts.alias("p")).withColumn("tgeom", g.geometry(g.MULTIPOLYGON, F.transform("p", lambda p: p["rings"])))
    return whole.select(F.lit("multi").alias("layer"), F.col("multi").alias("fid"), "tgeom", *[F.lit(0).alias(c) for c in tl.TILE])


@query("t35_validity_report_multi", pairs("rg") + """,
k as (select fid, fid - fid % 4 as multi, cast(row_number() over (partition by fid - fid % 4 order by fid) - 1 as integer) as piece from (select distinct fid from s)),
f as (select distinct fid, 'self-intersection' as message from x where bad
  union all select fid, 'too few points' from (select fid, max(n) as n from ln group by fid) where n < 3
  union all select fid, 'wrong ring orientation' from s group by fid having sum(ax * ey - ex * ay) < 0),
o1 as (select fid, any_value(ax) as px, any_value(ay) as py from s where seq = 0 group by fid)
select 'multi' as layer, multi as fid, piece, message, unit,
  round(case unit when 'degrees' then px / 4096 * 360 - 180 else (px / 4096 * 2 - 1) * 20037508.342789244e0 end, digits) as x,
  round(case unit when 'degrees' then degrees(2 * atan(exp((1 - py / 4096 * 2) * pi())) - pi() / 2) else (1 - py / 4096 * 2) * 20037508.342789244e0 end, digits) as y
from f join k using (fid) join o1 using (fid), (values ('degrees', 3), ('metres', 1)) u(unit, digits)""")
def _(v):
    """Parts with holes, each reported by itself, in both projections; x and y are the first position of the text."""
    report = reports.validity_texts(flat_multi(v), {"degrees": 4326, "metres": 3857}, split_multi=True)

    def place(unit, digits):
        at = [F.round(F.get_json_object(unit, f"$.coordinates[0][0][{i}]").cast("double"), digits).alias(c) for i, c in enumerate("xy")]
        return F.struct(F.lit(unit).alias("unit"), *at)

    both = F.explode(F.array(place("degrees", 3), place("metres", 1))).alias("_at")
    return report.select("layer", "fid", "piece", "message", both).select("layer", "fid", "piece", "message", "_at.*")
