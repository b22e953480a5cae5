"""Queries on key grids (U) and raster cells (R)."""

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blend, grid, raster
from .registry import query
from .tables import GRID_CTE, WORLD

W, H = 64, 32
CX, CY = "cast(floor(({0} + 180) * 64 / 360) as bigint)", "cast(floor((90 - {0}) * 32 / 180) as bigint)"
EV_CELLS = f"""(select {CX.format('lon')} as x, {CY.format('lat')} as y, max_by(fid, cast(layer_ord as bigint) * 1000000000 + fid) as fid from ev group by 1, 2)"""


def ev_cells(v):
    return grid.rasterize_points(v.ev_points, WORLD)


@query("u01_rasterize_points", f"select x, y, cast(fid as varchar) as key from {EV_CELLS}")
def _(v):
    return ev_cells(v).select("x", "y", "key")


# crossing sums per cell row, for rings of the orders
RING_CELLS = """(select fid, xs.x, y from (
  select fid, y, (ex-ax)*(y + 0.5e0 - ay)/(ey-ay) + ax as cx from (
    select fid, (ax + 180) * 64 / 360 as ax, (90 - ay) * 32 / 180 as ay, (ex + 180) * 64 / 360 as ex, (90 - ey) * 32 / 180 as ey from rg),
  (select unnest(range(32)) as y) where (ay > y + 0.5e0) <> (ey > y + 0.5e0)), (select unnest(range(64)) as x) xs
  where cx <= xs.x + 0.5e0 group by 1, 2, 3 having count(*) % 2 = 1)"""


@query("u02_rasterize_polygons", f"select x, y, cast(max(fid) as varchar) as key from {RING_CELLS} group by x, y")
def _(v):
    return grid.rasterize_polygons(v.pg_polys, WORLD).select("x", "y", "key")


LINE_CELLS = """(select distinct fid, cast(floor(ax + dx * i / n) as bigint) as x, cast(floor(ay + dy * i / n) as bigint) as y from (
  select *, unnest(range(cast(n as bigint) + 1)) as i from (
    select fid, ax, ay, ex - ax as dx, ey - ay as dy, greatest(ceil(greatest(abs(ex - ax), abs(ey - ay))), 1) as n from (
      select fid, (ax + 180) * 64 / 360 as ax, (90 - ay) * 32 / 180 as ay, (ex + 180) * 64 / 360 as ex, (90 - ey) * 32 / 180 as ey from sg))))"""


@query("u03_rasterize_lines", f"select x, y, cast(max(fid) as varchar) as key from {LINE_CELLS} where x between 0 and 63 and y between 0 and 31 group by x, y")
def _(v):
    return grid.rasterize_lines(v.ln_lines, WORLD).select("x", "y", "key")


DENSE = f"""(select xs.x, ys.y, coalesce(cast(c.fid as varchar), '') as key from (select unnest(range(64)) as x) xs
  cross join (select unnest(range(32)) as y) ys left join {EV_CELLS} c on c.x = xs.x and c.y = ys.y)"""


@query("u04_dense_grid", f"select x, y, key from {DENSE}")
def _(v):
    return grid.dense_grid(ev_cells(v), W, H).select("x", "y", "key")


@query("u05_encode_utf", GRID_CTE + "select y, line from lines")
def _(v):
    return grid.encode_utf(ev_cells(v), W, H).select("y", "line")


@query("u05_encode_keys", GRID_CTE + "select key, cast(key_ord as integer) as key_ord, cast(code as integer) as code from code")
def _(v):
    return grid.encode_keys(ev_cells(v), W, H).select("key", "key_ord", "code")


@query("u06_grid_data", f"""
select cast(c.fid as varchar) as key, '{{"__id__":' || c.fid || ',"event_type":"' || event_type || '"}}' as data from {EV_CELLS} c join ev on ev.fid = c.fid""")
def _(v):
    return grid.grid_data(ev_cells(v), v.ev_points, ["__id__", "event_type"]).select("key", "data")


@query("u07_grid_key", f"select x, y, event_type as key from {EV_CELLS} c join ev on ev.fid = c.fid")
def _(v):
    return grid.rasterize_points(v.ev_points, WORLD, "event_type").select("x", "y", "key")


@query("u09_grid_view", f"select x - 16 as x, y - 8 as y, key from {DENSE} where x between 16 and 31 and y between 8 and 23")
def _(v):
    return grid.grid_view(grid.dense_grid(ev_cells(v), W, H), 16, 8, 16, 16).select("x", "y", "key")


def layer_grids(v):
    """One grid per event type, keyed by whether the value is large."""
    rows = v.ev_points.withColumn("grid_id", F.col("layer_ord").cast("bigint")).withColumn("size", F.when(F.col("value") > 1000, "large").otherwise("small"))
    return grid.rasterize_points(rows, (4, 2, WORLD[2]), "size")


SMALL = """(select layer_ord as grid_id, cast(floor((lon + 180) * 4 / 360) as bigint) as x, cast(floor((90 - lat) * 2 / 180) as bigint) as y,
  max_by(case when value > 1000 then 'large' else 'small' end, fid) as key from ev group by 1, 2, 3)"""


@query("u10_grid_is_solid", f"select cast(grid_id as bigint) as grid_id, min(key) = max(key) and count(*) = 8 as solid, case when min(key) = max(key) and count(*) = 8 then max(key) end as value from {SMALL} group by 1")
def _(v):
    return grid.grid_is_solid(layer_grids(v), 4, 2)


@query("u11_grid_get", f"select cast(grid_id as bigint) as grid_id, key from {SMALL} where x = 1 and y = 1")
def _(v):
    return grid.grid_get(layer_grids(v), 1, 1)


@query("u12_grid_painted", f"select cast(grid_id as bigint) as grid_id, max(key) <> '' as painted from {SMALL} group by 1")
def _(v):
    return grid.grid_painted(layer_grids(v))


@query("u13_grid_clear", f"select cast(grid_id as bigint) as grid_id, x, y, '' as key from {SMALL}")
def _(v):
    return grid.grid_clear(layer_grids(v))


@query("u14_tile_grid", """
select '2/' || x || '/' || y as grid_id, tx // 256 as x, ty // 256 as y, cast(max(fid) as varchar) as key
from (select x as zx, y as zy, fid, tx // 256 as cx, ty // 256 as cy, x, y, tx, ty from tf where layer = 'view') where tx between 0 and 4095 and ty between 0 and 4095
group by x, y, tx // 256, ty // 256""".replace("select '2/' || x || '/' || y as grid_id, tx // 256 as x, ty // 256 as y", "select '2/' || zx || '/' || zy as grid_id, cx as x, cy as y").replace("group by x, y, tx // 256, ty // 256", "group by zx, zy, cx, cy"))
def _(v):
    return grid.tile_grid(v.tiles2, "view", 16, 16)


# --- rasters --------------------------------------------------------------------------------------

RGBA = "img_id, x, y, r, g, b, a"


def rgba(df, *more):
    return df.select("img_id", "x", "y", "r", "g", "b", "a", *more)


def premultiplied(v):
    return raster.premultiply(v.px)


def sources(v):
    """A second image set: mirrored, with rotated channels (still premultiplied)."""
    pm = premultiplied(v)
    return pm.select("img_id", (7 - F.col("x")).alias("x"), "y", F.col("b").alias("r"), F.col("r").alias("g"), F.col("g").alias("b"), "a")


@query("r01_get_pixel", "select img_id, r, g, b, a from px where x = 3 and y = 5")
def _(v):
    return raster.get_pixel(v.px, 3, 5).select("img_id", "r", "g", "b", "a")


@query("r02_set_pixel", """
select img_id, x, y, case when x = y then least(greatest((v - 90) * 9000, 0), 65535) else v end as v from g8""")
def _(v):
    updates = v.gray8.where(F.col("x") == F.col("y")).withColumn("v", (F.col("v") - 90) * 9000)
    return raster.set_pixel(v.gray8, updates)


@query("r03_fill", "select img_id, x, y, 0 as r, 128 as g, 0 as b, 255 as a from px")
def _(v):
    return rgba(raster.fill(v.px, r=0, g=128, b=0, a=255))


@query("r04_clear", "select img_id, x, y, cast(0 as bigint) as v from g8")
def _(v):
    return raster.clear(v.gray8)


@query("r05_compare", """
select 'alpha' as mode, p.img_id, cast(count_if(abs(p.r - q.r) > 16 or abs(p.g - q.g) > 16 or abs(p.b - q.b) > 16 or abs(p.a - q.a) > 16) as bigint) as different from pm p join ps q using (img_id, x, y) group by 2
union all select 'rgb', p.img_id, cast(count_if(p.r <> q.r or p.g <> q.g or p.b <> q.b) as bigint) from pm p join ps q using (img_id, x, y) group by 2""")
def _(v):
    a, b = premultiplied(v), sources(v)
    return raster.compare(a, b, 16).withColumn("mode", F.lit("alpha")).unionByName(raster.compare(a, b, 0, alpha=False).withColumn("mode", F.lit("rgb")))


@query("r06_is_solid", """
select img_id, min(v) = max(v) as solid, case when min(v) = max(v) then max(v) end as v from (select img_id, case when img_id % 3 = 0 then 7 else v end as v from g8) group by 1""")
def _(v):
    return raster.is_solid(v.gray8.withColumn("v", F.when(F.col("img_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("v"))))


@query("r07_image_stats", "select img_id, cast(max(x) + 1 as integer) as width, cast(max(y) + 1 as integer) as height, 'rgba8' as type from px group by 1")
def _(v):
    return raster.image_stats(v.px)


@query("r08_view", "select img_id, x - 2 as x, y - 1 as y, r, g, b, a from px where x between 2 and 5 and y between 1 and 6")
def _(v):
    return rgba(raster.view(v.px, 2, 1, 4, 6))


@query("r09_premultiply", "select img_id, x, y, r, g, b, a from pm")
def _(v):
    return rgba(premultiplied(v))


@query("r09_demultiply", f"""
select img_id, x, y, {', '.join(f'case when a = 0 then 0 else least({c} * 255 // a, 255) end as {c}' for c in 'rgb')}, a from pm""")
def _(v):
    return rgba(raster.demultiply(premultiplied(v)))


@query("r10_gray_to_alpha", """
select img_id, x, y, 255 as r, 255 as g, 255 as b, cast(least(ceil(r * 3e-1 + g * 59e-2 + b * 11e-2), 255) as integer) as a from px""")
def _(v):
    return rgba(raster.gray_to_alpha(v.px))


@query("r11_cast_copy", """
select img_id, x, y, least(greatest(cast(trunc((v - 20e0) / 5e-1) as bigint), 0), 255) as v from g8""")
def _(v):
    return raster.cast_copy(v.gray8, "gray8", 20.0, 0.5)


def targets(w, h):
    return f"(select unnest(range({w})) as tx), (select unnest(range({h})) as ty)"


@query("r12_resize_near", f"""
select d.img_id, cast(tx as integer) as x, cast(ty as integer) as y, r, g, b, a
from (select img_id, max(x) + 1 as w, max(y) + 1 as h from px group by 1) d, {targets(11, 5)}
join px on px.img_id = d.img_id and px.x = (2 * tx + 1) * w // 22 and px.y = (2 * ty + 1) * h // 10""".replace("from (select img_id, max(x)", "from (select tx, ty, img_id as did, w, h from (select img_id, max(x)").replace(f"{targets(11, 5)}\njoin", f"{targets(11, 5)}) d\njoin").replace("px.img_id = d.img_id", "px.img_id = d.did").replace("select d.img_id", "select px.img_id"))
def _(v):
    return rgba(raster.resize_near(v.px, 11, 5))


@query("r12_resize_near_window", f"""
select g8.img_id, cast(tx as integer) as x, cast(ty as integer) as y, v from g8, {targets(6, 6)} where x = 2 + (2 * tx + 1) * 4 // 12 and y = 1 + (2 * ty + 1) * 5 // 12""")
def _(v):
    return raster.resize_near(v.gray8, 6, 6, 2, 1, 4, 5)


def bilinear_sql(w, h):
    near = lambda axis, t, full, n: f"greatest(1 - abs(({t} + 0.5e0) * {full} / {n}e0 - 0.5e0 - {axis}) / greatest({full} / {n}e0, 1), 0)"
    return f"""select '{w}x{h}' as size, img_id, cast(tx as integer) as x, cast(ty as integer) as y,
  {', '.join(f'cast(case when a = 0 then 0 else least(floor({c} * 255 / case when a = 0 then 1 else a end), 255) end as integer) as {c}' for c in 'rgb')}, cast(a as integer) as a
from (select img_id, tx, ty, {', '.join(f'least(greatest(floor(round(sum(k * {c}) / sum(k), 6) + 0.5e0), 0), 255) as {c}' for c in 'rgba')}
  from (select p.img_id, tx, ty, r, g, b, a, {near('x', 'tx', 'w', w)} * {near('y', 'ty', 'h', h)} as k
    from pm p join (select img_id, max(x) + 1 as w, max(y) + 1 as h from px group by 1) d on d.img_id = p.img_id, {targets(w, h)})
  where k > 0 group by 1, 2, 3)"""


SIZES = ((13, 6), (11, 17), (3, 2))


@query("r13_resize_bilinear", " union all ".join(bilinear_sql(w, h) for w, h in SIZES))
def _(v):
    return rgba(raster.resize_bilinear_sizes(v.px, SIZES), "size")


# Published definitions of the kernels, by the distance t from the middle.
SINC = "case when {0} = 0 then 1 else sin(pi() * {0}) / (pi() * {0}) end"
SERIES = "list_sum(list_transform(range({n}), lambda k: {term}))"
HALF_POWER = "pow({x} / 2, 2 * k) / pow(gamma(k + 1e0), 2)"
I0 = lambda x: SERIES.format(n=30, term=HALF_POWER.format(x=x))
CUBE = "pow(greatest(t + {0}, 0), 3)"


def cubic_sql(b, c):
    return f"""(case when t < 1 then (12 - 9 * {b} - 6 * {c}) * pow(t, 3) + (12 * {b} + 6 * {c} - 18) * t * t + 6 - 2 * {b}
  when t < 2 then 8 * {b} + 24 * {c} - (12 * {b} + 48 * {c}) * t + (6 * {b} + 30 * {c}) * t * t - ({b} + 6 * {c}) * pow(t, 3) else 0 end) / 6"""


WEIGHTS = {
    "bicubic": (2, f"({CUBE.format(2)} - 4 * {CUBE.format(1)} + 6 * {CUBE.format(0)} - 4 * {CUBE.format(-1)}) / 6"),
    "spline16": (2, "case when t < 1 then pow(t, 3) - 9e0 / 5 * t * t - t / 5 + 1 else -pow(t - 1, 3) / 3 + 4e0 / 5 * pow(t - 1, 2) - 7e0 / 15 * (t - 1) end"),
    "spline36": (3, "case when t < 1 then 13e0 / 11 * pow(t, 3) - 453e0 / 209 * t * t - 3e0 / 209 * t + 1"
        " when t < 2 then -6e0 / 11 * pow(t - 1, 3) + 270e0 / 209 * pow(t - 1, 2) - 156e0 / 209 * (t - 1)"
        " else pow(t - 2, 3) / 11 - 45e0 / 209 * pow(t - 2, 2) + 26e0 / 209 * (t - 2) end"),
    "hanning": (1, "(1 + cos(pi() * t)) / 2"),
    "hamming": (1, "0.54e0 + 0.46e0 * cos(pi() * t)"),
    "hermite": (1, "2 * pow(t, 3) - 3 * t * t + 1"),
    "kaiser": (1, f"{I0('(6.33e0 * sqrt(greatest(1 - t * t, 0)))')} / {I0('6.33e0')}"),
    "quadric": (1.5, "case when t < 0.5e0 then 0.75e0 - t * t when t < 1.5e0 then pow(t - 1.5e0, 2) / 2 else 0 end"),
    "catrom": (2, cubic_sql("0e0", "0.5e0")),
    "gaussian": (2, "exp(-2 * t * t) * sqrt(2 / pi())"),
    "mitchell": (2, cubic_sql("(1e0 / 3)", "(1e0 / 3)")),
    "bessel": (3.2383, f"case when t = 0 then pi() / 4 else {SERIES.format(n=30, term='pow(-1e0, k) * pow(pi() * t / 2, 2 * k + 1) / (gamma(k + 1e0) * gamma(k + 2e0))')} / (2 * t) end"),
    "sinc": (4, SINC.format("t")),
    "lanczos": (4, f"({SINC.format('t')}) * ({SINC.format('(t / 4)')})"),
    "blackman": (4, f"({SINC.format('t')}) * (0.42e0 + 0.5e0 * cos(pi() * t / 4) + 0.08e0 * cos(pi() * t / 2))"),
}


def kernel_sql(method, w, h):
    """Weights at steps of 1/256 and six digits, along x and then along y."""
    radius, weight = WEIGHTS[method]
    table = f"(select i, round({weight}, 6) as k from (select i, i / 256e0 as t from (select unnest(range({math.ceil(radius * 256)})) as i)))"
    step = lambda axis, t, n: f"cast(floor(abs(({t} + 0.5e0) * (8 / {n}e0) - 0.5e0 - {axis}) / greatest(8 / {n}e0, 1) * 256) as integer)"
    return f"""select '{method}' as method, '{w}x{h}' as size, img_id, cast(tx as integer) as x, cast(ty as integer) as y, round(sum(k * v) / sum(k), 5) as v
from (select img_id, tx, y, sum(k * v) / sum(k) as v from gy, (select unnest(range({w})) as tx), {table} where i = {step('x', 'tx', w)} and k <> 0 group by 1, 2, 3),
  (select unnest(range({h})) as ty), {table} where i = {step('y', 'ty', h)} and k <> 0 group by img_id, tx, ty"""


KERNEL_SIZES = ((12, 5), (3, 9))


@query("r14_resize_kernel", " union all ".join(kernel_sql(k, w, h) for k in WEIGHTS for w, h in KERNEL_SIZES))
def _(v):
    out = raster.resize_kernels(v.gray, [(k, w, h) for k in WEIGHTS for w, h in KERNEL_SIZES])
    return out.select("method", "size", "img_id", "x", "y", F.round("v", 5).alias("v"))


NEAR = """
with n as (select p.img_id, p.x, p.y, p.r, p.g, p.b, p.a, lx.r as lr, lx.g as lg, lx.b as lb, rx.r as rr, rx.g as rg, rx.b as rb
  from px p left join px lx on lx.img_id = p.img_id and lx.y = p.y and lx.x = p.x - 1 left join px rx on rx.img_id = p.img_id and rx.y = p.y and rx.x = p.x + 1),
f as (select img_id, x, y, a, r as mr, g as mg, b as mb, coalesce(lr, r) as lr, coalesce(lg, g) as lg, coalesce(lb, b) as lb, coalesce(rr, r) as rr, coalesce(rg, g) as rg, coalesce(rb, b) as rb from n),
w as (select f.img_id, f.x, f.y, f.a, {cols} from f left join f u on u.img_id = f.img_id and u.x = f.x and u.y = f.y - 1 left join f d on d.img_id = f.img_id and d.x = f.x and d.y = f.y + 1)
""".format(cols=", ".join(
    f"coalesce(u.{s}{c}, d.{s}{c}, f.{s}{c}) as u{s}{c}, f.{s}{c} as m{s}{c}, coalesce(d.{s}{c}, u.{s}{c}, f.{s}{c}) as d{s}{c}" for s in "lmr" for c in "rgb"))


def weighed(kernel, c, scale=""):
    terms = [f"({w})*{row}{s}{c}" for row, ws in zip("umd", kernel) for s, w in zip("lmr", ws) if w]
    return " + ".join(terms)


def filter_sql(name):
    if name == "sobel":
        expr = lambda c: f"sqrt(pow({weighed(raster.SOBEL_X, c)}, 2) + pow({weighed(raster.SOBEL_Y, c)}, 2))"
    elif name == "blur":
        expr = lambda c: f"({weighed([[1] * 3] * 3, c)}) // 9"
    else:
        expr = lambda c: weighed(raster.CONVOLUTIONS[name], c)
    return f"select '{name}' as filter, img_id, x, y, " + ", ".join(f"cast(least(greatest(floor({expr(c)}), 0), 255) as integer) as {c}" for c in "rgb") + ", a from w"


FILTERS = ("blur", "emboss", "sharpen", "edge_detect", "sobel")


@query("r15_convolve", NEAR + " union all ".join(filter_sql(f) for f in FILTERS))
def _(v):
    return reduce(DataFrame.unionByName, [rgba(raster.convolve(v.px, f), F.lit(f).alias("filter")) for f in FILTERS])


@query("r16_gray_invert", """
select 'gray' as filter, img_id, x, y, cast((r * 299 + g * 587 + b * 114) // 1000 as integer) as r, cast((r * 299 + g * 587 + b * 114) // 1000 as integer) as g, cast((r * 299 + g * 587 + b * 114) // 1000 as integer) as b, a from px
union all select 'invert', img_id, x, y, a - r, a - g, a - b, a from pm""")
def _(v):
    return rgba(raster.gray(v.px), F.lit("gray").alias("filter")).unionByName(rgba(raster.invert(premultiplied(v)), F.lit("invert").alias("filter")))


def blur_pass(source, axis, other, radius, cols="rgba"):
    w = f"over (partition by img_id, {other} order by {axis} range between {radius} preceding and {radius} following)"
    return f"(select img_id, x, y, {', '.join(f'avg({c}) {w} as {c}' for c in cols)} from {source})"


@query("r17_stack_blur", "select img_id, x, y, " + ", ".join(f"cast(floor(round({c}, 6) + 0.5e0) as integer) as {c}" for c in "rgba") + " from "
       + blur_pass(blur_pass(blur_pass(blur_pass("px", "x", "y", 2), "x", "y", 2), "y", "x", 1), "y", "x", 1))
def _(v):
    return rgba(raster.stack_blur(v.px, 2, 1))


# --- compositing ----------------------------------------------------------------------------------

DX, DY = 2, -1
OVER = f"""(select d.img_id, d.x, d.y, d.r as dr0, d.g as dg0, d.b as db0, d.a as da0, d.r/255e0 as dr, d.g/255e0 as dg, d.b/255e0 as db, d.a/255e0 as da,
  s.a as hit, s.r/255e0 as sr, s.g/255e0 as sg, s.b/255e0 as sb, s.a/255e0 as sa
  from pm d left join ps s on s.img_id = d.img_id and s.x + {DX} = d.x and s.y + ({DY}) = d.y)"""


def op_sql(op, colour, alpha):
    """``colour`` is a formula in {s} and {d}; ``alpha`` one in sa and da."""
    byte = lambda e, c: f"cast(case when hit is null then d{c}0 else least(greatest(floor(round(({e}) * 255, 6) + 0.5e0), 0), 255) end as integer) as {c}"
    cols = [byte(colour.format(s=f"s{c}", d=f"d{c}", rest=f"(s{c} * (1 - da) + d{c} * (1 - sa))"), c) for c in "rgb"]
    return f"select '{op}' as op, img_id, x, y, {', '.join(cols)}, {byte(alpha, 'a')} from {OVER}"


PORTER = {
    "clear": ("0", "0"), "src": ("1", "0"), "dst": ("0", "1"), "src_over": ("1", "1 - sa"), "dst_over": ("1 - da", "1"),
    "src_in": ("da", "0"), "dst_in": ("0", "sa"), "src_out": ("1 - da", "0"), "dst_out": ("0", "1 - sa"),
    "src_atop": ("da", "1 - sa"), "dst_atop": ("1 - da", "sa"), "xor": ("1 - da", "1 - sa"),
}


def run_ops(v, ops):
    out = [rgba(blend.composite(premultiplied(v), sources(v), op, dx=DX, dy=DY), F.lit(op).alias("op")) for op in ops]
    return reduce(DataFrame.unionByName, out)


@query("r18_composite_porter_duff", " union all ".join(op_sql(o, f"{{s}} * ({fs}) + {{d}} * ({fd})", f"sa * ({fs}) + da * ({fd})") for o, (fs, fd) in PORTER.items()))
def _(v):
    return run_ops(v, PORTER)


HARD = "(sa * da - 2 * (da - {d}) * (sa - {s}))"
ONE = "(case when {0} = 0 then 1 else {0} end)"
M = "({d} / " + ONE.format("da") + ")"
BLENDS = {
    "plus": "{s} + {d}", "minus": "{d} - {s}", "multiply": "{s} * {d} + {rest}", "screen": "{s} + {d} - {s} * {d}",
    "overlay": "case when 2 * {d} <= da then 2 * {s} * {d} else " + HARD + " end + {rest}",
    "darken": "least({s} * da, {d} * sa) + {rest}", "lighten": "greatest({s} * da, {d} * sa) + {rest}",
    "color_dodge": "case when {s} * da + {d} * sa >= sa * da then sa * da else {d} * sa / " + ONE.format("(1 - {s} / " + ONE.format("sa") + ")") + " end + {rest}",
    "color_burn": "case when {s} * da + {d} * sa <= sa * da then 0 else sa * ({s} * da + {d} * sa - sa * da) / " + ONE.format("{s}") + " end + {rest}",
    "hard_light": "case when 2 * {s} <= sa then 2 * {s} * {d} else " + HARD + " end + {rest}",
    "soft_light": "{d} * sa + case when 2 * {s} <= sa then {d} * (2 * {s} - sa) * (1 - M) when 4 * {d} <= da then da * (2 * {s} - sa) * (((16 * M - 12) * M + 3) * M) else da * (2 * {s} - sa) * (sqrt(M) - M) end + {rest}".replace("M", M),
    "difference": "{s} + {d} - 2 * least({s} * da, {d} * sa)", "exclusion": "{s} * da + {d} * sa - 2 * {s} * {d} + {rest}",
}
UNION_ALPHA = "sa + da - sa * da"


@query("r19_composite_blend", " union all ".join(op_sql(o, f, "sa + da" if o == "plus" else UNION_ALPHA) for o, f in BLENDS.items()))
def _(v):
    return run_ops(v, BLENDS)


def plain(formula):
    return "sa * da * least(greatest(" + formula.replace("S", "({s} / " + ONE.format("sa") + ")").replace("D", M) + ", 0), 1) + {rest}"


ARITHS = {
    "contrast": "least(greatest(({d} - da / 2) * (2 * {s} - sa + 1) + da / 2, 0), da)", "invert": "(da - {d}) * sa + {d} * (1 - sa)",
    "invert-rgb": "(da - {d}) * {s} + {d} * (1 - sa)", "grain_merge": plain("D + S - 0.5e0"), "grain_extract": plain("D - S + 0.5e0"),
    "linear_dodge": plain("D + S"), "linear_burn": plain("D + S - 1"),
    "divide": plain("(case when S = 0 then 1 else D / (case when S = 0 then 1 else S end) end)"),
}


@query("r20_composite_arith", " union all ".join(op_sql(o, f, "da" if o == "contrast" else UNION_ALPHA) for o, f in ARITHS.items()))
def _(v):
    return run_ops(v, ARITHS)


def hsl_sql(r, g, b, source, keep):
    """Hue, saturation and lightness of channels in 0..1."""
    return f"""(select {keep}, case when top = low then 0e0 else (case when turn < 0 then turn + 6 else turn end) / 6e0 end as h,
  case when top = low then 0e0 else (top - low) / least(top + low, 2 - (top + low)) end as s, (top + low) / 2 as l
  from (select *, case when top = {r} then ({g} - {b}) / (top - low) when top = {g} then 2 + ({b} - {r}) / (top - low) else 4 + ({r} - {g}) / (top - low) end as turn
    from (select *, greatest({r}, {g}, {b}) as top, least({r}, {g}, {b}) as low from {source})))"""


def rgb_sql(source, keep, h="h", s="s", light="l"):
    ring = lambda shift: f"({h} {shift} + case when {h} {shift} < 0 then 1e0 when {h} {shift} > 1 then -1e0 else 0e0 end)"

    def ch(t):
        foot = f"(case when {t} < 0.5e0 then {t} when {t} < 2e0 / 3e0 then {blend.TWO_THIRDS}e0 - {t} else 0e0 end)"
        v = f"(case when {t} >= 1e0 / 6e0 and {t} < 0.5e0 then {light} + swing else {light} - swing + (({light} + swing) - ({light} - swing)) * {foot} * 6 end)"
        return f"cast(case when {s} = 0 then floor({light} * 255e0 + 0.5e0) else greatest(floor({v} * 255e0), 0) end as integer)"

    return f"""(select {keep}, {ch('t0')} as r, {ch('t1')} as g, {ch('t2')} as b from (
  select *, {ring(f'+ {blend.THIRD}e0')} as t0, {ring('+ 0e0')} as t1, {ring(f'- {blend.THIRD}e0')} as t2, {s} * least({light}, 1e0 - {light}) as swing from {source}))"""


UNIT = "(select img_id, x, y, a, r / 255e0 as r, g / 255e0 as g, b / 255e0 as b from px)"


@query("r23_rgb2hsl", f"select img_id, x, y, round(h, 9) as h, round(s, 9) as s, round(l, 9) as l from {hsl_sql('r', 'g', 'b', UNIT, 'img_id, x, y')}")
def _(v):
    return blend.rgb2hsl(v.px).select("img_id", "x", "y", *[F.round(c, 9).alias(c) for c in "hsl"])


COLOURS = "(select img_id, x, y, a, r / 255e0 as h, g / 255e0 as s, b / 255e0 as l from px)"


@query("r23_hsl2rgb", f"select img_id, x, y, r, g, b, a from {rgb_sql(COLOURS, 'img_id, x, y, a')}")
def _(v):
    hsl = v.px.select("img_id", "x", "y", "a", *[(F.col(c) / 255.0).alias(n) for c, n in zip("rgb", "hsl")])
    return rgba(blend.hsl2rgb(hsl))


@query("r24_tint", f"""
select img_id, x, y, case when a > 1 then r else r0 end as r, case when a > 1 then g else g0 end as g, case when a > 1 then b else b0 end as b, a from {rgb_sql(
    "(select img_id, x, y, r0, g0, b0, a, least(greatest(0.1e0 + h * 0.5e0, 0), 1) as h, least(greatest(0.2e0 + s * 0.7e0, 0), 1) as s, least(greatest(0.9e0 + l * (-0.8e0), 0), 1) as l from "
    + hsl_sql('r', 'g', 'b', "(select img_id, x, y, r as r0, g as g0, b as b0, r/255e0 as r, g/255e0 as g, b/255e0 as b, cast(least(greatest(floor((0.1e0 + a / 255e0 * 0.8e0) * 255 + 0.5e0), 0), 255) as integer) as a from px)", "img_id, x, y, r0, g0, b0, a") + ")",
    "img_id, x, y, a, r0, g0, b0")}""")
def _(v):
    return rgba(blend.tint(v.px, h=(0.1, 0.6), s=(0.2, 0.9), l=(0.9, 0.1), a=(0.1, 0.9)))


KEPT = "img_id, x, y, hit, dr0, dg0, db0, da0, dr, dg, db, da, sr, sg, sb, sa"
PLAIN = f"""(select *, {', '.join(f"least(s{c} / {ONE.format('sa')}, 1) * 255 / 255e0 as p{c}, least(d{c} / {ONE.format('da')}, 1) * 255 / 255e0 as q{c}" for c in 'rgb')} from {OVER})"""
SRC_HSL = f"(select *, h as sh, s as ss from {hsl_sql('pr', 'pg', 'pb', PLAIN, KEPT + ', qr, qg, qb')})"
BOTH_HSL = hsl_sql("qr", "qg", "qb", SRC_HSL, KEPT + ", sh, ss")


def hsl_op_sql(op):
    h, s = ("sh" if op in ("hue", "color") else "h"), ("ss" if op in ("saturation", "color") else "s")
    source = rgb_sql(f"(select {KEPT}, {h} as h, {s} as s, l from {BOTH_HSL})", KEPT)
    mixed = lambda c: f"sa * da * ({c} / 255e0) + s{c} * (1 - da) + d{c} * (1 - sa)"
    byte = lambda e, c: f"cast(case when hit is null then d{c}0 else least(greatest(floor(round(({e}) * 255, 6) + 0.5e0), 0), 255) end as integer) as {c}"
    return f"select '{op}' as op, img_id, x, y, {', '.join(byte(mixed(c), c) for c in 'rgb')}, {byte(UNION_ALPHA, 'a')} from {source}"


@query("r21_composite_hsl", " union all ".join(hsl_op_sql(o) for o in blend.HSL_OPS))
def _(v):
    return run_ops(v, blend.HSL_OPS)


def stack(v):
    """Every image is a layer of one of four canvases, moved by up to one cell."""
    return v.px.select((F.col("img_id") % 4).alias("canvas_id"), F.expr("cast(img_id div 4 as int)").alias("ord"), (F.col("img_id") % 3 - 1).alias("off_x"),
                       (F.col("img_id") % 2).alias("off_y"), "x", "y", "r", "g", "b", F.when(F.col("img_id") % 5 == 4, 255).otherwise(F.col("a")).alias("a"))


def mix_sql(shift):
    return f"(((((s >> {shift}) & 255) * WS + ((t >> {shift}) & 255) * WT) // greatest(WS + WT, 1)) << {shift})"


FOLD = f"case when (s >> 24) = 0 then t when (s >> 24) = 255 or (t >> 24) = 0 then s else (((WS + WT) // 256) << 24) | {mix_sql(16)} | {mix_sql(8)} | {mix_sql(0)} end"
FOLD = FOLD.replace("WS", "((s >> 24) * 256)").replace("WT", "(((t >> 24) & 255) * (256 - (s >> 24)))")


@query("r22_blend_stack", f"""
with c as (select img_id % 4 as canvas_id, img_id // 4 as ord, x + img_id % 3 - 1 as x, y + img_id % 2 as y, (cast(case when img_id % 5 = 4 then 255 else a end as bigint) << 24) | (cast(b as bigint) << 16) | (cast(g as bigint) << 8) | r as p from px),
f as (select canvas_id, x, y, list_reduce(list(p order by ord), lambda t, s: {FOLD}, cast(4278190335 as bigint)) as p from c where x between 0 and 7 and y between 0 and 7 group by 1, 2, 3),
k as (select k.canvas_id, xs.x, ys.y from (select distinct canvas_id from c) k, (select unnest(range(8)) as x) xs, (select unnest(range(8)) as y) ys),
o as (select k.canvas_id, k.x, k.y, coalesce(f.p, 4278190335) as p from k left join f on f.canvas_id = k.canvas_id and f.x = k.x and f.y = k.y)
select cast(canvas_id as integer) as canvas_id, cast(x as integer) as x, cast(y as integer) as y, cast(p & 255 as integer) as r, cast((p >> 8) & 255 as integer) as g, cast((p >> 16) & 255 as integer) as b, cast((p >> 24) & 255 as integer) as a from o""")
def _(v):
    return blend.blend_stack(stack(v), 8, 8, matte=0xFF0000FF).select("canvas_id", "x", "y", "r", "g", "b", "a")


PALETTE = [(0, 0, 0, 255), (255, 255, 255, 255), (255, 0, 0, 255), (0, 128, 0, 255), (0, 0, 255, 128), (128, 128, 128, 64), (200, 180, 40, 0)]


@query("r25_palette_map", f"""
with pal as (select * from (values {', '.join(str((i, *p)) for i, p in enumerate(PALETTE))}) t(i, pr, pg, pb, pa)),
c as (select img_id, x, y, i, pr, pg, pb, pa, row_number() over (partition by img_id, x, y order by (r-pr)*(r-pr) + (g-pg)*(g-pg) + (b-pb)*(b-pb) + (a-pa)*(a-pa), i) as k from px, pal)
select img_id, x, y, i as palette_index, pr as r, pg as g, pb as b, pa as a from c where k = 1""")
def _(v):
    return blend.palette_map(v.px, PALETTE)


# nodes of all levels of a colour octree; the last level of at most N nodes, its fullest nodes split while N colours last
OCTREE = """
with o as (select l, r >> (8 - l) as nr, g >> (8 - l) as ng, b >> (8 - l) as nb, count(*) as cells, sum(px.r) as sr, sum(px.g) as sg, sum(px.b) as sb, sum(px.a) as sa
  from px, (select unnest(range(9)) as l) group by 1, 2, 3, 4),
lv as (select l, count(*) as nodes from o group by l),
cut as (select max(l) as d from lv where nodes <= N),
par as (select p.*, (select count(*) from o c where c.l = p.l + 1 and c.nr >> 1 = p.nr and c.ng >> 1 = p.ng and c.nb >> 1 = p.nb) as kids from o p, cut where p.l = cut.d),
ranked as (select *, coalesce(sum(kids - 1) over (order by cells, nr, ng, nb rows between unbounded preceding and 1 preceding), 0) as saved from par),
whole as (select *, l = 8 or saved < (select nodes from lv, cut where lv.l = cut.d + 1) - N as w from ranked),
leaf as (select cells, sr, sg, sb, sa from whole where w union all
  select c.cells, c.sr, c.sg, c.sb, c.sa from o c join whole p on c.l = p.l + 1 and c.nr >> 1 = p.nr and c.ng >> 1 = p.ng and c.nb >> 1 = p.nb where not p.w)
"""
MEANS = ", ".join(f"cast(floor(s{c}::double / cells + 0.5e0) as integer) as {c}" for c in "rgba")


@query("r26_palette_of", OCTREE.replace("N", "16") + f"select {MEANS}, cells from leaf")
def _(v):
    return blend.palette_of(v.px, 16)


@query("r26_palette_of_200", OCTREE.replace("N", "200") + f"select {MEANS}, cells from leaf")
def _(v):
    return blend.palette_of(v.px, 200)


@query("r27_pack_rgba", """
select img_id, x, y, cast(a as bigint) * 16777216 + b * 65536 + g * 256 + r as rgba,
  '#' || printf('%02x', r) || printf('%02x', g) || printf('%02x', b) || case when a = 255 then '' else printf('%02x', a) end as hex from px""")
def _(v):
    return blend.to_hex(blend.pack_rgba(v.px)).select("img_id", "x", "y", "rgba", "hex")


@query("r27_unpack_rgba", "select img_id, x, y, r, g, b, a from px")
def _(v):
    only = blend.pack_rgba(v.px).select("img_id", "x", "y", "rgba")
    return rgba(blend.unpack_rgba(only))


@query("r29_painted", "select img_id, max(v) <> 0 as painted from (select img_id, case when img_id % 4 = 0 then 0 else v end as v from g8) group by 1")
def _(v):
    return raster.painted(v.gray8.withColumn("v", F.when(F.col("img_id") % 4 == 0, F.lit(0).cast("bigint")).otherwise(F.col("v"))))


@query("r30_feature_raster", f"""
select cast(0 as bigint) as img_id, x, y, max_by(fid * 2e0, fid) as v from (select fid, x, y from {LINE_CELLS} where x between 0 and 63 and y between 0 and 31) group by x, y""")
def _(v):
    return raster.feature_raster(v.ln_lines.withColumn("twice", F.col("fid") * 2.0), WORLD, "twice")
