"""Spatial views derived from the driver's tables, in Spark and as SQL for the checks.

The tables carry no geometry, so positions come from integer keys. Coordinates
end in a half step and so never sit on a whole-degree edge.
"""

from functools import cached_property

from pyspark.sql import functions as F

from ..functions import geom as g
from ..operators import project, tiles
from ..sources import readers

LAYERS = ("click", "error", "purchase", "signup", "view")

SQL_VIEWS = {
    "ev": """
select event_id as fid, event_type, value, list_position(['click','error','purchase','signup','view'], event_type) - 1 as layer_ord,
  cast((event_id*104729 + user_id*7919) % 36000 as double)/100 - 179.995e0 as lon,
  cast((event_id*15485863 + user_id*32452843) % 17000 as double)/100 - 84.995e0 as lat from events""",
    "evm": """
select *, lon * (20037508.342789244e0/180) as mx, ln(tan((lat + 90) * (pi()/360))) * 6378137e0 as my from ev""",
    "np": """
select n_nationkey as fid, n_name as name, n_regionkey as region,
  cast(-180 + 72*(n_nationkey % 5) as double) as minx, cast(-85 + 34*floor(n_nationkey/5) as double) as miny,
  cast(-108 + 72*(n_nationkey % 5) as double) as maxx, cast(-51 + 34*floor(n_nationkey/5) as double) as maxy from nation""",
    "npm": """
select fid, name, region, minx * (20037508.342789244e0/180) as minx, ln(tan((miny + 90) * (pi()/360))) * 6378137e0 as miny,
  maxx * (20037508.342789244e0/180) as maxx, ln(tan((maxy + 90) * (pi()/360))) * 6378137e0 as maxy from np""",
    "ln": """
select fid, lon, lat, row_number() over (partition by fid order by l_linenumber, lon, lat) - 1 as seq, count(*) over (partition by fid) as n
from (select l_orderkey as fid, l_linenumber, cast((l_partkey*7919) % 36000 as double)/100 - 179.995e0 as lon,
  cast((l_suppkey*104729 + l_partkey*31) % 17000 as double)/100 - 84.995e0 as lat from lineitem)""",
    "lnm": """
select *, lon * (20037508.342789244e0/180) as mx, ln(tan((lat + 90) * (pi()/360))) * 6378137e0 as my from ln""",
    # segments of the lines, and of the rings that close each order's line
    "sg": """
select * from (select fid, seq, n, lon as ax, lat as ay, lead(lon) over w as ex, lead(lat) over w as ey from ln
  window w as (partition by fid order by seq)) where ex is not null""",
    "rg": """
select fid, seq, n, ax, ay, ex, ey from sg union all
select a.fid, a.seq, a.n, a.lon, a.lat, b.lon, b.lat from ln a join ln b on a.fid = b.fid where a.seq = a.n - 1 and b.seq = 0""",
    "qp": """
select c_custkey as pid, cast((c_custkey*104729) % 36000 as double)/100 - 179.995e0 as lon,
  cast((c_custkey*32452843) % 17000 as double)/100 - 84.995e0 as lat from customer""",
    "qpm": """
select *, lon * (20037508.342789244e0/180) as mx, ln(tan((lat + 90) * (pi()/360))) * 6378137e0 as my from qp""",
    "ly": """
select n_name as layer, n_nationkey as ord, n_regionkey * 1000e0 as min_sd, (n_regionkey + 1 + n_nationkey % 3) * 1000e0 as max_sd,
  n_nationkey % 3 <> 0 as active, n_nationkey % 2 = 0 as queryable from nation""",
    "vw": """
select fid as view_id, 256 * (1 + fid % 3) as width, 256 * (1 + fid % 2) as height, minx, miny, maxx, maxy from np""",
    # point features cut into the tiles of zoom 2
    "tf": """
select 2 as z, cast(xs.x as integer) as x, cast(ys.y as integer) as y, event_type as layer, layer_ord, fid, event_type, value,
  cast(floor((u - xs.x) * 4096 + 0.5e0) as bigint) as tx, cast(floor((v - ys.y) * 4096 + 0.5e0) as bigint) as ty
from (select *, (mx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4 as u, (20037508.342789244e0 - my) / (2*20037508.342789244e0) * 4 as v from evm) p
join (select unnest(range(4)) as x) xs on xs.x between floor(u - 0.03125e0) and floor(u + 0.03125e0)
join (select unnest(range(4)) as y) ys on ys.y between floor(v - 0.03125e0) and floor(v + 0.03125e0)""",
    # polygon boxes cut into the tiles of zoom 2, in tile coordinates
    "tb": """
select *, greatest(qx0, -128) as cx0, least(qx1, 4224) as cx1, greatest(qy0, -128) as cy0, least(qy1, 4224) as cy1 from (
select 2 as z, cast(xs.x as integer) as x, cast(ys.y as integer) as y, fid, name, region,
  floor((u0 - xs.x) * 4096 + 0.5e0) as qx0, floor((u1 - xs.x) * 4096 + 0.5e0) as qx1,
  floor((v0 - ys.y) * 4096 + 0.5e0) as qy0, floor((v1 - ys.y) * 4096 + 0.5e0) as qy1
from (select *, (minx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4 as u0, (maxx + 20037508.342789244e0) / (2*20037508.342789244e0) * 4 as u1,
  (20037508.342789244e0 - maxy) / (2*20037508.342789244e0) * 4 as v0, (20037508.342789244e0 - miny) / (2*20037508.342789244e0) * 4 as v1 from npm) p
join (select unnest(range(4)) as x) xs on xs.x between floor(u0 - 0.03125e0) and floor(u1 + 0.03125e0)
join (select unnest(range(4)) as y) ys on ys.y between floor(v0 - 0.03125e0) and floor(v1 + 0.03125e0))""",
    "px": """
select p_partkey % 64 % 8 as x, cast(floor(p_partkey % 64 / 8) as int) as y, cast(floor(p_partkey/64) as int) as img_id,
  (p_size*5) % 256 as r, (p_partkey*37) % 256 as g, (p_partkey*p_size) % 256 as b, (p_partkey*101) % 256 as a from part""",
    # the same images, premultiplied, and a second set of sources made from them
    "pm": """
select img_id, x, y, (2*r*a + 255) // 510 as r, (2*g*a + 255) // 510 as g, (2*b*a + 255) // 510 as b, a from px""",
    "ps": """
select img_id, 7 - x as x, y, b as r, r as g, g as b, a from pm""",
    "gy": """
select vec_id as img_id, i % 8 as x, cast(floor(i / 8) as int) as y, cast(embedding[i + 1] as double) as v
from embeddings, (select unnest(range(64)) as i)""",
    "g8": """
select img_id, x, y, cast(floor((v + 1) * 100) as bigint) as v from gy""",
}


class Views:
    """The derived tables of one data folder."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name):
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def ev(self):
        return self.table("events").select(
            F.col("event_id").alias("fid"), "event_type", "value",
            (F.expr("cast((event_id*104729 + user_id*7919) % 36000 as double)/100") - 179.995).alias("lon"),
            (F.expr("cast((event_id*15485863 + user_id*32452843) % 17000 as double)/100") - 84.995).alias("lat"),
        )

    def _points(self, df, x, y):
        names = F.array(*[F.lit(n) for n in LAYERS])
        rows = readers.read_features(df.select("fid", "event_type", "value", x, y), x, y, "fid")
        return rows.withColumns({"layer": F.col("event_type"), "layer_ord": (F.array_position(names, F.col("event_type")) - 1).cast("int")})

    @cached_property
    def ev_points(self):
        """Point features in longitude/latitude, one layer per event type."""
        return self._points(self.ev, "lon", "lat")

    @cached_property
    def ev_merc(self):
        return self._points(project.forward(self.ev, x="mx", y="my"), "mx", "my")

    @cached_property
    def np_boxes(self):
        k = F.col("n_nationkey")
        left, low = (F.lit(-180) + k % 5 * 72).cast("double"), (F.lit(-85) + F.floor(k / 5) * 34).cast("double")
        return self.table("nation").select(
            k.cast("bigint").alias("fid"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"),
            left.alias("minx"), low.alias("miny"), (left + 72).alias("maxx"), (low + 34).alias("maxy"),
        )

    def _boxes(self, df):
        return df.select(
            F.lit("nation").alias("layer"), F.lit(0).alias("layer_ord"), "fid", "name", "region",
            g.polygon(g.box_ring(*g.BOX)).alias("geom"), *g.BOX,
        )

    @cached_property
    def np_polys(self):
        """25 rectangles that tile the world, in longitude/latitude."""
        return self._boxes(self.np_boxes)

    @cached_property
    def np_merc(self):
        return self._boxes(project.forward_box(self.np_boxes))

    @cached_property
    def order_vertices(self):
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("fid"), "l_linenumber",
            (F.expr("cast((l_partkey*7919) % 36000 as double)/100") - 179.995).alias("lon"),
            (F.expr("cast((l_suppkey*104729 + l_partkey*31) % 17000 as double)/100") - 84.995).alias("lat"),
        )

    def _order_shapes(self, layer, shape):
        # an order has few lines, so one array per order stays small
        rows = self.order_vertices.groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "lon", "lat"))).alias("v"))
        rows = rows.withColumn("v", F.transform("v", lambda s: g.vertex(s["lon"], s["lat"])))
        rows = rows.select(F.lit(layer).alias("layer"), F.lit(0).alias("layer_ord"), "fid", shape(F.col("v")).alias("geom"))
        return g.with_bounds(rows)

    @cached_property
    def ln_lines(self):
        """One line per order, in longitude/latitude."""
        return self._order_shapes("lines", g.line)

    @cached_property
    def ln_merc(self):
        return project.reproject(self.ln_lines, 4326, 3857)

    @cached_property
    def pg_polys(self):
        """One closed ring per order; most rings cross themselves."""
        return self._order_shapes("rings", lambda v: g.polygon(F.concat(v, F.slice(v, 1, 1))))

    @cached_property
    def query_points(self):
        return self.table("customer").select(
            F.col("c_custkey").alias("pid"), (F.expr("cast((c_custkey*104729) % 36000 as double)/100") - 179.995).alias("lon"),
            (F.expr("cast((c_custkey*32452843) % 17000 as double)/100") - 84.995).alias("lat"),
        )

    @cached_property
    def layers(self):
        k, r = F.col("n_nationkey"), F.col("n_regionkey")
        return self.table("nation").select(
            F.col("n_name").alias("layer"), k.alias("ord"), (r * 1000.0).alias("min_sd"), ((r + 1 + k % 3) * 1000.0).alias("max_sd"),
            (k % 3 != 0).alias("active"), (k % 2 == 0).alias("queryable"),
        )

    @cached_property
    def viewports(self):
        return self.np_boxes.select(
            F.col("fid").alias("view_id"), ((1 + F.col("fid") % 3) * 256).cast("int").alias("width"),
            ((1 + F.col("fid") % 2) * 256).cast("int").alias("height"), *g.BOX,
        )

    @cached_property
    def tiles2(self):
        """Point features cut into the tiles of zoom 2."""
        return tiles.tile_from_features(self.ev_merc, 2)

    @cached_property
    def nation_tiles2(self):
        return tiles.tile_from_features(self.np_merc, 2)

    @cached_property
    def px(self):
        return self.table("part").select(
            F.expr("cast(p_partkey % 64 % 8 as int)").alias("x"), F.expr("cast(floor(p_partkey % 64 / 8) as int)").alias("y"),
            F.expr("cast(floor(p_partkey / 64) as int)").alias("img_id"),
            F.expr("cast((p_size*5) % 256 as int)").alias("r"), F.expr("cast((p_partkey*37) % 256 as int)").alias("g"),
            F.expr("cast((p_partkey*p_size) % 256 as int)").alias("b"), F.expr("cast((p_partkey*101) % 256 as int)").alias("a"),
        )

    @cached_property
    def gray(self):
        """8 x 8 gray images from the embeddings."""
        cells = self.table("embeddings").select(F.col("vec_id").alias("img_id"), F.posexplode("embedding").alias("i", "v"))
        return cells.select("img_id", (F.col("i") % 8).alias("x"), F.floor(F.col("i") / 8).cast("int").alias("y"), F.col("v").cast("double").alias("v"))

    @cached_property
    def gray8(self):
        return self.gray.withColumn("v", F.floor((F.col("v") + 1) * 100))
