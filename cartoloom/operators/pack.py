"""Tile geometry commands and dictionary-encoded tile layers."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions import geom as g
from ..functions import skew
from . import chains, packs
from .tiles import TILE

# Command numbers of the tile geometry encoding.
MOVE_TO, LINE_TO, CLOSE_PATH = 1, 2, 7


def _command(cmd, count):
    return F.array((F.lit(cmd).cast("bigint").bitwiseOR(F.shiftleft(count.cast("bigint"), 3))))


def _zigzag(v):
    v = v.cast("bigint")
    return F.shiftleft(v, 1).bitwiseXOR(F.shiftright(v, 63))


def _unzigzag(v):
    return F.shiftright(v, 1).bitwiseXOR(-(v.bitwiseAND(F.lit(1).cast("bigint"))))


def _path(ring, before, kind):
    """Commands of one vertex array whose cursor starts at ``before``."""
    points = F.slice(ring, 1, F.size(ring) - 1) if kind == "ring" else ring
    return g.let(points, lambda p: _drawn(p, before, kind))


def _drawn(points, before, kind):
    prev = F.concat(F.array(before), F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))))
    deltas = F.zip_with(points, prev, lambda p, q: F.array(_zigzag(p["x"] - q["x"]), _zigzag(p["y"] - q["y"])))
    none = F.expr("cast(array() as array<bigint>)")
    closing = _command(CLOSE_PATH, F.lit(1)) if kind == "ring" else none

    def stream(d):
        drawn = F.when(F.size(d) > 1, F.concat(_command(LINE_TO, F.size(d) - 1), F.flatten(F.slice(d, 2, F.size(d) - 1)))).otherwise(none)
        return F.concat(_command(MOVE_TO, F.lit(1)), d[0], drawn, closing)

    return g.let(deltas, stream)


def commands(geom):
    """MoveTo / LineTo / ClosePath integers with zig-zag deltas.

    The cursor runs on from path to path; a closed ring leaves it on its last
    vertex before the closing one.
    """
    c = g.col(geom)
    rings = F.flatten(c["parts"])
    origin = g.vertex(F.lit(0.0), F.lit(0.0))
    vs = g.vertices(c)
    prev = F.concat(F.array(origin), F.slice(vs, 1, F.greatest(F.size(vs) - 1, F.lit(0))))
    multi = F.concat(
        _command(MOVE_TO, F.size(vs)),
        F.flatten(F.zip_with(vs, prev, lambda p, q: F.array(_zigzag(p["x"] - q["x"]), _zigzag(p["y"] - q["y"])))),
    )

    def paths(kind):
        back = 2 if kind == "ring" else 1
        before = lambda i: F.when(i == 0, origin).otherwise(F.try_element_at(F.get(rings, i - 1), F.lit(-back)))
        return F.flatten(F.transform(rings, lambda r, i: _path(r, before(i), kind)))

    return (
        F.when(c["type"].isin(g.POINT, g.MULTIPOINT), multi)
        .when(c["type"].isin(g.LINE, g.MULTILINE), paths("line"))
        .when(c["type"].isin(g.POLYGON, g.MULTIPOLYGON), paths("ring"))
    )


def geometry_commands(df, geom="tgeom"):
    return df.withColumn("commands", commands(geom))


_HEADERS = "named_struct('i', 0, 'next', 0, 'seen', 0, 'found', cast(array() as array<struct<cmd:bigint,at:int,count:int,seen:int>>))"


def _headers(cmds):
    """Commands of a stream with the place of their first parameter, their count and the vertices before them.

    Parameters are stepped over; a stream that ends early has no more vertices than it has pairs for.
    """
    def step(s, c):
        cmd = c.bitwiseAND(F.lit(7).cast("bigint"))
        count = F.when(cmd == CLOSE_PATH, 0).otherwise(F.least(F.shiftright(c, 3).cast("int"), F.floor((F.size(cmds) - s["i"] - 1) / 2).cast("int")))
        held = F.struct(cmd.alias("cmd"), (s["i"] + 1).alias("at"), count.alias("count"), s["seen"].alias("seen"))
        here = F.struct((s["i"] + 1).alias("i"), (s["i"] + 1 + 2 * count).alias("next"), (s["seen"] + count).alias("seen"), F.concat(s["found"], F.array(held)).alias("found"))
        return F.when(s["i"] == s["next"], here).otherwise(F.struct((s["i"] + 1).alias("i"), s["next"].alias("next"), s["seen"].alias("seen"), s["found"].alias("found")))

    return F.aggregate(cmds, F.expr(_HEADERS), step, lambda s: s["found"])


def _running_sums(vs):
    """Vertices from their deltas: sums over 1, 2, 4 ... neighbours, so a vertex is added up in few rounds."""
    def double(own, k):
        reach = F.pow(F.lit(2), k).cast("int")

        def add(v, i):
            before = F.get(own, i - reach)
            return F.struct((v["x"] + F.coalesce(before["x"], F.lit(0))).alias("x"), (v["y"] + F.coalesce(before["y"], F.lit(0))).alias("y"))

        return F.transform(own, add)

    rounds = F.when(F.size(vs) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(vs))).cast("int") - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(rounds, vs, double)


def decode_commands(cmds, gtype):
    """Geometry struct from a command array; the work grows with its length, not with its square."""
    def rings_of(heads):
        def deltas(h):
            at = F.when(h["count"] > 0, F.sequence(F.lit(0), h["count"] - 1)).otherwise(F.expr("cast(array() as array<int>)"))
            pair = lambda k: F.struct(_unzigzag(F.get(cmds, h["at"] + 2 * k)).alias("x"), _unzigzag(F.get(cmds, h["at"] + 2 * k + 1)).alias("y"))
            return F.transform(at, pair)

        starts = F.flatten(F.transform(F.filter(heads, lambda h: (h["cmd"] == MOVE_TO) & (h["count"] > 0)), lambda h: F.sequence(h["seen"], h["seen"] + h["count"] - 1)))
        closes = F.transform(F.filter(heads, lambda h: h["cmd"] == CLOSE_PATH), lambda h: h["seen"])
        vs = F.transform(_running_sums(F.flatten(F.transform(heads, deltas))), lambda v: g.vertex(v["x"], v["y"]))

        def ring(own, at, ended):
            def one(i, k):
                end = F.coalesce(F.get(at, k + 1), F.size(own))
                body = F.slice(own, i + 1, end - i)
                return F.when(F.array_contains(ended, end), F.concat(body, F.slice(body, 1, 1))).otherwise(body)

            return F.transform(at, one)

        return g.let(vs, lambda own: g.let(starts, lambda at: g.let(F.array_distinct(closes), lambda ended: ring(own, at, ended))))

    rings = g.let(_headers(cmds), rings_of)
    one_each = F.transform(rings, lambda r: F.array(r))
    polys = g.runs(rings, lambda r, before: g.ring_area(r) > 0, lambda run: run)
    pick = lambda parts, one, many: g.let(parts, lambda p: g.geometry(F.when(F.size(p) == 1, one).otherwise(many), p))
    return (
        F.when(gtype == 1, pick(one_each, g.POINT, g.MULTIPOINT)).when(gtype == 2, pick(one_each, g.LINE, g.MULTILINE))
        .when(gtype == 3, pick(polys, g.POLYGON, g.MULTIPOLYGON))
    )


def pack_tiles(tiles, per_row=10_000, prop_types=None, extent=4096, version=2):
    """One row per tile layer: key and value dictionaries, and features with index pairs.

    A layer above ``per_row`` features takes several rows (``part``), each with
    its own dictionaries, so no array grows with the data. ``prop_types`` gives
    the value kind of a key (string, double, bigint, boolean), string otherwise.
    Features are numbered, shuffled once by part and sorted there; a part is
    packed as it passes, so a task holds one part and not all of its own.
    """
    keys = [*TILE, "layer", "part"]
    # a feature id may repeat inside a layer, so features are told apart by position
    order = ["fid", F.col("props").cast("string"), F.xxhash64("tgeom")]
    rows = skew.group_position(tiles, [*TILE, "layer"], order, "_n").withColumn("part", F.floor(F.col("_n") / per_row))
    held = rows.select(*keys, "_n", "layer_ord", "fid", "gtype", commands("tgeom").alias("geometry"), F.map_keys("props").alias("_k"), F.map_values("props").alias("_t"))
    chains.bound_batches(tiles.sparkSession)
    types = {f.name: f.dataType for f in held.schema}
    feature = StructType([StructField("id", types["fid"]), StructField("type", types["gtype"]), StructField("tags", ArrayType(IntegerType())), StructField("geometry", types["geometry"])])
    value = StructType([StructField("kind", StringType()), StructField("text", StringType())])
    out = StructType([*[StructField(k, types[k]) for k in (*keys, "layer_ord")], StructField("keys", ArrayType(StringType())), StructField("values", ArrayType(value)), StructField("features", ArrayType(feature))])
    layers = held.repartition(*keys).sortWithinPartitions(*keys, "_n").mapInArrow(packs.in_parts(out.names, len(keys), per_row, prop_types or {}), out)
    return layers.select(*keys, "layer_ord", F.lit(extent).alias("extent"), F.lit(version).alias("version"), "keys", "values", "features")


def unpack_tiles(packed, decode_geometry=True):
    """Packed rows to tile features; index pairs outside the dictionaries are skipped."""
    def attributes(tags, words):
        pairs = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(tags) / 2).cast("int") - 1),
            lambda i: F.struct(F.get(words["keys"], F.get(tags, i * 2)).alias("k"), F.get(words["values"], F.get(tags, i * 2 + 1))["text"].alias("v")),
        )
        pairs = F.when(F.size(tags) > 1, F.filter(pairs, lambda p: p["k"].isNotNull() & p["v"].isNotNull()))
        return F.coalesce(F.map_from_entries(pairs), F.expr("cast(map() as map<string,string>)"))

    # looked up before the features are spread, so that no feature's row carries its layer's dictionaries
    named = lambda f, words: F.struct(f["id"].alias("fid"), f["type"].alias("gtype"), attributes(f["tags"], words).alias("props"), f["geometry"].alias("commands"))
    whole = g.let(F.struct("keys", "values"), lambda words: F.transform("features", lambda f: named(f, words)))
    rows = packed.select(*TILE, "layer", "layer_ord", whole.alias("_f")).select(*TILE, "layer", "layer_ord", F.explode("_f").alias("f"))
    rows = rows.select(*TILE, "layer", "layer_ord", "f.*")
    if not decode_geometry:
        return rows
    return rows.withColumn("tgeom", decode_commands(F.col("commands"), F.col("gtype"))).drop("commands")
