"""Compositing, blending and colour conversion."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import skew
from .raster import RGBA, byte

# --- packed colours -------------------------------------------------------------------------------


def packed(r="r", g="g", b="b", a="a"):
    big = lambda c: F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")
    return F.shiftleft(big(a), 24).bitwiseOR(F.shiftleft(big(b), 16)).bitwiseOR(F.shiftleft(big(g), 8)).bitwiseOR(big(r))


def _channel(p, shift):
    return F.shiftright(p, shift).bitwiseAND(F.lit(255).cast("bigint"))


def pack_rgba(df, name="rgba"):
    """``a<<24 | b<<16 | g<<8 | r``."""
    return df.withColumn(name, packed())


def unpack_rgba(df, name="rgba"):
    return df.withColumns({c: _channel(F.col(name), s).cast("int") for c, s in zip(RGBA, (0, 8, 16, 24))})


def to_hex(df, name="hex"):
    """``#rrggbb``, with the alpha appended when not opaque."""
    two = lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")
    rgb = F.concat(F.lit("#"), two("r"), two("g"), two("b"))
    return df.withColumn(name, F.when(F.col("a") == 255, rgb).otherwise(F.concat(rgb, two("a"))))


# --- compositing ----------------------------------------------------------------------------------
# Published formulas on premultiplied values in 0..1: s, d are colours, sa, da alphas.

def _rest(s, d, sa, da):
    return s * (1 - da) + d * (1 - sa)


PORTER_DUFF = {
    # op: (factor of the source, factor of the destination), each from (sa, da)
    "clear": (lambda sa, da: F.lit(0.0), lambda sa, da: F.lit(0.0)),
    "src": (lambda sa, da: F.lit(1.0), lambda sa, da: F.lit(0.0)),
    "dst": (lambda sa, da: F.lit(0.0), lambda sa, da: F.lit(1.0)),
    "src_over": (lambda sa, da: F.lit(1.0), lambda sa, da: 1 - sa),
    "dst_over": (lambda sa, da: 1 - da, lambda sa, da: F.lit(1.0)),
    "src_in": (lambda sa, da: da, lambda sa, da: F.lit(0.0)),
    "dst_in": (lambda sa, da: F.lit(0.0), lambda sa, da: sa),
    "src_out": (lambda sa, da: 1 - da, lambda sa, da: F.lit(0.0)),
    "dst_out": (lambda sa, da: F.lit(0.0), lambda sa, da: 1 - sa),
    "src_atop": (lambda sa, da: da, lambda sa, da: 1 - sa),
    "dst_atop": (lambda sa, da: 1 - da, lambda sa, da: sa),
    "xor": (lambda sa, da: 1 - da, lambda sa, da: 1 - sa),
}


def _or1(c):
    return F.when(c == 0, F.lit(1.0)).otherwise(c)


def _soft_light(s, d, sa, da):
    m = d / _or1(da)
    twice = 2 * s - sa
    return d * sa + F.when(2 * s <= sa, d * twice * (1 - m)).when(
        4 * d <= da, da * twice * (((16 * m - 12) * m + 3) * m)).otherwise(da * twice * (F.sqrt(m) - m)) + _rest(s, d, sa, da)


def _hard(s, d, sa, da):
    return sa * da - 2 * (da - d) * (sa - s)


BLEND = {
    "plus": lambda s, d, sa, da: s + d,
    "minus": lambda s, d, sa, da: d - s,
    "multiply": lambda s, d, sa, da: s * d + _rest(s, d, sa, da),
    "screen": lambda s, d, sa, da: s + d - s * d,
    "overlay": lambda s, d, sa, da: F.when(2 * d <= da, 2 * s * d).otherwise(_hard(s, d, sa, da)) + _rest(s, d, sa, da),
    "darken": lambda s, d, sa, da: F.least(s * da, d * sa) + _rest(s, d, sa, da),
    "lighten": lambda s, d, sa, da: F.greatest(s * da, d * sa) + _rest(s, d, sa, da),
    "color_dodge": lambda s, d, sa, da: F.when(s * da + d * sa >= sa * da, sa * da).otherwise(
        d * sa / _or1(1 - s / _or1(sa))) + _rest(s, d, sa, da),
    "color_burn": lambda s, d, sa, da: F.when(s * da + d * sa <= sa * da, F.lit(0.0)).otherwise(
        sa * (s * da + d * sa - sa * da) / _or1(s)) + _rest(s, d, sa, da),
    "hard_light": lambda s, d, sa, da: F.when(2 * s <= sa, 2 * s * d).otherwise(_hard(s, d, sa, da)) + _rest(s, d, sa, da),
    "soft_light": _soft_light,
    "difference": lambda s, d, sa, da: s + d - 2 * F.least(s * da, d * sa),
    "exclusion": lambda s, d, sa, da: s * da + d * sa - 2 * s * d + _rest(s, d, sa, da),
}


def _plain(fn):
    """Formula on unmultiplied colours, kept within 0..1."""
    def apply(s, d, sa, da):
        b = fn(s / _or1(sa), d / _or1(da))
        return sa * da * F.least(F.greatest(b, F.lit(0.0)), F.lit(1.0)) + _rest(s, d, sa, da)
    return apply


ARITH = {
    "contrast": lambda s, d, sa, da: F.least(F.greatest((d - da / 2) * (2 * s - sa + 1) + da / 2, F.lit(0.0)), da),
    "invert": lambda s, d, sa, da: (da - d) * sa + d * (1 - sa),
    "invert-rgb": lambda s, d, sa, da: (da - d) * s + d * (1 - sa),
    "grain_merge": _plain(lambda s, d: d + s - 0.5),
    "grain_extract": _plain(lambda s, d: d - s + 0.5),
    "linear_dodge": _plain(lambda s, d: d + s),
    "linear_burn": _plain(lambda s, d: d + s - 1),
    "divide": _plain(lambda s, d: F.when(s == 0, F.lit(1.0)).otherwise(d / _or1(s))),
}
HSL_OPS = ("hue", "saturation", "color")


def _overlay_join(dst: DataFrame, src: DataFrame, dx, dy):
    """Source cells moved by (dx, dy) beside the destination cells they fall on."""
    s = src.select("img_id", (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), *[F.col(c).alias(f"_s{c}") for c in RGBA])
    return dst.join(s, ["img_id", "x", "y"], "left")


def composite(dst, src, op="src_over", opacity=1.0, dx=0, dy=0):
    """Composite source images onto destination images cell by cell.

    Both must be premultiplied. The source is shifted and cut to the
    destination; cells without a source keep their value. Cell keys are unique,
    so the join has no hot keys.
    """
    if not 0 <= opacity <= 1:
        raise ValueError("opacity must be between 0 and 1")
    if op not in PORTER_DUFF and op not in BLEND and op not in ARITH and op not in HSL_OPS:
        raise ValueError(f"comp_op value is invalid: {op!r}")
    joined = _overlay_join(dst, src, dx, dy)
    if op in HSL_OPS:
        joined = _with_hsl_mix(joined, op, opacity)
    sv = {c: F.col(f"_s{c}") / 255.0 * opacity for c in RGBA}
    dv = {c: F.col(c) / 255.0 for c in RGBA}
    sa, da = sv["a"], dv["a"]
    if op in PORTER_DUFF:
        fs, fd = PORTER_DUFF[op]
        out = {c: sv[c] * fs(sa, da) + dv[c] * fd(sa, da) for c in RGBA}
    else:
        if op in HSL_OPS:
            out = {c: sa * da * (F.col(f"_m{c}") / 255.0) + _rest(sv[c], dv[c], sa, da) for c in RGBA[:3]}
        else:
            fn = BLEND.get(op) or ARITH[op]
            out = {c: fn(sv[c], dv[c], sa, da) for c in RGBA[:3]}
        out["a"] = sa + da if op == "plus" else da if op == "contrast" else sa + da - sa * da
    # a hair of tolerance keeps exact halves stable whatever the order of products
    return joined.select(
        "img_id", "x", "y", *[F.when(F.col("_sa").isNull(), F.col(c)).otherwise(byte(F.round(out[c] * 255, 6))).cast("int").alias(c) for c in RGBA],
    )


# --- hue, saturation, lightness -------------------------------------------------------------------

# The shortened thirds of the reference.
THIRD, TWO_THIRDS = 0.33333, 0.66666


def with_hsl(df, rgb, hsl):
    """Add hue, saturation and lightness of three channels in 0..255.

    The hue is the place on a ring of six sextants: the largest channel gives
    the centre, the difference of the other two, over the chroma, the way from
    it. Intermediate values are columns of their own: each is computed once.
    """
    r, g, b = (F.col(f"_u{i}") for i in range(3))
    out = df.withColumns({f"_u{i}": F.col(c) / 255.0 for i, c in enumerate(rgb)})
    out = out.withColumns({"_top": F.greatest(r, g, b), "_low": F.least(r, g, b)})
    top = F.col("_top")
    out = out.withColumns({"_chroma": top - F.col("_low"), "_both": top + F.col("_low")})
    chroma, both = F.col("_chroma"), F.col("_both")
    gray = chroma == 0
    centre = F.when(top == r, 0.0).when(top == g, 2.0).otherwise(4.0)
    way = F.when(top == r, g - b).when(top == g, b - r).otherwise(r - g)
    hue = F.pmod(way / chroma + centre, F.lit(6.0)) / 6.0
    room = F.least(both, F.lit(2.0) - both)  # the largest chroma at this lightness
    out = out.withColumns(dict(zip(hsl, (F.when(gray, 0.0).otherwise(hue), F.when(gray, 0.0).otherwise(chroma / room), both / 2.0))))
    return out.drop("_u0", "_u1", "_u2", "_top", "_low", "_chroma", "_both")


def with_rgb(df, hsl, rgb):
    """Add channels in 0..255 from hue, saturation and lightness.

    Over the ring of hues a channel is a trapezoid between lightness minus and
    plus ``saturation * min(lightness, 1 - lightness)``: it rises during one
    sextant, stays for two, falls during one. The channels are the same shape, a
    third of the ring apart.
    """
    h, s, light = (F.col(c) for c in hsl)
    out = df.withColumn("_swing", s * F.least(light, F.lit(1.0) - light))
    turns = {"_t0": THIRD, "_t1": 0.0, "_t2": -THIRD}
    out = out.withColumns({t: h + shift for t, shift in turns.items()})
    out = out.withColumns({t: F.col(t) + F.when(F.col(t) < 0, 1.0).when(F.col(t) > 1, -1.0).otherwise(0.0) for t in turns})
    low, high = light - F.col("_swing"), light + F.col("_swing")

    def channel(t):
        foot = F.when(t < 0.5, t).when(t < 2 / 3, F.lit(TWO_THIRDS) - t).otherwise(F.lit(0.0))  # way from the nearer foot of the shape
        v = F.when((t >= 1 / 6) & (t < 0.5), high).otherwise(low + (high - low) * foot * 6)
        # Grays round to the nearest, colours are cut to whole numbers.
        return F.when(s == 0, F.floor(light * 255.0 + 0.5)).otherwise(F.greatest(F.floor(v * 255.0), F.lit(0))).cast("int")

    out = out.withColumns({c: channel(F.col(t)) for c, t in zip(rgb, turns)})
    return out.drop("_swing", *turns)


def rgb2hsl(df):
    return with_hsl(df, RGBA[:3], ("h", "s", "l"))


def hsl2rgb(df):
    return with_rgb(df, ("h", "s", "l"), RGBA[:3])


def _with_hsl_mix(joined, op, opacity):
    """Mix hue, saturation and lightness of the plain colours into ``_mr, _mg, _mb``."""
    unit = lambda c, a: F.least(c / _or1(a), F.lit(1.0)) * 255
    sa, da = F.col("_sa") / 255.0 * opacity, F.col("a") / 255.0
    out = joined.withColumns({f"_p{c}": unit(F.col(f"_s{c}") / 255.0 * opacity, sa) for c in RGBA[:3]})
    out = out.withColumns({f"_q{c}": unit(F.col(c) / 255.0, da) for c in RGBA[:3]})
    out = with_hsl(with_hsl(out, ("_pr", "_pg", "_pb"), ("_sh", "_ss", "_sl")), ("_qr", "_qg", "_qb"), ("_dh", "_ds", "_dl"))
    take = ("_sh" if op in ("hue", "color") else "_dh", "_ss" if op in ("saturation", "color") else "_ds", "_dl")
    return with_rgb(out, take, ("_mr", "_mg", "_mb"))


def tint(df, h=(0, 1), s=(0, 1), l=(0, 1), a=(0, 1)):  # noqa: E741
    """Each of hue, saturation, lightness and alpha becomes ``c0 + c * (c1 - c0)``.

    Cells with alpha of 1 or less keep their colour; an identity is skipped.
    """
    out = df
    if tuple(a) != (0, 1):
        alpha = F.lit(float(a[0])) + F.col("a") / 255.0 * float(a[1] - a[0])
        out = out.withColumn("a", byte(alpha * 255.0))
    if (tuple(h), tuple(s), tuple(l)) == ((0, 1), (0, 1), (0, 1)):
        return out

    def move(v, c):
        return F.least(F.greatest(F.lit(float(c[0])) + v * float(c[1] - c[0]), F.lit(0.0)), F.lit(1.0))

    names = ("_h", "_s", "_l")
    out = with_hsl(out, RGBA[:3], names)
    out = with_rgb(out.withColumns({n: move(F.col(n), c) for n, c in zip(names, (h, s, l))}), names, ("_nr", "_ng", "_nb"))
    out = out.withColumns({c: F.when(F.col("a") > 1, F.col(f"_n{c}")).otherwise(F.col(c)).cast("int") for c in RGBA[:3]})
    return out.drop(*names, "_nr", "_ng", "_nb")


# --- stacks of layers -----------------------------------------------------------------------------

def blend_over(target, source):
    """One packed pixel over another: source-over on plain colours in whole numbers.

    The source weighs its alpha, the target its own alpha times what the source
    lets through. Fixed values: alphas are 256ths here, so opaque is 256 in the
    part that shines through, and every result is cut to a whole number.
    """
    sa, ta = _channel(source, 24), _channel(target, 24)
    over, under = sa * 256, ta * (F.lit(256).cast("bigint") - sa)
    total = over + under

    def mean(shift):
        weighed = _channel(source, shift) * over + _channel(target, shift) * under
        return F.shiftleft(F.floor(weighed / F.greatest(total, F.lit(1).cast("bigint"))).cast("bigint"), shift)

    mixed = F.shiftleft(F.shiftright(total, 8), 24).bitwiseOR(mean(16)).bitwiseOR(mean(8)).bitwiseOR(mean(0))
    return F.when(sa == 0, target).when((sa == 255) | (ta == 0), source).otherwise(mixed)


def _skip_covered(cells, width, height):
    """Leave out layers below the topmost layer that covers its canvas with opaque cells."""
    full = cells.where(_channel(F.col("p"), 24) == 255).groupBy("canvas_id", "ord").agg(F.count(F.lit(1)).alias("n"))
    top = full.where(F.col("n") == width * height).groupBy("canvas_id").agg(F.max("ord").alias("_top"))
    joined = cells.join(top, "canvas_id", "left")
    return joined.where(F.col("_top").isNull() | (F.col("ord") >= F.col("_top"))).drop("_top")


def blend_stack(layers, width, height, matte=0, block=256, skip_covered=False):
    """Blend layers bottom to top onto ``width`` x ``height`` canvases.

    ``layers`` holds ``canvas_id, ord, off_x, off_y, x, y, r, g, b, a``; ``ord``
    counts from 0. Layers are folded in blocks of ``block``, so a cell never
    gathers more than that many values however many layers there are.
    ``skip_covered`` drops what an opaque full cover hides before the shuffle;
    it reads the cells once more, so ask for it when covers are common.
    """
    if width <= 0 or height <= 0:
        raise ValueError(f"Image dimensions {width}x{height} are invalid")
    keys = ["canvas_id", "x", "y"]
    cells = layers.select(
        "canvas_id", "ord", (F.col("x") + F.col("off_x")).cast("int").alias("x"), (F.col("y") + F.col("off_y")).cast("int").alias("y"), packed().alias("p"),
    ).where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    if skip_covered:
        cells = _skip_covered(cells, width, height)
    cells = cells.withColumn("_block", F.floor(F.col("ord") / block))
    blocks = cells.agg(F.max("_block")).first()[0]  # one number: how many rounds there are
    start = F.lit(matte).cast("bigint")

    def fold(rows, base):
        stack = F.array_sort(F.collect_list(F.struct("ord", "p")))
        agg = rows.groupBy(*keys).agg(stack.alias("_s"), *([F.first("_base").alias("_base")] if base else []))
        return agg.select(*keys, F.aggregate("_s", F.col("_base") if base else start, lambda t, s: blend_over(t, s["p"])).alias("p"))

    canvas = layers.select("canvas_id").distinct().withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))) \
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    if blocks is None:
        return unpack_rgba(canvas.withColumn("p", start), "p").drop("p")
    done = fold(cells.where(F.col("_block") == 0), False)
    for i in range(1, blocks + 1):
        part = cells.where(F.col("_block") == i)
        base = skew.checkpoint(done).withColumnRenamed("p", "_base")
        joined = part.join(base, keys, "left").withColumn("_base", F.coalesce("_base", start))
        touched = fold(joined, True)
        untouched = base.join(part.select(*keys).distinct(), keys, "left_anti").withColumnRenamed("_base", "p")
        done = touched.unionByName(untouched)
    out = canvas.join(done, keys, "left").withColumn("p", F.coalesce("p", start))
    return unpack_rgba(out, "p").drop("p")


# --- palettes -------------------------------------------------------------------------------------

MAX_PALETTE = 256
CUBE_BITS = 3  # leading bits of a channel that choose a cell of the colour cube


def _palette_cube(spark, entries):
    """Cells of the colour cube with the entries that can be nearest to one of their colours.

    An entry can be nearest if its distance to the cell's closest corner is not above the smallest distance that any entry
    has to the cell's farthest one. The cube has 4,096 cells, whatever the images and the palette are.
    """
    width = 256 >> CUBE_BITS
    cells = spark.range(1 << (4 * CUBE_BITS)).withColumnRenamed("id", "_cell")
    low = [F.shiftright("_cell", CUBE_BITS * k).bitwiseAND(F.lit((1 << CUBE_BITS) - 1).cast("bigint")) * width for k in range(4)]
    cells = cells.select("_cell", F.array(*low).alias("_low"))

    def reach(p):
        near = far = F.lit(0).cast("bigint")
        for k, c in enumerate(RGBA):
            below, above = F.col("_low")[k] - p[c], p[c] - F.col("_low")[k] - (width - 1)
            closest, farthest = F.greatest(below, above, F.lit(0).cast("bigint")), F.greatest(F.abs(below), F.abs(above))
            near, far = near + closest * closest, far + farthest * farthest
        return F.struct(near.alias("near"), far.alias("far"), p.alias("p"))

    spread = cells.select("_cell", F.transform(entries, reach).alias("_e"))
    bound = F.array_min(F.transform("_e", lambda e: e["far"]))
    return spread.select("_cell", "_e", bound.alias("_bound")).select(
        "_cell", F.transform(F.filter("_e", lambda e: e["near"] <= F.col("_bound")), lambda e: e["p"]).alias("_candidates"))


def palette_map(df, palette):
    """Nearest palette colour per cell; a palette is a list of at most 256 ``(r, g, b, a)``, a tie goes to its first entry.

    Channels are bytes. A colour is compared only with the entries that its cell of a colour cube holds; the cube is of a
    fixed size and broadcast, so images are not shuffled. A colour with a null channel has no entry.
    """
    palette = [tuple(p) for p in palette]
    if not 1 <= len(palette) <= MAX_PALETTE:
        raise ValueError("a palette has 1 to 256 colours")
    entries = F.array(*[F.struct(*[F.lit(int(v)).alias(c) for c, v in zip(RGBA, p)], F.lit(i).alias("i")) for i, p in enumerate(palette)])
    cell = F.lit(0).cast("bigint")
    for k, c in enumerate(RGBA):
        cell = cell + F.shiftleft(F.shiftright(F.col(c).cast("bigint"), 8 - CUBE_BITS), CUBE_BITS * k)

    def ranked(p):
        d = F.lit(0)
        for c in RGBA:
            d = d + (F.col(c) - p[c]) * (F.col(c) - p[c])
        return F.struct(d.alias("d"), p["i"].alias("i"), p.alias("p"))

    cube = F.broadcast(_palette_cube(df.sparkSession, entries))
    best = df.withColumn("_cell", cell).join(cube, "_cell", "left").withColumn("_best", F.array_min(F.transform("_candidates", ranked)))
    return best.select("img_id", "x", "y", F.col("_best")["i"].alias("palette_index"), *[F.col("_best")["p"][c].alias(c) for c in RGBA])


def palette_of(df, n):
    """At most ``n`` colours that stand for all cells: an octree over red, green and blue, merged from its leaves up.

    A node of depth ``d`` holds the colours of equal ``d`` leading bits. The deepest level of at most ``n`` nodes is found
    first; its nodes are then split into their children, the fullest ones first, for as long as ``n`` colours last. A
    colour is the mean of its cells and ``cells`` their number. Of the images, only distinct colours are kept; eight
    numbers come to the driver, and what is ranked are the at most ``n`` nodes of one level. Cells with a null channel
    don't count; no cells give no rows.
    """
    if not 2 <= n <= MAX_PALETTE:
        raise ValueError("max_colors must be between 2 and 256")
    sums = [f"_s{c}" for c in RGBA]
    used = df.where(" and ".join(f"{c} is not null" for c in RGBA))
    colours = skew.checkpoint(used.groupBy("r", "g", "b").agg(
        F.count(F.lit(1)).alias("cells"), *[F.sum(F.col(c).cast("bigint")).alias(s) for c, s in zip(RGBA, sums)]))

    def node(depth):
        return [F.shiftright(c, 8 - depth) for c in RGBA[:3]]

    sizes = [1, *colours.agg(*[F.count_distinct(*node(d)) for d in range(1, 9)]).first()]  # nodes per level
    depth = max(d for d, size in enumerate(sizes) if size <= n)

    def level(rows, at, *more):
        total = [F.sum("cells").alias("cells"), *[F.sum(s).alias(s) for s in sums], *more]
        return rows.groupBy(*[c.alias(k) for c, k in zip(at, ("_r", "_g", "_b"))]).agg(*total)

    if depth == 8:
        leaves = colours
    else:
        children = level(colours, node(depth + 1))
        parents = level(children, [F.shiftright(k, 1) for k in ("_r", "_g", "_b")], F.count(F.lit(1)).alias("_kids"))
        before = Window.orderBy("cells", "_r", "_g", "_b").rowsBetween(Window.unboundedPreceding, -1)  # at most n rows
        saved = F.coalesce(F.sum(F.col("_kids") - 1).over(before), F.lit(0))
        parents = parents.withColumn("_whole", saved < sizes[depth + 1] - n)
        up = [F.shiftright(F.col(f"c.{k}"), 1) == F.col(f"p.{k}") for k in ("_r", "_g", "_b")]
        split = children.alias("c").join(F.broadcast(parents.where(~F.col("_whole")).alias("p")), up).select("c.cells", *[f"c.{s}" for s in sums])
        leaves = parents.where("_whole").select("cells", *sums).unionByName(split)
    return leaves.select(*[byte(F.col(s) / F.col("cells")).alias(c) for c, s in zip(RGBA, sums)], "cells")
