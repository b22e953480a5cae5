"""Raster cells: ``img_id, x, y`` with ``r, g, b, a`` or ``v``.

Every operator handles all images at once.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import burn

RGBA = ("r", "g", "b", "a")

# The ranges of the pixel types.
PIXEL_RANGES = {
    "gray8": (0, 2**8 - 1), "gray8s": (-(2**7), 2**7 - 1), "gray16": (0, 2**16 - 1), "gray16s": (-(2**15), 2**15 - 1),
    "gray32": (0, 2**32 - 1), "gray32s": (-(2**31), 2**31 - 1), "gray64": (0, 2**63 - 1), "gray64s": (-(2**63), 2**63 - 1),
}
FLOAT_TYPES = ("gray32f", "gray64f")


def channels(df):
    return [c for c in (*RGBA, "v") if c in df.columns]


def clamp(v, pixel_type):
    if pixel_type in FLOAT_TYPES:
        return v.cast("float" if pixel_type == "gray32f" else "double")
    lo, hi = PIXEL_RANGES[pixel_type]
    v = v.cast("bigint")
    return F.least(F.greatest(v, F.lit(lo).cast("bigint")), F.lit(hi).cast("bigint"))


def byte(v):
    """Round to the nearest of 0..255."""
    return F.least(F.greatest(F.floor(v + 0.5), F.lit(0)), F.lit(255)).cast("int")


def get_pixel(df, x, y):
    return df.where((F.col("x") == x) & (F.col("y") == y))


def set_pixel(df, updates, pixel_type="gray16"):
    """Overwrite cells from ``img_id, x, y, v``, clamped to the pixel type."""
    new = updates.select("img_id", "x", "y", clamp(F.col("v"), pixel_type).alias("_new"))
    return df.join(new, ["img_id", "x", "y"], "left").withColumn("v", F.coalesce("_new", "v")).drop("_new")


def fill(df, **values):
    """Every cell to a value or colour, e.g. ``v=3`` or ``r=0, g=128, b=0, a=255``."""
    return df.withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()})


def clear(df):
    return fill(df, **{c: 0 for c in channels(df)})


def image_stats(df):
    """Width, height and pixel kind per image."""
    kind = "rgba8" if "r" in df.columns else {"float": "gray32f", "double": "gray64f"}.get(df.schema["v"].dataType.simpleString(), "gray")
    return df.groupBy("img_id").agg((F.max("x") + 1).cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height")).withColumn("type", F.lit(kind))


def compare(a, b, threshold=0, alpha=True, check_size=True):
    """Differing cells per image; a channel differs beyond the threshold. Sizes must match."""
    names = [c for c in channels(a) if alpha or c != "a"]
    left = a.select("img_id", "x", "y", *[F.col(c).alias(f"_a_{c}") for c in names])
    right = b.select("img_id", "x", "y", *[F.col(c).alias(f"_b_{c}") for c in names])
    both = left.join(right, ["img_id", "x", "y"], "full" if check_size else "inner")
    differs = F.lit(False)
    for c in names:
        differs = differs | (F.abs(F.col(f"_a_{c}").cast("bigint" if c != "v" else "double") - F.col(f"_b_{c}")) > threshold)
    unmatched = F.col(f"_a_{names[0]}").isNull() | F.col(f"_b_{names[0]}").isNull()
    flag = F.when(unmatched, F.raise_error(F.lit("image dimensions do not match")).cast("boolean")).otherwise(differs)
    return both.groupBy("img_id").agg(F.count_if(flag).alias("different"))


def is_solid(df):
    """Are all cells of an image identical, and which value do they hold."""
    names = channels(df)
    agg = df.groupBy("img_id").agg(*[f(c).alias(f"_{n}_{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))])
    solid = F.lit(True)
    for c in names:
        solid = solid & (F.col(f"_lo_{c}") == F.col(f"_hi_{c}"))
    return agg.select("img_id", solid.alias("solid"), *[F.when(solid, F.col(f"_hi_{c}")).alias(c) for c in names])


def view(df, x, y, width, height):
    inside = F.col("x").between(x, x + width - 1) & F.col("y").between(y, y + height - 1)
    return df.where(inside).withColumns({"x": F.col("x") - x, "y": F.col("y") - y})


def premultiply(df):
    """Colour times alpha, rounded."""
    return df.withColumns({c: F.expr(f"cast((2 * {c} * a + 255) div 510 as int)") for c in RGBA[:3]})


def demultiply(df):
    """Colour divided by alpha, truncated; fully transparent cells are 0."""
    return df.withColumns({c: F.expr(f"cast(case when a = 0 then 0 else least(({c} * 255) div a, 255) end as int)") for c in RGBA[:3]})


def gray_to_alpha(df, color=None):
    """Alpha from the gray value with white, or the given ``(r, g, b)``, as colour."""
    if color is not None:
        # with a colour every cell takes that colour and stays opaque
        r, gr, b = color
        return df.withColumns({"r": F.lit(r), "g": F.lit(gr), "b": F.lit(b), "a": F.lit(255)})
    gray = F.least(F.ceil(F.col("r") * 0.3 + F.col("g") * 0.59 + F.col("b") * 0.11), F.lit(255)).cast("int")
    return df.withColumns({"a": gray, "r": F.lit(255), "g": F.lit(255), "b": F.lit(255)})


def cast_copy(df, pixel_type, offset=0.0, scaling=1.0):
    """``(v - offset) / scaling``, truncated and clamped to the target type."""
    if scaling == 0:
        raise ValueError("scaling must not be zero")
    v = (F.col("v").cast("double") - offset) / scaling
    if pixel_type not in FLOAT_TYPES:
        lo, hi = PIXEL_RANGES[pixel_type]
        v = F.when(v >= float(hi), F.lit(hi).cast("bigint")).when(v <= float(lo), F.lit(lo).cast("bigint")).otherwise(v.cast("bigint"))
    return df.withColumn("v", clamp(v, pixel_type))


# --- resampling -----------------------------------------------------------------------------------

def _with_size(df):
    """Image size on every cell; a very large image is sliced over tasks."""
    size = df.groupBy("img_id").agg((F.max("x") + 1).alias("_w"), (F.max("y") + 1).alias("_h"))
    return df.join(size, "img_id")


def _check_size(width, height):
    if width <= 0 or height <= 0:
        raise ValueError("Width and height must be integers greater than zero")


def resize_near(df, width, height, offset_x=0, offset_y=0, offset_width=None, offset_height=None):
    """Nearest source cell, optionally from a window of the source.

    Each source cell finds the target cells that look at it - whole-number
    arithmetic, no join and no shuffle besides the image sizes.
    """
    _check_size(width, height)
    rows = _with_size(df)
    for axis, target, off, win, full in (("x", width, offset_x, offset_width, "_w"), ("y", height, offset_y, offset_height, "_h")):
        n = F.lit(win).cast("bigint") if win is not None else F.col(full).cast("bigint")
        at = F.col(axis).cast("bigint") - off
        # target t reads source floor((2t + 1) * n / (2 * target))
        ceil_div = lambda p, q: -F.floor(-p / q)
        first = F.greatest(ceil_div(at * (2 * target) - n, n * 2), F.lit(0))
        last = F.least(ceil_div((at + 1) * (2 * target) - n, n * 2) - 1, F.lit(target - 1))
        inside = (at >= 0) & (at < n)
        rows = rows.where(inside & (first <= last)).withColumn(axis, F.explode(F.sequence(first, last)))
    return rows.select("img_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), *channels(df))


def _resample_axis(rows, axis, target, size_col, weight, names):
    """Weighted mean along one axis; every source cell is sent to the targets within reach.

    When the axis gets shorter the kernel gets wider by the ratio, so that every source cell counts; a cell still reaches
    no more than about twice the radius of targets.
    """
    target = F.col("_to")[target]
    ratio = F.col(size_col) / target.cast("double")
    scale = F.greatest(ratio, F.lit(1.0))
    reach = scale * F.col("_to.radius")
    lo = F.greatest(F.floor((F.col(axis) - reach + 0.5) / ratio - 0.5), F.lit(0))
    hi = F.least(F.ceil((F.col(axis) + reach + 0.5) / ratio - 0.5), target - 1)
    taps = rows.where(lo <= hi).withColumn("_t", F.explode(F.sequence(lo, hi)))
    d = F.abs((F.col("_t") + 0.5) * ratio - 0.5 - F.col(axis)) / scale
    taps = taps.withColumn("_k", weight(d)).where(F.col("_k") != 0)
    other = "y" if axis == "x" else "x"
    agg = taps.groupBy(F.col("_to.at").alias("_at"), "img_id", other, "_t").agg(
        F.first("_to").alias("_to"), F.first("_w").alias("_w"), F.first("_h").alias("_h"),
        *[(F.sum(F.col("_k") * F.col(c)) / F.sum("_k")).alias(c) for c in names],
    )
    return agg.withColumnRenamed("_t", axis)


#: A task resamples about so many cells; its hash tables hold no more.
TASK_CELLS = 250_000


def _resample(df, sizes, weight):
    """To several sizes ``(width, height, radius)`` in one pass, along x and then along y; ``_at`` is the place of a cell's size.

    Cells are dealt by image and row, then by image and column, which is how they are grouped, over as many tasks as cells
    come and go: no task has more of them in larger tables, and a large image lies on many.
    """
    for width, height, _ in sizes:
        _check_size(width, height)
    names = channels(df)
    of_image = df.groupBy("img_id").agg(F.count(F.lit(1)).alias("n"), (F.max("y") + 1).alias("h"))
    cells, lines, images = (n or 0 for n in of_image.agg(F.sum("n"), F.sum("h"), F.count(F.lit(1))).first())
    wide = lines * sum(w for w, _, _ in sizes)
    tasks = lambda *n: max(1, math.ceil(max(n) / TASK_CELLS))
    to = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(w).alias("width"), F.lit(h).alias("height"), F.lit(float(r)).alias("radius")) for i, (w, h, r) in enumerate(sizes)])
    rows = (premultiply(df) if "a" in names else df).repartition(tasks(cells), "img_id")
    rows = _with_size(rows).repartition(tasks(cells, wide), "img_id", "y").withColumn("_to", F.explode(to))
    rows = _resample_axis(rows, "x", "width", "_w", weight, names).drop("_at")
    rows = rows.repartition(tasks(wide, images * sum(w * h for w, h, _ in sizes)), F.col("_to.at"), "img_id", "x")
    rows = _resample_axis(rows, "y", "height", "_h", weight, names)
    out = rows.select("_at", "img_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), *names)
    if "a" in names:
        # means of whole numbers hit exact halves; the rounding keeps them from depending on summation order
        return demultiply(out.withColumns({c: byte(F.round(c, 6)) for c in names}))
    return out


def _named(cells, names):
    """The texts of a cell's size."""
    return cells.withColumns({n: F.get(F.array(*[F.lit(t) for t in texts]), F.col("_at")) for n, texts in names.items()}).drop("_at")


def resize_bilinear(df, width, height):
    """Weighted mean of the 2 x 2 nearest cells, or of all within the ratio when reducing; colours are premultiplied on the way."""
    return resize_bilinear_sizes(df, [(width, height)]).drop("size")


def resize_bilinear_sizes(df, sizes):
    """The same to several sizes in one pass, each named in ``size``."""
    out = _resample(df, [(w, h, 1) for w, h in sizes], lambda d: F.greatest(F.lit(1.0) - d, F.lit(0.0)))
    return _named(out, {"size": [f"{w}x{h}" for w, h in sizes]})


def _sinc(t):
    return 1.0 if t == 0 else math.sin(math.pi * t) / (math.pi * t)


def _cubic(t, b, c):
    if t < 1:
        return ((12 - 9 * b - 6 * c) * t**3 + (-18 + 12 * b + 6 * c) * t**2 + (6 - 2 * b)) / 6
    if t < 2:
        return ((-b - 6 * c) * t**3 + (6 * b + 30 * c) * t**2 + (-12 * b - 48 * c) * t + (8 * b + 24 * c)) / 6
    return 0.0


def _bessel_i0(x):
    total, term, k = 1.0, 1.0, 1
    while term > total * 1e-16:
        term *= (x / (2 * k)) ** 2
        total += term
        k += 1
    return total


def _bessel_j1(x):
    total, term, k = 0.0, x / 2, 0
    while abs(term) > 1e-17:
        total += term
        k += 1
        term *= -(x * x / 4) / (k * (k + 1))
    return total


def _spline16(t):
    if t < 1:
        return ((t - 9 / 5) * t - 1 / 5) * t + 1
    u = t - 1
    return ((-1 / 3 * u + 4 / 5) * u - 7 / 15) * u


def _spline36(t):
    if t < 1:
        return ((13 / 11 * t - 453 / 209) * t - 3 / 209) * t + 1
    if t < 2:
        u = t - 1
        return ((-6 / 11 * u + 270 / 209) * u - 156 / 209) * u
    u = t - 2
    return ((1 / 11 * u - 45 / 209) * u + 26 / 209) * u


def _bspline_cubic(t):
    up = lambda v: max(v, 0.0) ** 3
    return (up(t + 2) - 4 * up(t + 1) + 6 * up(t) - 4 * up(t - 1)) / 6


# Published resampling kernels: radius and weight at a distance.
KERNELS = {
    "bicubic": (2, _bspline_cubic),
    "spline16": (2, _spline16),
    "spline36": (3, _spline36),
    "hanning": (1, lambda t: 0.5 + 0.5 * math.cos(math.pi * t)),
    "hamming": (1, lambda t: 0.54 + 0.46 * math.cos(math.pi * t)),
    "hermite": (1, lambda t: (2 * t - 3) * t * t + 1),
    "kaiser": (1, lambda t: _bessel_i0(6.33 * math.sqrt(max(0.0, 1 - t * t))) / _bessel_i0(6.33)),
    "quadric": (1.5, lambda t: 0.75 - t * t if t < 0.5 else (0.5 * (t - 1.5) ** 2 if t < 1.5 else 0.0)),
    "catrom": (2, lambda t: _cubic(t, 0, 0.5)),
    "gaussian": (2, lambda t: math.exp(-2 * t * t) * math.sqrt(2 / math.pi)),
    "bessel": (3.2383, lambda t: math.pi / 4 if t == 0 else _bessel_j1(math.pi * t) / (2 * t)),
    "mitchell": (2, lambda t: _cubic(t, 1 / 3, 1 / 3)),
    "sinc": (4, _sinc),
    "lanczos": (4, lambda t: _sinc(t) * _sinc(t / 4)),
    "blackman": (4, lambda t: _sinc(t) * (0.42 + 0.5 * math.cos(math.pi * t / 4) + 0.08 * math.cos(2 * math.pi * t / 4))),
}
STEPS = 256


def kernel_table(method):
    """Weights at multiples of 1/256 up to the radius, rounded to six digits."""
    if method not in KERNELS:
        raise ValueError(f"unknown scaling method {method!r}")
    radius, fn = KERNELS[method]
    return [round(fn(i / STEPS), 6) for i in range(math.ceil(radius * STEPS))]


def resize_kernel(df, width, height, method):
    """Resize with a named kernel; the weight table is a constant of at most 1024 numbers."""
    return resize_kernels(df, [(method, width, height)]).drop("method", "size")


def resize_kernels(df, ways):
    """Resize in several ways ``(method, width, height)`` in one pass, each named by ``method`` and ``size``."""
    tables = [kernel_table(method) for method, _, _ in ways]
    lookup = F.expr("array(" + ",".join("array(" + ",".join(f"{w!r}D" for w in table) + ")" for table in tables) + ")")
    weight = lambda d: F.coalesce(F.get(F.get(lookup, F.col("_to.at")), F.floor(d * STEPS).cast("int")), F.lit(0.0))
    out = _resample(df, [(w, h, KERNELS[method][0]) for method, w, h in ways], weight)
    return _named(out, {"method": [k for k, _, _ in ways], "size": [f"{w}x{h}" for _, w, h in ways]})


def resize(df, width, height, method="near", **window):
    if method == "near":
        return resize_near(df, width, height, **window)
    return resize_bilinear(df, width, height) if method == "bilinear" else resize_kernel(df, width, height, method)


# --- neighbourhoods -------------------------------------------------------------------------------

# 3 x 3 kernels, rows from top to bottom.
CONVOLUTIONS = {
    "blur": [[1 / 9] * 3] * 3,
    "emboss": [[-2, -1, 0], [-1, 1, 1], [0, 1, 2]],
    "sharpen": [[0, -1, 0], [-1, 5, -1], [0, -1, 0]],
    "edge_detect": [[0, 1, 0], [1, -4, 1], [0, 1, 0]],
}
SOBEL_X = [[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]]
SOBEL_Y = [[-1, -2, -1], [0, 0, 0], [1, 2, 1]]


def convolve(df, kernel):
    """3 x 3 filter; results are truncated and kept within 0..255, alpha stays.

    Beside the image, x repeats the edge cell and y mirrors. Neighbours come
    from two windows, along rows and then along columns, so cells are shuffled
    twice and never multiplied.
    """
    names = [c for c in channels(df) if c != "a"]
    row = Window.partitionBy("img_id", "y").orderBy("x")
    colw = Window.partitionBy("img_id", "x").orderBy("y")
    triple = df.withColumn("_c", F.struct(*names))
    at = lambda c, w, d: F.first(c).over(w.rangeBetween(d, d))
    triple = triple.withColumns({"_left": at("_c", row, -1), "_right": at("_c", row, 1)})
    triple = triple.withColumn("_mid", F.struct(F.coalesce("_left", "_c").alias("l"), F.col("_c").alias("m"), F.coalesce("_right", "_c").alias("r")))
    triple = triple.withColumns({"_up": at("_mid", colw, -1), "_down": at("_mid", colw, 1)})
    rows = (F.coalesce("_up", "_down", "_mid"), F.col("_mid"), F.coalesce("_down", "_up", "_mid"))

    def weigh(k, c):
        total = F.lit(0.0)
        for weights, cells in zip(k, rows):
            for w, side in zip(weights, "lmr"):
                if w:
                    total = total + cells[side][c] * F.lit(float(w))
        return total

    def value(c):
        if kernel == "sobel":
            gx, gy = weigh(SOBEL_X, c), weigh(SOBEL_Y, c)
            return F.sqrt(gx * gx + gy * gy)
        # sums of thirds and ninths sit a hair below whole numbers
        return weigh(CONVOLUTIONS[kernel], c) + 1e-9

    if kernel != "sobel" and kernel not in CONVOLUTIONS:
        raise ValueError(f"unknown filter {kernel!r}")
    out = {c: F.least(F.greatest(F.floor(value(c)), F.lit(0)), F.lit(255)).cast("int") for c in names}
    return triple.select("img_id", "x", "y", *[out[c].alias(c) for c in names], *(["a"] if "a" in df.columns else []))


def gray(df):
    v = F.floor(F.col("r") * 0.299 + F.col("g") * 0.587 + F.col("b") * 0.114 + 1e-9).cast("int")
    return df.withColumn("_v", v).withColumns({c: F.col("_v") for c in RGBA[:3]}).drop("_v")


def invert(df):
    """Complement within alpha, for premultiplied cells."""
    return df.withColumns({c: F.greatest(F.col("a") - F.col(c), F.lit(0)).cast("int") for c in RGBA[:3]})


def stack_blur(df, rx, ry):
    """Blur with triangular weights: two box means along each axis, over the cells that exist."""
    names = channels(df)
    out = df
    for axis, other, radius in (("x", "y", rx), ("y", "x", ry)):
        if radius > 0:
            w = Window.partitionBy("img_id", other).orderBy(axis).rangeBetween(-radius, radius)
            for _ in range(2):
                out = out.withColumns({c: F.avg(c).over(w) for c in names})
    return out.withColumns({c: byte(F.round(c, 6)) for c in names})


def painted(df):
    """Has any cell been written."""
    any_set = F.lit(False)
    for c in channels(df):
        any_set = any_set | (F.col(c) != 0)
    return df.groupBy("img_id").agg(F.max(any_set).alias("painted"))


def feature_raster(df, view_, value, img_id=0):
    """Burn a value of the features into raster cells; the last drawn feature wins."""
    rows = burn.to_cells(df.withColumn("_value", F.col(value)), view_)
    cells = burn.all_cells(rows, view_[0], view_[1], ["layer_ord", "fid", "_value"])
    burnt = burn.last_drawn(cells, ["x", "y"], "_value")
    return burnt.select(F.lit(img_id).cast("bigint").alias("img_id"), "x", "y", F.col("_value").alias("v"))
