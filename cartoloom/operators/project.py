"""Projection of whole tables (G05-G08) and viewport arithmetic (V)."""

from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import mercator as m
from . import features


def forward(df, lon="lon", lat="lat", x="x", y="y"):
    return df.withColumns({x: m.merc_x(lon), y: m.merc_y(lat)})


def inverse(df, x="x", y="y", lon="lon", lat="lat"):
    return df.withColumns({lon: m.lon_of(x), lat: m.lat_of(y)})


def _project_box(df, fn, names):
    corners = [fn(F.col(cx), F.col(cy)) for cx in (names[0], names[2]) for cy in (names[1], names[3])]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return df.withColumns(dict(zip(names, (F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)))))


def forward_box(df, names=g.BOX):
    """Project the four corners and take their envelope."""
    return _project_box(df, m.transformer(4326, 3857), names)


def inverse_box(df, names=g.BOX):
    return _project_box(df, m.transformer(3857, 4326), names)


def reproject(df, src, dst):
    """Every vertex of every geometry, and the envelope; the same table when nothing changes."""
    fn = m.transformer(src, dst)
    if fn is None:
        return df
    out = df.withColumn("geom", g.map_vertices("geom", fn))
    return g.with_bounds(out) if "minx" in df.columns else out


# --- viewports: one row per view with width, height and a box -------------------------------------

# Names of the ways to fit a box to a canvas.
ASPECT_MODES = (
    "GROW_BBOX", "SHRINK_BBOX", "ADJUST_BBOX_WIDTH", "ADJUST_BBOX_HEIGHT",
    "GROW_CANVAS", "SHRINK_CANVAS", "ADJUST_CANVAS_WIDTH", "ADJUST_CANVAS_HEIGHT", "RESPECT",
)


def zoom_all(sources):
    """Extent of all layers in map coordinates; ``sources`` are ``(features, srs)`` pairs."""
    out = None
    for df, srs in sources:
        box = features.extent(df)
        if m.srs_code(srs) == 4326:
            box = forward_box(box)
        out = box if out is None else out.unionByName(box)
    return features.extent(out)


def zoom_to_box(views, mode="GROW_BBOX"):
    """Fit each view's box to its canvas, or its canvas to the box."""
    if mode not in ASPECT_MODES:
        raise ValueError(f"unknown aspect mode {mode!r}")
    w, h = F.col("width"), F.col("height")
    bw, bh = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    canvas, box = w / h, bw / bh
    wider = box > canvas
    taller_box, wider_box = bw / canvas, bh * canvas
    fit_w, fit_h = (h * box + 0.5).cast("int"), (w / box + 0.5).cast("int")
    new_w, new_h, new_bw, new_bh = w, h, bw, bh
    if mode == "GROW_BBOX":
        new_bw, new_bh = F.when(wider, bw).otherwise(wider_box), F.when(wider, taller_box).otherwise(bh)
    elif mode == "SHRINK_BBOX":
        new_bw, new_bh = F.when(wider, wider_box).otherwise(bw), F.when(wider, bh).otherwise(taller_box)
    elif mode == "ADJUST_BBOX_WIDTH":
        new_bw = wider_box
    elif mode == "ADJUST_BBOX_HEIGHT":
        new_bh = taller_box
    elif mode == "GROW_CANVAS":
        new_w, new_h = F.when(wider, fit_w).otherwise(w), F.when(wider, h).otherwise(fit_h)
    elif mode == "SHRINK_CANVAS":
        new_w, new_h = F.when(wider, w).otherwise(fit_w), F.when(wider, fit_h).otherwise(h)
    elif mode == "ADJUST_CANVAS_WIDTH":
        new_w = fit_w
    elif mode == "ADJUST_CANVAS_HEIGHT":
        new_h = fit_h
    cx, cy = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    differs = canvas != box
    change = {
        "width": (new_w, w), "height": (new_h, h),
        "minx": (cx - new_bw / 2, F.col("minx")), "maxx": (cx + new_bw / 2, F.col("maxx")),
        "miny": (cy - new_bh / 2, F.col("miny")), "maxy": (cy + new_bh / 2, F.col("maxy")),
    }
    return views.withColumns({n: F.when(differs, new).otherwise(old) for n, (new, old) in change.items()})


def scale_of():
    return F.when(F.col("width") > 0, (F.col("maxx") - F.col("minx")) / F.col("width")).otherwise(F.col("maxx") - F.col("minx"))


def scale(views):
    """Map units per pixel."""
    return views.withColumn("scale", scale_of())


def scale_denominator(views, geographic=False):
    d = scale_of() / m.PIXEL_SIZE
    return views.withColumn("scale_denominator", d * m.METERS_PER_DEGREE if geographic else d)


def buffered_extent(views, buffer):
    """The box grown by a number of pixels."""
    pad = scale_of() * buffer
    return views.withColumns({
        "minx": F.col("minx") - pad, "miny": F.col("miny") - pad, "maxx": F.col("maxx") + pad, "maxy": F.col("maxy") + pad,
    })


def to_screen(df, view, x="x", y="y"):
    """Map to pixel coordinates; ``view`` is ``(width, height, box)``."""
    w, h, (minx, miny, maxx, maxy) = view
    return df.withColumns({
        "px": (F.col(x) - minx) * (w / (maxx - minx)),
        "py": (F.lit(float(maxy)) - F.col(y)) * (h / (maxy - miny)),
    })


def from_screen(df, view, px="px", py="py"):
    """Pixel to map coordinates; a position outside the canvas is an error."""
    w, h, (minx, miny, maxx, maxy) = view
    inside = F.col(px).between(0, w) & F.col(py).between(0, h)
    ok = lambda c: F.when(inside, c).otherwise(F.raise_error(F.lit("x or y outside of map bounds")).cast("double"))
    return df.withColumns({
        "x": ok(F.col(px) * ((maxx - minx) / w) + minx),
        "y": ok(F.lit(float(maxy)) - F.col(py) * ((maxy - miny) / h)),
    })
