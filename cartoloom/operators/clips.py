"""Liang-Barsky on Arrow batches: lines cut to boxes.

All segments of a batch are cut together. The arithmetic is that of ``tiles.clip_line``, so both give the same vertices.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from ..functions import geom as g
from .chains import _counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
LINE, MULTILINE = g.LINE, g.MULTILINE


def _cut(ax, ay, bx, by, box):
    """Start, end, whether it starts on the box, and whether anything is left of each segment."""
    minx, miny, maxx, maxy = box
    dx, dy = bx - ax, by - ay
    lo, hi, ok = np.zeros(len(ax)), np.ones(len(ax)), np.ones(len(ax), bool)
    for p, q in ((-dx, ax - minx), (dx, maxx - ax), (-dy, ay - miny), (dy, maxy - ay)):
        r = q / np.where(p == 0, 1.0, p)
        lo = np.maximum(lo, np.where(p < 0, r, 0.0))
        hi = np.fmin(hi, np.where((p > 0) | np.isnan(p), r, 1.0))  # Spark holds NaN for the largest number
        ok &= (p != 0) | (q >= 0)
    keep = ok & (lo <= hi) & ((lo < hi) | ((dx == 0) & (dy == 0)))
    start = [np.where(lo <= 0, a, a + lo * d) for a, d in ((ax, dx), (ay, dy))]
    end = [np.where(hi >= 1, b, a + hi * d) for a, b, d in ((ax, bx, dx), (ay, by, dy))]
    return start, end, lo > 0, keep


def _apart(a, b):
    return (a != b) & ~(np.isnan(a) & np.isnan(b))


def _nested(offsets, values):
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def lines_in_boxes(shapes: pa.Array, minx: pa.Array, miny: pa.Array, maxx: pa.Array, maxy: pa.Array) -> pa.Array:
    """For ``arrow_udf``: lines cut to the box of their row, without parts where nothing is left; null where a line lies inside."""
    parts = shapes.flatten()[1]
    rings = parts.flatten()
    lines = rings.flatten()
    n, sizes = len(shapes), _counts(lines)
    rows = np.repeat(np.repeat(np.arange(n), _counts(parts)), _counts(rings))
    x, y = lines.flatten().flatten()
    known = ~(x.is_null().to_numpy(zero_copy_only=False) | y.is_null().to_numpy(zero_copy_only=False))
    x, y = (c.to_numpy(zero_copy_only=False) for c in (x, y))
    sides = [c.to_numpy(zero_copy_only=False) for c in (minx, miny, maxx, maxy)]
    line = np.repeat(np.arange(len(sizes)), sizes)
    own = rows[line]
    inside = (x >= sides[0][own]) & (x <= sides[2][own]) & (y >= sides[1][own]) & (y <= sides[3][own])
    whole = np.bincount(own[~inside], minlength=n) == 0
    # a segment for each vertex that isn't its line's last one
    first = np.flatnonzero(line[1:] == line[:-1])
    own = own[first]
    with np.errstate(all="ignore"):
        start, end, enters, keep = _cut(x[first], y[first], x[first + 1], y[first + 1], [c[own] for c in sides])
    kept = np.flatnonzero(keep & known[first] & known[first + 1])
    start, end, enters, line, own = [c[kept] for c in start], [c[kept] for c in end], enters[kept], line[first][kept], own[kept]
    # a piece begins with a line, at the box, or where the last segment didn't end
    begins = np.ones(len(kept), bool)
    begins[1:] = (line[1:] != line[:-1]) | enters[1:] | _apart(end[0][:-1], start[0][1:]) | _apart(end[1][:-1], start[1][1:])
    heads = np.flatnonzero(begins)
    place = np.arange(len(kept)) + np.cumsum(begins)
    out = []
    for s, e in zip(start, end):
        values = np.empty(len(kept) + len(heads))
        values[place] = e
        values[heads + np.arange(len(heads))] = s[heads]
        out.append(pa.array(values))
    pieces = np.bincount(own[heads], minlength=n)
    made = pa.StructArray.from_arrays(out, ["x", "y"])
    made = _nested(np.append(heads + np.arange(len(heads)), len(kept) + len(heads)), made)
    made = _nested(np.arange(len(heads) + 1), made)
    made = _nested(np.concatenate(([0], np.cumsum(pieces))), made)
    kind = pa.array(np.where(pieces == 1, LINE, MULTILINE), pa.int32())
    return pa.StructArray.from_arrays([kind, made], ["type", "parts"], mask=pa.array(whole | shapes.is_null().to_numpy(zero_copy_only=False)))
