"""Spans of polygons on the rows of a grid, on Arrow batches.

The crossings of all polygons of a batch are sorted together. No more than about ``MOST`` of them are held at once: a batch
is halved by features, and a single feature by grid rows, since a row's crossings depend on no other row.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from .chains import _counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

MOST = 500_000
#: Rings of more vertices are summed one by one.
SHORT = 64


def _turns(x, y, sizes):
    """The sign of each ring's area, summed up in the order of its vertices as ``geom.ring_area`` does."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    area = np.zeros(len(sizes))
    cross = np.append(x[:-1] * y[1:] - x[1:] * y[:-1], 0.0) if len(x) else x
    for k in range(min(SHORT, int(sizes.max(initial=1))) - 1):
        own = np.flatnonzero((sizes > k + 1) & (sizes <= SHORT))
        area[own] += cross[starts[own] + k]
    for i in np.flatnonzero(sizes > SHORT):
        area[i] = np.cumsum(cross[starts[i] : ends[i] - 1])[-1]
    return np.sign(np.nan_to_num(area, nan=0.0)).astype(np.int64)


def _edges(shapes, height, by_part):
    """Edges that cross a row: feature, part, ends, direction, first and last row."""
    parts = shapes.flatten()[1]
    rings = parts.flatten()
    lines = rings.flatten()
    per_part, per_ring = _counts(rings), _counts(lines)
    within = lambda sizes: np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    feature = np.repeat(np.arange(len(shapes)), _counts(parts))
    part = within(_counts(parts))
    x, y = (c.to_numpy(zero_copy_only=False).astype(float) for c in lines.flatten().flatten())
    turn = _turns(x, y, per_ring) * np.where(within(per_part) == 0, 1, -1)
    ring = np.repeat(np.arange(len(per_ring)), per_ring)
    a = np.flatnonzero(ring[1:] == ring[:-1])
    ax, ay, bx, by = x[a], y[a], x[a + 1], y[a + 1]
    known = ~np.isnan(ax + bx + ay + by)
    place = lambda v: np.ceil(np.clip(v, -1.0, height + 1.0) - 0.5)
    low = np.where(known, np.maximum(place(np.minimum(ay, by)), 0), 1).astype(np.int64)
    high = np.where(known, np.minimum(place(np.maximum(ay, by)) - 1, height - 1), 0).astype(np.int64)
    kept = np.flatnonzero(low <= high)
    owner = np.repeat(np.arange(len(per_part)), per_part)[ring[a[kept]]]
    step = np.where(by[kept] < ay[kept], turn[ring[a[kept]]], -turn[ring[a[kept]]])
    return feature[owner], part[owner] if by_part else np.zeros(len(kept), np.int64), ax[kept], ay[kept], bx[kept], by[kept], step, low[kept], high[kept]


def _spans(edges, width):
    """``(feature, part, row, first cell, last cell, winding number)`` arrays of the spans that hold a cell, in pieces."""
    feature, part, ax, ay, bx, by, step, low, high = edges
    n = high - low + 1
    if n.sum() > MOST:
        middle = (feature.min() + feature.max()) // 2
        if feature.min() < feature.max():
            for half in (feature <= middle, feature > middle):
                yield from _spans([c[half] for c in edges], width)
            return
        first, last = low.min(), high.max()
        if first < last:
            middle = (first + last) // 2
            for half, bounds in ((low <= middle, (first, middle)), (high > middle, (middle + 1, last))):
                own = [c[half] for c in edges]
                yield from _spans([*own[:7], np.maximum(own[7], bounds[0]), np.minimum(own[8], bounds[1])], width)
            return
    if not len(n):
        return
    own = np.repeat(np.arange(len(n)), n)
    row = np.arange(len(own)) - np.repeat(np.cumsum(n) - n - low, n)
    ax, ay, bx, by = ax[own], ay[own], bx[own], by[own]
    x = (bx - ax) * (row + 0.5 - ay) / np.where(by == ay, 1.0, by - ay) + ax
    feature, part, step = feature[own], part[own], step[own]
    order = np.lexsort((x, row, part, feature))
    x, row, part, feature, step = x[order], row[order], part[order], feature[order], step[order]
    same = (feature[1:] == feature[:-1]) & (part[1:] == part[:-1]) & (row[1:] == row[:-1])
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    total = np.cumsum(step)
    winding = total - np.repeat(total[heads] - step[heads], np.diff(np.append(heads, len(x))))
    cell = lambda v: np.ceil(np.clip(v, -1.0, width + 1.0) - 0.5)
    first, last = np.maximum(cell(x[:-1]), 0), np.minimum(cell(x[1:]) - 1, width - 1)
    kept = np.flatnonzero(same & (winding[:-1] != 0) & (first <= last))
    yield feature[kept], part[kept], row[kept], first[kept].astype(np.int64), last[kept].astype(np.int64), winding[kept]


def in_batches(keep, width, height, by_part):
    """For ``mapInArrow``: the ``keep`` columns of each polygon with its spans; the last column has the shapes."""

    def run(batches):
        for batch in batches:
            with np.errstate(all="ignore"):
                for feature, *spans in _spans(_edges(batch.column(len(keep)), height, by_part), width):
                    own = batch.select(list(range(len(keep)))).take(pa.array(feature))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(spans[0], pa.int32()), *[pa.array(c, pa.int64()) for c in spans[1:]]], names=[*keep, "part", "y", "_c0", "_c1", "_w"])

    return run
