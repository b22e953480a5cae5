"""Douglas-Peucker inside chains of vertices, on Arrow batches.

All chains of a batch are split together, level by level. Pieces that are still open after ``PLAIN`` levels belong to chains that
split unevenly; from then on the farthest vertex of a piece comes from the hulls of a few fixed blocks: the distance to a
segment is convex, so the largest one is met on the boundary of a hull. Both ways give the same vertices.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

LEAF = 64
PLAIN = 32


def bound_batches(spark):
    """Batches are bounded in bytes, so that long geometries don't add up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def _half(order, xs, ys):
    """One side of a hull along vertices in order of place; vertices on its edges stay."""
    out = []
    for i in order:
        while len(out) > 1:
            a, b = out[-2], out[-1]
            if (xs[b] - xs[a]) * (ys[i] - ys[a]) - (ys[b] - ys[a]) * (xs[i] - xs[a]) >= 0:
                break
            out.pop()
        out.append(i)
    return out


def hull(among, xs, ys):
    """Of some vertices those on the boundary of their hull, in their order; of equal places the first."""
    order = among[np.lexsort((among, ys[among], xs[among]))]
    moved = np.concatenate(([True], (np.diff(xs[order]) != 0) | (np.diff(ys[order]) != 0)))
    order = order[moved]
    return np.unique(np.array(_half(order, xs, ys) + _half(order[::-1], xs, ys), dtype=np.int64))


class Hulls:
    """Hulls of blocks of 64 vertices, of pairs of blocks and so on, each made when first needed."""

    def __init__(self, xs, ys):
        self.xs, self.ys, self.made = xs, ys, {}

    def node(self, level, i):
        if (level, i) not in self.made:
            own = np.arange(i * LEAF, (i + 1) * LEAF) if level == 0 else np.concatenate((self.node(level - 1, 2 * i), self.node(level - 1, 2 * i + 1)))
            self.made[level, i] = hull(own, self.xs, self.ys)
        return self.made[level, i]

    def between(self, low, high):
        """Vertices of ``low..high - 1`` in order, among them every one that can be the first of the farthest."""
        first, last = -(-low // LEAF), high // LEAF
        out = [np.arange(low, first * LEAF)]
        while first < last:
            level = 0
            while first % (2 << level) == 0 and first + (2 << level) <= last:
                level += 1
            out.append(self.node(level, first >> level))
            first += 1 << level
        return np.concatenate([*out, np.arange(last * LEAF, high)])


def _distances(x, y, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = np.clip(((x - ax) * dx + (y - ay) * dy) / np.where(length2 == 0, 1.0, length2), 0.0, 1.0)
    t = np.where(length2 == 0, 0.0, t)
    ex, ey = ax + t * dx - x, ay + t * dy - y
    return np.sqrt(ex * ex + ey * ey)


def _level(xs, ys, low, high, distance):
    """Of each piece the first of its farthest vertices, -1 where it is not farther than the distance."""
    sizes = high - low - 1
    starts = np.cumsum(sizes) - sizes
    inner = np.arange(sizes.sum()) + np.repeat(low + 1 - starts, sizes)
    a, b = np.repeat(low, sizes), np.repeat(high, sizes)
    away = _distances(xs[inner], ys[inner], xs[a], ys[a], xs[b], ys[b])
    top = np.maximum.reduceat(away, starts)
    first = np.minimum.reduceat(np.where(away == np.repeat(top, sizes), inner, len(xs)), starts)
    return np.where(top > distance, first, -1)


def kept(xs, ys, low, high, distance):
    """Flags of the vertices that stay of the chains ``low[i]..high[i]``; of equally far ones the first splits.

    Vertices outside the chains are not flagged.
    """
    stay = np.zeros(len(xs), bool)
    stay[low] = stay[high] = True
    for _ in range(PLAIN):
        open_ = high - low > 1
        low, high = low[open_], high[open_]
        if not len(low):
            return stay
        middle = _level(xs, ys, low, high, distance)
        split = middle >= 0
        low, middle, high = low[split], middle[split], high[split]
        stay[middle] = True
        low, high = np.concatenate((low, middle)), np.concatenate((middle, high))
    hulls, pieces = Hulls(xs, ys), list(zip(low.tolist(), high.tolist()))
    while pieces:
        a, b = pieces.pop()
        if b - a < 2:
            continue
        among = hulls.between(a + 1, b) if b - a > 4 * LEAF else np.arange(a + 1, b)
        away = _distances(xs[among], ys[among], xs[a], ys[a], xs[b], ys[b])
        at = int(np.argmax(away))
        if away[at] > distance:
            middle = int(among[at])
            stay[middle] = True
            pieces += [(a, middle), (middle, b)]
    return stay


def _counts(lists):
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _nest(like, values, lengths):
    """A list array of new lengths, null where ``like`` is."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null() if like.null_count else None)


def _thin(lines, x, y, open_, distance):
    """Lists of vertices with those that stay, of the lists in ``open_``."""
    vertices, counts = lines.flatten(), _counts(lines)
    xs, ys = (vertices.field(c).to_numpy(zero_copy_only=False) for c in (x, y))
    ends = np.cumsum(counts)
    open_ &= counts > 2
    stay = kept(xs, ys, (ends - counts)[open_], ends[open_] - 1, distance) | ~np.repeat(open_, counts)
    running = np.concatenate(([0], np.cumsum(stay)))
    return _nest(lines, vertices.filter(pa.array(stay)), running[ends] - running[ends - counts])


def in_lists(distance):
    """For ``arrow_udf``: lists of vertices ``(seq, vx, vy)`` with those that stay."""

    def run(lines: pa.Array) -> pa.Array:
        return _thin(lines, "vx", "vy", np.ones(len(lines), bool), distance)

    return run


def in_column(distance, untouched):
    """For ``arrow_udf``: geometries with the vertices that stay; types in ``untouched`` and nulls come back as they are."""

    def run(shapes: pa.Array) -> pa.Array:
        parts = shapes.field("parts")
        rings = parts.flatten()
        lines = rings.flatten()
        kind = pc.fill_null(shapes.field("type"), untouched[0]).to_numpy(zero_copy_only=False)
        kind = np.repeat(np.repeat(kind, _counts(parts)), _counts(rings))
        made = _thin(lines, "x", "y", ~np.isin(kind, untouched), distance)
        made = _nest(parts, _nest(rings, made, _counts(rings)), _counts(parts))
        return pa.StructArray.from_arrays([shapes.field("type"), made], ["type", "parts"], mask=shapes.is_null() if shapes.null_count else None)

    return run
