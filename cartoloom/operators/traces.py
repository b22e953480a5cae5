"""Rings around covered cells on Arrow batches, many groups of cells at once (T15): a helper of ``outline.cover_rings``.

Cells are held as runs along their rows. The ends of runs that follow each other in a column are one upright edge, and at
each of its two corners a level edge leads to another upright one, so a ring is worked on by its corners, not by its cells.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from ..functions import geom as g
from .chains import _counts
from .clips import _nested

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
MULTIPOLYGON = g.MULTIPOLYGON

#: About so many runs are traced together.
TOGETHER = 100_000


def _order(*keys):
    """Order by whole numbers of at least 0, the first one being the most significant."""
    code, room = np.zeros(len(keys[0]), np.int64), 1
    for k in keys:
        size = int(k.max(initial=0)) + 1
        room *= size
        if room >= 2**62:
            return np.lexsort(keys[::-1])
        code = code * size + k
    return np.argsort(code, kind="stable")


def _owners(columns, n):
    """A number for each of ``n`` rows, the same for rows of equal keys."""
    own = np.zeros(n, np.int64)
    for c in columns:
        held = c.dictionary_encode(null_encoding="encode")
        own = np.unique(own * max(1, len(held.dictionary)) + held.indices.to_numpy(), return_inverse=True)[1]
    return own


def in_runs(keep):
    """For ``mapInArrow``: cells as one row per key and batch, its runs as ``y``, first cell and the one after the last in a row."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _owners(batch.columns[: len(keep)], batch.num_rows)
            x, y = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[len(keep) :])
            order = _order(own, y, x)
            own, x, y = own[order], x[order], y[order]
            first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (y[1:] != y[:-1]) | (x[1:] > x[:-1] + 1))))
            runs = np.stack((y[first], x[first], x[np.append(first[1:], len(x)) - 1] + 1), 1).astype(np.int32)
            heads = np.flatnonzero(np.concatenate(([True], own[first][1:] != own[first][:-1])))
            ends = np.append(heads, len(first))
            keys = [batch.column(i).take(pa.array(order[first[heads]])) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*keys, _nested(3 * ends, pa.array(runs.ravel())), pa.array(np.diff(ends), pa.int32())], names=[*keep, "_runs", "_n"])

    return run


def _merged(group, y, a, b):
    """Runs in order of group, row and cell; those that overlap or touch are one."""
    order = _order(group, y, a)
    group, y, a, b = group[order], y[order], a[order], b[order]
    row = np.cumsum(np.concatenate(([False], (group[1:] != group[:-1]) | (y[1:] != y[:-1])))) << 30
    reach = np.maximum.accumulate(row + b)
    heads = np.flatnonzero(np.concatenate(([True], row[1:] + a[1:] > reach[:-1])))
    last = np.append(heads[1:], len(a)) - 1
    return group[heads], y[heads], a[heads], reach[last] - row[last]


def trace(group, y, a, b):
    """Rings around runs ``a`` to ``b`` in rows ``y`` of groups: the group of each part, rings of a part, vertices of a ring, their places.

    Rings have covered cells on their right in a frame with y down and begin with their upper left corner. At a corner where
    two cells touch, a ring stays with its cell.
    """
    group, y, a, b = _merged(group, y, a, b)
    # the ends of runs, in rows; an odd one has its cells on the left
    tg, ty, tx = np.repeat(group, 2), np.repeat(y, 2), np.stack((a, b), 1).ravel()
    col = _order(tg, tx, ty)
    cg, cx, cy, odd = tg[col], tx[col], ty[col], col & 1
    begins = np.concatenate(([True], (cg[1:] != cg[:-1]) | (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1] + 1) | (odd[1:] != odd[:-1])))
    # upright edges, numbered by group, upper end and column
    is_first = np.zeros(len(col), bool)
    is_first[col[begins]] = True
    first = np.flatnonzero(is_first)
    number = (np.cumsum(is_first) - 1)[col[begins]]
    edge = np.empty(len(col), np.int64)
    edge[col] = number[np.cumsum(begins) - 1]
    n = len(first)
    eg, ex, top, down = tg[first], tx[first], ty[first], (first & 1) == 1
    bottom = np.empty(n, np.int64)
    bottom[number] = cy[np.append(np.flatnonzero(begins)[1:], len(col)) - 1] + 1
    # corners along the rows: two and two are the ends of a level edge
    flat = _order(np.tile(eg, 2), np.concatenate((top, bottom)), np.tile(ex, 2), np.tile(~down, 2).astype(np.int64))
    other = np.empty(2 * n, np.int64)
    other[flat[::2]], other[flat[1::2]] = flat[1::2], flat[::2]
    ahead = other[np.where(down, n, 0) + np.arange(n)] % n
    # the least edge of each ring, and the steps to it
    least, steps, reach = np.arange(n), np.zeros(n, np.int64), 1
    while (lower := least[ahead] < least).any():
        least, steps = np.where(lower, least[ahead], least), np.where(lower, steps[ahead] + reach, steps)
        ahead, reach = ahead[ahead], reach * 2
    heads = np.flatnonzero(least == np.arange(n))
    ring = np.searchsorted(heads, least)
    sizes = np.bincount(ring)
    at = np.where(steps == 0, 0, sizes[ring] - steps)
    hole = down[heads]
    shell = np.arange(len(heads))
    if hole.any():
        # the ring that begins the run to the left of the hole's leftmost edge; it may be a hole itself
        own = np.flatnonzero(down & hole[ring])
        own = own[_order(ring[own], ex[own], top[own])]
        own = own[np.concatenate(([True], ring[own][1:] != ring[own][:-1]))]
        shell[ring[own]] = ring[edge[first[own] - 1]]
        while (shell[shell] != shell).any():
            shell = shell[shell]
    turn = np.argsort(shell, kind="stable")
    starts = np.empty(len(heads), np.int64)
    starts[turn] = np.cumsum(2 * sizes[turn] + 1) - 2 * sizes[turn] - 1
    # an edge gives its two ends; a hole begins with the start of its first edge, a shell with the end of it
    vx, vy = np.empty(2 * n + len(heads), np.int64), np.empty(2 * n + len(heads), np.int64)
    shift = np.where(hole[ring], 0, 1)
    for k, level in ((0, np.where(down, top, bottom)), (1, np.where(down, bottom, top))):
        place = starts[ring] + (2 * at + k - shift) % (2 * sizes[ring])
        vx[place], vy[place] = ex, level
    vx[starts + 2 * sizes], vy[starts + 2 * sizes] = vx[starts], vy[starts]
    return eg[heads[~hole]], np.bincount(shell, minlength=len(heads))[~hole], (2 * sizes + 1)[turn], vx, vy


def in_rings(keep, name):
    """For ``mapInArrow``: the multipolygon of each row's runs beside its ``keep`` columns."""

    def run(batches):
        for batch in batches:
            runs = batch.column(len(keep))
            sizes = _counts(runs) // 3
            ends = np.cumsum(sizes)
            held = runs.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 3)
            for some in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff((ends - sizes) // TOGETHER)) + 1):
                if not len(some):
                    continue
                own = np.repeat(np.arange(len(some)), sizes[some])
                group, rings, vertices, vx, vy = trace(own, *held[ends[some[0]] - sizes[some[0]] : ends[some[-1]]].T)
                parts = pa.StructArray.from_arrays([pa.array(vx.astype(float)), pa.array(vy.astype(float))], ["x", "y"])
                for counts in (vertices, rings, np.bincount(group, minlength=len(some))):
                    parts = _nested(np.concatenate(([0], np.cumsum(counts))), parts)
                shape = pa.StructArray.from_arrays([pa.array(np.full(len(some), MULTIPOLYGON), pa.int32()), parts], ["type", "parts"])
                yield pa.RecordBatch.from_arrays([*batch.slice(some[0], len(some)).columns[: len(keep)], shape], names=[*keep, name])

    return run
