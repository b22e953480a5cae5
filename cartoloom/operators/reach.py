"""How many lines come near each of some places, by numpy: a helper of ``query.count_lines``."""

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Places are halved until so many are left, or until they make no more than so many pairs with the segments near them.
LEAF, PAIRS = 24, 8192
#: So many pairs are looked at together.
TOGETHER = 2_000_000
#: Distances from a segment's straight line this close to the tolerance are taken again, with the segment's ends.
HAIR = 1e-3


def count_near(px, py, line, ax, ay, bx, by, tolerance):
    """For each place the number of lines with a segment within the tolerance, and the least distance (infinite without one).

    Places are halved across the wider side of their box, and each half keeps the segments that come near its box. Where few
    places are left, all pairs are compared. Of a line with a single segment there, whose ends lie beyond the box, that is the
    distance from a straight line; lines with several are counted once. Memory doesn't follow the hits.
    """
    found, best = np.zeros(len(px), np.int64), np.full(len(px), np.inf)
    if len(px) and len(line):
        by_line = np.argsort(line, kind="stable")
        line, ax, ay, bx, by = (v[by_line] for v in (line, ax, ay, bx, by))
        _Near(px, py, line, ax, ay, bx, by, float(tolerance), found, best).within(np.flatnonzero(np.isfinite(px + py)), np.flatnonzero(np.isfinite(ax + ay + bx + by)))
    return found, best


def in_groups(tolerance):
    """``count_near`` on the places and the segments of a group, as frames."""
    def count(places, segments):
        lines, nearest = count_near(*(places[c].to_numpy() for c in ("_px", "_py")), *(segments[c].to_numpy() for c in ("_line", "_ax", "_ay", "_bx", "_by")), tolerance)
        return places[["_px", "_py"]].assign(lines=lines, nearest=nearest)[lines > 0]

    return count


class _Near:
    """Places and segments, the latter in order of their lines, with what was found for each place."""

    def __init__(self, px, py, line, ax, ay, bx, by, tolerance, found, best):
        self.px, self.py, self.line, self.tolerance, self.found, self.best = px, py, line, tolerance, found, best
        dx, dy = bx - ax, by - ay
        length = np.hypot(dx, dy)
        per = 1.0 / np.where(length == 0, 1.0, length)
        self.segment = np.stack((ax, ay, dx, dy), 1)
        # the unit normal, its size on each axis, where the middle lies along it and along the segment, and half the length
        nx, ny, mx, my = np.where(length == 0, 1.0, -dy * per), dx * per, (ax + bx) / 2, (ay + by) / 2
        self.lies = np.stack((nx, ny, np.abs(nx), np.abs(ny), mx * nx + my * ny, mx * ny - my * nx, length / 2))

    def within(self, places, segments):
        """Counts the lines of some segments at some places."""
        pad = self.tolerance + HAIR
        stack = [(places, segments, self.lies.take(segments, axis=1))] if len(places) else []
        while stack:
            places, segments, lies = stack.pop()
            x, y = self.px[places], self.py[places]
            x0, x1, y0, y1 = x.min(), x.max(), y.min(), y.max()
            cx, cy, w, h = (x0 + x1) / 2, (y0 + y1) / 2, (x1 - x0) / 2, (y1 - y0) / 2
            nx, ny, wide, tall, across, along, half = lies
            across, along = nx * cx + ny * cy - across, np.abs(ny * cx - nx * cy - along)
            room = tall * w + wide * h
            near = np.flatnonzero((np.abs(across) <= wide * w + tall * h + pad) & (along <= room + (half + pad)))
            if not len(near):
                continue
            if len(near) < len(segments):
                segments, lies = segments[near], lies.take(near, axis=1)
            if len(places) > LEAF and len(places) * len(near) > PAIRS:
                half_way = len(places) // 2
                order = np.argpartition(x if w >= h else y, half_way)
                stack += [(places[order[:half_way]], segments, lies), (places[order[half_way:]], segments, lies)]
                continue
            # whether both ends of a segment lie beyond the box, as seen along it; zero lengths never do
            through = (along + room)[near] + HAIR < half[near]
            ids = self.line[segments]
            twice = ids[1:] == ids[:-1]
            through[1:] &= ~twice
            through[:-1] &= ~twice
            some = np.flatnonzero(through)
            self._straight(places, x - cx, y - cy, segments[some], lies[0, some], lies[1, some], across[near[some]])
            some = np.flatnonzero(~through)
            self._exact(places, x, y, segments[some], ids[some])

    def _straight(self, places, x, y, segments, nx, ny, offset):
        """Lines of one segment each, which lies along the whole box."""
        least, at = np.full(len(places), np.inf), np.zeros(len(places), np.int64)
        step = max(1, TOGETHER // len(places))
        for low in range(0, len(segments), step):
            some = slice(low, low + step)
            away = np.multiply.outer(x, nx[some])
            away += np.multiply.outer(y, ny[some])
            away += offset[some]
            np.abs(away, out=away)
            sure = np.count_nonzero(away < self.tolerance - HAIR, axis=1)
            if (np.count_nonzero(away <= self.tolerance + HAIR, axis=1) != sure).any():
                i, j = np.nonzero(np.abs(away - self.tolerance) <= HAIR)
                sure += np.bincount(i[self._distance(places[i], segments[low + j]) <= self.tolerance], minlength=len(places))
            self.found[places] += sure
            first = away.argmin(axis=1)
            away = away[np.arange(len(places)), first]
            closer = away < least
            least, at = np.where(closer, away, least), np.where(closer, low + first, at)
        i = np.flatnonzero(least <= self.tolerance + HAIR)
        if len(i):
            away = self._distance(places[i], segments[at[i]])
            self.best[places[i]] = np.minimum(self.best[places[i]], np.where(away <= self.tolerance, away, np.inf))

    def _exact(self, places, x, y, segments, ids):
        """Any segments; those of a line follow each other, and a place counts the line once."""
        before, last = None, np.zeros(len(places), bool)  # the line that the last piece ended with, and who has it
        step = max(1, TOGETHER // len(places))
        for low in range(0, len(segments), step):
            own = ids[low : low + step]
            away = _apart(x[:, None], y[:, None], *self.segment[segments[low : low + step]].T)
            hit = away <= self.tolerance
            self.best[places] = np.minimum(self.best[places], np.where(hit, away, np.inf).min(axis=1))
            heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            if len(heads) < len(own):
                hit = np.logical_or.reduceat(hit, heads, axis=1)
            if before == own[0]:
                hit[:, 0] |= last
            else:
                self.found[places] += last
            self.found[places] += np.count_nonzero(hit[:, :-1], axis=1)
            before, last = own[-1], hit[:, -1]
        self.found[places] += last

    def _distance(self, places, segments):
        return _apart(self.px[places], self.py[places], *self.segment[segments].T)


def _apart(x, y, ax, ay, dx, dy):
    """Distances of places from segments."""
    square = dx * dx + dy * dy
    t = np.clip(np.where(square == 0, 0.0, ((x - ax) * dx + (y - ay) * dy) / np.where(square == 0, 1.0, square)), 0.0, 1.0)
    return np.sqrt((x - (ax + t * dx)) ** 2 + (y - (ay + t * dy)) ** 2)
