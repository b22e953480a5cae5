"""Polygons are filled in Arrow batches, with a bounded number of crossings at once."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import burn, fills
from cartoloom.plans import QUERIES

W, H = 13, 9


def shapes(n=60):
    rng = random.Random(3)
    spot = lambda: (rng.choice([float(rng.randint(-3, 15)), rng.uniform(-3, 15)]), rng.choice([float(rng.randint(-3, 12)), rng.uniform(-3, 12)]))

    def ring():
        vs = [spot() for _ in range(rng.randint(3, 7))]
        return [*vs, vs[0]]

    return [[[ring() for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 2))] for _ in range(n)] + [[[[]]], [], [[[(1.0, 1.0)]]]]


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))


def brute(parts, rule, by_part):
    out = set()
    for y in range(H):
        for x in range(W):
            for k, group in enumerate([[p] for p in parts] if by_part else [parts]):
                w = 0
                for rings in group:
                    for i, ring in enumerate(rings):
                        turn = np.sign(area(ring)) * (1 if i == 0 else -1)
                        for a, b in zip(ring, ring[1:]):
                            if (a[1] > y + 0.5) != (b[1] > y + 0.5) and (b[0] - a[0]) * (y + 0.5 - a[1]) / (b[1] - a[1]) + a[0] <= x + 0.5:
                                w += turn if b[1] < a[1] else -turn
                if {"evenOdd": w % 2 == 1, "nonZero": w != 0, "positive": w > 0, "negative": w < 0}[rule]:
                    out.add((k if by_part else 0, x, y))
    return out


@pytest.mark.parametrize("by_part", [True, False])
@pytest.mark.parametrize("most", [fills.MOST, 3])
def test_fill_equals_brute_force(spark, monkeypatch, by_part, most):
    monkeypatch.setattr(fills, "MOST", most)
    given = shapes()
    df = spark.createDataFrame([(i, (g.MULTIPOLYGON, p)) for i, p in enumerate(given)], f"fid long, _cells {g.GEOM_TYPE}").repartition(2)
    cells = burn.polygon_cells(df, W, H, ["fid"], burn.FILL_RULES, by_part)
    got = {}
    for r in cells.collect():
        got.setdefault((r["fid"], r["rule"]), []).append((r["part"] if by_part else 0, r["x"], r["y"]))
    for i, parts in enumerate(given):
        for rule in burn.FILL_RULES:
            own = got.get((i, rule), [])
            assert len(own) == len(set(own)) and set(own) == brute(parts, rule, by_part)


def test_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(fills, "MOST", 50)
    box = [[[(0.0, 0.0), (0.0, 400.0), (400.0, 400.0), (400.0, 0.0), (0.0, 0.0)]]]
    kind = pa.struct([("type", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))])
    column = pa.array([{"type": g.POLYGON, "parts": [[[{"x": x, "y": y} for x, y in r] for r in p] for p in box]}] * 5, kind)
    pieces = list(fills._spans(fills._edges(column, 400, True), 400))
    assert max(len(p[0]) for p in pieces) <= 50 and sum(len(p[0]) for p in pieces) == 5 * 400


def test_long_rings_turn_as_short_ones(spark):
    turn = np.linspace(0, 2 * np.pi, 200)
    x, y = np.cos(turn), np.sin(turn)
    assert fills._turns(np.concatenate((x, x[::-1], x[:3])), np.concatenate((y, y[::-1], y[:3])), np.array([200, 200, 3])).tolist() == [1, -1, 1]


def test_crossings_are_not_sorted_by_spark(spark):
    plan = QUERIES["t13_fill_rule_cover"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert burn.fill_rule_cover(spark.createDataFrame([], f"fid long, _cells {g.GEOM_TYPE}"), W, H, "evenOdd").where(F.lit(True)).count() == 0
