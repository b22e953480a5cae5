"""Images made smaller and larger: every source cell counts, means stay."""

import random

import pytest
from pyspark.sql import functions as F

from cartoloom.operators import raster

# Kernels that are nowhere below zero, so that a mean lies between the cells.
POSITIVE = ["bicubic", "hanning", "hamming", "hermite", "kaiser", "quadric", "gaussian"]


def gray(spark, size, value):
    return spark.createDataFrame([(0, x, y, float(value(x, y))) for x in range(size) for y in range(size)], "img_id long, x int, y int, v double")


def mean(df, c="v"):
    return df.agg(F.avg(c)).first()[0]


@pytest.mark.parametrize("method", ["bilinear", *raster.KERNELS])
def test_reducing_keeps_the_mean(spark, method):
    rng = random.Random(5)
    image = gray(spark, 64, lambda x, y: rng.randint(0, 199))
    small = raster.resize(image, 8, 8, method)
    assert small.count() == 64 and abs(mean(small) - mean(image)) < 6
    flat = raster.resize(gray(spark, 16, lambda x, y: 7), 5, 3, method).agg(F.min("v"), F.max("v"), F.count("v")).first()
    assert abs(flat[0] - 7) < 1e-9 and abs(flat[1] - 7) < 1e-9 and flat[2] == 15


@pytest.mark.parametrize("method", ["bilinear", *POSITIVE])
def test_every_source_cell_counts(spark, method):
    """One bright cell anywhere is seen in the small image."""
    for at in ((0, 0), (5, 9), (15, 15), (7, 8)):
        small = raster.resize(gray(spark, 16, lambda x, y: 1_000 if (x, y) == at else 0), 4, 4, method).collect()
        best = max(small, key=lambda r: r["v"])
        assert best["v"] > 0 and abs(best["x"] - at[0] // 4) <= 1 and abs(best["y"] - at[1] // 4) <= 1


def test_bilinear_to_half_is_the_triangle(spark):
    """By hand: at half the size the weights of one axis are 1, 3, 3, 1 of 8, less at the border."""
    row = [float(v) for v in (8, 0, 0, 0, 16, 0, 0, 0)]
    image = spark.createDataFrame([(0, x, 0, v) for x, v in enumerate(row)], "img_id long, x int, y int, v double")
    got = [r["v"] for r in raster.resize_bilinear(image, 4, 1).orderBy("x").collect()]
    assert got == pytest.approx([8 * 3 / 7, 16 / 8, 16 * 3 / 8, 0])


def test_enlarging_is_as_before(spark):
    image = spark.createDataFrame([(0, 0, 0, 0.0), (0, 1, 0, 8.0)], "img_id long, x int, y int, v double")
    assert [r["v"] for r in raster.resize_bilinear(image, 4, 1).orderBy("x").collect()] == pytest.approx([0, 2, 6, 8])


def test_colours_keep_alpha(spark):
    """Transparent cells give no colour to their neighbours."""
    cells = [(0, x, y, *((250, 10, 20, 255) if (x + y) % 2 else (0, 0, 0, 0))) for x in range(16) for y in range(16)]
    image = spark.createDataFrame(cells, "img_id long, x int, y int, r int, g int, b int, a int")
    for r in raster.resize_bilinear(image, 4, 4).collect():
        assert abs(r["a"] - 128) <= 1 and abs(r["r"] - 250) <= 2 and abs(r["g"] - 10) <= 1 and abs(r["b"] - 20) <= 1
