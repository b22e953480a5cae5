"""Spherical mercator (3857) and longitude/latitude (4326) as column functions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geom as g

# Fixed values of the web mercator definition.
RADIUS = 6378137.0
HALF_WORLD = 20037508.342789244
MAX_LATITUDE = 85.0511287798066
METERS_PER_DEGREE = 111319.49079327358
PIXEL_SIZE = 0.00028

SRS = {"epsg:4326": 4326, "epsg:3857": 3857, "4326": 4326, "3857": 3857, 4326: 4326, 3857: 3857}


def merc_x(lon) -> Column:
    return g.col(lon) * (HALF_WORLD / 180)


def merc_y(lat) -> Column:
    lat = F.greatest(F.least(g.col(lat), F.lit(MAX_LATITUDE)), F.lit(-MAX_LATITUDE))
    return F.log(F.tan((lat + 90) * (math.pi / 360))) * RADIUS


def mercator_position(lon: float, lat: float) -> tuple[float, float]:
    """Mercator coordinates of one query position."""
    lat = max(min(lat, MAX_LATITUDE), -MAX_LATITUDE)
    return lon * (HALF_WORLD / 180), math.log(math.tan((lat + 90) * (math.pi / 360))) * RADIUS


def lon_of(x) -> Column:
    return g.col(x) / HALF_WORLD * 180


def lat_of(y) -> Column:
    return (F.atan(F.exp(g.col(y) / RADIUS)) * 2 - math.pi / 2) * (180 / math.pi)


def srs_code(srs) -> int:
    key = srs.lower() if isinstance(srs, str) else srs
    if key not in SRS:
        raise ValueError(f"unsupported projection: {srs!r} (4326 and 3857 are known)")
    return SRS[key]


def transformer(src, dst):
    """``fn(x, y) -> (x, y)`` from one projection to the other, or None when they are the same."""
    s, d = srs_code(src), srs_code(dst)
    if s == d:
        return None
    if s == 4326:
        return lambda x, y: (merc_x(x), merc_y(y))
    return lambda x, y: (lon_of(x), lat_of(y))


def world_u(x) -> Column:
    """Mercator x as a fraction of the world's width, west to east."""
    return (g.col(x) + HALF_WORLD) / (2 * HALF_WORLD)


def world_v(y) -> Column:
    """Mercator y as a fraction of the world's height, north to south."""
    return (F.lit(HALF_WORLD) - g.col(y)) / (2 * HALF_WORLD)


def n_tiles(z) -> Column:
    z = F.lit(z) if isinstance(z, int) else g.col(z)
    return F.pow(F.lit(2.0), z)


def tile_index(world, z) -> Column:
    n = n_tiles(z)
    return F.least(F.greatest(F.floor(world * n), F.lit(0)), (n - 1).cast("bigint")).cast("int")
