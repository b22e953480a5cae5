"""Registered queries over the driver's tables, each with the SQL that checks it."""

from . import rasters, shapes, tables, tiling  # noqa: F401  (registration)
from .registry import ORACLES, QUERIES  # noqa: F401
