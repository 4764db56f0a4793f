"""Great-circle distance and a hierarchical metric grid, for Columns and for numpy arrays."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180
BAND_DEGREES = 0.5


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def haversine(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(h, 1.0)))


def haversines(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def grid_cells(lat: np.ndarray, lon: np.ndarray, edge_m: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band, row, column) of the grid cell of each position.

    Rows are edge_m high. Columns are edge_m wide at the band's edge nearest the equator (bands are
    half a degree of latitude), so two positions of one band less than edge_m * 0.98 apart lie in the
    same or neighbouring cells. A cell's parent k levels up is (band, row >> k, column >> k).
    """
    band = np.floor(lat / BAND_DEGREES)
    near = np.minimum(np.abs(band), np.abs(band + 1)) * BAND_DEGREES
    row = np.floor(lat * (METRES_PER_DEGREE / edge_m))
    column = np.floor(lon * np.cos(np.radians(near)) * (METRES_PER_DEGREE / edge_m))
    return band.astype(np.int64), row.astype(np.int64), column.astype(np.int64)
