"""Great-circle distance and points on the unit sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, decimals: int | None = 4) -> Column:
    """Great-circle distance of two points given in degrees."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    square = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    km = 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), square)))
    return km if decimals is None else F.round(km, decimals)


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point as x, y, z on the unit sphere; poles and the date line are ordinary there."""
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def hilbert_position(lat: Column, lon: Column, bits: int = 20) -> Column:
    """Position on the Hilbert curve over the lat/lon plane: near points get near numbers."""
    cells = 1 << bits

    def cell(c: Column, span: int) -> Column:
        return F.least(F.floor((c + span / 2) / span * cells), F.lit(cells - 1)).cast("long")

    def descend(at: Column, step: Column) -> Column:
        right = at["x"].bitwiseAND(step) != 0
        upper = at["y"].bitwiseAND(step) != 0
        quadrant = (
            F.when(upper & right, 2).when(upper, 1).when(right, 3).otherwise(0).cast("long")
        )
        turned = F.when(right, F.lit(cells - 1)).otherwise(F.lit(0)).cast("long")
        return F.struct(
            (at["d"] + step * step * quadrant).alias("d"),
            F.when(upper, at["x"]).otherwise(at["y"].bitwiseXOR(turned)).alias("x"),
            F.when(upper, at["y"]).otherwise(at["x"].bitwiseXOR(turned)).alias("y"),
        )

    start = F.struct(F.lit(0).cast("long").alias("d"), cell(lon, 360).alias("x"), cell(lat, 180).alias("y"))
    steps = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(bits))])
    return F.aggregate(steps, start, descend, lambda at: at["d"])


def grid_cell(c: Column, step: float) -> Column:
    return F.floor(c / F.lit(step)).cast("long")
