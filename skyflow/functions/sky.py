"""Positions on the sky: separations and the declination-zone cells that turn cone matches into equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

MATCH_RADIUS_DEG = 0.000277778   # fixed value: the 1 arcsec match radius
CELLS_PER_RADIUS = 16            # a join cell is this many radii high
_ZONE_SHIFT = 1 << 32
_MARGIN = 1.0 + 1e-9             # keeps positions on a cell edge inside the ball that touches it


def haversine_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """sin^2(separation / 2): grows with the separation, so it can be compared and ordered as it is."""
    return (
        f"(pow(sin(radians({dec2} - {dec1}) / 2), 2) + cos(radians({dec1})) * cos(radians({dec2})) "
        f"* pow(sin(radians({ra2} - {ra1}) / 2), 2))"
    )


def haversine_limit(radius_deg: float) -> float:
    return math.sin(math.radians(radius_deg) / 2) ** 2


def haversine_to_arcsec(h: Column) -> Column:
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))) * 3600.0


def angular_sep_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))

    h = half_chord(dec1, dec2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * half_chord(ra1, ra2)
    return haversine_to_arcsec(h)


def _zone(dec: str, height: float) -> str:
    top = math.ceil(180.0 / height) - 1
    return f"CAST(least(greatest(floor(({dec} + 90D) / {height!r}D), 0), {top}) AS BIGINT)"


def _buckets(zone: str, height: float) -> str:
    """RA buckets of a zone: about square cells, fewer towards the poles."""
    return f"CAST(greatest(floor(360D * cos(radians(({zone} + 0.5D) * {height!r}D - 90D)) / {height!r}D), 1) AS BIGINT)"


def with_cell(df: DataFrame, ra: str, dec: str, height: float, name: str) -> DataFrame:
    """`df` plus the cell its position lies in, as one long."""
    zone = _zone(dec, height)
    n = _buckets(zone, height)
    return df.withColumn(name, F.expr(f"{zone} * {_ZONE_SHIFT}L + pmod(CAST(floor({ra} / 360D * {n}) AS BIGINT), {n})"))


def with_ball_cells(df: DataFrame, ra: str, dec: str, radius_deg: float, height: float, name: str) -> DataFrame:
    """One row of `df` per cell that a circle of `radius_deg` around the position touches (RA wrap and poles included)."""
    r = radius_deg * _MARGIN
    half = (
        f"CASE WHEN abs({dec}) + {r!r}D >= 90D THEN 180D ELSE degrees(asin(least(1D, {math.sin(math.radians(r))!r}D "
        f"/ cos(radians({dec}))))) * {_MARGIN!r}D + 1e-12D END"
    )
    zones = f"sequence({_zone(f'({dec} - {r!r}D)', height)}, {_zone(f'({dec} + {r!r}D)', height)})"
    per_zone = df.withColumn("_half", F.expr(half)).withColumn("_zone", F.expr(f"explode({zones})"))
    sized = per_zone.withColumn("_n", F.expr(_buckets("_zone", height)))
    low, high = (f"CAST(floor(({ra} {sign} _half) / 360D * _n) AS BIGINT)" for sign in "-+")
    buckets = sized.withColumn("_bucket", F.expr(f"explode(sequence({low}, least({high}, {low} + _n - 1)))"))
    return buckets.withColumn(name, F.expr(f"_zone * {_ZONE_SHIFT}L + pmod(_bucket, _n)")).drop("_half", "_zone", "_n", "_bucket")


def tight_cell(ra: str, dec: str, radius_deg: float) -> Column:
    """A cell so small that any two positions in it are less than `radius_deg` apart."""
    side = radius_deg / math.sqrt(2.0) * (1.0 - 1e-6)
    zone = f"CAST(floor(({dec} + 90D) / {side!r}D) AS BIGINT)"
    low, high = f"({zone} * {side!r}D - 90D)", f"(({zone} + 1) * {side!r}D - 90D)"
    widest = f"CASE WHEN {low} * {high} <= 0 THEN 1D ELSE cos(radians(least(abs({low}), abs({high})))) END"
    n = f"CAST(greatest(ceil(360D * ({widest}) / {side!r}D), 1) AS BIGINT)"
    return F.expr(f"{zone} * {_ZONE_SHIFT}L + pmod(CAST(floor({ra} / 360D * {n}) AS BIGINT), {n})")
