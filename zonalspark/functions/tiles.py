"""Projections (Web Mercator, UTM, national Krovak) and tile arithmetic as column expressions."""

from __future__ import annotations

import math
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import krovak

#: The sphere and the ellipsoid of these projections, and the pixel of zoom 0.
RADIUS = 6378137.0
PIXEL_0 = 156543.03392804097
FLATTENING = 1 / 298.257223563
UTM_SCALE, UTM_EAST = 0.9996, 500000.0


def pixel_size(zoom: int) -> float:
    return PIXEL_0 / 2**zoom


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * RADIUS, F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def utm_steps(zone: int) -> krovak.Steps:
    """Northern UTM by the usual series in the third flattening: millimetres within the zone."""
    n = FLATTENING / (2 - FLATTENING)
    a = RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3)
    k = 2 * math.sqrt(n) / (1 + n)

    def place(xi: Column, eta: Column) -> dict[str, Column]:
        east = eta + sum(c * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, c in enumerate(alpha, 1))
        north = xi + sum(c * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, c in enumerate(alpha, 1))
        return {"x": UTM_EAST + UTM_SCALE * a * east, "y": UTM_SCALE * a * north}

    return (
        lambda x, y: {"sine": F.sin(F.radians(y)), "lam": F.radians(x - (6 * zone - 183))},
        lambda sine, lam: {"t": F.sinh(F.atanh(sine) - k * F.atanh(k * sine)), "lam": lam},
        lambda t, lam: {"xi": F.atan2(t, F.cos(lam)), "eta": F.atanh(F.sin(lam) / F.sqrt(1 + t * t))},
        place,
    )


def from_utm_steps(zone: int) -> krovak.Steps:
    """Degrees of northern UTM, by the same series the other way."""
    n = FLATTENING / (2 - FLATTENING)
    a = RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)

    def sphere(xi: Column, eta: Column) -> dict[str, Column]:
        north = xi - sum(c * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, c in enumerate(beta, 1))
        east = eta - sum(c * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, c in enumerate(beta, 1))
        return {"north": north, "east": east}

    def degrees(chi: Column, lam: Column) -> dict[str, Column]:
        lat = chi + sum(c * F.sin(2 * j * chi) for j, c in enumerate(delta, 1))
        return {"x": F.degrees(lam) + (6 * zone - 183), "y": F.degrees(lat)}

    return (
        lambda x, y: {"xi": y / (UTM_SCALE * a), "eta": (x - UTM_EAST) / (UTM_SCALE * a)}, sphere,
        lambda north, east: {"chi": F.asin(F.sin(north) / F.cosh(east)), "lam": F.atan2(F.sinh(east), F.cos(north))}, degrees,
    )


def to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    out = krovak.nested(utm_steps(zone), x=lon, y=lat)
    return out["x"], out["y"]


def from_utm(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    out = krovak.nested(from_utm_steps(zone), x=x, y=y)
    return out["x"], out["y"]


#: The steps from and to degrees, by EPSG number.
PROJECTIONS: dict[int, tuple[krovak.Steps, krovak.Steps]] = {
    4326: ((), ()),
    3857: ((lambda x, y: dict(zip("xy", to_mercator(x, y), strict=True)),), (lambda x, y: dict(zip("xy", from_mercator(x, y), strict=True)),)),
    32633: (utm_steps(33), from_utm_steps(33)),
    5514: (krovak.FORWARD, krovak.INVERSE),
}


def _steps(*route: int) -> krovak.Steps:
    """The steps from the first projection by way of the others to the last one."""
    return tuple(step for a, b in pairwise(route) if a != b for step in PROJECTIONS[a][1] + PROJECTIONS[b][0])


def project(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """A point of one projection in another, by EPSG numbers, as expressions. For a whole table see ``projected``."""
    steps = _steps(source, target)
    if len(steps) < 2:
        out = steps[0](x, y) if steps else {"x": x, "y": y}
    else:
        out = krovak.nested(steps, x=x, y=y)
    return out["x"], out["y"]


def projected(df: DataFrame, x: Column, y: Column, *route: int, names: tuple[str, str]) -> DataFrame:
    """df with a point of the first projection in the last one, by way of those between, as two columns. Both are computed at once, step by step."""
    return krovak.chained(df, _steps(*route), dict(zip("xy", names, strict=True)), x=x, y=y)


def tile_of(x: Column, y: Column, zoom: int) -> tuple[Column, Column]:
    """Tile column and row of a Mercator point, counted from the north-west."""
    edge = math.pi * RADIUS
    size = 2 * edge / 2**zoom
    return F.floor((x + edge) / size).cast("int"), F.floor((edge - y) / size).cast("int")


def overzoom(z: Column, x: Column, y: Column, native: int) -> Column:
    """struct(z, x, y, factor, sub_x, sub_y): the deepest tile there is, and the part of it that is asked for."""
    factor = F.pow(F.lit(2), F.greatest(z - native, F.lit(0))).cast("int")
    return F.struct(F.least(z, F.lit(native)).alias("z"), F.floor(x / factor).cast("int").alias("x"), F.floor(y / factor).cast("int").alias("y"), factor.alias("factor"), F.pmod(x, factor).alias("sub_x"), F.pmod(y, factor).alias("sub_y"))
