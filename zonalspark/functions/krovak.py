"""The oblique conic projection of the Czech and Slovak grid, and its datum, as column expressions.

The formulas are the public ones of the EPSG guidance notes: method 9819 (here with
east and north positive) and the seven-parameter position vector transformation.
They are steps: functions from named values to the named values of the next one, from
x and y to x and y. A formula names a value many times, and a value of a value more
often with every step, so each step's values are computed once (``nested``, ``chained``).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Steps = tuple[Callable[..., dict[str, Column]], ...]

#: The two ellipsoids (semi-axis, flattening), and the projection's parameters in degrees.
BESSEL, WGS84 = (6377397.155, 1 / 299.1528128), (6378137.0, 1 / 298.257223563)
LAT_CENTRE, LON_ORIGIN, CONE_COLATITUDE, PSEUDO_PARALLEL, SCALE = 49.5, 24 + 50 / 60, 30 + 17 / 60 + 17.30311 / 3600, 78.5, 0.9999
#: Shift to WGS 84 in metres, rotations in seconds of arc, scale in parts of a million.
SHIFT, ROTATION, PPM = (570.8, 85.7, 462.8), (4.998, 1.587, 5.261), 3.56

_A, _F = BESSEL
_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)
_C, _P, _K = math.radians(LAT_CENTRE), math.radians(PSEUDO_PARALLEL), math.radians(CONE_COLATITUDE)
_B = math.sqrt(1 + _E2 * math.cos(_C) ** 4 / (1 - _E2))
_G = math.asin(math.sin(_C) / _B)
_T0 = math.tan(math.pi / 4 + _G / 2) * ((1 + _E * math.sin(_C)) / (1 - _E * math.sin(_C))) ** (_E * _B / 2) / math.tan(math.pi / 4 + _C / 2) ** _B
_N = math.sin(_P)
_R0 = SCALE * _A * math.sqrt(1 - _E2) / (1 - _E2 * math.sin(_C) ** 2) / math.tan(_P)
_RATIO = math.tan(math.pi / 4 + _P / 2)


def bind(f, **values: Column) -> Column:
    """f of named values that are computed once: nested formulas stay as long as they are written."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), lambda s: f(*(s[k] for k in values))), F.lit(0))


def nested(steps: Steps, **values: Column) -> Column:
    """The last step's values as a struct, for use inside of other expressions. A single step is written as it is."""
    if not steps:
        return F.struct(*(c.alias(k) for k, c in values.items()))
    if len(steps) == 1:
        return nested((), **steps[0](**values))
    return _bound(steps, values)


def _bound(steps: Steps, values: dict[str, Column]) -> Column:
    if not steps:
        return nested((), **values)
    return bind(lambda *v: _bound(steps[1:], steps[0](**dict(zip(values, v, strict=True)))), **values)


#: Steps of one compiled method: HotSpot only interprets a method of more than 8,000 bytes, which is ten times slower.
TOGETHER = 14


def chained(df: DataFrame, steps: Steps, names: dict[str, str], **values: Column) -> DataFrame:
    """df with the last step's values, as the columns that names gives them. Each step is a select: plain columns, which Spark compiles."""
    own = [F.col(f"`{c}`") for c in df.columns]
    for start in range(0, len(steps), TOGETHER):
        for step in steps[start : start + TOGETHER]:
            df = df.select(*own, *(c.alias(f"_step_{k}") for k, c in values.items()))
            values = step(**{k: F.col(f"_step_{k}") for k in values})
        # an array function is not compiled with its neighbours: the method ends here
        df = df.select(*own, bind(lambda *v, keys=tuple(values): nested((), **dict(zip(keys, v, strict=True))), **values).alias("_step"))
        values = {k: F.col("_step")[k] for k in values}
    return df.select(*own, *(values[k].alias(name) for k, name in names.items()))


def _xy(steps: Steps, x: Column, y: Column) -> tuple[Column, Column]:
    out = nested(steps, x=x, y=y)
    return out["x"], out["y"]


def _shifted(source: tuple[float, float], target: tuple[float, float], shift) -> Steps:
    """Degrees of one ellipsoid on another: to coordinates in space, shifted, and back."""
    (a, f), (a2, f2) = source, target
    e2, t2, b2 = 2 * f - f * f, 2 * f2 - f2 * f2, a2 * (1 - f2)

    def normal(phi: Column, lam: Column) -> dict[str, Column]:
        return {"phi": phi, "lam": lam, "v": a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))}

    def space(phi: Column, lam: Column, v: Column) -> dict[str, Column]:
        return {"x": v * F.cos(phi) * F.cos(lam), "y": v * F.cos(phi) * F.sin(lam), "z": v * (1 - e2) * F.sin(phi)}

    def axis(x: Column, y: Column, z: Column) -> dict[str, Column]:
        return {"lam": F.atan2(y, x), "z": z, "p": F.hypot(x, y)}

    def latitude(lam: Column, z: Column, p: Column, theta: Column) -> dict[str, Column]:
        lat = F.atan2(z + t2 / (1 - t2) * b2 * F.pow(F.sin(theta), 3), p - t2 * a2 * F.pow(F.cos(theta), 3))
        return {"x": F.degrees(lam), "y": F.degrees(lat)}

    moved = lambda x, y, z: dict(zip("xyz", shift(x, y, z), strict=True))
    angle = lambda lam, z, p: {"lam": lam, "z": z, "p": p, "theta": F.atan2(z * a2, p * b2)}
    return (lambda x, y: {"phi": F.radians(y), "lam": F.radians(x)}, normal, space, moved, axis, angle, latitude)


_M, (_RX, _RY, _RZ) = 1 + PPM / 1e6, (math.radians(r / 3600) for r in ROTATION)


def _there(*xyz: Column) -> tuple[Column, Column, Column]:
    x, y, z = ((c - s) / _M for c, s in zip(xyz, SHIFT, strict=True))
    return x + _RZ * y - _RY * z, y - _RZ * x + _RX * z, z + _RY * x - _RX * y


def _back(x: Column, y: Column, z: Column) -> tuple[Column, ...]:
    turned = (x - _RZ * y + _RY * z, y + _RZ * x - _RX * z, z - _RY * x + _RX * y)
    return tuple(s + _M * c for s, c in zip(SHIFT, turned, strict=True))


def _bent(phi: Column, power: float) -> Column:
    return F.pow((1 + _E * F.sin(phi)) / (1 - _E * F.sin(phi)), power)


def _sphere(phi: Column, v: Column) -> dict[str, Column]:
    return {"u": 2 * (F.atan(_T0 * F.pow(F.tan(phi / 2 + math.pi / 4), _B) / _bent(phi, _E * _B / 2)) - math.pi / 4), "v": v}


def _cone(u: Column, v: Column) -> dict[str, Column]:
    return {"t": F.asin(math.cos(_K) * F.sin(u) + math.sin(_K) * F.cos(u) * F.cos(v)), "u": u, "v": v}


def _polar(t: Column, u: Column, v: Column) -> dict[str, Column]:
    return {"r": _R0 * F.pow(_RATIO / F.tan(t / 2 + math.pi / 4), _N), "theta": _N * F.asin(F.cos(u) * F.sin(v) / F.cos(t))}


def _from_polar(x: Column, y: Column) -> dict[str, Column]:
    return {"t": 2 * (F.atan(F.pow(_R0 / F.hypot(x, y), 1 / _N) * _RATIO) - math.pi / 4), "d": F.atan2(-x, -y) / _N}


def _from_cone(t: Column, d: Column) -> dict[str, Column]:
    return {"u": F.asin(math.cos(_K) * F.sin(t) - math.sin(_K) * F.cos(t) * F.cos(d)), "t": t, "d": d}


def _from_sphere(u: Column, t: Column, d: Column) -> dict[str, Column]:
    start = _T0 ** (-1 / _B) * F.pow(F.tan(u / 2 + math.pi / 4), 1 / _B)
    return {"v": F.asin(F.cos(t) * F.sin(d) / F.cos(u)), "start": start, "phi": u}


def _latitude(v: Column, start: Column, phi: Column) -> dict[str, Column]:
    """A round of the latitude's series: each gains three digits."""
    return {"v": v, "start": start, "phi": 2 * (F.atan(start * _bent(phi, _E / 2)) - math.pi / 4)}


TO_BESSEL, FROM_BESSEL = _shifted(WGS84, BESSEL, _there), _shifted(BESSEL, WGS84, _back)
TO_GRID: Steps = (
    lambda x, y: {"phi": F.radians(y), "v": _B * (math.radians(LON_ORIGIN) - F.radians(x))}, _sphere, _cone, _polar,
    lambda r, theta: {"x": -r * F.sin(theta), "y": -r * F.cos(theta)},
)
FROM_GRID: Steps = (_from_polar, _from_cone, _from_sphere, *(_latitude,) * 5, lambda v, start, phi: {"x": F.lit(LON_ORIGIN) - F.degrees(v / _B), "y": F.degrees(phi)})
#: WGS 84 degrees to the grid, and back.
FORWARD, INVERSE = TO_BESSEL + TO_GRID, FROM_GRID + FROM_BESSEL


def to_bessel(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS 84 degrees on the grid's own ellipsoid."""
    return _xy(TO_BESSEL, lon, lat)


def from_bessel(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _xy(FROM_BESSEL, lon, lat)


def grid_of(lon: Column, lat: Column) -> tuple[Column, Column]:
    """East and north (both negative in the country) of degrees on the grid's ellipsoid."""
    return _xy(TO_GRID, lon, lat)


def degrees_of(x: Column, y: Column) -> tuple[Column, Column]:
    return _xy(FROM_GRID, x, y)


def forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS 84 degrees to the grid."""
    return _xy(FORWARD, lon, lat)


def inverse(x: Column, y: Column) -> tuple[Column, Column]:
    return _xy(INVERSE, x, y)
