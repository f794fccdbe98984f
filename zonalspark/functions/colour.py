"""Colour ramps and colour arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .formats import mapped

#: The ramps.
CHANGE_RAMP = ((0.0, "#B54836"), (1 / 6, "#CE8579"), (2 / 6, "#E6C2BC"), (0.5, "#FFFFFF"), (4 / 6, "#BBCFE2"), (5 / 6, "#769EC5"), (1.0, "#326EA8"))
ABSOLUTE_RAMP = ((0.0, "#b23a2e"), (0.5, "#e8c547"), (1.0, "#1f7a3d"))
NO_VALUE, NO_DATA = "#cccccc", "#e2e7e4"
BUCKET_COLOURS = {"F": "#1b5e20", "A": "#c9962c", "G": "#7cb342", "U": "#757575", "X": "#e0e0e0"}
TILE_WHITE, TILE_RED, TILE_GREEN = 253, 169, 253


def channels(colour: str) -> tuple[int, int, int]:
    return tuple(int(colour[i : i + 2], 16) for i in (1, 3, 5))


def half_up(x: Column) -> Column:
    """Nearest whole number, halves up."""
    return F.floor(x + 0.5).cast("int")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def ramp(t: Column, stops: tuple[tuple[float, str], ...]) -> Column:
    """struct(r, g, b) at t, clamped to the ends, linear in between, channel by channel."""
    t = clamp(t, stops[0][0], stops[-1][0])
    parts = []
    for c, name in enumerate("rgb"):
        out = F.lit(channels(stops[-1][1])[c])
        for (a, ca), (b, cb) in reversed(list(zip(stops[:-1], stops[1:], strict=True))):
            low, high = channels(ca)[c], channels(cb)[c]
            out = F.when(t <= b, half_up(low + (high - low) * ((t - a) / (b - a)))).otherwise(out)
        parts.append(out.cast("int").alias(name))
    return F.struct(*parts)


def change_colour(t: Column) -> Column:
    return ramp(t, CHANGE_RAMP)


def difference_colour(d: Column, most: Column) -> Column:
    """The change ramp with 0 in its middle and most at its end."""
    return change_colour((d / most + 1) / 2)


def absolute_colour(v: Column, low: Column, high: Column) -> Column:
    """Three stops over [low, high]; grey without a value."""
    grey = F.struct(*(F.lit(x).alias(n) for x, n in zip(channels(NO_VALUE), "rgb", strict=True)))
    return F.when(v.isNull(), grey).otherwise(ramp((v - low) / (high - low), ABSOLUTE_RAMP))


def from_hex(colour: Column) -> Column:
    """struct(r, g, b) of #RRGGBB."""
    return F.struct(*(F.conv(F.substr(colour, F.lit(i), F.lit(2)), 16, 10).cast("int").alias(n) for i, n in ((2, "r"), (4, "g"), (6, "b"))))


def to_hex(rgb: Column) -> Column:
    return F.concat(F.lit("#"), *(F.lpad(F.hex(rgb[n]), 2, "0") for n in "rgb"))


def rgba(rgb: Column, alpha: Column) -> Column:
    return F.concat(F.lit("rgba("), F.concat_ws(",", rgb["r"], rgb["g"], rgb["b"], alpha), F.lit(")"))


def hsl(rgb: Column) -> Column:
    """struct(h in degrees, s and l in percent)."""
    r, g, b = (rgb[n] / 255.0 for n in "rgb")
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    d, light = high - low, (high + low) / 2
    sat = F.when(d == 0, 0.0).when(light > 0.5, F.try_divide(d, 2 - high - low)).otherwise(F.try_divide(d, high + low))
    hue = F.when(d == 0, 0.0).when(high == r, F.try_divide(g - b, d) + F.when(g < b, 6).otherwise(0)).when(high == g, F.try_divide(b - r, d) + 2).otherwise(F.try_divide(r - g, d) + 4)
    return F.struct((hue * 60).alias("h"), (sat * 100).alias("s"), (light * 100).alias("l"))


def shade(base: Column, i: Column, n: Column) -> Column:
    """hsl(...) text of shade i of n of a colour: lightness 26..70, saturation 30..70 or 0 if below 5."""
    x = hsl(base)
    light = F.when(n > 1, 26 + F.try_divide(44 * i, n - 1)).otherwise(48)
    sat = F.when(x["s"] < 5, 0.0).otherwise(clamp(x["s"], 30.0, 70.0))
    return F.concat(F.lit("hsl("), half_up(x["h"]), F.lit(", "), half_up(sat), F.lit("%, "), half_up(light), F.lit("%)"))


def recolour(r: Column, g: Column, b: Column, a: Column, low: int = 15, high: int = 95) -> Column:
    """struct(r, g, b, a) of an orange-white-green tile pixel in the change ramp.

    The dominant hue gives the sign, the distance from white the size; dark
    pixels fade out between low and high.
    """
    bright = F.greatest(r, g, b)
    size = F.when(g > r + 2, F.least(F.lit(1.0), (TILE_WHITE - r) / TILE_GREEN)).when(r > g + 2, -F.least(F.lit(1.0), (TILE_WHITE - b) / TILE_RED)).otherwise(0.0)
    new = change_colour((size + 1) / 2)
    own = [F.when(bright > low, new[n]).otherwise(c).cast("int").alias(n) for n, c in zip("rgb", (r, g, b), strict=True)]
    alpha = F.when(bright <= low, 0).when(bright < high, half_up(a * ((bright - low) / (high - low)))).otherwise(a)
    return F.struct(*own, alpha.cast("int").alias("a"))


def _text(rgb: Column) -> Column:
    return F.lower(to_hex(rgb))


def fill_level(value: Column, low: Column, high: Column, without: Column | None = None) -> Column:
    """Colour text of a level of a bucket or of the composite."""
    return F.when(value.isNull(), F.lit(NO_VALUE) if without is None else without).otherwise(_text(absolute_colour(value, low, high)))


def fill_class(bucket: Column) -> Column:
    """Colour text of the dominant class."""
    return F.coalesce(mapped(bucket, BUCKET_COLOURS), F.lit(NO_DATA))


def fill_change(before: Column, after: Column, most: Column) -> Column:
    """Colour text of a change; that of no data if one of its years has no value."""
    gone = before.isNull() | after.isNull()
    return F.when(gone, F.lit(NO_DATA)).otherwise(_text(difference_colour(after - before, most)))
