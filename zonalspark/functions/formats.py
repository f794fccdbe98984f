"""Texts of numbers and templates, and classes of values, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUS, NBSP = "−", " "


def number(x: Column, digits: int, language: str = "en") -> Column:
    """x with a fixed number of digits, a true minus, and a decimal comma in Czech; null stays null."""
    text = F.format_string(f"%.{digits}f", F.round(x, digits))
    text = F.regexp_replace(text, "^-(0[.]?0*)$", "$1")
    text = F.regexp_replace(text, "^-", MINUS)
    return F.when(x.isNotNull(), F.translate(text, ".", ",") if language == "cz" else text)


def points(x: Column, language: str = "en", digits: int = 1) -> Column:
    """Percentage points of a difference of 0..1 values, with a plus only if it rounds above 0."""
    v = F.when(x.isNotNull(), F.greatest(F.least(x * 100, F.lit(100.0)), F.lit(-100.0)))  # least and greatest pass over nulls
    plus = F.when(F.round(v, digits) > 0, "+").otherwise("")
    return F.concat(plus, number(v, digits, language), F.lit(f"{NBSP}p.{NBSP}b." if language == "cz" else f"{NBSP}p.p."))


def rounded_sign(x: Column) -> Column:
    """-1, 0 or 1 of a difference as shown: in points, rounded to 0.1."""
    return F.signum(F.round(x * 100, 1)).cast("int")


def comparison(x: Column) -> Column:
    sign = rounded_sign(x)
    return F.when(sign < 0, "below").when(sign == 0, "same").when(sign > 0, "above")


def significance(p: Column, level: float = 0.05) -> Column:
    return F.when(p.isNull(), "unknown").when(p < level, "significant").otherwise("not significant")


def p_text(p: Column) -> Column:
    return F.when(p < 0.001, "<0.001").when(p.isNotNull(), F.format_string("%.3f", p))


def arrow(slope: Column, threshold: float = 0.0005) -> Column:
    return F.when(slope > threshold, "up").when(slope < -threshold, "down").otherwise("flat")


def level(x: Column, language: str = "en") -> Column:
    """A level of 0..1 in whole percent."""
    return F.coalesce(F.concat(number(x * 100, 0, language), F.lit(" %" if language == "cz" else "%")), F.lit(NOT_AVAILABLE))


def change(x: Column, threshold: float = 0.0005, language: str = "en") -> Column:
    """An arrow and points of a difference."""
    sign = F.when(F.abs(x) < threshold, "→ ").when(x > 0, "▲ ").otherwise("▼ ")
    return F.coalesce(F.concat(sign, points(x, language)), F.lit(NOT_AVAILABLE))


#: Fixed texts of tips.
NOT_AVAILABLE, REGION_MEDIAN, DOMINANT, SHARE = "n/a", "Regional median", "Dominant class", "share of area"


def level_tip(name: Column, label: Column, year: Column, value: Column, median: Column | None = None) -> Column:
    """What is shown of a zone's level: its name, the level of a year, and its region's median if there is a place for one."""
    lines = [name, F.concat_ws(" ", label, F.concat(year.cast("string"), F.lit(":")), level(value))]
    return F.concat_ws("\n", *lines, *([] if median is None else [F.concat(F.lit(f"{REGION_MEDIAN}: "), level(median))]))


def dominant_tip(name: Column, label: Column, share: Column) -> Column:
    """A zone's name and its largest class with its share."""
    part = F.when(share.isNotNull(), F.concat(level(share), F.lit(f" {SHARE}"))).otherwise(NOT_AVAILABLE)
    return F.concat_ws("\n", name, F.concat(F.lit(f"{DOMINANT}: "), F.coalesce(label, F.lit(NOT_AVAILABLE)), F.lit(" ("), part, F.lit(")")))


def change_tip(name: Column, label: Column, first: Column, last: Column, value: Column) -> Column:
    return F.concat_ws("\n", name, F.concat(label, F.lit(" "), first.cast("string"), F.lit("→"), last.cast("string"), F.lit(": "), change(value)))


def legend_ends(m: Column, clipping: bool) -> tuple[Column, Column]:
    """Labels of the ends of a symmetric scale in points: no digit for whole numbers, else one."""
    text = F.when(F.abs(m - F.round(m)) < 1e-9, number(m, 0)).otherwise(number(m, 1))
    return F.concat(F.lit("≤ " if clipping else ""), F.lit(MINUS), text), F.concat(F.lit("≥ +" if clipping else "+"), text)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """template with every {KEY} replaced."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), kv[1].cast("string")), values.items(), template)


def short_names(names: list[str], size: int = 10, reserved: tuple[str, ...] = ()) -> dict[str, str]:
    """Names cut to size characters, all different: a numeric ending replaces the last characters of repeats."""
    taken, out = set(reserved), {}
    for name in names:
        short, k = name[:size], 0
        while short in taken:
            k += 1
            short = name[: size - len(str(k))] + str(k)
        taken.add(short)
        out[name] = short
    return out


def mapped(column: Column, pairs: dict) -> Column:
    """The value of each key; null for others."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), column)
