"""What a reader asks for - mode, layer, years, zone - checked, and as the text of a link."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import parse_qsl, urlencode

from .tables import BUCKETS, COMPOSITE

#: The letters of a link.
LETTERS = {"m": "mode", "p": "key", "y": "year", "f": "first", "t": "last", "l": "language", "o": "zone"}
MODES, LANGUAGES = ("absolute", "change"), ("cz", "en")


@dataclass(frozen=True)
class Query:
    mode: str = "absolute"
    key: str = COMPOSITE
    year: int = 2024
    first: int = 2017
    last: int = 2024
    language: str = "cz"
    zone: str | None = None

    @classmethod
    def of_link(cls, text: str, years: tuple[int, ...], zones: frozenset[str] | None = None) -> Query:
        """The parts of a link that are valid; the rest keeps its default."""
        got = {LETTERS[k]: v for k, v in parse_qsl(text.lstrip("#?")) if k in LETTERS}
        known = {str(y): y for y in years}
        out = {k: known[got[k]] for k in ("year", "first", "last") if got.get(k) in known}
        if not out.get("first", cls.first) < out.get("last", cls.last):
            out.pop("first", None), out.pop("last", None)
        for name, allowed in (("mode", MODES), ("key", (COMPOSITE, *BUCKETS)), ("language", LANGUAGES)):
            if got.get(name) in allowed:
                out[name] = got[name]
        if "zone" in got and (zones is None or got["zone"] in zones):
            out["zone"] = got["zone"]
        return cls(**out)

    def link(self) -> str:
        return urlencode({k: v for k, name in LETTERS.items() if (v := getattr(self, name)) is not None})
