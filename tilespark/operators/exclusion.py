"""Excluding tiles by a small language: terms coordinate:operator:integer, separated by commas."""

from __future__ import annotations

import operator
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = {"<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge, "==": operator.eq}


def parse(text: str | None) -> list[tuple[str, str, int]]:
    """Blanks around a term don't count; malformed terms are dropped with a warning; the coordinate is lower-cased."""
    found = []
    for term in (text or "").split(",") if text else []:
        parts = term.strip().split(":")
        try:
            name, sign, value = parts
            if sign not in OPERATORS:
                raise ValueError(f"unknown operator {sign!r}")
            found.append((name.lower(), sign, int(value)))
        except ValueError as error:
            warnings.warn(f"exclusion term {term!r} is ignored: {error}", stacklevel=2)
    return found


def excluded(terms: list[tuple[str, str, int]], mode: str = "any", x: str = "x", y: str = "y") -> Column:
    """Whether a tile is excluded; unknown coordinates are ignored, and without a usable term nothing is."""
    if mode not in ("any", "all"):
        raise ValueError(f"mode is any or all, not {mode!r}")
    place = {"x": x, "y": y}
    tests = [OPERATORS[sign](F.col(place[name]), F.lit(value)) for name, sign, value in terms if name in place]
    return reduce(operator.or_ if mode == "any" else operator.and_, tests) if tests else F.lit(False)


def exclude(tiles: DataFrame, text: str | None, mode: str = "any") -> DataFrame:
    """To be applied before any limit or sample."""
    return tiles.filter(~F.coalesce(excluded(parse(text), mode), F.lit(False)))
