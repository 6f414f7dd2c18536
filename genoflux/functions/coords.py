"""Coordinate texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_PAIR = r"(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)"


def number(text: Column) -> Column:
    """A finite number, or null."""
    bare = F.trim(text)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def in_range(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: later rules of the optimizer
    copy expressions, and nested texts would multiply."""
    return F.get(F.transform(F.array(value), body), 0)


def _pair(parts: Column, validate: bool) -> Column:
    def checked(p: Column) -> Column:
        good = p["lat"].isNotNull() & p["lon"].isNotNull()
        return F.when(good & in_range(p["lat"], p["lon"]) if validate else good, p)

    both = F.struct(number(F.get(parts, 0)).alias("lat"), number(F.get(parts, 1)).alias("lon"))
    return F.when(F.size(parts) == 2, _let(both, checked))


def coordinate_pair(text: Column, validate: bool = True) -> Column:
    """struct<lat,lon> of '[34.5, -76.2]', '34.5, -76.2' or '34.5 -76.2'; null if it is no pair."""
    split = lambda bare: F.when(bare.contains(","), F.split(bare, ",")).otherwise(F.split(bare, r"\s+"))
    bare = F.regexp_replace(F.trim(text), r"^[\[\](){} ]+|[\[\](){} ]+$", "")
    return _let(bare, lambda b: _let(split(b), lambda parts: _pair(parts, validate)))


def embedded_pair(text: Column) -> Column:
    """struct<lat,lon> from the first 'number, number' anywhere in the text, ranges unchecked.

    Lists in other notations (such as exponents) are tried as a whole first.
    """
    whole = F.when(text.rlike(r"^\s*[\[(].*,.*[\])]\s*$"), coordinate_pair(text, validate=False))
    found = F.when(
        text.rlike(_PAIR),
        F.struct(F.regexp_extract(text, _PAIR, 1).cast("double").alias("lat"), F.regexp_extract(text, _PAIR, 2).cast("double").alias("lon")),
    )
    return F.coalesce(whole, found)


def decimals(text: Column) -> Column:
    """Digits behind the point in a number's text."""
    return F.length(F.coalesce(F.get(F.split(text, r"\."), 1), F.lit("")))
