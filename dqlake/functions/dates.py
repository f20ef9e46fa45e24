"""Dates. Timestamps carry no zone, so results do not depend on the session's."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
STANDARD = "yyyy-MM-dd HH:mm:ss"
PARTS = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}  # with their digits


def timestamp_of(c: Column, formats: Sequence[str] = FORMATS) -> Column:
    """Text to timestamp in any of the listed formats, made of ``PARTS`` and fixed text; null when none fits.

    The text becomes a timestamp without zone directly, so an hour that some zone skips is an hour like any other.
    """
    return F.coalesce(*[_iso(c, f).try_cast("timestamp_ntz") for f in formats])


def _iso(c: Column, fmt: str) -> Column:
    """The text in the standard order of parts, null if it does not have the format's shape."""
    pieces = re.split("(" + "|".join(PARTS) + ")", fmt)
    order = [p for p in pieces if p in PARTS]
    shape = "^" + "".join(f"([0-9]{{{PARTS[p]}}})" if p in PARTS else re.escape(p) for p in pieces) + "$"
    if STANDARD.startswith(fmt):  # what is missing is put where the shape ends; nothing has to be replaced
        rest = re.sub("[A-Za-z]", "0", STANDARD[len(fmt):])
        whole = F.concat(F.substring(c, 1, len(fmt)), F.lit(rest), c.substr(F.lit(len(fmt) + 1), F.length(c))) if rest else c
        return F.when(c.rlike(shape), whole)
    at = {p: f"${order.index(p) + 1}" if p in order else "00" for p in PARTS}
    standard = f"{at['yyyy']}-{at['MM']}-{at['dd']} {at['HH']}:{at['mm']}:{at['ss']}"
    return F.when(c.rlike(shape), F.regexp_replace(c, shape, standard))


def date_of(c: Column, formats: Sequence[str] = FORMATS) -> Column:
    return timestamp_of(c, formats).cast("date")


def date_key(c: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
