"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a text strip removes (Unicode white space and the four separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of a country that a clean customer may carry.
COUNTRIES = {
    "us": "United States",
    "usa": "United States",
    "united states of america": "United States",
    "united states": "United States",
    "uk": "United Kingdom",
    "united kingdom": "United Kingdom",
    "in": "India",
    "ind": "India",
    "india": "India",
    "de": "Germany",
    "germany": "Germany",
    "ca": "Canada",
    "canada": "Canada",
}

# Texts that count as true.
TRUE_TEXTS = ["true", "1", "yes"]


def strip(c: Column) -> Column:
    """Remove white space at both ends. Plain ``trim`` removes only blanks.

    A text that begins and ends with a visible ASCII character stays as it is, which is cheaper to see than to strip.
    """
    bare = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def title(c: Column) -> Column:
    """Capital after any non-letter: ``o'brien`` -> ``O'Brien``, which ``initcap`` does not do."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), ""
    )


def is_blank(c: Column) -> Column:
    """Null, empty after strip, or one of the words that stand for null."""
    return c.isNull() | F.lower(strip(c)).isin("", "nan", "null")


def boolean_of(c: Column) -> Column:
    return F.coalesce(F.lower(c).isin(TRUE_TEXTS), F.lit(False))


def lookup(c: Column, values: dict[str, str]) -> Column:
    """Small fixed map as a literal map expression; null when the key is not in it."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def country(c: Column) -> Column:
    return F.coalesce(lookup(F.lower(strip(c)), COUNTRIES), F.lit("Other"))
