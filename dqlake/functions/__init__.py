"""Column expressions shared by rules, cleaning and marts. All stay inside the JVM."""

from dqlake.functions.dates import date_of, date_key, timestamp_of
from dqlake.functions.numbers import money_avg, money_sum, number, percent, round2
from dqlake.functions.text import boolean_of, country, is_blank, strip, title

__all__ = [
    "boolean_of", "country", "date_key", "date_of", "is_blank", "money_avg", "money_sum",
    "number", "percent", "round2", "strip", "timestamp_of", "title",
]
