import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqlake import functions as X
from dqlake.operators.contracts import standard_country


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_strip_follows_text_strip(spark):
    texts = ["  a b ", "\t x\n", " y　", "\x1cz\x1f", "", "   ", None]
    assert values(spark, texts, X.strip) == [t if t is None else t.strip() for t in texts]


def test_strip_sees_both_ends(spark):
    texts = ["a", "a ", " a", "a\u2003", "\u00e9 ", " \u00e9", "a\u00e9", "\u00e9a", "~!", "\x7f", "x\x1f"]
    assert values(spark, texts, X.strip) == [t.strip() for t in texts]


def test_title_capitalises_after_any_non_letter(spark):
    texts = ["o'brien", "mary-jane SMITH", "3com", "customer#00a1b", "", None]
    assert values(spark, texts, X.title) == [t if t is None else t.title() for t in texts]


@pytest.mark.parametrize("text, value", [
    ("5", 5.0), (" 5 ", 5.0), ("+7", 7.0), ("1.", 1.0), (".5", 0.5), ("1e3", 1000.0), ("-2.50", -2.5),
    ("123456789012345678", 123456789012345678.0), ("1e-300", 1e-300),
    ("5d", None), ("0x10", None), ("1,000", None), ("1_000", None), ("NaN", None), ("inf", None), ("1e999", None),
    ("-1e999", None), ("True", None), ("", None), (None, None), ("1.2.3", None),
])
def test_number(spark, text, value):
    assert values(spark, [text], X.number) == [value]


def test_round2_is_half_even_on_the_binary_value(spark):
    numbers = [0.125, 0.375, 2.675, 1.005, -0.125, 1234.565, 8.045, 100.0]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n double")
    got = [r[0] for r in df.orderBy("i").select(X.round2(F.col("n"))).collect()]
    assert got == list(np.round(np.array(numbers), 2))


def test_money_does_not_depend_on_the_order_of_rows(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 0.07] * 50
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    sums = {df.repartition(n).agg(X.money_sum(F.col("a"))).first()[0] for n in (1, 3, 7)}
    assert sums == {33.5}


def test_dates(spark):
    texts = ["2024-02-29 23:59:59", "2024-02-29", "2023-02-29", "2026-99-99 25:99:99", "2024-1-1", "2024", "", None]
    got = values(spark, texts, X.timestamp_of)
    assert got == [dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2024, 2, 29)] + [None] * 6
    assert values(spark, ["31/12/2024"], lambda c: X.timestamp_of(c, ["dd/MM/yyyy"])) == [dt.datetime(2024, 12, 31)]
    assert values(spark, ["2024-03-07"], lambda c: X.date_key(X.date_of(c))) == [20240307]


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, ["2024-07-01 00:30:00"], X.timestamp_of) == [dt.datetime(2024, 7, 1, 0, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_booleans_and_countries(spark):
    assert values(spark, ["True", "1", "yes", "YES", " true", "no", "0", "", None], X.boolean_of) == [
        True, True, True, True, False, False, False, False, False]
    assert values(spark, ["USA", " us ", "Ind", "uk", "France", "", None], X.country) == [
        "United States", "United States", "India", "United Kingdom", "Other", "Other", "Other"]
    assert values(spark, ["usa", "FRANCE", "United states of america", None], standard_country) == [
        "United States", "France", "United States", None]


def test_percent(spark):
    got = spark.range(1).select(X.percent(F.lit(1), F.lit(3)), X.percent(F.lit(0), F.lit(0))).first()
    assert tuple(got) == (33.33, 100.0)
    assert not math.isnan(got[0])
