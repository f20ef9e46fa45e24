"""Lookups and numbering against brute force, with hot keys, copies and nulls."""

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dqlake.operators.keyed import ROW_ID, SPREAD, attach, mark_members, repeated_keys, with_row_id
from dqlake.operators.numbering import number_rows, rank_desc
from dqlake.operators.upsert import first_per_key, keep_or_number, replace_by_key
from dqlake.sources.staging import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key, a third no key, and many rows are copies of each other."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 400 + [f"k{rng.randrange(120)}" for _ in range(400)]
    rng.shuffle(keys)
    return stage(spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "key string, v int"), "skewed")


def test_attach_equals_a_left_join(spark, skewed):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), ("absent", 4)], "key string, w int")
    got = attach(with_row_id(skewed), lookup, ["key"]).drop(ROW_ID)
    want = skewed.join(lookup, "key", "left")
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_a_hot_key_without_a_match_stays_unmatched(spark, skewed):
    members = spark.createDataFrame([("k1",)], "key string")
    marked = mark_members(with_row_id(skewed), members, ["key"], "hit")
    assert marked.where("hit").select("key").distinct().collect() == [("k1",)]
    assert marked.count() == skewed.count()


def test_null_keys_are_spread_by_their_row_id(spark, skewed):
    lookup = spark.createDataFrame([("hot", 1)], "key string, w int")
    plan = attach(with_row_id(skewed), lookup, ["key"])._jdf.queryExecution().analyzed().toString()
    assert SPREAD in plan and ROW_ID in plan


def test_repeated_keys(spark, skewed):
    counts = Counter(r["key"] for r in skewed.collect() if r["key"] is not None)
    got = {r["key"]: r["copies"] for r in repeated_keys(skewed, ["key"]).collect()}
    assert got == {k: n for k, n in counts.items() if n > 1}


def test_numbers_are_dense_and_ordered_even_with_copies(spark, skewed):
    numbered = number_rows(
        with_row_id(skewed), [F.col("key").asc_nulls_first(), F.col("v"), F.col(ROW_ID)], "n", 5
    ).orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(5, 5 + 1200))
    order = [((r["key"] is not None, r["key"] or ""), r["v"]) for r in numbered]
    assert order == sorted(order)


def test_rank_equals_sql_rank(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("aaab"), float(rng.choice([0, 0, 0, 5, 7, rng.randrange(50)]))) for i in range(600)]
    df = stage(spark.createDataFrame(rows, "id int, g string, v double"), "ranked")
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"]).set_index("id")
    overall = {r["id"]: r["r"] for r in rank_desc(df, "v", "r").collect()}
    assert overall == pdf["v"].rank(method="min", ascending=False).astype(int).to_dict()
    inside = {r["id"]: r["r"] for r in rank_desc(df, "v", "r", ["g"]).collect()}
    assert inside == pdf.groupby("g")["v"].rank(method="min", ascending=False).astype(int).to_dict()


def test_first_per_key_and_upsert(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert sorted(map(tuple, first_per_key(df, "k", ["o"]).collect())) == [("a", 1, "y"), ("b", 9, "q")]

    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "id long, k string, v string")
    source = spark.createDataFrame([("b", "new"), ("c", "new"), ("aa", "new")], "k string, v string")
    given = keep_or_number(source, target, "k", "id", ["k"])
    merged = replace_by_key(target, given, "k")
    assert sorted(map(tuple, merged.select("id", "k", "v").collect())) == [
        (1, "a", "old"), (2, "b", "new"), (3, "aa", "new"), (4, "c", "new")]
