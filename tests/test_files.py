import csv
import random

import pytest

from dqlake import schemas
from dqlake.plans import evolution
from dqlake.sources.files import (
    read_csv, read_csv_batches, read_documents, read_parquet, write_csv, write_document, write_parquet,
)
from dqlake.sources.headers import csv_files, csv_headers
from dqlake.sources.staging import shared_folder


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_round_trip_keeps_quotes_commas_and_blanks(spark, table, tmp_path):
    df = table("a b", [('say "hi", x', " padded "), (None, "1"), ("é", "plain")])
    write_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"))) == rows(df)


def test_csv_null_words(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,v\n1,NA\n2,null\n3,\n4,"NaN"\n5,none\n6,#N/A\n7, NA\n8,007\n')
    got = {r["id"]: r["v"] for r in read_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {"1": None, "2": None, "3": None, "4": None, "5": "none", "6": None, "7": " NA", "8": "007"}


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,v\n1,"two\nlines"\n')
    assert rows(read_csv(spark, str(tmp_path / "t.csv"), multiline=True)) == [("1", "two\nlines")]


def test_parquet_whole_and_touched(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2024, 3), (2, 2024, 4)], "v int, year int, month int")
    write_parquet(df, path, ["year", "month"])
    one = spark.createDataFrame([(9, 2024, 4)], "v int, year int, month int")
    write_parquet(one, path, ["year", "month"], touched_only=True)
    assert rows(read_parquet(spark, path)) == [(1, 2024, 3), (9, 2024, 4)]
    write_parquet(one, path, ["year", "month"])
    assert rows(read_parquet(spark, path)) == [(9, 2024, 4)]


def test_documents(spark, tmp_path):
    assert read_documents(spark, str(tmp_path / "none"), schemas.REPORT).count() == 0
    doc = spark.createDataFrame([("r1", None)], "run_id string, end_time string")
    write_document(doc, str(tmp_path / "reports" / "a"))
    got = read_documents(spark, str(tmp_path / "reports"), schemas.REPORT).first()
    assert (got["run_id"], got["metrics"]) == ("r1", None)


def test_staging_needs_a_shared_folder(spark):
    one, other = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != other and one.split("/x-")[0] == other.split("/x-")[0]  # one folder a run


@pytest.fixture()
def incoming(spark, tmp_path):
    header = schemas.RAW["orders"].fieldNames()
    files = {
        "exact.csv": header,
        "extended.csv": [*header, "coupon_code"],
        "reduced.csv": [c for c in header if c != "payment_method"],
        "broken.csv": [c for c in header if c != "customer_id"],
        "swapped.csv": header[::-1],
    }
    for name, columns in files.items():
        line = ",".join(f"{c}!" for c in columns)
        (tmp_path / name).write_text('"' + '","'.join(columns) + '"\r\n' + line + "\r\n")
    return str(tmp_path)


def test_headers_of_a_folder(spark, incoming):
    got = {r["path"].rsplit("/", 1)[1]: r["columns"] for r in csv_headers(spark, incoming).collect()}
    assert len(got) == 5 and got["extended.csv"][-1] == "coupon_code" and got["swapped.csv"][0] == "payment_method"


def test_drift_per_file(spark, incoming):
    report = {r["path"].rsplit("/", 1)[1]: r for r in evolution.file_drift(spark, incoming, "orders").collect()}
    assert {k: (r["verdict"], r["action"]) for k, r in report.items()} == {
        "exact.csv": ("NO_CHANGE", "CONTINUE"),
        "swapped.csv": ("NO_CHANGE", "CONTINUE"),
        "extended.csv": ("COMPATIBLE_EXTENSION", "CONTINUE"),
        "reduced.csv": ("COMPATIBLE_EXTENSION", "CONTINUE"),
        "broken.csv": ("BREAKING_CHANGE", "HALT"),
    }
    assert report["extended.csv"]["added_columns"] == ["coupon_code"]
    assert report["reduced.csv"]["removed_columns"] == ["payment_method"]
    assert report["broken.csv"]["missing_required_columns"] == ["customer_id"]
    assert evolution.must_halt(evolution.file_drift(spark, incoming, "orders"))


def test_drift_of_a_table_and_unknown_dataset(spark, table):
    empty = spark.createDataFrame([], schemas.RAW["customers"])
    assert evolution.frame_drift(empty, "customers").first()["verdict"] == "NO_CHANGE"
    assert evolution.frame_drift(empty.drop("email", "country"), "customers").first()["verdict"] == "BREAKING_CHANGE"
    with pytest.raises(ValueError):
        evolution.frame_drift(empty, "returns")


def test_files_with_other_columns_are_read_by_name(spark, incoming):
    df = read_csv_batches(spark, incoming)
    assert "coupon_code" in df.columns and df.count() == 5
    assert {r["order_id"] for r in df.collect()} == {"order_id!"}
    assert {r["coupon_code"] for r in df.collect()} == {None, "coupon_code!"}


def test_extension_fills_nulls(table):
    both = evolution.extend(table("a", [("1",)]), table("a b", [("2", "x")]))
    assert rows(both) == [("1", None), ("2", "x")]


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffid,v\r\n1,"x, ""y"""\r\n\r\n2,NA\r\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('"v","extra, col",id\nz,e,3\nw,,4\n')
    (tmp_path / "c.csv").write_text("id\n5\n")
    (tmp_path / "d.csv").write_text("")
    got = {r["id"]: (r["v"], r["extra, col"]) for r in read_csv(spark, str(tmp_path)).collect()}
    assert got == {"1": ('x, "y"', None), "2": (None, None), "3": ("z", "e"), "4": ("w", None), "5": (None, None)}


def written(folder, name, columns, data, end="\n"):
    """A CSV file as Python's own writer makes it."""
    with open(folder / name, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerows([columns, *[[r[c] for c in columns] for r in data]])


@pytest.mark.parametrize("size", ["97", "1000", "128m"])
def test_line_breaks_in_quotes_across_splits_and_headers(spark, tmp_path, size):
    """Files cut at any byte, with different headers: as Python's own reader takes them."""
    r = random.Random(5)
    bits = ["x", "\n", '"', ",", ' 5" pipe', "\n\n", '""', "é", '",', ',"', "word " * 9, "\n,\n"]
    made = [{"id": str(i), "a": "".join(r.choices(bits, k=r.randrange(1, 6))) + "." if i % 3 else f"plain{i}", "b": "." + "".join(r.choices(bits, k=3)) + "."} for i in range(150)]
    written(tmp_path, "one.csv", ["id", "a", "b"], made[:60])
    written(tmp_path, "two.csv", ["b", "id"], made[60:110], "\r\n")
    written(tmp_path, "three.csv", ["a", "id"], made[110:])
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = {x["id"]: (x["a"], x["b"]) for x in read_csv(spark, str(tmp_path)).collect()}
        lines = spark.read.option("pathGlobFilter", "*.csv").text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert lines > 40 or size != "97"
    want = {x["id"]: (x["a"] if k < 60 or k >= 110 else None, x["b"] if k < 110 else None) for k, x in enumerate(made)}
    assert got == want


def test_literal_quotes_are_no_breaks_and_open_ones_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,5" pipe\n2,"a ""b"""\n3,"c"d\n')
    files = csv_files(spark, str(tmp_path))
    assert files.records is None
    assert {r["id"]: r["v"] for r in read_csv(spark, str(tmp_path), files=files).collect()}.keys() == {"1", "2", "3"}
    (tmp_path / "b.csv").write_text('id,v\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="never closed.*b.csv"):
        read_csv(spark, str(tmp_path))


def test_a_header_may_hold_a_line_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeff"the\nid",v\r\n1,"x\r\ny"\r\n\r\n2,\r\n', encoding="utf-8", newline="")
    assert rows(read_csv(spark, str(tmp_path))) == [("1", "x\ny"), ("2", None)]
    assert csv_headers(spark, str(tmp_path)).first()["columns"] == ["the\nid", "v"]


def test_drift_of_files_with_line_breaks(spark, tmp_path):
    header = schemas.RAW["orders"].fieldNames()
    written(tmp_path, "a.csv", [*header, "note"], [{c: f"{c}\n!" for c in [*header, "note"]}] * 3)
    files = csv_files(spark, str(tmp_path))
    report = evolution.header_drift(files.headers, "orders").collect()
    assert [(r["verdict"], r["added_columns"]) for r in report] == [("COMPATIBLE_EXTENSION", ["note"])]
    assert read_csv(spark, str(tmp_path), files=files).select("note").distinct().collect() == [("note\n!",)]
