"""What CSV files hold before they are parsed: their headers, and their records where quoted values run over several lines.

A look over all lines finds each file's first line and whether any line ends inside a quoted value. If none does, every line is a
record and the lines are parsed where they are read. Otherwise the lines are stored once with what is known inside a split of a file:
whether a line begins inside quotes if the split begins outside of them, and if it begins inside. What a split does to
either is a small row; a pass over a file's splits in order then settles every line, wherever the file was cut. Only lines of
records that run on are shuffled, to be joined. A line break inside a value becomes a line feed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqlake.sources.staging import stage

MARK = "\ufeff"
# From the start of a field, with doubled quotes taken out: whole fields, then one that is still open at the end of the line.
OPEN = r'(?:(?:"[^"]*+"[^,]*+|[^",][^,]*+)?,)*+"[^"]*+\Z'
CLOSE = r'[^"]*+"[^,]*+(,|\Z)'  # from inside quotes: the rest of the field
FOUND = "path string, start long, first string, breaks boolean"
STORED = "path string, start long, n long, line string, in0 boolean, out0 boolean, head0 long, in1 boolean, out1 boolean, head1 long"
SETTLED = "path string, start long, inside boolean, head_before long, unclosed boolean"


@dataclass
class CsvFiles:
    """``headers``: (path, header, columns), one row per file that is not empty. ``records``: (path, record), or None: every line is one."""

    headers: DataFrame
    records: DataFrame | None


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, start, line): every line of the CSV files, with where its split of the file starts."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*")
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.regexp_replace("value", f"^{MARK}", "").alias("line"),
    )


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is still open at the end of a line that begins inside or outside of one."""
    at, line = 0, line.replace('""', "")
    if inside:
        closed = re.match(CLOSE, line)
        if closed is None:
            return True
        if not closed[1]:
            return False
        at = closed.end()
    return re.compile(OPEN).match(line, at) is not None


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of a batch that come from one split of a file."""
    path, start = batch["path"].dictionary_encode(), batch["start"].to_numpy()
    names, codes = path.dictionary.to_pylist(), path.indices.to_numpy()
    cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (start[1:] != start[:-1])) + 1
    ends = [0, *cuts.tolist(), len(codes)]
    for a, b in zip(ends, ends[1:]):
        if a < b:
            yield (names[codes[a]], int(start[a])), a, b


def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: its first line if the file begins there, and whether a line would end inside quotes."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        quoted = pc.match_substring(batch["line"], '"').to_numpy(zero_copy_only=False)
        for split, a, b in runs(batch):
            row = found.setdefault(split, [batch["line"][a].as_py() if split[1] == 0 else None, False])
            if not row[1]:
                row[1] = any(ends_inside(batch["line"][i].as_py(), False) for i in (np.flatnonzero(quoted[a:b]) + a).tolist())
    rows = [{"path": p, "start": s, "first": first, "breaks": breaks} for (p, s), (first, breaks) in found.items()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("first", pa.string()), ("breaks", pa.bool_())]))


def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to every line, for a split that begins outside (0) and inside (1) quotes: whether the line begins and ends inside, and
    the number of the last line that began outside (-1: none in this split yet)."""
    now, state, head = None, [False, True], [-1, -1]
    for batch in batches:
        n, size = batch["n"].to_numpy(), batch.num_rows
        quoted = pc.match_substring(batch["line"], '"').to_numpy(zero_copy_only=False)
        into, out = np.empty((2, size), dtype=bool), np.empty((2, size), dtype=bool)
        heads = np.empty((2, size), dtype=np.int64)
        for split, a, b in runs(batch):
            if split != now:
                now, state, head = split, [False, True], [-1, -1]
            at = a
            for i in [*(np.flatnonzero(quoted[a:b]) + a).tolist(), b]:
                into[:, at:i + 1] = out[:, at:i] = np.array([state]).T  # lines without quotes change nothing
                if i < b:
                    line = batch["line"][i].as_py()
                    after = {s: ends_inside(line, s) for s in set(state)}
                    state = [after[s] for s in state]
                    out[:, i] = state
                at = i + 1
            for x in (0, 1):
                began = np.where(into[x, a:b], -1, n[a:b])
                began[0] = max(began[0], head[x])
                heads[x, a:b] = np.maximum.accumulate(began)
                head[x] = int(heads[x, b - 1])
        flags = [pa.array(v) for x in (0, 1) for v in (into[x], out[x], heads[x])]
        yield pa.RecordBatch.from_arrays([batch["path"], batch["start"], batch["n"], batch["line"], *flags], names=[c.split(" ")[0] for c in STORED.split(", ")])


def settle(_: tuple[pa.Scalar, ...], splits: pa.Table) -> pa.Table:
    """The splits of one file in order: whether each begins inside quotes, and which line the open record began with."""
    inside, head, rows = False, None, []
    for s in sorted(splits.to_pylist(), key=lambda r: r["start"]):
        rows.append({"path": s["path"], "start": s["start"], "inside": inside, "head_before": head})
        x = "1" if inside else "0"
        inside, head = s[f"end{x}"], s[f"head{x}"] if s[f"head{x}"] >= 0 else head
    kinds = [("path", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("head_before", pa.int64()), ("unclosed", pa.bool_())]
    return pa.Table.from_pylist([r | {"unclosed": inside} for r in rows], schema=pa.schema(kinds))


def records_of(lines: DataFrame) -> DataFrame:
    """(path, start, n, record) of ``csv_lines``, whatever the splits; ``start`` and ``n`` give the order inside a file."""
    stored = stage(lines.withColumn("n", F.monotonically_increasing_id()).select("path", "start", "n", "line").mapInArrow(follow, STORED), "csv-lines")
    ends = stored.groupBy("path", "start").agg(
        F.max("n").alias("last"), F.max("head0").alias("head0"), F.max("head1").alias("head1"),
        F.max(F.col("n") * 4 + F.col("out0").cast("int") * 2 + F.col("out1").cast("int")).alias("end"),  # one number: no sort to find it
    ).select("path", "start", (F.col("end") % 4 >= 2).alias("end0"), (F.col("end") % 2 == 1).alias("end1"), "head0", "head1")
    settled = stage(ends.groupBy("path").applyInArrow(settle, SETTLED), "csv-splits")
    unclosed = [r[0] for r in settled.filter("unclosed").select("path").distinct().limit(10).collect()]
    if unclosed:
        raise ValueError(f"a quoted value is never closed in {unclosed}")
    x = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    head = F.when(x("head") >= 0, x("head")).otherwise(F.col("head_before")).alias("head")
    known = stored.join(settled, ["path", "start"]).select("path", "start", "n", "line", (x("in") | x("out")).alias("runs_on"), head)
    whole = known.filter("NOT runs_on").select("path", "start", "n", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("start", "n", "line"))).alias("parts")
    joined = known.filter("runs_on").groupBy("path", "head").agg(parts)
    text = F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record")
    return whole.union(joined.select("path", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["n"].alias("n"), text))


def columns_of(header: str) -> Column:
    """The column names in a header record."""
    outside = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma with an even number of quotes after it
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, '^"|"$', ""), '""', '"')
    return F.transform(F.split(header, outside, -1), bare)


def csv_files(spark: SparkSession, path: str | list[str], multiline: bool | None = None) -> CsvFiles:
    """The headers of the files, and their records where a value runs on; the files are read once, or twice if one does.

    ``multiline`` says what is known already: True skips the look, False takes every line for a record.
    """
    lines, firsts = csv_lines(spark, path), None
    if not multiline:
        found = stage(lines.mapInArrow(look, FOUND), "csv-found")
        if multiline is None and not found.filter("breaks").isEmpty():
            multiline = True
        firsts = found.filter("first IS NOT NULL").select("path", F.col("first").alias("header"))
    records = None
    if multiline:
        records = stage(records_of(lines), "csv-records")
        first = records.where("start = 0").groupBy("path").agg(F.min("n").alias("n"))  # a file's first line begins its first split
        firsts = records.where("start = 0").join(first, ["path", "n"]).select("path", F.col("record").alias("header"))
        records = records.select("path", "record")
    return CsvFiles(stage(firsts.select("path", "header", columns_of("header").alias("columns")), "csv-headers"), records)


def csv_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per CSV file that is not empty: its path, its first record and the column names in it."""
    return csv_files(spark, path).headers
