"""Records of CSV files cut into many blocks, against the csv module."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import types as T

from ledgerloom.sources.files import latin_csv, numbered_csv, sheet_export
from ledgerloom.sources.records import file_records, inside_after, parsed

TEXTS = ["", "a", "b,c", 'say "hi"', "two\nlines", "three\n\n\nlines", '"', '""', ',"', '",', '"\n"', "é", " x ", 'in"side', "x" * 300, "y\n" * 200]


@pytest.fixture
def small_blocks(spark):
    """Blocks of 200 bytes, so that many records lie in two."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "200")
    spark.conf.set(names[1], "1")
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def written(folder, number, rows, top="", encoding="latin-1", end="\n"):
    out = io.StringIO(newline="")
    out.write(top)
    csv.writer(out, lineterminator=end).writerows(rows)
    path = os.path.join(folder, f"part-{number:03}.csv")
    with open(path, "w", encoding=encoding, newline="") as file:
        file.write(out.getvalue())
    return path


@pytest.mark.parametrize("seed", range(2))
def test_numbers_follow_the_files_order_whatever_their_sizes(spark, small_blocks, tmp_path, seed):
    pick = random.Random(seed)
    want = []
    # The last file is the largest, the first has no row.
    for number, size in enumerate((0, 3, 1, 60)):
        rows = [[str(len(want) + i), pick.choice(TEXTS), pick.choice(TEXTS), "end"] for i in range(size)]
        written(tmp_path, number, [["n", "one", "two", "last"], *rows])
        want += rows
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("n", "one", "two", "last")])
    got = numbered_csv(spark, str(tmp_path), schema).orderBy("row_no").collect()
    assert [tuple(r)[1:] for r in got] == [tuple(r) for r in want]
    assert [r.row_no for r in got] == list(range(len(want)))
    plain = latin_csv(spark, str(tmp_path), schema).collect()
    assert sorted((r.n, r.one or "") for r in plain) == sorted((r[0], r[1]) for r in want)


def test_a_quote_inside_an_open_field_is_a_letter(spark, small_blocks, tmp_path):
    lines = ['5" pipe,a', 'x,6" y', '"q ""z""",b', '"two\n5"" wide",c', 'd" e"f,"g"']
    (tmp_path / "f.csv").write_text("h,i\n" + "\n".join(lines) + "\n")
    want = list(csv.reader(io.StringIO("\n".join(lines))))
    records = file_records(spark, str(tmp_path)).orderBy("row_no")
    assert [r.record for r in records.collect()] == lines
    assert [list(r) for r in parsed(records, "h string, i string").collect()] == want


@pytest.mark.parametrize(("line", "outside", "inside"), [
    (b"", False, True), (b"a,b", False, True), (b'"', True, False), (b'""', False, True), (b'"a', True, False), (b'a"', False, False),
    (b'a,"b', True, False), (b'a",b', False, False), (b'""",x', True, False), (b'x"",', False, True), (b'",",', False, True),
])
def test_both_cases_of_a_line(line, outside, inside):
    assert (inside_after(line, False), inside_after(line, True)) == (outside, inside)


def test_preamble_lines_are_no_records(spark, small_blocks, tmp_path):
    top = 'Report "open,,\n"Sheet,Sales\n,,\n1,2,3\n'
    schema = T.StructType([T.StructField("Item Number", T.LongType()), T.StructField("Store", T.StringType())])
    want = []
    for number, size in enumerate((2, 0, 40)):
        rows = [[len(want) + i, TEXTS[i % len(TEXTS)] or "s"] for i in range(size)]
        written(tmp_path, number, [["Item Number", "Store"], *rows], top, "utf-8", "\r\n")
        want += rows
    got = sheet_export(spark, str(tmp_path), schema, ["Store", "Item Number"])
    assert sorted((r["Item Number"], r["Store"]) for r in got.collect()) == sorted((n, t) for n, t in want)


def test_an_open_quote_runs_to_the_end_of_its_file_only(spark, small_blocks, tmp_path):
    (tmp_path / "a.csv").write_text('h\n1\n"open\n2\n' + "3\n" * 60)
    (tmp_path / "b.csv").write_text("h\n4\n")
    got = [r.record for r in file_records(spark, str(tmp_path)).orderBy("row_no").collect()]
    assert got == ["1", '"open\n2\n' + "3\n" * 59 + "3", "4"]


def test_rows_of_single_lines_are_not_shuffled(spark, tmp_path):
    written(tmp_path, 0, [["h"], ["x"]])
    plan = file_records(spark, str(tmp_path)).where("record = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(file#") >= 1 and "SinglePartition" in plan
