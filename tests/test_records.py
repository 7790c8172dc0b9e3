"""CSV files read in splits of any size, with line breaks inside cells."""

import csv
import io
import os

import pytest
from pyspark.sql import functions as F

from lodgelake.session import scratch_path
from lodgelake.sources import ingest, records

ROWS = [["1", "plain", "a"], ["2", "two\nlines", "b"], ["3", 'quo"ted\n\n"twice"', "c"], ["4", "", ""],
        ["5", "tail\n" * 9 + "end", "d"], ["6", ",;\n,", "\n"], ["7", "ünï\ncode", "e"], ["8", "last", "f"]]


def written(folder, name, rows, header=("ID", "Free Text", "c"), end="\r\n"):
    os.makedirs(folder, exist_ok=True)
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows([header, *rows])
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text.getvalue())
    return f"{folder}/{name}"


def cells(df, names=("id", "free text", "c")):
    rows = df.orderBy("_file", "_block", "_row").collect()
    return [[r[c] if r[c] is not None else "" for c in names] for r in rows]


@pytest.fixture
def split_size(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def to(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield to
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_at_every_split_point(spark, split_size, end):
    folder = scratch_path(spark, "csv")
    path = written(folder, "a b.csv", ROWS, end=end)
    size = os.path.getsize(path)
    for at in [*range(7, 60, 2), size]:
        split_size(at)
        text = ingest.read_csv_text(spark, [path], ["id", "c"])
        assert cells(text) == ROWS, at


def test_files_with_and_without_breaks_side_by_side(spark, split_size):
    folder = scratch_path(spark, "csv")
    plain = [[str(k), "x" * (k % 7), '"q"'] for k in range(200)]
    paths = [written(folder, "a.csv", plain), written(folder, "b.csv", ROWS),
             written(folder, "c.csv", [["9", 'never "closed\nat', "z"]], ("C", "id", "Free Text"))]
    split_size(300)
    assert records.broken_paths(spark, paths) == set(paths[1:])
    got = cells(ingest.read_csv_text(spark, paths))
    assert sorted(got) == sorted(plain + ROWS + [['never "closed\nat', "z", "9"]])


def test_a_large_file_is_read_by_several_tasks(spark, split_size):
    folder = scratch_path(spark, "csv")
    rows = [[str(k), f"line\nbreak {k}" if k % 3 else "none", "y" * 50] for k in range(5_000)]
    path = written(folder, "big.csv", rows)
    split_size(20_000)
    text = ingest.read_csv_text(spark, [path])
    tasks = text.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 5 and cells(text) == rows


def test_empty_and_odd_files(spark):
    folder = scratch_path(spark, "csv")
    paths = [written(folder, "only_header.csv", []), written(folder, "break_in_header.csv", [["1", "a\nb", "c"]], ("id", "free\ntext", "c"))]
    got = ingest.read_csv_text(spark, paths)
    assert cells(got, ("id", "free\ntext", "c")) == [["1", "a\nb", "c"]]
    unclosed = f"{folder}/unclosed.csv"
    with open(unclosed, "w") as f:
        f.write('id,t\n1,a\n2,"b\nc\n')
    assert [r[1] for r in ingest.read_csv_text(spark, [unclosed]).orderBy("id").collect()] == ["a", "b\nc"]


def test_records_over_batch_borders(spark, split_size):
    """Lines come in batches of any size; a record may run over several."""
    path = written(scratch_path(spark, "csv"), "a.csv", ROWS)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for rows in (1, 2, 3, 5):
            spark.conf.set(key, str(rows))
            for at in (23, os.path.getsize(path)):
                split_size(at)
                assert cells(ingest.read_csv_text(spark, [path], ["id", "c"])) == ROWS, (rows, at)
    finally:
        spark.conf.set(key, before)


def test_text_is_scanned_for_quotes_once_and_parsed_once(spark, monkeypatch):
    """Files with breaks in cells: one scan tells of files and splits, and what is
    asked of the cells does not parse the text again."""
    path, seen, scan = written(scratch_path(spark, "csv"), "a.csv", ROWS), [], records._lines
    monkeypatch.setattr(records, "_lines", lambda *a, **k: seen.append(a) or scan(*a, **k))
    text = ingest.read_csv_text(spark, [path], ["id", "c"])
    assert len(seen) == 2  # the quotes, the records
    plan = text.where("id > 1 and id < 9 and c is not null").select("id", "c")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count("csvtostructs") + plan.count("from_csv") <= 2  # records of one split, and joined ones


def test_bare_carriage_return_in_a_cell_is_a_break(spark):
    paths = [written(scratch_path(spark, "csv"), "a.csv", [["1", "a\rb", "c"]]),
             written(scratch_path(spark, "csv"), "b.csv", [["1", "ab", "c"]])]
    assert records.broken_paths(spark, paths) == set(paths[:1])
