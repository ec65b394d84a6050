"""Records with line breaks in quotes, at every border between splits."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from strata.sources import delimited
from strata.sources.lines import read_lines
from strata.sources.records import read_records


def records(spark, path):
    rows = read_records(read_lines(spark, str(path), position=True, raw=True))
    return [r["value"] for r in rows.orderBy("file_path", "block_start", "row_id").collect()]


def sheet_text(rows, ending="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=ending).writerows(rows)
    return out.getvalue()


def random_rows(seed, count):
    rng = random.Random(seed)
    parts = ["a", "é", ",", '"', '""', "\n", "\n\n", "x y", '",\n"', ""]
    return [[str(i)] + ["".join(rng.choices(parts, k=rng.randrange(6))) for _ in range(3)] for i in range(count)]


@pytest.mark.parametrize("size", ["3", "64", "5000000"])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_sheet_equals_the_parser_at_every_split(spark, tmp_path, settings, size, ending):
    rows = random_rows(int(size), 6 if int(size) < 10 else 200)
    settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1")
    path = tmp_path / "s.csv"
    path.write_bytes(sheet_text([["k", "a\nb", "c", "d"], *rows], ending).encode())
    got = delimited.read_sheet_csv(spark, str(path))
    assert got.columns == ["k", "a\nb", "c", "d"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: int(r[0])) == [
        tuple(cell or None for cell in row) for row in rows
    ]


def test_split_sheet_equals_the_reader_of_whole_files(spark, tmp_path, settings):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(sheet_text([["k", "x", "y", "z"], *random_rows(ord(name), 300)]))
    schema = "k string, x string, y string, z string"
    whole = spark.read.schema(schema).options(multiLine=True, escape='"', header=True).csv(str(tmp_path)).collect()
    settings(spark__sql__files__maxPartitionBytes="100", spark__sql__files__openCostInBytes="1")
    lines = read_lines(spark, str(tmp_path), position=True)
    assert lines.rdd.getNumPartitions() > 20
    split = delimited.read_sheet_csv(spark, str(tmp_path)).collect()
    key = lambda row: tuple(cell or "" for cell in row)
    assert sorted(split, key=key) == sorted(whole, key=key)


def test_a_cell_over_many_splits(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="50", spark__sql__files__openCostInBytes="1")
    cell = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "s").write_text(f'a,"{cell}",b\nc,d,e\n')
    assert records(spark, tmp_path / "s") == [f'a,"{cell}",b', "c,d,e"]


def test_quotes_within_unquoted_cells_are_characters(spark, tmp_path, settings):
    text = ['5" pipe,x', 'a,"b', 'c",6" pipe', 'd,"e ""f""', '",g"', "h,i"]
    (tmp_path / "s").write_text("\n".join(text))
    for size in ("1", "1000"):
        settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1")
        assert records(spark, tmp_path / "s") == [text[0], f"{text[1]}\n{text[2]}", f"{text[3]}\n{text[4]}", text[5]]


def test_awkward_files(spark, tmp_path):
    (tmp_path / "e").write_text("")
    assert records(spark, tmp_path / "e") == []
    (tmp_path / "b").write_text("\n\nx\n \nx")
    assert records(spark, tmp_path / "b") == ["", "", "x", " ", "x"]
    (tmp_path / "u").write_text('a,"b\nc\n')
    with pytest.raises(ValueError, match="never closed"):
        records(spark, tmp_path / "u")
    nothing = read_lines(spark, str(tmp_path / "b"), position=True, raw=True).withColumn("value", F.lit(None).cast("string"))
    assert read_records(nothing).isEmpty()


def test_no_task_gets_a_whole_file(spark, tmp_path, settings):
    """Lines are shuffled by split, and only lines of records that go over several meet by record."""
    settings(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="1")
    (tmp_path / "s").write_text(sheet_text(random_rows(1, 2000)))
    lines = read_lines(spark, str(tmp_path / "s"), position=True, raw=True)
    largest = lines.groupBy("file_path", "block_start").agg(F.sum(F.octet_length("value")).alias("n")).agg(F.max("n")).first()[0]
    assert largest < 4000
    rows = read_records(lines)
    assert rows.count() == 2000
