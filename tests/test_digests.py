"""Files landed byte for byte, digests put together from parts, and trees of them."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import digests
from strata.plans import landing
from strata.sources.lines import read_lines

CONTENTS = {
    "lf": b"one\ntwo\nthree\n",
    "crlf": b"one\r\ntwo\r\n\r\nthree\r\n",
    "open": b"one\ntwo",
    "open_crlf": b"one\r\ntwo\r",
    "blank_lines": b"\n\n\n",
    "blank_then_open": b"\n\nx",
    "one_byte": b"x",
    "one_end": b"\n",
    "empty": b"",
    "not_text": bytes(range(256)) * 40 + b"\xff\xfe\n\x80\x81",
    "old_mac": b"one\rtwo\rthree",
    "long": b"".join(b"%d,%d\n" % (i, i * i) for i in range(20_000)),
}


def written(folder, contents=CONTENTS):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in contents.items():
        path = folder / f"{name}.dat"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return {"things": [(str(folder), "*.dat")]}


def restored(spark, root):
    rows = landing.landed_bytes(spark, root, "things").orderBy("relative_path", "block_start", "row_id").collect()
    found = {}
    for row in rows:
        found[row["relative_path"]] = found.get(row["relative_path"], b"") + bytes(row["content"])
    return found


@pytest.mark.parametrize("split", ["128m", "4k"])
@pytest.mark.parametrize("prefix", [0, 2])
def test_landed_files_come_back(spark, tmp_path, settings, split, prefix):
    settings(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1k")
    inputs, root = written(tmp_path / "in"), str(tmp_path / "raw")
    landing.land_raw(spark, inputs, root, text_datasets=["things"], prefix_length=prefix)
    found = restored(spark, root)
    hashes = {name: hashlib.sha256(content).hexdigest() for name, content in found.items()}
    assert hashes == {f"{n}.dat": hashlib.sha256(c).hexdigest() for n, c in CONTENTS.items() if c}
    checked = landing.reconcile_landing(landing.source_files(spark, inputs, ["things"]), landing.landed_files(spark, root))
    assert {row["status"] for row in checked.collect()} == {"same"} and checked.count() == len(CONTENTS)
    assert all(row["local_bytes"] == len(CONTENTS[row["relative_path"].split("/")[1][:-4]]) for row in checked.collect())


def digest_of(spark, path):
    lines = read_lines(spark, path, position=True, raw=True).withColumn("dataset", F.lit("d"))
    return {row["path"].split("/")[-1]: (row["lines"], row["bytes"], row["digest"]) for row in digests.file_digests(lines).collect()}


def value_of(content):
    """The polynomial of a file's lines, line by line; numbers come from Spark's hash."""
    from pyspark.sql import SparkSession

    lines = content.split(b"\n")[: -1 if content.endswith(b"\n") else None]
    df = SparkSession.getActiveSession().createDataFrame([(i, bytearray(line)) for i, line in enumerate(lines)], "i int, b binary")
    df = df.select("i", *[F.xxhash64(F.lit(k), "b").alias(f"h{k}") for k in range(2)]).orderBy("i")
    values = [0, 0]
    for row in df.collect():
        for k, (prime, base) in enumerate(zip(digests.PRIMES, digests.BASES)):
            values[k] = (values[k] + row[f"h{k}"] % prime * pow(base, row["i"], prime)) % prime
    return "-".join([str(len(lines)), *(f"{value:X}" for value in values)])


def test_digests_do_not_depend_on_splits(spark, tmp_path, settings):
    written(tmp_path)
    whole = digest_of(spark, str(tmp_path))
    assert whole["long.dat"][2] == value_of(CONTENTS["long"]) and whole["not_text.dat"][2] == value_of(CONTENTS["not_text"])
    for split in ("1k", "7k", "50k"):
        settings(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1k")
        assert digest_of(spark, str(tmp_path)) == whole


def test_every_change_shows(spark, tmp_path):
    drawn = random.Random(1)
    content = CONTENTS["long"][:4_000]
    changed = {"as_it_is": content}
    for i in range(30):
        at = drawn.randrange(len(content))
        changed[f"byte_{i}"] = content[:at] + bytes([content[at] ^ 1 << drawn.randrange(8)]) + content[at + 1 :]
    lines = content.splitlines(keepends=True)
    changed["swapped"] = b"".join([lines[1], lines[0], *lines[2:]])
    changed["moved"] = b"".join([*lines[1:], lines[0]])
    written(tmp_path, changed)
    found = digest_of(spark, str(tmp_path))
    assert len({value for value in found.values()}) == len(changed)


def test_changes_are_reported_and_nothing_else(spark, tmp_path):
    contents = {f"{folder}/{name}": b"some\ntext of %d\n" % i for i, (folder, name) in enumerate((a, b) for a in ("x", "x/y", "z") for b in "abcd")}
    inputs, root = written(tmp_path / "in", contents), str(tmp_path / "raw")
    landing.land_raw(spark, inputs, root, text_datasets=["things"])
    (tmp_path / "in" / "x" / "y" / "b.dat").write_bytes(b"some\ntexT of 5\n")  # a byte, not the length
    (tmp_path / "in" / "z" / "a.dat").write_bytes(b"some\ntext of 8")  # without its last line end
    (tmp_path / "in" / "z" / "new.dat").write_bytes(b"")
    (tmp_path / "in" / "x" / "c.dat").unlink()
    now = landing.source_files(spark, inputs, ["things"])
    stored = landing.landed_files(spark, root)
    expected = {
        ("things/x/y/b.dat", "content_differs"),
        ("things/z/a.dat", "size_differs"),
        ("things/z/new.dat", "only_local"),
        ("things/x/c.dat", "only_stored"),
    }
    flat = landing.reconcile_landing(now, stored).where("status <> 'same'")
    assert {(row["relative_path"], row["status"]) for row in flat.collect()} == expected
    files, opened = digests.differences(landing.landing_tree(now), landing.landing_tree(stored))
    assert {(row["path"], row["status"]) for row in files.collect()} == expected
    assert {row["path"] for row in opened.collect()} == {"", "/things", "/things/x", "/things/x/y", "/things/z"}


def test_only_new_and_changed_files_are_read_again(spark, tmp_path):
    inputs = written(tmp_path / "in")
    folder = tmp_path / "known"
    landing.source_files(spark, inputs, ["things"]).write.parquet(str(folder))
    known = spark.read.parquet(str(folder))
    (tmp_path / "in" / "added.dat").write_bytes(b"more\n")
    again = landing.source_files(spark, inputs, ["things"], known=known)
    fresh = landing.source_files(spark, inputs, ["things"])
    columns = ["path", "length", "lines", "open_end", "digest"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, fresh.select(columns).collect()))
    fresh.write.parquet(str(tmp_path / "fresh"))
    unchanged = landing.source_files(spark, inputs, ["things"], known=spark.read.parquet(str(tmp_path / "fresh")))
    assert sorted(map(tuple, unchanged.select(columns).collect())) == sorted(map(tuple, fresh.select(columns).collect()))
    assert "Format: Text" not in unchanged._jdf.queryExecution().toString()


def test_equal_trees_are_not_opened(spark):
    rows = [(f"d{i % 7}/e{i % 3}/f{i}", i, str(i)) for i in range(100)]
    files = spark.createDataFrame(rows, "relative_path string, length bigint, digest string")
    tree = digests.tree(files)
    root = tree.where("depth = 0").first()
    assert (root["files"], root["bytes"], root["is_file"]) == (100, sum(range(100)), False)
    assert tree.where("is_file").count() == 100 and tree.where("depth = 1").count() == 7
    differing, opened = digests.differences(tree, digests.tree(files.repartition(9)))
    assert differing.count() == 0 and opened.count() == 1
    moved = files.withColumn("relative_path", F.when(F.col("length") == 50, "d9/f").otherwise(F.col("relative_path")))
    differing, opened = digests.differences(tree, digests.tree(moved))
    assert sorted((row["path"], row["status"]) for row in differing.collect()) == [("d1/e2/f50", "only_local"), ("d9/f", "only_stored")]
    assert {row["path"] for row in opened.collect()} == {"", "/d1", "/d1/e2", "/d9"}
