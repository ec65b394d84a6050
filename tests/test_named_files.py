"""Files named by the rows, their listing, and how landed lines are dealt, on hand-made rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import cleaned, landing
from strata.sources import files
from workload import shapes

TEXTS = "stem string, value string"


def written(folder):
    return {found.name: found.read_text() for found in folder.iterdir() if not found.name.startswith(".")}


def test_tasks_write_files_under_their_names(spark, tmp_path):
    rows = [("a", "1"), ("a", None), ("b/c=d", "é"), (None, "3"), ("", "4")]
    shapes.write_named_files(spark.createDataFrame(rows, TEXTS).repartition(3), str(tmp_path / "in"), ".txt")
    got = {name: sorted(text.splitlines()) for name, text in written(tmp_path / "in").items()}
    assert got == {"a.txt": ["", "1"], "b%2Fc%3Dd.txt": ["é"], "__HIVE_DEFAULT_PARTITION__.txt": ["3", "4"]}
    shapes.write_named_files(spark.createDataFrame([("a", "2")], TEXTS), str(tmp_path / "in"), ".txt")
    assert written(tmp_path / "in")["a.txt"] == "2\n"
    read = spark.read.text(str(tmp_path / "in"))
    # As before, Spark passes over the file of rows without a stem, as its name starts with an underscore.
    assert sorted(row["value"] for row in read.collect()) == ["2", "é"]


def test_no_file_is_moved_by_the_driver(spark, tmp_path):
    """Names as Spark's partition folders have them, from rows of many stems, without a folder per stem."""
    df = spark.range(500).select(F.format_string("S%03d", "id").alias("stem"), F.col("id").cast("string").alias("value"))
    shapes.write_named_files(df, str(tmp_path / "in"), ".dly")
    jobs = [name for name in (p.name for p in tmp_path.rglob("*")) if name.startswith(("stem=", "part-", ".part-"))]
    assert not jobs and not list((tmp_path / "in").glob(".*"))
    assert written(tmp_path / "in") == {f"S{n:03d}.dly": f"{n}\n" for n in range(500)}


def test_ordered_rows_stay_in_order_across_batches(spark, tmp_path, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    df = spark.range(100).select((F.col("id") % 2).cast("string").alias("stem"), "id", F.col("id").cast("string").alias("value"))
    ordered = df.repartition("stem").sortWithinPartitions("stem", F.col("id").desc())
    shapes.write_named_files(ordered, str(tmp_path / "in"), "", ordered=True)
    assert written(tmp_path / "in") == {
        str(k): "".join(f"{n}\n" for n in range(99, -1, -1) if n % 2 == k) for k in range(2)
    }


def test_no_rows_give_an_empty_folder(spark, tmp_path):
    shapes.write_named_files(spark.createDataFrame([], TEXTS), str(tmp_path / "in"), ".txt")
    assert written(tmp_path / "in") == {}


def test_a_listing_asks_for_each_file_once(spark, tmp_path):
    (tmp_path / "a.dly").write_text("1\n")
    (tmp_path / "empty.dly").write_text("")
    listed = files.manifest(spark, str(tmp_path), "d", pattern="*.dly")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan
    assert sorted((r["relative_path"], r["length"]) for r in listed.collect()) == [("a.dly", 2), ("empty.dly", 0)]


def test_only_a_large_prefix_is_dealt_in_parts(spark, tmp_path, monkeypatch, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(landing, "PART_BYTES", 1000)
    for name, count in (("AA1", 2000), ("AA2", 2000), ("BB1", 3), ("CC1", 2)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} {n}\n" for n in range(count)))
    inputs = {"texts": [(str(tmp_path), "*.txt")]}
    landing.land_raw(spark, inputs, str(tmp_path / "raw"), text_datasets=["texts"], prefix_length=2)
    stored = landing.landed_lines(spark, str(tmp_path / "raw"), "texts")
    folders = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "raw").rglob("prefix=*")}
    assert folders["prefix=BB"] == folders["prefix=CC"] == 1 and folders["prefix=AA"] > 1
    assert stored.count() == 4005
    assert stored.select("file_path", "block_start", "row_id").distinct().count() == 4005


def test_daily_lines_of_awkward_rows(spark, tmp_path):
    """Days of one month in one line whatever the order of the rows; a day without a quantity blanks its line."""
    schema = (
        "l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate string"
    )
    rows = [
        (1, "2001-02-03", 21.0, 0.0, 0.01, "A"),
        (1, "2001-02-01", 5.0, 0.1, 0.01, "A"),
        (1, "2001-02-03", 22.5, 0.0, 0.0, "A"),
        (1, "2001-03-31", 20.0, 0.0, 0.08, "R"),
        (2, "2001-01-05", None, 0.0, 0.01, "A"),
        (2, "2001-01-06", 30.0, 0.0, 0.01, "A"),
    ]
    items = spark.createDataFrame([(k, q, d, t, flag, "O", day) for k, day, q, d, t, flag in rows], schema)
    items = items.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    items.repartition(4).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1,), (2,)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = shapes.encoded_daily_lines(spark, str(tmp_path))
    assert lines._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    one, two = "SU000000001", "SU000000002"
    february = f"{one}200102TMAX" + "-9999  S" + " " * 8 + "   25T S" + " " * 26 * 8 + "  100"
    march = f"{one}200103TMIN" + " " * 30 * 8 + "    0 XS"
    got = sorted(((r["file_stem"], r["value"]) for r in lines.collect()), key=str)
    assert got == sorted([(one, one), (one, february), (one, march), (two, two), (two, None)], key=str)


def test_the_choice_of_station_files_is_stored(spark, tmp_path, monkeypatch):
    """The listing behind the choice is made once for each root, whatever is asked of it later."""
    asked = []
    monkeypatch.setattr(files, "preferred_files", lambda found, real=files.preferred_files: asked.append(1) or real(found))
    kept = []
    real = cleaned.require_files
    monkeypatch.setattr(cleaned, "require_files", lambda found: kept.append(found) or real(found))
    station = "SU000000001"
    (tmp_path / "stations").write_text(f"{station} {5.0:8.4f} {100.0:9.4f} {1.0:6.1f}    NAME\n")
    (tmp_path / "inventory").write_text(f"{station}{' ' * 20}TMAX 1995 2001\n")
    (tmp_path / "daily").mkdir()
    (tmp_path / "daily" / f"{station}.dly").write_text(f"{station}200101TMAX   10   \n")
    lists = str(tmp_path / "stations"), str(tmp_path / "inventory")
    rows, missing = cleaned.run_daily(spark, *lists, [str(tmp_path / "daily")], str(tmp_path / "silver"))
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and len(asked) == 1
    assert [r["value"] for r in rows.collect()] == [1.0] and missing.count() == 0
