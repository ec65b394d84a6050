"""Whole jobs on small files: landing, cleaned and aggregated layers, flat twin, evaluation."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.operators.select import Box
from strata.plans import aggregated, cleaned, evaluation, flat, landing
from strata.sinks import publish, read_layer, replace_table, write_layer, write_merged, write_metrics
from strata.sources import delimited
from strata.sources.files import manifest
from strata.sources.lines import read_lines

MONTHS = "Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def raw(tmp_path):
    """One small file set per dataset, in the raw formats."""
    root = tmp_path / "in"
    daily = root / "noaa" / "all"
    nested = daily / "all"
    nested.mkdir(parents=True)
    (root / "nasa.csv").write_text(
        f"Land-Ocean: Global Means\nYear,{MONTHS},J-D\n"
        "2000," + ",".join(str(i / 10) for i in range(12)) + ",x\n"
        "2001," + ",".join(["***"] * 12) + ",x\n"
        "2002,9" + ",0" * 11 + ",x\n"
    )
    (root / "gcb.csv").write_text(
        "Notes about the sheet,,\nYear,Fossil emissions,Land-use (net),Empty\n"
        "2000,10,1.5,\n2001,20,,\n1700,5,5,\ntotal,1,1,\n"
    )

    def station(number, lat, lon, name):
        return f"ST{number:09d} {lat:8.4f} {lon:9.4f} {'':6}    {name}"

    stations = [
        station(3, 0, 100, "FIRST"),
        station(1, 0, 10, "OUTSIDE"),
        station(2, 28, 142, "EDGE"),
        station(4, 0, 100, "NOT WANTED"),
        station(5, 0, 100, "NO FILE"),
        station(3, 1, 101, "SECOND"),
        station(6, 0, 100, "OVER THE CAP"),
    ]
    (root / "noaa" / "stations.txt").write_text("\n".join(stations) + "\n")
    elements = {1: "TMAX", 2: "TMIN", 3: "PRCP", 4: "SNOW", 5: "TAVG", 6: "TMAX"}
    (root / "noaa" / "inventory.txt").write_text(
        "".join(f"ST{n:09d} {'':19}{e} 2000 2001\n" for n, e in elements.items())
    )
    for number, folder in ((3, daily), (2, nested), (6, daily)):
        # The line's own id differs from the file's name; attributes follow the name.
        text = f"XX{number:09d}200001TMAX   {number}0   \n"
        (folder / f"ST{number:09d}.dly").write_text(text)
    (nested / "ST000000003.dly").write_text("XX000000003200001TMAX  990   \n")
    return root


def grid_cells(spark):
    nan = float("nan")
    data = [
        (dt.datetime(2000, 1, 1, 6), "t2m", 1.0),
        (dt.datetime(2000, 1, 1, 6), "t2m", 3.0),
        (dt.datetime(2000, 1, 2, 6, 0, 0, 900000), "t2m", 4.0),
        (dt.datetime(2000, 2, 1), "t2m", nan),
        (dt.datetime(2000, 2, 1), "tp", 5.0),
        (dt.datetime(2000, 2, 1), "latitude", 5.0),
    ]
    cells = spark.createDataFrame(data, "time timestamp, variable string, value double")
    units = F.when(F.col("variable") == "t2m", "K")
    return cells.withColumns({"units": units, "source_file": F.lit("a.nc")})


def build_silver(spark, raw, root):
    cleaned.run_anomalies(spark, str(raw / "nasa.csv"), root)
    cleaned.run_carbon(spark, str(raw / "gcb.csv"), root, header_row=1)
    cleaned.run_grid(grid_cells(spark), root)


def run_daily(spark, raw, root, *, roots=None, **options):
    noaa = raw / "noaa"
    return cleaned.run_daily(
        spark,
        str(noaa / "stations.txt"),
        str(noaa / "inventory.txt"),
        roots or [str(noaa / "all"), str(noaa / "all" / "all")],
        root,
        **options,
    )


def test_anomaly_job(spark, raw, tmp_path):
    got = cleaned.run_anomalies(spark, str(raw / "nasa.csv"), str(tmp_path / "silver"))
    assert got.columns == ["year", "month", "date", "anomaly"]
    assert got.count() == 36
    assert [r["date"] for r in got.collect()] == sorted(r["date"] for r in got.collect())
    assert got.where("anomaly is null").count() == 12


def test_carbon_job(spark, raw, tmp_path):
    got = cleaned.run_carbon(spark, str(raw / "gcb.csv"), str(tmp_path / "silver"), header_row=1)
    assert rows(got) == [
        (2000, "fossil_emissions", 10.0),
        (2000, "land_use_net", 1.5),
        (2001, "fossil_emissions", 20.0),
    ]


def test_carbon_sheet_with_the_header_taken_from_the_title(spark, raw):
    """Read as the title row says: the raw table has no numeric column."""
    sheet = delimited.read_sheet_csv(spark, str(raw / "gcb.csv"))
    assert tuple(evaluation.numeric_quality(sheet).first()) == (0.0, 0.0)
    names = {r["metric"] for r in cleaned.clean_carbon(sheet).collect()}
    assert names == {"unnamed_1", "unnamed_2"}


def test_grid_job(spark, tmp_path):
    got = cleaned.run_grid(grid_cells(spark), str(tmp_path))
    assert [tuple(r) for r in got.orderBy("time", "variable").collect()] == [
        (dt.datetime(2000, 1, 1, 6), "t2m", 2.0, "K", "a.nc"),
        (dt.datetime(2000, 1, 2, 6), "t2m", 4.0, "K", "a.nc"),
        (dt.datetime(2000, 2, 1), "t2m", None, "K", "a.nc"),
        (dt.datetime(2000, 2, 1), "tp", 5.0, None, "a.nc"),
    ]


def test_grid_times_as_text(spark):
    cells = grid_cells(spark).withColumn("time", F.col("time").cast("string"))
    noon = cells.limit(1).withColumn("time", F.lit("noon"))
    got = cleaned.clean_grid(cells.unionByName(noon))
    assert got.count() == 5 and got.where("time is null").count() == 1


def test_daily_job(spark, raw, tmp_path):
    got, missing = run_daily(spark, raw, str(tmp_path / "silver"), max_stations=4)
    # Four matches in file order: 3, 2, 5 and the second entry of 3, whose attributes win.
    day = dt.date(2000, 1, 1)
    assert rows(got.select("station_id", "date", "value", "lat", "lon", "elevation", "name")) == [
        ("XX000000002", day, 2.0, 28.0, 142.0, 0.0, "EDGE"),
        ("XX000000003", day, 3.0, 1.0, 101.0, 0.0, "SECOND"),
    ]
    assert rows(missing) == [("ST000000005",)]


def test_daily_job_without_a_cap(spark, raw, tmp_path):
    got, _ = run_daily(spark, raw, str(tmp_path / "silver"), max_stations=None)
    assert got.count() == 3


def test_daily_job_without_files(spark, raw, tmp_path):
    """An error with and without a cap, from files and from landed lines."""
    for cap in (None, 4, 20_000):
        with pytest.raises(FileNotFoundError, match="no data files"):
            run_daily(spark, raw, str(tmp_path / "silver"), max_stations=cap, roots=[str(tmp_path / "none")])


def test_daily_job_without_stations(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="no station"):
        run_daily(spark, raw, str(tmp_path / "silver"), box=Box(60, 61, 0, 1))


def test_lines_in_folders_of_other_stations_are_not_read(spark, tmp_path):
    lines = spark.createDataFrame([(f"S{i}",) for i in range(20)], "value string")
    prefix = F.substring("value", 1, 2).alias("prefix")
    lines.select("value", prefix).write.partitionBy("prefix").text(str(tmp_path / "d"))
    stored = spark.read.schema("value string, prefix string").text(str(tmp_path / "d"))
    stations = spark.createDataFrame([("S1",), ("S12",)], "station_id string").where("station_id <> ''")
    pruned = cleaned.prune_lines(stored, stations)
    assert {r["prefix"] for r in pruned.collect()} == {"S1"}
    assert "dynamicpruning" in pruned._jdf.queryExecution().toString()


def test_gold_tables_equal_their_flat_twins(spark, raw, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    build_silver(spark, raw, silver)
    trend = aggregated.run_trend(spark, silver, gold)
    annual = aggregated.run_annual_carbon(spark, silver, gold)
    joined = aggregated.run_multi_source(spark, silver, gold)
    assert trend.dtypes == [("date", "date"), ("source", "string"), ("variable", "string"), ("unit", "string"), ("value", "double")]
    assert trend.count() == 24 + 3
    jan = dt.date(2000, 1, 1)
    assert (jan, "ERA5", "t2m", "K", 3.0) in rows(trend)
    assert [tuple(r) for r in joined.orderBy("year").collect()] == [
        (2000, pytest.approx(0.55), 3.0, 10.0, "t2m", "fossil_emissions"),
        (2001, None, None, 20.0, "t2m", "fossil_emissions"),
        (2002, 0.75, None, None, "t2m", "fossil_emissions"),
    ]
    parts = [
        read_layer(spark, silver, name)
        for name in (cleaned.ANOMALY_TABLE, cleaned.GRID_TABLE, cleaned.CARBON_TABLE)
    ]
    paths = flat.run_flat(*parts, str(tmp_path / "flat"))
    for name, layered in {"temp_trend": trend, "gcb_annual": annual, "multi_source_join": joined}.items():
        other = spark.read.parquet(paths[name])
        assert tuple(flat.difference_counts(layered, other).first()) == (0, 0)
        assert spark.table(name).count() == other.count()
    serving = [aggregated.serving_query(t) for t in (trend, spark.read.parquet(paths["temp_trend"]))]
    assert serving[0].collect() == serving[1].collect()


def test_difference_counts_sees_duplicates(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (3,)], "a int")
    assert tuple(flat.difference_counts(left, right).first()) == (2, 1)


def test_jobs_run_twice_leave_one_copy(spark, raw, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    counts = []
    for _ in range(2):
        build_silver(spark, raw, silver)
        daily, _ = run_daily(spark, raw, silver)
        tables = [
            daily,
            aggregated.run_trend(spark, silver, gold),
            aggregated.run_annual_carbon(spark, silver, gold),
            aggregated.run_multi_source(spark, silver, gold),
        ]
        counts.append([t.count() for t in tables])
    assert counts[0] == counts[1]


def test_landing_and_its_reconciliation(spark, raw, tmp_path):
    inputs = {
        "anomaly": [(str(raw), "nasa.csv")],
        "daily": [(str(raw / "noaa" / "packed"), "*"), (str(raw / "noaa" / "all"), "*.dly")],
    }
    root = str(tmp_path / "bronze")
    required = ["nasa.csv"]
    files = landing.land_raw(spark, inputs, root, text_datasets=list(inputs), required=required, prefix_length=2)
    assert files.count() == 5
    lines = landing.landed_lines(spark, root, "anomaly").orderBy("file_path", "block_start", "row_id")
    assert "\n".join(r["value"] for r in lines.collect()) + "\n" == (raw / "nasa.csv").read_text()
    assert {r["prefix"] for r in landing.landed_lines(spark, root, "daily").collect()} == {"ST"}
    (raw / "noaa" / "all" / "ST000000009.dly").write_text("late\n")
    checked = landing.reconcile_landing(
        landing.source_files(spark, inputs, list(inputs)), landing.landed_files(spark, root)
    )
    assert {r["status"]: r["count"] for r in checked.groupBy("status").count().collect()} == {"same": 5, "only_local": 1}
    (raw / "noaa" / "all" / "ST000000009.dly").write_text("")
    (raw / "other.xlsx").write_text("not text")
    more = inputs | {"other": [(str(raw), "*.xlsx")]}
    landing.land_raw(spark, more, root, text_datasets=list(inputs))
    checked = landing.reconcile_landing(landing.source_files(spark, more, list(inputs)), landing.landed_files(spark, root))
    assert {r["status"]: r["count"] for r in checked.groupBy("status").count().collect()} == {"same": 6}
    with pytest.raises(FileNotFoundError, match="absent"):
        landing.land_raw(spark, inputs, root, text_datasets=[], required=["absent"])


def test_sheet_choice(spark):
    def choose(*names):
        sheets = spark.createDataFrame(list(enumerate(names)), "position int, sheet string")
        return cleaned.choose_sheet(sheets).first()["sheet"]

    assert choose("Summary", "GLOBAL carbon Budget", "global budget 2") == "GLOBAL carbon Budget"
    assert choose("Summary", "Budget") == "Summary"


def test_evaluation_and_report(spark, raw, tmp_path):
    silver = str(tmp_path / "silver")
    build_silver(spark, raw, silver)
    daily, _ = run_daily(spark, raw, silver)
    wide = delimited.read_anomaly_csv(spark, str(raw / "nasa.csv"))
    tables = [
        read_layer(spark, silver, name)
        for name in (cleaned.ANOMALY_TABLE, cleaned.CARBON_TABLE, cleaned.GRID_TABLE)
    ]
    scores = evaluation.quality_scores(
        {
            "nasa": delimited.missing_marks_to_null(wide, evaluation.MONTH_NAMES),
            "gcb": delimited.read_sheet_csv(spark, str(raw / "gcb.csv")),
            "era5": cleaned.clean_grid(grid_cells(spark)),
            "noaa": daily,
        },
        {"nasa": tables[0], "gcb": tables[1], "era5": tables[2], "noaa": daily},
    )
    files = evaluation.layer_files(
        spark, {"bronze": str(raw), "silver": silver, "gold": str(tmp_path / "none")}
    )
    document = evaluation.metrics_document(scores, files, medallion_seconds=0.25, note="Note.")
    path = str(tmp_path / "metrics.json")
    row = evaluation.run_evaluation(document, path).first()
    nasa = 0.5 * 24 / 36 + 0.5 * 23 / 36
    assert row["data_quality"]["nasa"]["raw_score"] == pytest.approx(nasa)
    assert row["data_quality"]["nasa"]["silver_score"] == pytest.approx(nasa)
    assert tuple(row["data_quality"]["gcb"]) == (0.0, 1.0)
    assert tuple(row["data_quality"]["era5"]) == (0.75, 0.75)
    assert row["data_quality"]["overall"]["silver_score"] == pytest.approx((nasa + 1 + 0.75 + 1) / 4)
    assert row["storage_bytes"]["gold"] == 0 and row["compression_ratio"]["silver_to_gold"] is None
    raw_bytes = sum(p.stat().st_size for p in raw.rglob("*") if p.is_file())
    assert row["storage_bytes"]["bronze"] == raw_bytes
    report = {r["label"]: r["value"] for r in evaluation.run_report(spark, path).collect()}
    assert report["Medallion query latency (s)"] == "0.2500"
    assert report["Baseline query latency (s)"] == "n/a"
    assert report["Compression Silver→Gold"] == "n/a"
    assert report["latency"] == "Note." and report["GCB"] == "0.0000"


def test_report_of_published_numbers(spark, tmp_path):
    path = tmp_path / "metrics.json"
    quality = {"nasa": {"raw_score": 0.8765432109876543, "silver_score": 0.8765432109876543}}
    path.write_text(
        json.dumps(
            {
                "latency_seconds": {"medallion_query": 0.01239473499985761},
                "storage_human": {"bronze": "30.8GB"},
                "compression_ratio": {"bronze_to_silver": 2048.317642496002, "silver_to_gold": None},
                "data_quality": quality,
            },
            indent=2,
        )
    )
    got = [tuple(r) for r in evaluation.run_report(spark, str(path)).orderBy("position").collect()]
    assert len(got) == 13
    values = {label: (value, silver) for _, _, label, value, silver in got}
    assert values["Medallion query latency (s)"] == ("0.0124", None)
    assert values["Bronze size"] == ("30.8GB", None) and values["Gold size"] == ("n/a", None)
    assert values["Compression Bronze→Silver"] == ("2048.32x", None)
    assert values["NASA"] == ("0.8765", "0.8765") and values["Overall"] == ("n/a", "n/a")


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "k")
    files = publish(df, str(tmp_path), "a/b")
    assert files.count() == publish(df, str(tmp_path), "a/b").count()
    merged = write_merged(df, str(tmp_path / "one"))
    assert manifest(spark, merged, "x", pattern="*.parquet").count() == 1
    with pytest.raises(Exception, match="more than one row"):
        write_metrics(df, str(tmp_path / "metrics"))
    assert replace_table(df, "numbers").count() == 10
    replace_table(df, "saved_numbers", saved=True)
    assert replace_table(df, "saved_numbers", saved=True).count() == 10
    path = write_layer(df.withColumn("p", F.col("k") % 2), str(tmp_path), "parts", partition_by=["p"])
    assert spark.read.parquet(path).where("p = 1").count() == 5


def test_lines_read_whole(spark, tmp_path):
    (tmp_path / "t").write_bytes("é1\r\n\r\nlast".encode())
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "t")).collect()] == ["é1", "", "last"]
