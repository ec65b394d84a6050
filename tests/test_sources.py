"""Readers: headers, fixed-width fields, file order, listings and file choice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.sources import delimited, files, fixed_width, lines, tables

HEADER = "Year,Jan,Feb,Mar,Apr,May,Jun,Jul,Aug,Sep,Oct,Nov,Dec,J-D"


def test_anomaly_csv_with_preamble_and_blank_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    row = "1880,-.18,***,.5" + ",1" * 9 + ",.1"
    path.write_text(f"\nLand-Ocean: Global Means\n{HEADER}\n\n{row}\n1881\n")
    wide = delimited.read_anomaly_csv(spark, str(path))
    assert wide.columns == HEADER.split(",")
    rows = {r["Year"]: r for r in wide.collect()}
    assert rows["1880"]["Jan"] == "-.18" and rows["1880"]["Feb"] == "***"
    assert rows["1881"]["Jan"] is None
    raw = delimited.missing_marks_to_null(wide, ["Feb"]).collect()
    assert [r["Feb"] for r in raw] == [None, None]


def test_many_anomaly_files_with_their_own_headers(spark, tmp_path):
    for year, preamble in ((1880, "Land-Ocean: Global\n"), (1990, "")):
        body = f"{preamble}{HEADER}\n{year}" + ",0" * 13 + "\n"
        (tmp_path / f"{year}.csv").write_text(body)
    wide = delimited.read_anomaly_csv(spark, str(tmp_path))
    assert sorted(r["Year"] for r in wide.collect()) == ["1880", "1990"]


def test_different_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Year,Jan\n1,2\n3,4\n5,6\n")
    (tmp_path / "b.csv").write_text("Year,Feb\n1,2\n")
    with pytest.raises(Exception, match="header"):
        delimited.read_anomaly_csv(spark, str(tmp_path)).collect()


def test_sheet_with_title_rows(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('Title,,\n,,\nYear,"Fossil, total",,x,x\n2000,1.5,a,b,c\n')
    sheet = delimited.read_sheet_csv(spark, str(path), header_row=2)
    assert sheet.columns == ["Year", "Fossil, total", "Unnamed: 2", "x", "x.1"]
    assert [tuple(r) for r in sheet.collect()] == [("2000", "1.5", "a", "b", "c")]


def test_stations_and_inventory(spark, tmp_path):
    def station(i, lat, lon, elevation, name):
        return f"{i:<11} {lat:>8} {lon:>9} {elevation:>6}    {name}"

    (tmp_path / "st").write_text(
        "\n".join([station("AA000000001", "-11.0000", "90.0000", "12.5", "ÉTÉ ONE"), "   ", station("AA000000002", "28.0000", "142.0000", "", "TWO")])
    )
    rows = fixed_width.read_stations(lines.read_lines(spark, str(tmp_path / "st"))).collect()
    assert [tuple(r) for r in rows] == [
        ("AA000000001", -11.0, 90.0, 12.5, "ÉTÉ ONE"),
        ("AA000000002", 28.0, 142.0, 0.0, "TWO"),
    ]
    (tmp_path / "inv").write_text(
        "".join(f"{i:<11} {'0':>8} {'0':>9} {e} 1900 2000\n" for i, e in (("A", "TMAX"), ("A", "PRCP"), ("B", "SNOW"), ("C", "TAVG")))
    )
    ids = fixed_width.inventory_stations(lines.read_lines(spark, str(tmp_path / "inv")))
    assert sorted(r[0] for r in ids.collect()) == ["A", "C"]


def test_position_is_file_order_when_files_are_split(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="1")
    text = [f"{i:07d}" for i in range(2000)]
    (tmp_path / "b").write_text("\n".join(text[1000:]))
    (tmp_path / "a").write_text("\n".join(text[:1000]))
    df = lines.read_lines(spark, str(tmp_path), position=True)
    assert df.rdd.getNumPartitions() > 4
    assert [r["value"] for r in df.orderBy(*lines.file_order()).collect()] == text
    assert lines.leading_lines(df, 1)[0] in ("0000000", "0001000")


def test_manifest_lists_names_as_they_are(spark, tmp_path):
    for name in ("a b.dly", "x+y.dly", "sub/c.dly", "other.txt", "sub/n%ne.dly"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("" if "%" in name else "12345\n")
    listed = files.manifest(spark, str(tmp_path), "d", pattern="*.dly").collect()
    assert sorted((r["relative_path"], r["length"]) for r in listed) == [
        ("a b.dly", 6),
        ("sub/c.dly", 6),
        ("sub/n%ne.dly", 0),
        ("x+y.dly", 6),
    ]


def test_first_place_and_required_inputs(spark, tmp_path):
    (tmp_path / "z.zip").write_text("z")
    places = [(str(tmp_path / "none"), "*"), (str(tmp_path), "*.nc"), (str(tmp_path), "*.zip")]
    assert files.first_available(spark, "grid", places).first()["pattern"] == "*.zip"
    with pytest.raises(FileNotFoundError, match="grid"):
        files.first_available(spark, "grid", places[:2])
    listing = files.manifest(spark, str(tmp_path), "d")
    files.require_inputs(listing, ["z.zip"])
    with pytest.raises(FileNotFoundError, match="a.csv"):
        files.require_inputs(listing, ["z.zip", "a.csv"])


def test_selected_files_prefer_the_first_root(spark, tmp_path):
    outer, inner = tmp_path / "all", tmp_path / "all" / "all"
    inner.mkdir(parents=True)
    (outer / "S 1.dly").write_text("outer\n")
    (inner / "S 1.dly").write_text("inner\n")
    (inner / "S2.dly").write_text("two\n")
    (inner / "S3.dly").write_text("three\n")
    roots = [str(outer), str(inner), str(tmp_path / "absent")]
    found = files.station_files(spark, roots).where(F.col("stem") != "S3")
    got = files.read_selected_files(spark, found, roots).collect()
    assert sorted((r["value"], r["file_stem"]) for r in got) == [("outer", "S 1"), ("two", "S2")]


def test_an_empty_choice_of_files_is_an_error(spark, tmp_path):
    (tmp_path / "S1.dly").write_text("x\n")
    chosen = files.station_files(spark, [str(tmp_path)])
    files.require_files(chosen)
    with pytest.raises(FileNotFoundError, match="no data files"):
        files.require_files(chosen.where("stem = 'S2'"))


def test_preamble_and_header_go_by_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nLand-Ocean: x\n \nYear,Jan\nYear,1\nLand-Ocean: y,2\n2000,3\n")
    (tmp_path / "b.csv").write_text("Year,Jan\n2001,4\n\n2001,4\n")
    got = delimited.read_anomaly_csv(spark, str(tmp_path))
    rows = [("2000", "3"), ("2001", "4"), ("2001", "4"), ("Land-Ocean: y", "2"), ("Year", "1")]
    assert got.columns == ["Year", "Jan"] and sorted(tuple(r) for r in got.collect()) == rows
    (tmp_path / "c.csv").write_text("Year,Feb\n2002,5\n")
    with pytest.raises(ValueError, match="disagree"):
        delimited.read_anomaly_csv(spark, str(tmp_path))


def test_sheet_cells_with_line_breaks(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        '2000,1,2\n\n"Year","Fossil\n\nfuel ""x""\n(urgent)",Low\n2000,1,2\n2001,"3\n4",\n , ,\n"Year",y,z\n'
    )
    got = delimited.read_sheet_csv(spark, str(tmp_path / "s.csv"), header_row=1)
    assert got.columns == ["Year", 'Fossil\n\nfuel "x"\n(urgent)', "Low"]
    assert [tuple(r) for r in got.collect()] == [("2000", "1", "2"), ("2001", "3\n4", None), (" ", " ", None), ("Year", "y", "z")]


def test_tables(spark, tmp_path):
    near, far = str(tmp_path / "near"), str(tmp_path / "far")
    spark.range(3).write.parquet(far)
    assert tables.read_first_parquet(spark, [near, far]).count() == 3
    assert tables.read_parquet(spark, far, far).count() == 6
    with pytest.raises(FileNotFoundError):
        tables.read_first_parquet(spark, [near])
    records = tables.from_records(spark, [("a", float("nan")), (None, 1.0)], "k string, v double")
    assert [tuple(r) for r in records.collect()] == [("a", None), (None, 1.0)]


def test_metrics_with_missing_sections(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{\n "storage_human": {"bronze": "1.0B"}\n}')
    row = tables.read_metrics(spark, str(path)).first()
    assert row["storage_human"]["bronze"] == "1.0B" and row["data_quality"] is None
