import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldlake.operators.mapping import (
    first_present,
    map_database_soil,
    map_local_soil,
    prefix_columns,
)
from fieldlake.sources import catalogue, documents, grids, soil_files, tables
from fieldlake.sources.profile import profile


@pytest.fixture
def soil_root(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "SoilHealthDB_V1.csv").write_text(
        "Latitude,Longitude,SamplingYear,SoilpH,N_C,N_T,Place\n"
        "47.92,-109.92,1998,6.1,10,12,Königsau\n48.3,-110.1,n/a,x,8,,b\n",
        encoding="utf-8",
    )
    (tmp_path / "deep" / "SoilHealthDB_V2.csv").write_bytes(
        "Latitude,Longitude,YearPublication,pH_C,pH_T,P_C,Région\n"
        "10,20,2001,5,7,4,été\n".encode("latin1")
    )
    (tmp_path / "deep" / "er" / "same [header] 100%+.csv").write_text(
        "Latitude,Longitude,SamplingYear,SoilpH,N_C,N_T,Place\n1,2,2005,7,1,2,c\n"
    )
    (tmp_path / "deep" / "header_only.csv").write_text("a,b\n")
    (tmp_path / "deep" / "empty.csv").write_text("")
    return tmp_path


def test_csv_files_with_differing_headers_and_encodings(spark, soil_root):
    found = soil_files.read_csv_files(spark, str(soil_root))
    rows = {r["Latitude"]: r.asDict() for r in found.table.collect()}
    assert set(rows) == {"47.92", "48.3", "10", "1"}
    assert rows["47.92"]["Place"] == "Königsau"
    assert rows["10"]["Région"] == "été"
    assert rows["10"]["SamplingYear"] is None and rows["1"]["SoilpH"] == "7"
    skipped = {r["path"].rsplit("/", 1)[1] for r in found.skipped.collect()}
    assert skipped == {"header_only.csv", "empty.csv"}


def test_curated_files_only(spark, soil_root):
    assert soil_files.read_curated_soil_files(spark, str(soil_root)).table.count() == 3


def test_quotes_line_breaks_and_repeated_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n\nYear,Note,year, \n1999,"x, ""y""",7,8\nYear,Note,year, \n\n2000,"",,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_bytes('note,YEAR\n"two\nlines, é",2001\nshort\n'.encode("latin1"))
    (tmp_path / "c.csv").write_text('N,Note\n1,"multi\n""line"" é",beyond\n2,plain\n', encoding="utf-8")
    rows = soil_files.read_csv_files(spark, str(tmp_path)).table
    assert rows.columns == ["Year", "Note", "year.1", "_c3", "N"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [
            ("1999", 'x, "y"', "7", "8", None),
            ("Year", "Note", "year", " ", None),
            ("2000", None, None, None, None),
            ("2001", "two\nlines, é", None, None, None),
            (None, "short", None, None, None),
            (None, 'multi\n"line" é', None, None, "1"),
            (None, "plain", None, None, "2"),
        ],
        key=str,
    )


def test_plan_does_not_grow_with_files_and_headers(spark, tmp_path, plan_of):
    sizes = []
    for number, (files, headers) in enumerate([(12, 3), (600, 60)]):
        root = tmp_path / f"r{number}"
        root.mkdir()
        for i in range(files):
            names = [f"c{(i % headers + j) % 5}" for j in range(1 + i % headers % 5)] + ["Year"] * (i % 2)
            names.append("lat" if i % 2 else "Year")
            text = ",".join(names) + ("\r\n" if i % 3 else "\n") + ",".join(str(i) for _ in names) + "\n"
            (root / f"f{i}.csv").write_text(text)
        table = soil_files.read_csv_files(spark, str(root)).table
        assert table.count() == files
        assert {r["Year"] for r in table.select("Year").collect()} == {str(i) for i in range(files)}
        sizes.append(plan_of(table).count("Scan"))
    assert sizes[0] == sizes[1]


def test_parquet_kinds_share_scans(spark, tmp_path, plan_of, monkeypatch):
    for i in range(8):
        pd.DataFrame({"lat": [i if i % 2 else i + 0.5], f"extra{i % 3}": ["e"]}).to_parquet(tmp_path / f"f{i}.parquet")
    found = soil_files.read_parquet_files(spark, str(tmp_path))
    rows = {r["lat"]: [r[f"extra{j}"] for j in range(3)] for r in found.table.collect()}
    assert set(rows) == {"0.5", "1", "2.5", "3", "4.5", "5", "6.5", "7"}
    assert rows["7"] == [None, "e", None] and found.skipped.count() == 0
    assert plan_of(found.table).count("Location:") == 2  # lat is a long or a double
    (tmp_path / "damaged.parquet").write_bytes(b"not parquet at all")
    monkeypatch.setattr(soil_files, "FOOTER_BYTES", 10)
    again = soil_files.read_parquet_files(spark, str(tmp_path))
    assert {r["lat"]: [r[f"extra{j}"] for j in range(3)] for r in again.table.collect()} == rows
    assert [r["path"].rsplit("/", 1)[1] for r in again.skipped.collect()] == ["damaged.parquet"]


def test_no_usable_file_is_an_error(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(FileNotFoundError):
        soil_files.read_csv_files(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        soil_files.read_soil_files(spark, str(tmp_path))


def test_damaged_parquet_is_skipped_and_listed(spark, soil_root):
    pd.DataFrame({"Latitude": [5.5], "Longitude": [6.5], "K_C": [3]}).to_parquet(
        soil_root / "more.parquet"
    )
    (soil_root / "zz_damaged.parquet").write_bytes(b"not parquet")
    found = soil_files.read_parquet_files(spark, str(soil_root))
    assert [r["Latitude"] for r in found.table.collect()] == ["5.5"]
    assert [r["path"].rsplit("/", 1)[1] for r in found.skipped.collect()] == ["zz_damaged.parquet"]
    both = soil_files.read_soil_files(spark, str(soil_root))
    assert both.table.count() == 5 and both.skipped.count() == 3


def test_mapping_of_the_database_layout(spark, soil_root):
    mapped = map_database_soil(soil_files.read_csv_files(spark, str(soil_root)).table)
    rows = {r["field_id"]: r for r in mapped.collect()}
    first = rows["grid_47.92_-109.92"]
    assert (first["timestamp"].year, first["soil_ph"], first["nitrogen"]) == (1998, 6.1, 11.0)
    # The time column is chosen per table, so the other file's YearPublication is not looked at.
    assert rows["grid_10.0_20.0"]["timestamp"] is None
    assert rows["grid_48.3_-110.1"]["soil_ph"] is None
    assert all(r["potassium"] is None and 0 <= r["q_value"] < 1 for r in rows.values())


def test_mapping_priorities_differ(spark):
    raw = spark.createDataFrame(
        [("2003-05-06", "1999", "7", "1", "2", "9")],
        "timestamp string, SamplingYear string, SoilpH string, N string, N_total string, K_1 string",
    )
    local, database = map_local_soil(raw).first(), map_database_soil(raw).first()
    assert str(local["timestamp"]) == "2003-05-06 00:00:00"
    assert str(database["timestamp"]) == "1999-01-01 00:00:00"
    assert local["nitrogen"] == 1.0 and database["nitrogen"] == 1.5
    assert local["potassium"] is None and database["potassium"] == 9.0
    assert local["temperature"] == 20.0 and database["temperature"] is None


def test_prefixes_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "P int, p_x int, PH_1 int, Price int")
    assert prefix_columns(df, "P") == ["P", "p_x"]
    assert first_present(df, ["nope", "PH_1", "P"]) == "PH_1"


def test_row_ids_are_unique(spark):
    raw = spark.range(1000).repartition(5).select(F.col("id").alias("N"))
    assert map_local_soil(raw).select("field_id").distinct().count() == 1000


def test_grid_falls_back_to_the_first_variable(spark):
    df = spark.createDataFrame(
        [("2001-01-01", 1.0, 2.0, float("nan"))], "time string, lat double, lon double, sm double"
    )
    row = grids.moisture_grid(df).first()
    assert row["soil_moisture"] is None and row["time"].year == 2001
    with pytest.raises(KeyError):
        grids.moisture_grid(df.drop("time"))
    with pytest.raises(ValueError):
        grids.moisture_grid(df.drop("sm"))


def test_raster_means_ignore_missing_pixels(spark):
    pixels = spark.createDataFrame(
        [("d/SM2001.tif", 1.0), ("d/SM2001.tif", float("nan")), ("d/SM2001.tif", 3.0),
         ("d/sm_v2_1998.tif", 5.0), ("nodigits.tif", None)],
        "file string, value double",
    )
    rows = {r["file"]: r for r in grids.raster_means(pixels).collect()}
    assert rows["d/SM2001.tif"]["soil_moisture"] == 2.0
    assert rows["d/SM2001.tif"]["time"].year == 2001
    assert rows["d/sm_v2_1998.tif"]["time"].year == 2199
    assert rows["nodigits.tif"]["time"].year == 2000
    strict = {r["file"]: r["time"].year for r in grids.raster_means(pixels, strict_year=True).collect()}
    assert strict["d/sm_v2_1998.tif"] == 1998


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo é", encoding="utf-8")
    row = documents.read_text_files(spark, str(tmp_path)).first()
    assert row["text"] == "one\ntwo é" and row["doc_id"].endswith("a.txt")
    with pytest.raises(AnalysisException):
        documents.read_text_files(spark, str(tmp_path / "none")).count()


def test_catalogue_and_profile(spark):
    df = catalogue.applications(spark)
    assert df.count() == 5
    assert df.filter("market_potential = 'high'").count() == 3
    facts = {r["column"]: r for r in profile(tables.normalise(df)).collect()}
    assert facts["name"]["rows"] == 5 and facts["name"]["nulls"] == 0
    assert facts["name"]["min"] == "environmental_monitoring"


def test_normalise_types(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' t, double('NaN') x, 1.5 y")
    row = tables.normalise(df)
    assert dict(row.dtypes)["t"] == "timestamp"
    assert row.first()["x"] is None


def test_profile_of_a_map_column(spark):
    df = spark.sql("SELECT * FROM VALUES (1, map('a', 1)), (2, NULL) AS t(n, m)")
    facts = {r["column"]: r for r in profile(df).collect()}
    assert (facts["m"]["rows"], facts["m"]["nulls"], facts["m"]["min"], facts["m"]["max"]) == (2, 1, None, None)
    assert (facts["n"]["min"], facts["n"]["max"]) == ("1", "2")


def test_files_are_described_without_sorting_their_lines(spark, tmp_path, plan_of):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text('x\n"one\ntwo"\n')
    described = soil_files.describe_csv_files(spark, str(tmp_path))
    assert "SortAggregate" not in plan_of(described)
    found = {row["path"].rsplit("/", 1)[1]: tuple(row)[1:] for row in described.collect()}
    assert found == {"a.csv": ("x,y", True, 3, False), "b.csv": ("x", True, 3, True)}
