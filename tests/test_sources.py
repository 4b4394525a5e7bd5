"""Readers, writers, catalogs and lookups on small files."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.sources import catalog, lookups, readers, writers
from conftest import rows

SKIM = T.StructType([T.StructField("F_TAZ", T.IntegerType()), T.StructField("T_TAZ", T.IntegerType()),
                     T.StructField("TIME", T.DoubleType()), T.StructField("GEOID", T.StringType())])


def test_csv_with_separators_names_and_gzip(spark, tmp_path):
    text = 'F_TAZ,T_TAZ,TIME,GEOID\n"1,001",2,"1,234.5",00120\n3,4,7,00340\n'
    (tmp_path / "a.csv").write_text(text)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(text)
    df = readers.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv.gz")], SKIM, ["F_TAZ", "TIME", "GEOID"],
                          {"F_TAZ": "OName"}, with_separators=["F_TAZ", "TIME"])
    assert df.dtypes == [("OName", "int"), ("TIME", "double"), ("GEOID", "string")]
    assert rows(df) == [(1001, 1234.5, "00120")] * 2 + [(3, 7.0, "00340")] * 2


def test_gzip_is_told_by_its_first_bytes(spark, tmp_path):
    (tmp_path / "plain.gz").write_text("not gzip")
    with gzip.open(tmp_path / "real.dat", "wt") as f:
        f.write("x")
    out = {r["path"].split("/")[-1]: r["is_gzip"] for r in readers.gzip_files(spark, str(tmp_path)).collect()}
    assert out == {"plain.gz": False, "real.dat": True}


def test_harmonised_years(spark, tmp_path):
    (tmp_path / "18.csv").write_text("PARCEL_ID,LND_SQFOOT\n01,5\n")
    (tmp_path / "19.csv").write_text("PARCEL_ID,LND_SQFOO\n02,6\n")
    schemas = {2018: "LND_SQFOOT", 2019: "LND_SQFOO"}
    df = readers.read_harmonised(
        spark, {y: str(tmp_path / f"{y % 100}.csv") for y in schemas},
        {y: T.StructType([T.StructField("PARCEL_ID", T.StringType()), T.StructField(c, T.DoubleType())]) for y, c in schemas.items()},
        {2019: {"LND_SQFOO": "LND_SQFOOT"}}, ["PARCEL_ID", "LND_SQFOOT"])
    assert rows(df) == [("01", 5.0, 2018), ("02", 6.0, 2019)]


def test_read_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.0, None)], "k int, v double, s string")
    assert rows(readers.read_table(df, ["k", "v"])) == [(0, 2.0), (1, 0.0)]
    assert rows(readers.read_table(df, "*", {"s": "none"})) == [(1, None, "a"), (None, 2.0, "none")]
    assert rows(readers.read_table(df, ["v"], skip_nulls=True)) == [(2.0,)]


def test_promoted_header(spark):
    first = spark.createDataFrame([(0, "ATIMEPER", "ALAT", "X"), (1, "AM", "25.1", "q")], "n int, a string, b string, c string")
    second = spark.createDataFrame([(0, "ATIMEPER", "ALAT", "X"), (1, "PM", "25.2", "r")], "n int, a string, b string, c string")
    out = readers.promote_header([first, second], "n", {"ATIMEPER": "TIME_PERIOD", "ALAT": "LAT"})
    assert out.columns == ["TIME_PERIOD", "LAT"] and rows(out) == [("AM", "25.1"), ("PM", "25.2")]
    assert readers.tag_renames("1411_2015_APR")["ON_1411_2015_APR"] == "ON"


def test_catalog_tables(spark):
    spark.range(2).createOrReplaceTempView("snap_a_2014")
    spark.range(3).withColumn("x", F.lit(1)).createOrReplaceTempView("snap_b_2015")
    assert readers.list_tables(spark, "snap_*") == ["snap_a_2014", "snap_b_2015"]
    assert readers.stack_tables(spark, "snap_*").count() == 5
    with pytest.raises(ValueError):
        readers.stack_tables(spark, "missing_*")


def test_writing_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_table(spark.range(3), path)
    writers.write_table(spark.range(5), path, overwrite=True)
    writers.append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 7


def test_publish_replaces_only_its_years_and_keeps_the_old_on_failure(spark, tmp_path):
    path = str(tmp_path / "out")

    def year(y, v):
        return spark.createDataFrame([(y, v)], "Year int, v int")

    writers.publish({"t": year(2018, 1)}, path)
    writers.publish({"t": year(2019, 2)}, path)
    writers.publish({"t": year(2019, 3)}, path)
    assert rows(writers.read_published(spark, path, "t").select("Year", "v")) == [(2018, 1), (2019, 3)]
    broken = year(2019, 9).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        writers.publish({"t": year(2018, 7), "u": broken}, path)
    assert rows(writers.read_published(spark, path, "t").select("Year", "v")) == [(2018, 1), (2019, 3)]


def test_points(spark):
    df = spark.createDataFrame([(-81.0, 25.0)], "lon double, lat double")
    p = writers.to_points(df, "lon", "lat", 4326, 6437).first()["geometry"]
    assert p["x"] == pytest.approx(200000.0)
    back = writers.to_points(df.select(F.lit(200000.0).alias("x"), F.lit(p["y"]).alias("y")), "x", "y", 6437, 4326).first()["geometry"]
    assert (back["x"], back["y"]) == (pytest.approx(-81.0), pytest.approx(25.0))
    with pytest.raises(ValueError):
        writers.to_points(df, "lon", "lat", 1, 6437)


@pytest.mark.parametrize("url,year,county", [
    ("h/Map Data/2019/dade.zip", 2019, "Miami-Dade"), ("h/x/PALM_BEACH/a", 9999, "Palm Beach"), ("h/2018/saint lucie/a", 2018, "St. Lucie"),
    ("h/2018/st.johns", 2018, "St. Johns"), ("h/2018/NAL23F.csv", 2018, "Miami-Dade"), ("h/2018/nal99x", 2018, ""), ("h/DESOTO/20", 9999, "DeSoto")])
def test_file_catalog(spark, url, year, county):
    out = catalog.file_catalog(spark.createDataFrame([("GIS", url)], "file string, url string")).first()
    assert (out["year"], out["county"]) == (year, county)


def test_catalog_filter(spark):
    df = spark.createDataFrame([("GIS", 2018, "Bay", "u"), ("GIS", 2019, "Lee", "v")], "file string, year int, county string, url string")
    kept, lacking = catalog.available(df, [2018, 2000], ["Bay"])
    assert rows(kept, "url") == [("u",)] and rows(lacking) == [("year", "2000")]
    with pytest.raises(ValueError):
        catalog.available(df, [1990])


def test_states_and_requests(spark):
    assert catalog.states(spark).count() == 56
    named = spark.createDataFrame([("fl",), ("Texas",), ("PUERTO RICO",), ("x",)], "s string")
    assert rows(catalog.state_codes(named, "s"), "s", "fips") == [("PUERTO RICO", "72"), ("Texas", "48"), ("fl", "12"), ("x", None)]
    asked = spark.createDataFrame(
        [("wac", "fl", "S000", "", "JT00", 2018, "bgrp"), ("wac", "ak", "S000", "", "JT00", 2018, "bgrp"), ("rac", "FL", "S9", "", "JT00", 2015, ""),
         ("od", "pr", "", "main", "JT00", 2015, ""), ("od", "fl", "", "main", "JT09", 2015, "")],
        "file_type string, state string, segment string, part string, job_type string, year int, agg_geo string")
    assert [r["refused"] for r in catalog.check_requests(asked).collect()] == [None, "year", "segment", "state", "job_type"]


def test_land_use_lookup(spark):
    table = {r["DOR_UC"]: r for r in lookups.land_uses(spark).collect()}
    assert len(table) == 104
    assert (table[14]["DIV_CLASS"], table[14]["GN_VA_LU"], table[14]["GEN_LU"]) == ("grocery", "Commercial/Retail", "Commercial")
    assert table[999]["DIV_CLASS"] == "other" and table[40]["GN_VA_LU"] == "Vacant/Undeveloped"


def test_codes_and_derivations(spark):
    raw = spark.createDataFrame([(10.0, 4.0, 2.0, 1.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0)], ", ".join(f"B08301_{c} double" for c in catalog.COMMUTE_CODES))
    out = catalog.derive_commute(catalog.rename_codes(raw, catalog.COMMUTE_TABLE, catalog.COMMUTE_CODES)).first()
    assert (out["Drove"], out["NonMotor"], out["AllOther"], out["SOV_Share"], out["HOV_Share"]) == (5.0, 2.0, 0.0, 0.5, 0.2)
    none = raw.withColumn("B08301_001E", F.lit(0.0))
    assert catalog.derive_commute(catalog.rename_codes(none, catalog.COMMUTE_TABLE, catalog.COMMUTE_CODES)).first()["SOV_Share"] is None


def test_a_driver_lost_between_any_two_steps_leaves_the_old_set(spark, tmp_path, monkeypatch):
    path, one = str(tmp_path / "out"), spark.createDataFrame([(1, 2018), (2, 2019)], "k int, Year int")
    writers.publish({"a": one, "b": one}, path)
    new = spark.createDataFrame([(9, 2019), (9, 2020)], "k int, Year int")
    steps = {"n": 0, "stop": None}

    class Lost(BaseException):
        """The driver's end: nothing after it runs."""

    def step(fn, after):
        def run(*args, **kwargs):
            steps["n"] += 1
            if steps["n"] == steps["stop"] and not after:
                raise Lost
            out = fn(*args, **kwargs)
            if steps["n"] == steps["stop"]:
                raise Lost
            return out
        return run

    from pyspark.sql.readwriter import DataFrameWriter
    write, manifest = DataFrameWriter.parquet, writers._write_manifest

    def attempt(stop, after):
        steps.update(n=0, stop=stop)
        monkeypatch.setattr(DataFrameWriter, "parquet", step(write, after))
        monkeypatch.setattr(writers, "_write_manifest", step(manifest, after))
        try:
            writers.publish({"a": new, "b": new, "c": new}, path)
            return False
        except Lost:
            return True
        finally:
            monkeypatch.setattr(DataFrameWriter, "parquet", write)
            monkeypatch.setattr(writers, "_write_manifest", manifest)

    def found():
        return {n: rows(writers.read_published(spark, path, n), "k", "Year") for n in writers.published(spark, path)}

    old = {n: [(1, 2018), (2, 2019)] for n in ("a", "b")}
    # Three tables and the manifest: ended before or after each of the writes, and before the manifest.
    for stop, after in [(1, False), (1, True), (2, False), (2, True), (3, False), (3, True), (4, False)]:
        assert attempt(stop, after) and found() == old
    assert not attempt(None, False)
    changed = [(1, 2018), (9, 2019), (9, 2020)]
    assert found() == {"a": changed, "b": changed, "c": [(9, 2019), (9, 2020)]}


def test_a_half_written_manifest_is_not_read_and_two_writers_do_not_mix(spark, tmp_path):
    path, one = str(tmp_path / "out"), spark.createDataFrame([(1, 2018)], "k int, Year int")
    writers.publish({"a": one}, path)
    (tmp_path / "out" / "manifests" / "draft-1").write_text('{"a": ')
    assert rows(writers.read_published(spark, path, "a"), "k", "Year") == [(1, 2018)]
    with pytest.raises(RuntimeError):
        writers._write_manifest(spark, path, 1, {})
    with pytest.raises(ValueError):
        writers.read_published(spark, path, "b")


def test_published_tables_keep_columns_null_years_and_recent_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.publish({"a": spark.createDataFrame([(1, 2018, "x"), (2, None, "y")], "k int, Year int, old string"), "w": spark.range(3)}, path)
    writers.publish({"a": spark.createDataFrame([(3, 2019, 0.5)], "k int, Year int, new double")}, path)
    assert rows(writers.read_published(spark, path, "a"), "k", "Year", "old", "new") == [(1, 2018, "x", None), (2, None, "y", None), (3, 2019, None, 0.5)]
    writers.publish({"a": spark.createDataFrame([(4, None, 1.5), (5, 2018, 2.5)], "k int, Year int, new double"), "w": spark.range(1)}, path)
    assert rows(writers.read_published(spark, path, "a"), "k", "Year", "new") == [(3, 2019, 0.5), (4, None, 1.5), (5, 2018, 2.5)]
    writers.publish({"w": spark.range(2)}, path)
    assert rows(writers.read_published(spark, path, "w")) == [(0,), (1,)]
    left = sorted(p.name for p in (tmp_path / "out" / "manifests").iterdir() if not p.name.startswith("."))
    assert left == ["000000000003.json", "000000000004.json"]
    writers.publish({}, path)


def test_gzip_files_under_any_name_are_read(spark, tmp_path):
    plain = 'F_TAZ,TIME,GEOID,X\n1,"1,234.5",007,a\n2,,008,"two\nlines"\n'
    (tmp_path / "a.csv").write_text(plain.replace('"two\nlines"', "b"))
    for name in ("b", "c.csv", "d.dat"):
        (tmp_path / name).write_bytes(gzip.compress(plain.encode()))
    (tmp_path / "e").write_bytes(gzip.compress("GEOID,F_TAZ\n009,5\n\nx,oops\n".encode()))
    (tmp_path / "f").write_bytes(gzip.compress(b""))
    schema = T.StructType([T.StructField("F_TAZ", T.IntegerType()), T.StructField("TIME", T.DoubleType()), T.StructField("GEOID", T.StringType()), T.StructField("X", T.StringType())])
    out = readers.read_sniffed_csv(spark, str(tmp_path), schema, ["F_TAZ", "TIME", "GEOID", "X"], {"F_TAZ": "zone"}, ["TIME"])
    assert out.columns == ["zone", "TIME", "GEOID", "X"] and [f.dataType for f in out.schema] == [f.dataType for f in schema]
    two = [(1, 1234.5, "007", "a"), (2, None, "008", "two\nlines")]
    want = two * 3 + [(1, 1234.5, "007", "a"), (2, None, "008", "b"), (5, None, "009", None), (None, None, "x", None)]
    assert sorted(rows(out), key=str) == sorted(want, key=str)


def test_unpacking_goes_on_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "UNPACKED_ROWS", 7)
    (tmp_path / "big").write_bytes(gzip.compress(("n\n" + "\n".join(map(str, range(100)))).encode()))
    out = readers.read_sniffed_csv(spark, str(tmp_path / "big"), T.StructType([T.StructField("n", T.LongType())]))
    assert sorted(r.n for r in out.collect()) == list(range(100))


def test_nested_maps_become_columns(spark):
    data = [(1, {"a": (1, {"x": 0.5}), "b": (2, None)}, {1: "u"}), (2, {"c": (3, {"y": 1.5, "x": 2.5})}, None), (3, None, {2: "v"})]
    df = spark.createDataFrame(data, "id int, m map<string,struct<n:int,d:map<string,double>>>, k map<int,string>")
    out = readers.flatten_columns(df)
    assert out.columns == ["id", "m/a/n", "m/a/d/x", "m/b/n", "m/c/n", "m/c/d/x", "m/c/d/y", "k/1", "k/2"]
    assert rows(out) == [(1, 1, 0.5, 2, None, None, None, "u", None), (2, None, None, None, 3, 2.5, 1.5, None, None), (3, None, None, None, None, None, None, None, "v")]
    with pytest.raises(ValueError, match="more than 2 keys"):
        readers.flatten_columns(df, most_keys=2)
    with pytest.raises(ValueError, match="two values"):
        readers.flatten_columns(spark.createDataFrame([(1, {"b": 2})], "`a/b` int, a map<string,int>"))
