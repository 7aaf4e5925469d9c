"""Mixed headers, quarantine, file order, one file by all tasks, observed rejects."""

import os

import pytest
from pyspark.sql import functions as F

from urbanlens.plans.inspect import physical_plan
from urbanlens.session import settings_of
from urbanlens.sources import writers
from urbanlens.sources.city import crime_rejects, observed_counts, read_crimes_observed, read_stations
from urbanlens.sources.lines import column_names, quarantined, read_mixed_headers, with_file_order
from urbanlens.sources.readers import read_delimited
from urbanlens.sources.writers import write_one_file


def _write(root, **files):
    for name, text in files.items():
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)


def test_files_of_one_folder_under_their_own_headers(spark, tmp_dir):
    _write(tmp_dir, a="zip;name;income\n1;A;$1\n2;B;$2\n", b='income;zip;name\n"$3;x";3;C\n', c="name;zip\nD;4\n\n",
           d="", e="zip;name;income\n", **{"odd {name} [x] %41": "zip;name;income\n5;E;$5\n"})
    df = read_mixed_headers(spark, tmp_dir, sep=";")
    assert sorted(tuple(r) for r in df.select("zip", "name", "income").collect()) == [
        ("1", "A", "$1"), ("2", "B", "$2"), ("3", "C", "$3;x"), ("4", "D", None), ("5", "E", "$5")]
    # Equal headers share a scan.
    assert physical_plan(df).count("\n(") >= 3 and physical_plan(df).count("Scan csv") == 2 * 3
    with pytest.raises(ValueError):
        read_mixed_headers(spark, os.path.join(tmp_dir, "d"))


def test_names_of_a_header():
    assert column_names('a,"b,c",a,A,', ",") == ["a", "b,c", "a2", "A3", "_c4"]


def test_only_first_lines_are_read(spark, tmp_dir):
    from urbanlens.sources.lines import file_headers
    spark.range(200_000).selectExpr("CAST(id AS STRING) AS value").coalesce(2).write.text(os.path.join(tmp_dir, "big"))
    heads = sorted(r.header for r in file_headers(spark, tmp_dir).collect())
    assert heads == ["0", "100000"]


def test_every_line_is_kept_or_put_aside(spark, tmp_dir):
    text = 'key;name;n\n1;A;10\n2\n3;"x;y";30\n;;\n4;D;four\n5;E;50;more\n\n   \n6;"F \\"q\\" ;";60\n'
    _write(tmp_dir, a=text, b="7;G;70\nbad")
    rows, rejects = quarantined(spark, tmp_dir, "key int, name string, n int", sep=";", header="key;name;n")
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == sorted(
        [(1, "A", 10), (3, "x;y", 30), (None, None, None), (6, 'F "q" ;', 60), (7, "G", 70)], key=repr)
    got = {(r.line, r.reason) for r in rejects.collect()}
    assert got == {("2", "too few fields"), ("4;D;four", "unreadable value"), ("5;E;50;more", "too many fields"),
                   ("", "empty line"), ("   ", "empty line"), ("bad", "too few fields")}
    assert rows.count() + rejects.count() == 11
    assert {os.path.basename(r.file) for r in rejects.where("line = 'bad'").collect()} == {"b"}


def test_rows_are_numbered_as_they_stand(spark, tmp_dir):
    _write(tmp_dir, **{f"f{i}": "".join(f"{i}-{j:03}\n" for j in range(n)) for i, n in enumerate((300, 0, 1, 250))})
    want = [f"{i}-{j:03}" for i, n in enumerate((300, 0, 1, 250)) for j in range(n)]
    for split in ("100", "1k", "1m"):
        with settings_of(spark, {"spark.sql.files.maxPartitionBytes": split}):
            rows = with_file_order(read_delimited(spark, tmp_dir, header=False, schema="v string")).collect()
        assert [r.v for r in sorted(rows, key=lambda r: r.ord)] == want
        assert sorted(r.ord for r in rows) == list(range(551))
    with pytest.raises(ValueError):
        with_file_order(read_delimited(spark, tmp_dir, header=False, schema="ord string"))


def test_stations_keep_file_order_when_split(spark, tmp_dir):
    _write(tmp_dir, **{f"s{i}.csv": "X,Y,DIVISION\n" + "".join(f"-118.25,34.05,S{i}{j:02}\n" for j in range(40))
                       for i in (0, 1)})
    with settings_of(spark, {"spark.sql.files.maxPartitionBytes": "200"}):
        rows = read_stations(spark, tmp_dir).orderBy("ord").collect()
    assert [r.division for r in rows] == [f"S{i}{j:02}" for i in (0, 1) for j in range(40)]
    assert rows[0].lat == 34.05 and rows[0].lon == -118.25


def test_one_file_in_order_by_all_tasks(spark, tmp_dir, monkeypatch):
    df = spark.range(5_000).select((5_000 - F.col("id")).alias("k"), F.lit("a,b").alias("s")).repartition(7)
    seen = []
    real = writers._join_parts
    monkeypatch.setattr(writers, "_join_parts", lambda spark, parts, target: (
        seen.append(len([f for f in os.listdir(parts) if f.startswith("part-")])), real(spark, parts, target)))
    path = os.path.join(tmp_dir, "one.csv")
    for _ in range(2):      # a second write replaces the first
        with settings_of(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            assert write_one_file(df, path, order_by=["k"]) == path
    assert seen[0] > 1
    with open(path) as fh:
        assert fh.read() == "".join(f'{k},"a,b"\n' for k in range(1, 5_001))
    assert "SinglePartition" not in physical_plan(df.repartitionByRange("k").sortWithinPartitions("k"))
    with open(write_one_file(df.where("false"), os.path.join(tmp_dir, "none.csv"))) as fh:
        assert fh.read() == ""


def test_a_store_that_cannot_join_is_an_error(spark, tmp_dir):
    """The checksummed view of the local disk refuses to join files, as object stores do."""
    spark._jsc.hadoopConfiguration().set("fs.norename.impl", "org.apache.hadoop.fs.LocalFileSystem")
    with pytest.raises(Exception):
        write_one_file(spark.range(10), "norename://" + os.path.join(tmp_dir, "x.csv"))


def test_rejects_are_counted_by_the_query_itself(spark, tmp_dir):
    from files import write_crime_files

    paths = write_crime_files(tmp_dir)
    crimes, seen = read_crimes_observed(spark, paths)
    assert crimes.where(F.col("premis") == "STREET").groupBy("time_occ").count().collect()
    counts = observed_counts(spark, seen)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, crime_rejects(spark, paths).collect()))
    assert counts.columns == crime_rejects(spark, paths).columns


def test_rejects_of_every_source_are_counted_by_its_reader(spark, tmp_dir):
    from files import write_blocks, write_income, write_stations

    from urbanlens.operators.areas import area_ratio, income_lookup
    from urbanlens.sources import city

    blocks, income, stations = write_blocks(tmp_dir), write_income(tmp_dir), write_stations(tmp_dir)
    for split in (False, True):
        rows, in_blocks = city.read_census_blocks_observed(spark, [blocks], split=split)
        incomes, in_income = city.read_income_observed(spark, [income])
        assert area_ratio(rows, income_lookup(incomes, "zip", "income_text")).count() == 6
        for seen, counted in ((in_blocks, city.block_rejects(spark, [blocks])), (in_income, city.income_rejects(spark, [income]))):
            assert list(map(tuple, observed_counts(spark, seen).collect())) == list(map(tuple, counted.collect()))
    sites, in_stations = city.read_stations_observed(spark, stations)
    assert sites.count() == 3
    assert tuple(observed_counts(spark, in_stations).first()) == tuple(city.station_rejects(spark, [stations]).first())


def test_typed_readers_take_folders_with_mixed_headers(spark, tmp_dir):
    from urbanlens.sources.city import read_crimes, read_income

    _write(tmp_dir, a="Zip Code;Name;Estimated Median Income\n1;A;$1\n", b="Estimated Median Income;Zip Code\n$2;2\n")
    rows = read_income(spark, tmp_dir, own_headers=True).collect()
    assert sorted(map(tuple, rows)) == [("1", "$1"), ("2", "$2")]
    crimes = os.path.join(tmp_dir, "crimes")
    os.mkdir(crimes)
    _write(crimes, a="DATE OCC,TIME OCC,Premis Desc,LAT,LON\nd,0100,STREET,1,2\n", b="LON,LAT,TIME OCC,DATE OCC\n4,3,0200,e\n")
    rows = sorted(map(tuple, read_crimes(spark, [crimes], own_headers=True).collect()))
    assert rows == [("d", 100, "STREET", 1.0, 2.0), ("e", 200, None, 3.0, 4.0)]


def test_features_to_parquet_by_many_tasks(spark, tmp_dir):
    from files import write_blocks

    from urbanlens.sources.city import BLOCK_PROPERTIES
    from urbanlens.sources.writers import features_to_parquet

    blocks = write_blocks(tmp_dir)
    out = [sorted(map(str, spark.read.parquet(features_to_parquet(
        spark, blocks, BLOCK_PROPERTIES, os.path.join(tmp_dir, str(split)), split=split)).collect())) for split in (False, True)]
    assert out[0] == out[1] and len(out[0]) == 9
