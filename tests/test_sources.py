import glob
import os

from pyspark.sql import functions as F

from urbanlens.functions.clean import (
    clock_of,
    format_event_time,
    parse_clock,
    parse_event_time,
    parse_money,
    parse_money_whole,
)
from urbanlens.sources.readers import conform, read_delimited, reject_counts, union_sources
from urbanlens.sources.writers import write_result


def test_parsers_return_null_instead_of_failing(spark):
    df = spark.createDataFrame(
        [("0459", "$52,806", "2019 Jan 05 01:30:00 PM"), (" 1200 ", "$52,806.50", "2019 Feb 30 01:00:00 PM"),
         ("12a", "--", "yesterday"), (None, None, None)],
        "clock string, money string, date string")
    rows = df.select(
        parse_clock("clock").alias("c"), parse_money("money").alias("m"),
        parse_money_whole("money").alias("w"), parse_event_time("date").alias("t"),
    ).collect()
    assert [r.c for r in rows] == [459, 1200, None, None]
    assert [r.m for r in rows] == [52806.0, 52806.5, None, None]
    assert [r.w for r in rows] == [52806, None, None, None]
    assert rows[0].t is not None and str(rows[0].t) == "2019-01-05 13:30:00"
    assert [r.t for r in rows[1:]] == [None, None, None]


def test_event_time_text_round_trip(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:07' AS ts, TIMESTAMP '2024-07-09 23:59:59' AS ts2")
    r = df.select(format_event_time("ts").alias("a"), parse_event_time(format_event_time("ts2")).alias("b"),
                  clock_of("ts2").alias("c")).first()
    assert r.a == "2024 Jan 01 12:00:07 AM"
    assert str(r.b) == "2024-07-09 23:59:59" and r.c == 2359


def test_conform_and_reject_counts(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("x", "3"), (None, "y")], "`A B` string, `C` string")
    typed = conform(raw, {"a": ("A B", "int"), "c": ("C", "double")})
    assert [tuple(r) for r in typed.collect()] == [(1, 2.5), (None, 3.0), (None, None)]
    counts = reject_counts(typed, {"bad_a": F.col("a").isNull(), "bad_c": F.col("c").isNull()})
    assert tuple(counts.first()) == (3, 2, 1)


def test_union_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, i int")
    assert sorted(tuple(r) for r in union_sources([a, b]).collect()) == [(1, "x"), (1, "x")]


def test_single_file_headerless_result(spark, tmp_dir):
    df = spark.range(100).select((F.col("id") % 3).alias("k")).groupBy("k").count().repartition(5)
    path = write_result(df, os.path.join(tmp_dir, "out"))
    parts = glob.glob(os.path.join(path, "part-*"))
    assert len(parts) == 1
    with open(parts[0]) as fh:
        lines = fh.read().splitlines()
    assert len(lines) == 3 and not lines[0].startswith("k")
    back = read_delimited(spark, path, header=False, schema="k long, n long")
    assert sorted(tuple(r) for r in back.collect()) == [(0, 34), (1, 33), (2, 33)]


def test_single_file_write_keeps_the_query_parallel(spark):
    """The one-task write is behind an exchange of its own, not on top of the join."""
    from urbanlens.plans.catalog import QUERIES
    from urbanlens.plans.inspect import physical_plan

    out = QUERIES["area_ratio_merge"](spark, "/root/testdata/sf0.001").repartition(1)
    plan = physical_plan(out)
    assert plan.index("Exchange") < plan.index("SortMergeJoin") and "SinglePartition" in plan
    import inspect

    assert "repartition(1)" in inspect.getsource(write_result)


def test_semicolon_scan_is_quote_aware(spark, tmp_dir):
    path = os.path.join(tmp_dir, "q.csv")
    with open(path, "w") as fh:
        fh.write('Zip Code;Name;Income\n90001;"A; B";"$1,000"\n')
    row = read_delimited(spark, path, sep=";").first()
    assert (row["Zip Code"], row["Name"], row["Income"]) == ("90001", "A; B", "$1,000")


def test_crime_rejects_per_source(spark, tmp_dir):
    from files import write_crime_files

    from urbanlens.sources.city import crime_rejects

    a, b = write_crime_files(tmp_dir)
    rows = {r.source: r for r in crime_rejects(spark, [a, b]).collect()}
    assert (rows[a].rows, rows[a].bad_date, rows[a].bad_clock, rows[a].bad_coordinates) == (8, 0, 0, 0)
    # File B: a missing clock is not a bad clock (it is night); one row has no coordinates.
    assert (rows[b].rows, rows[b].bad_date, rows[b].bad_clock, rows[b].bad_coordinates) == (5, 0, 0, 1)


def test_malformed_lines_kept_or_dropped_by_reader_mode(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as fh:
        fh.write("Zip Code;Name;Income\n90001;A;$1,000\n90002\n90003;C;$3\n")
    schema = "zip string, name string, income string"
    kept = read_delimited(spark, path, sep=";", schema=schema).collect()
    dropped = read_delimited(spark, path, sep=";", schema=schema, mode="DROPMALFORMED").collect()
    assert [r.zip for r in kept] == ["90001", "90002", "90003"] and kept[1].income is None
    assert [r.zip for r in dropped] == ["90001", "90003"]


def test_malformed_lines_are_dropped_when_only_some_columns_are_needed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as fh:
        fh.write("90001;A;$1,000\n90002\n90003;C;$3\n")
    df = read_delimited(spark, path, sep=";", header=False, schema="zip string, name string, income string",
                        mode="DROPMALFORMED")
    assert sorted(r.zip for r in df.select("zip").collect()) == ["90001", "90003"]


def test_csv_files_with_reordered_headers_never_mix_columns(spark, tmp_dir):
    from urbanlens.sources.city import income_rejects, read_income

    paths = []
    for name, text in (("a", "Zip Code;Name;Estimated Median Income\n90001;A;$1,000\n"),
                       ("b", "Name;Estimated Median Income;Zip Code\nB;$2.50;90002\nshort\n")):
        paths.append(os.path.join(tmp_dir, f"{name}.csv"))
        with open(paths[-1], "w") as fh:
            fh.write(text)
    rows = sorted(map(tuple, read_income(spark, paths).collect()), key=repr)
    assert rows == [("90001", "$1,000"), ("90002", "$2.50"), (None, None)]
    rejects = {r.source: tuple(r)[1:] for r in income_rejects(spark, paths).collect()}
    assert rejects == {paths[0]: (1, 0, 0, 0), paths[1]: (2, 1, 0, 1)}


def test_unreadable_documents_fail_or_are_counted(spark, tmp_dir):
    import pytest
    from files import write_blocks

    from urbanlens.sources.city import BLOCK_PROPERTIES, block_rejects, read_census_blocks
    from urbanlens.sources.readers import flatten_features, read_features, unreadable_documents

    whole = write_blocks(tmp_dir)
    cut = os.path.join(tmp_dir, "cut.geojson")
    with open(whole) as fh:
        text = fh.read()
    with open(cut, "w") as fh:
        fh.write(text[:len(text) // 2])
    with pytest.raises(Exception):
        read_census_blocks(spark, [whole, cut]).collect()
    kept = read_features(spark, [whole, cut], BLOCK_PROPERTIES, mode="PERMISSIVE")
    assert kept.count() == 9
    bad = {os.path.basename(r.source): r.unreadable
           for r in unreadable_documents(spark, [whole, cut], BLOCK_PROPERTIES).collect()}
    assert bad == {"blocks.geojson": 0, "cut.geojson": 1}
    # The property set can be found instead of declared.
    found = flatten_features(read_features(spark, whole, None))
    assert set(found.columns) == {"ZCTA20", "POP20", "HOUSING20", "COUNTY"}
    assert block_rejects(spark, [whole]).first()["no_key"] == 1


def test_number_properties_of_any_type_are_read(spark, tmp_dir):
    import json

    from urbanlens.sources.city import block_rejects, read_census_blocks

    values = [(4, 1), (4.0, "2"), ("7", 3.5), ("x", None), (None, 1)]
    features = [{"type": "Feature", "properties": {"ZCTA20": "1", "POP20": p, "HOUSING20": h}} for p, h in values]
    doc = os.path.join(tmp_dir, "d.geojson")
    with open(doc, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": features}, fh)
    lines = os.path.join(tmp_dir, "l.geojsonl")
    with open(lines, "w") as fh:
        fh.write("\n".join(map(json.dumps, features)))
    for path, as_lines in ((doc, False), (lines, True)):
        rows = [(None if r.population is None else float(r.population),
                 None if r.housing is None else float(r.housing))
                for r in read_census_blocks(spark, path, lines=as_lines).collect()]
        assert sorted(rows, key=repr) == sorted([(4, 1), (4, 2), (7, 3.5), (None, None), (None, 1)], key=repr)
        counts = block_rejects(spark, [path], lines=as_lines).first()
        assert (counts.rows, counts.no_key, counts.bad_population, counts.bad_housing) == (5, 0, 1, 0)


def test_feature_lines_round_trip_and_split(spark, tmp_dir):
    from pyspark.sql import types as T

    from urbanlens.sources.readers import read_feature_lines
    from urbanlens.sources.writers import as_features, write_feature_lines

    df = spark.range(2000).select(F.col("id").alias("k")).coalesce(1)
    path = write_feature_lines(as_features(df, ["k"]), os.path.join(tmp_dir, "lines"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        back = read_feature_lines(spark, path, T.StructType([T.StructField("k", T.LongType())]))
        assert back.rdd.getNumPartitions() > 1      # one file, many tasks
        assert sorted(r.k for r in back.select("properties.k").collect()) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
