"""Query catalogue: every question and variant as ``(spark, sf_dir) -> DataFrame``.

Each function reads whole driver tables (see ``inputs``) and returns a lazy
DataFrame; the caller runs the one action.  Queries that exercise a file
format first write their input under a new folder of the shared checkpoint
location and then scan it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.functions.clean import clock_of, format_event_time, parse_event_time, parse_money, round_to
from urbanlens.operators.areas import area_ratio, income_lookup
from urbanlens.operators.nearest import nearest_site, nearest_site_summary, point_rejects
from urbanlens.operators.ranking import monthly_top_k, monthly_top_k_sql
from urbanlens.operators.shares import time_of_day_share
from urbanlens.plans import inputs
from urbanlens.session import scratch_path, written
from urbanlens.sources.city import (
    CRIME_COLUMNS,
    block_rejects,
    crime_rejects,
    income_rejects,
    observed_counts,
    read_census_blocks,
    read_census_blocks_observed,
    read_crimes,
    read_crimes_observed,
    read_income,
    read_income_observed,
    read_stations,
    read_stations_observed,
    station_rejects,
)
from urbanlens.sources.feature_scan import read_features_split
from urbanlens.sources.lines import quarantined, read_mixed_headers, with_file_order
from urbanlens.sources.readers import (
    flatten_features,
    read_delimited,
    read_features,
    read_parquet,
    union_sources,
)
from urbanlens.sources.writers import (
    as_features,
    csv_to_parquet,
    feature_collections,
    write_feature_collections,
    write_feature_lines,
    write_one_collection,
    write_one_file,
    write_result,
)

Query = Callable[[SparkSession, str], DataFrame]


# --- Q1: share per part of day ------------------------------------------------------

def time_of_day_share_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_of_day_share(inputs.error_events(spark, sf_dir), "clock")


def time_of_day_share_half_even_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_of_day_share(inputs.error_events(spark, sf_dir), "clock", rounding="half_even")


def time_of_day_share_udf_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_of_day_share(inputs.error_events(spark, sf_dir), "clock", method="udf")


def time_of_day_share_two_sources_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with different column orders, combined by name."""
    ev = inputs.table(spark, sf_dir, "events")
    first, second = inputs.split_sources(ev, "ts", inputs.EVENTS_SPLIT)
    first = first.select("event_id", "ts", "event_type", "user_id")
    second = second.select("event_type", "user_id", "ts", "event_id")
    both = union_sources([first, second])
    errors = both.where(F.col("event_type") == "error").select(clock_of("ts").alias("clock"))
    return time_of_day_share(errors, "clock")


# --- sources and sinks --------------------------------------------------------------

def csv_parquet_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> CSV with header -> Parquet (all strings) -> rows per event type."""
    base = scratch_path(spark, "csv_parquet")
    csv_dir = f"{base}/csv/events"
    _write_csv(inputs.table(spark, sf_dir, "events"), csv_dir)
    written = csv_to_parquet(spark, {"events": csv_dir}, f"{base}/parquet")
    ev = read_parquet(spark, written["events"])
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def event_time_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as 'yyyy MMM dd hh:mm:ss a' text and parsed back."""
    ev = inputs.table(spark, sf_dir, "events")
    t = parse_event_time(format_event_time("ts"))
    return (
        ev.select(t.alias("t")).where(F.col("t").isNotNull())
        .groupBy(F.year("t").alias("year"), F.month("t").alias("month"), F.hour("t").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _income_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "income_csv")
    (inputs.income_text(spark, sf_dir)
     .select(F.col("zip").alias("Zip Code"), F.col("name").alias("Name"),
             F.col("income_text").alias("Estimated Median Income"))
     .write.mode("overwrite").option("header", True).option("sep", ";").csv(path))
    return path


def semicolon_csv_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """';'-separated income text with header, scanned back and parsed."""
    raw = read_delimited(spark, _income_csv(spark, sf_dir), sep=";")
    income = income_lookup(raw, "Zip Code", "Estimated Median Income")
    return income.select(F.col("zip").cast("bigint").alias("s_suppkey"), "income")


CUSTOMER_PROPERTIES = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
])


def multiline_json_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as GeoJSON FeatureCollection files, scanned back multi-line.

    The read schema omits the geometry, so the scan never materialises it.
    """
    pts = inputs.points(spark, sf_dir, extra=("c_name", "c_nationkey"))
    path = scratch_path(spark, "features")
    write_feature_collections(
        as_features(pts, ["c_custkey", "c_name", "c_nationkey"], lon="lon", lat="lat"), path)
    return flatten_features(read_features(spark, path, CUSTOMER_PROPERTIES))


def single_file_csv_sink_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event type written as one headerless CSV file, read back."""
    counts = inputs.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"))
    path = write_result(counts, scratch_path(spark, "result_csv"))
    return read_delimited(spark, path, header=False, schema="event_type STRING, n BIGINT")


# --- Q2: busiest months --------------------------------------------------------------

def monthly_top3_rank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_top_k([inputs.table(spark, sf_dir, "orders")], "o_orderdate", k=3, ties="rank")


def monthly_top3_row_number_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_top_k([inputs.table(spark, sf_dir, "orders")], "o_orderdate", k=3,
                         ties="row_number")


def _order_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderdate")
    return inputs.split_sources(orders, "o_orderdate", inputs.ORDERS_SPLIT)


def monthly_top3_per_source_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-source counts combined with UNION ALL, ranked in SQL over temp views."""
    first, second = _order_sources(spark, sf_dir)
    return monthly_top_k_sql(spark, {"orders_a": first, "orders_b": second}, "o_orderdate", k=3)


def monthly_top3_per_source_df_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per-source question in the DataFrame API."""
    first, second = _order_sources(spark, sf_dir)
    return monthly_top_k([first, second], "o_orderdate", k=3, ties="row_number", combine=False)


# --- Q3: ratio per area ---------------------------------------------------------------

def feature_flatten_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as nested FeatureCollections, exploded and flattened in memory."""
    sup = inputs.sites(spark, sf_dir, extra=("s_suppkey", "s_name", "s_nationkey"))
    docs = feature_collections(
        as_features(sup, ["s_suppkey", "s_name", "s_nationkey"], lon="lon", lat="lat"))
    flat = flatten_features(docs.selectExpr("explode(features) AS feature").select("feature.*"))
    return flat.select(
        "s_suppkey", "s_name", "s_nationkey",
        F.col("geometry.coordinates")[0].alias("lon"),
        F.col("geometry.coordinates")[1].alias("lat"),
    )


def money_clean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.income_text(spark, sf_dir)
    return raw.select(F.col("zip").cast("bigint").alias("s_suppkey"),
                      parse_money("income_text").alias("income"))


def _area_ratio(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return area_ratio(inputs.blocks(spark, sf_dir),
                      income_lookup(inputs.income_rows(spark, sf_dir), "zip", "income_text",
                                    strict=kw.get("strict", False)),
                      **kw)


def area_ratio_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir)


def area_ratio_broadcast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir, join_strategy="broadcast")


def area_ratio_merge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir, join_strategy="merge")


def area_ratio_shuffle_hash_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir, join_strategy="shuffle_hash")


def area_ratio_strict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir, strict=True)


# --- Q4: nearest site ----------------------------------------------------------------

def _assign(spark: SparkSession, sf_dir: str, strategy: str, digits: int | None) -> DataFrame:
    return nearest_site(inputs.points(spark, sf_dir), inputs.sites(spark, sf_dir),
                        strategy=strategy, digits=digits)


def nearest_site_assign_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assign(spark, sf_dir, "auto", 6).select("c_custkey", "division", "distance")


def nearest_site_assign_grid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assign(spark, sf_dir, "grid", 6).select("c_custkey", "division", "distance")


def nearest_site_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text coordinates, some of them null, words or NaN: what the search keeps and leaves out."""
    pts = inputs.text_points(spark, sf_dir)
    counts = point_rejects(pts).select(F.explode(F.create_map(
        F.lit("rows"), "rows", F.lit("bad_coordinates"), "bad_coordinates")).alias("what", "n"))
    kept = nearest_site(pts, inputs.sites(spark, sf_dir))
    return counts.unionByName(kept.agg(F.lit("assigned").alias("what"), F.count("division").alias("n")))


def nearest_site_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_site_summary(_assign(spark, sf_dir, "auto", None))


# --- the original file formats end to end --------------------------------------------

def _write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def _crime_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Events as two crime CSV files (text columns, second file reordered)."""
    ev = inputs.table(spark, sf_dir, "events").select(
        format_event_time("ts").alias("DATE OCC"),
        F.date_format("ts", "HHmm").alias("TIME OCC"),
        F.col("event_type").alias("Premis Desc"),
        "ts",
    )
    first, second = inputs.split_sources(ev, "ts", inputs.EVENTS_SPLIT)
    base = scratch_path(spark, "crimes_csv")
    return [
        _write_csv(first.select("DATE OCC", "TIME OCC", "Premis Desc"), f"{base}/part1"),
        _write_csv(second.select("Premis Desc", "TIME OCC", "DATE OCC"), f"{base}/part2"),
    ]


def time_of_day_share_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crime CSV text: HHMM clock text cast to int, filtered on the premise text."""
    cols = {k: CRIME_COLUMNS[k] for k in ("time_occ", "premis")}
    crimes = read_crimes(spark, _crime_files(spark, sf_dir), columns=cols)
    return time_of_day_share(crimes.where(F.col("premis") == "error"), "time_occ")


def monthly_top3_rank_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busiest months from 'yyyy MMM dd hh:mm:ss a' date text in a CSV file."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        format_event_time("o_orderdate").alias("DATE OCC"))
    path = _write_csv(orders, scratch_path(spark, "dates_csv"))
    crimes = read_crimes(spark, [path], columns={"date_occ": CRIME_COLUMNS["date_occ"]})
    return monthly_top_k([crimes.select(parse_event_time("date_occ").alias("t"))], "t", k=3)


def _block_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = inputs.blocks(spark, sf_dir).select(
        F.col("zip").alias("ZCTA20"), F.col("population").alias("POP20"),
        F.col("housing").alias("HOUSING20"))
    return as_features(blocks, ["ZCTA20", "POP20", "HOUSING20"])


def _income_file(spark: SparkSession, sf_dir: str) -> str:
    """All incomes as a ';' file with header."""
    return _write_csv(inputs.income_rows(spark, sf_dir).select(
        F.col("zip").alias("Zip Code"), F.col("name").alias("Name"),
        F.col("income_text").alias("Estimated Median Income")), scratch_path(spark, "income_rows"), sep=";")


def area_ratio_geojson_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as GeoJSON FeatureCollection files, income as a ';' file."""
    path = write_feature_collections(_block_features(spark, sf_dir), scratch_path(spark, "blocks_geojson"))
    income = read_income(spark, _income_file(spark, sf_dir))
    return area_ratio(read_census_blocks(spark, path), income_lookup(income, "zip", "income_text"))


def area_ratio_feature_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks as GeoJSON features, one per line (splittable), income as a ';' file."""
    path = write_feature_lines(_block_features(spark, sf_dir), scratch_path(spark, "blocks_lines"))
    income = read_income(spark, _income_file(spark, sf_dir))
    return area_ratio(read_census_blocks(spark, path, lines=True), income_lookup(income, "zip", "income_text"))


def _rough_income_lines(spark: SparkSession, sf_dir: str) -> str:
    """Income text as it comes: blanks around keys, cents (every 7th), words, and short lines (every 9th)."""
    key = F.col("zip").cast("long")
    rows = inputs.income_rows(spark, sf_dir)
    text = F.when(key % 7 == 0, F.concat("income_text", F.lit(".50"))).otherwise(F.col("income_text"))
    line = F.when(key % 9 == 0, F.col("zip")).otherwise(
        F.concat_ws(";", F.concat(F.lit("  "), "zip", F.lit(" ")), "name", text))
    path = scratch_path(spark, "income_lines")
    rows.select(line.alias("value")).write.text(path)
    return path


def area_ratio_strict_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict ratio over a rough ';' file: malformed lines dropped, whole incomes only, keys trimmed."""
    raw = read_delimited(spark, _rough_income_lines(spark, sf_dir), sep=";", header=False,
                         schema="zip string, name string, income_text string", mode="DROPMALFORMED")
    return area_ratio(inputs.blocks(spark, sf_dir), income_lookup(raw, "zip", "income_text", strict=True), strict=True)


def time_of_day_share_parquet_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crime files converted to (all-text) Parquet, then the share over the copies."""
    files = _crime_files(spark, sf_dir)
    copies = csv_to_parquet(spark, {f"part{i}": f for i, f in enumerate(files)}, scratch_path(spark, "crimes_parquet"))
    cols = {k: CRIME_COLUMNS[k] for k in ("time_occ", "premis")}
    crimes = read_crimes(spark, list(copies.values()), fmt="parquet", columns=cols)
    return time_of_day_share(crimes.where(F.col("premis") == "error"), "time_occ")


def _rough_crimes(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Events as a crime file with a fault in each row, by its number."""
    ev = inputs.table(spark, sf_dir, "events")
    odd = F.col("event_id") % 5
    return _write_csv(ev.select(
        F.when(odd == 0, F.lit("2019 Feb 30 01:00:00 PM")).otherwise(format_event_time("ts")).alias("DATE OCC"),
        F.when(odd == 1, F.lit("noon")).when(odd == 2, F.lit(None)).otherwise(F.date_format("ts", "HHmm")).alias("TIME OCC"),
        F.col("event_type").alias("Premis Desc"),
        F.when(odd == 3, F.lit("NaN")).otherwise(F.lit("34.1")).alias("LAT"),
        F.when(odd == 4, F.lit("west")).otherwise(F.lit("95")).alias("LON")), path)


def _by_name(counts: DataFrame, source: str) -> DataFrame:
    """One row of counts as (source, what, n) rows."""
    return counts.select(F.lit(source).alias("source"), F.explode(F.create_map(*[
        x for c in counts.columns if c != "source" for x in (F.lit(c), F.col(c).cast("long"))])).alias("what", "n"))


def _rough_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A file of every kind, each with faults planted in known rows."""
    base = scratch_path(spark, "rough")
    line = F.col("l_linenumber")
    rough = inputs.table(spark, sf_dir, "lineitem").select(
        F.when(line != 1, F.col("l_suppkey").cast("string")).alias("ZCTA20"),
        F.when(line == 2, F.lit("many")).when(line != 3, F.col("l_quantity").cast("string")).alias("POP20"),
        F.when(line == 4, F.lit("4.0")).when(line == 5, F.lit("-")).otherwise(F.lit("7")).alias("HOUSING20"))
    return {
        "crimes": _rough_crimes(spark, sf_dir, f"{base}/crimes"),
        "blocks": write_feature_lines(as_features(rough, ["ZCTA20", "POP20", "HOUSING20"]), f"{base}/blocks"),
        "income": _write_csv(inputs.income_text(spark, sf_dir).select(
            F.col("zip").alias("Zip Code"), F.col("name").alias("Name"),
            F.when(F.col("zip").cast("long") % 7 == 0, F.concat("income_text", F.lit(".50")))
            .otherwise(F.col("income_text")).alias("Estimated Median Income")), f"{base}/income", sep=";"),
        "stations": _write_csv(inputs.sites(spark, sf_dir).select(
            F.when(F.col("ord") % 3 == 0, F.lit("?")).otherwise(F.col("lon").cast("string")).alias("X"),
            F.col("lat").cast("string").alias("Y"), F.col("division").alias("DIVISION")), f"{base}/stations"),
    }


def source_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects of every source: (source, what, n)."""
    files = _rough_files(spark, sf_dir)
    return union_sources([
        _by_name(crime_rejects(spark, [files["crimes"]]), "crimes"),
        _by_name(block_rejects(spark, [files["blocks"]], lines=True), "blocks"),
        _by_name(income_rejects(spark, [files["income"]]), "income"),
        _by_name(station_rejects(spark, [files["stations"]]), "stations")])


def observed_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts made by the scans of the questions themselves, and the share that one of them gives."""
    files = _rough_files(spark, sf_dir)
    crimes, in_crimes = read_crimes_observed(spark, [files["crimes"]])
    shares = written(time_of_day_share(crimes.where(F.col("premis") == "error"), "time_occ"), "observed-shares")
    blocks, in_blocks = read_census_blocks_observed(spark, [files["blocks"]], lines=True)
    income, in_income = read_income_observed(spark, [files["income"]])
    written(area_ratio(blocks, income_lookup(income, "zip", "income_text")), "observed-ratios")
    stations, in_stations = read_stations_observed(spark, files["stations"])
    written(stations, "observed-stations")
    share = shares.select(F.lit("share").alias("source"), F.col("period").alias("what"),
                          F.round(F.col("percentage") * 100).cast("long").alias("n"))
    seen = {"crimes": in_crimes, "blocks": in_blocks, "income": in_income, "stations": in_stations}
    return union_sources([_by_name(observed_counts(spark, s), name) for name, s in seen.items()] + [share])


def geojson_split_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as one GeoJSON document, written by all tasks and read by several."""
    pts = inputs.points(spark, sf_dir, extra=("c_name", "c_nationkey"))
    # Names with the characters that a scan of JSON text can stumble over.
    named = pts.withColumn("c_name", F.concat("c_name", F.lit('}"{[\\')))
    features = as_features(named, ["c_custkey", "c_name", "c_nationkey"], lon="lon", lat="lat")
    keyed = features.select(F.col("feature.properties.c_custkey").alias("key"), "feature")
    path = write_one_collection(keyed, "key", scratch_path(spark, "collection") + ".geojson")
    return flatten_features(read_features_split(spark, path, CUSTOMER_PROPERTIES, split_bytes=128 << 10))


def area_ratio_geojson_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks as one GeoJSON document read by many tasks, income files of one folder under headers of their own."""
    features = _block_features(spark, sf_dir).withColumn("key", F.monotonically_increasing_id())
    path = write_one_collection(written(features, "keyed-blocks"), "key", scratch_path(spark, "blocks") + ".geojson")
    rows = inputs.income_rows(spark, sf_dir).select(
        F.col("zip").alias("Zip Code"), F.col("name").alias("Name"), F.col("income_text").alias("Estimated Median Income"))
    folder = scratch_path(spark, "income_folder")
    even = F.col("Zip Code").cast("long") % 2 == 0
    for part, columns in ((rows.where(even), rows.columns), (rows.where(~even), rows.columns[::-1])):
        part.select(*columns).write.mode("append").option("header", True).option("sep", ";").csv(folder)
    income = read_income(spark, folder, own_headers=True)
    return area_ratio(read_census_blocks(spark, path, split=True), income_lookup(income, "zip", "income_text"))


def mixed_headers_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of income files whose headers differ in order and lack columns."""
    rows = inputs.income_text(spark, sf_dir).select(
        F.col("zip").alias("Zip Code"), F.col("name").alias("Name"), F.col("income_text").alias("Estimated Median Income"))
    path = scratch_path(spark, "mixed_headers")
    third = F.col("Zip Code").cast("long") % 3
    for i, columns in enumerate((["Zip Code", "Name", "Estimated Median Income"],
                                 ["Estimated Median Income", "Zip Code", "Name"], ["Name", "Zip Code"])):
        rows.where(third == i).select(*columns).write.mode("append").option("header", True).option("sep", ";").csv(path)
    raw = read_mixed_headers(spark, path, sep=";")
    return raw.select(F.col("Zip Code").cast("long").alias("s_suppkey"), F.col("Name").alias("s_name"),
                      parse_money("Estimated Median Income").alias("income"))


def _quarantine(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quarantined(spark, _rough_income_lines(spark, sf_dir), "zip string, name string, income_text string", sep=";")


def quarantine_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict ratio over the rough ';' file, its malformed lines put aside."""
    rows, _ = _quarantine(spark, sf_dir)
    return area_ratio(inputs.blocks(spark, sf_dir), income_lookup(rows, "zip", "income_text", strict=True), strict=True)


def quarantine_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines of the rough ';' file, with the reason."""
    return _quarantine(spark, sf_dir)[1].select("line", "reason")


def nearest_site_file_order_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with equal places, in a file of descending keys split over several parts: the first in the file wins."""
    places = inputs.sites(spark, sf_dir)
    stations = places.orderBy(F.col("ord").desc()).select(
        (F.floor(F.col("lon") * 10) / 10).cast("string").alias("X"),
        (F.floor(F.col("lat") * 10) / 10).cast("string").alias("Y"), F.col("division").alias("DIVISION"))
    path = _write_csv(stations, scratch_path(spark, "stations_in_order"))
    found = nearest_site(inputs.points(spark, sf_dir), read_stations(spark, path), digits=6)
    return found.select("c_custkey", "division", "distance")


def binary_rounding_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near ties of every line (three decimals, the last one 5), rounded by their binary value."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    x = F.col("l_partkey").cast("double") + (F.col("l_orderkey") % 100).cast("double") / 100.0 + 0.005
    return lines.select("l_orderkey", "l_linenumber", round_to(x, 2, "binary").alias("cents"),
                        round_to(x * 1.1, 1, "binary").alias("tenths"))


def area_ratio_binary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _area_ratio(spark, sf_dir, strict=True, rounding="binary")


def nearest_site_exact_mean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean distances by exact sums, to the millimetre."""
    return nearest_site_summary(_assign(spark, sf_dir, "auto", None), digits=6)


def ordered_single_file_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in descending order as one file written by all tasks; each with its line number."""
    rows = inputs.table(spark, sf_dir, "customer").select((-F.col("c_custkey")).alias("key"), "c_name")
    path = write_one_file(rows, scratch_path(spark, "one_file") + ".csv", order_by=["key"])
    back = with_file_order(read_delimited(spark, path, header=False, schema="key BIGINT, c_name STRING"), "line")
    return back.select((-F.col("key")).alias("c_custkey"), "c_name", "line")


def nearest_site_summary_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crime coordinates and stations as CSV text, then per-station summary."""
    base = scratch_path(spark, "nearest_csv")
    pts = inputs.points(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.col("lat").cast("string").alias("LAT"), F.col("lon").cast("string").alias("LON"))
    stations = inputs.sites(spark, sf_dir).select(
        F.col("lon").cast("string").alias("X"), F.col("lat").cast("string").alias("Y"),
        F.col("division").alias("DIVISION"), F.col("ord").cast("string").alias("PREC"))
    crimes = read_crimes(spark, [_write_csv(pts, f"{base}/crimes")], columns={
        "id": ("ID", "bigint"), "lat": CRIME_COLUMNS["lat"], "lon": CRIME_COLUMNS["lon"]})
    sites = read_stations(spark, _write_csv(stations, f"{base}/stations"), order_col="PREC")
    return nearest_site_summary(nearest_site(crimes, sites))


QUERIES: dict[str, Query] = {
    "time_of_day_share": time_of_day_share_q,
    "time_of_day_share_half_even": time_of_day_share_half_even_q,
    "time_of_day_share_udf": time_of_day_share_udf_q,
    "time_of_day_share_two_sources": time_of_day_share_two_sources_q,
    "time_of_day_share_csv": time_of_day_share_csv_q,
    "time_of_day_share_parquet": time_of_day_share_parquet_q,
    "csv_parquet_roundtrip": csv_parquet_roundtrip_q,
    "event_time_parse": event_time_parse_q,
    "semicolon_csv_scan": semicolon_csv_scan_q,
    "multiline_json_scan": multiline_json_scan_q,
    "single_file_csv_sink": single_file_csv_sink_q,
    "monthly_top3_rank": monthly_top3_rank_q,
    "monthly_top3_row_number": monthly_top3_row_number_q,
    "monthly_top3_rank_text": monthly_top3_rank_text_q,
    "monthly_top3_per_source": monthly_top3_per_source_q,
    "monthly_top3_per_source_df": monthly_top3_per_source_df_q,
    "feature_flatten": feature_flatten_q,
    "money_clean": money_clean_q,
    "area_ratio": area_ratio_q,
    "area_ratio_broadcast": area_ratio_broadcast_q,
    "area_ratio_merge": area_ratio_merge_q,
    "area_ratio_shuffle_hash": area_ratio_shuffle_hash_q,
    "area_ratio_strict": area_ratio_strict_q,
    "area_ratio_geojson": area_ratio_geojson_q,
    "area_ratio_feature_lines": area_ratio_feature_lines_q,
    "area_ratio_strict_csv": area_ratio_strict_csv_q,
    "source_rejects": source_rejects_q,
    "nearest_site_assign": nearest_site_assign_q,
    "nearest_site_assign_grid": nearest_site_assign_grid_q,
    "nearest_site_rejects": nearest_site_rejects_q,
    "nearest_site_summary": nearest_site_summary_q,
    "nearest_site_summary_csv": nearest_site_summary_csv_q,
    "geojson_split_scan": geojson_split_scan_q,
    "area_ratio_geojson_split": area_ratio_geojson_split_q,
    "mixed_headers_scan": mixed_headers_scan_q,
    "quarantine_rows": quarantine_rows_q,
    "quarantine_lines": quarantine_lines_q,
    "nearest_site_file_order": nearest_site_file_order_q,
    "binary_rounding": binary_rounding_q,
    "area_ratio_binary": area_ratio_binary_q,
    "nearest_site_exact_mean": nearest_site_exact_mean_q,
    "observed_rejects": observed_rejects_q,
    "ordered_single_file": ordered_single_file_q,
}
