import math
import random

import pytest
from fixtures import Q4_EXPECTED
from files import write_crime_files, write_stations

from urbanlens.functions.geo import haversine_km
from urbanlens.operators.nearest import nearest_site, nearest_site_summary, point_rejects
from urbanlens.sources.city import read_crimes, read_stations


def _summary(df):
    return {r.division: (r.avg_distance, r.crime_total) for r in nearest_site_summary(df).collect()}


@pytest.mark.parametrize("strategy", ["array", "grid"])
def test_fixture_summary(spark, tmp_dir, strategy):
    crimes = read_crimes(spark, write_crime_files(tmp_dir))
    stations = read_stations(spark, write_stations(tmp_dir), order_col="PREC")
    out = nearest_site(crimes, stations, strategy=strategy)
    assert _summary(out) == Q4_EXPECTED  # TWIN ties CENTRAL and loses on order
    assert point_rejects(crimes).first().bad_coordinates == 1


def test_station_order_defaults_to_file_order(spark, tmp_dir):
    stations = read_stations(spark, write_stations(tmp_dir))
    assert [r.division for r in stations.orderBy("ord").collect()] == ["CENTRAL", "TWIN", "VALLEY"]


def test_no_sites_gives_nulls(spark):
    pts = spark.createDataFrame([(1, 34.0, -118.0)], "id long, lat double, lon double")
    empty = spark.createDataFrame([], "ord long, division string, lat double, lon double")
    for strategy in ("array", "grid"):
        row = nearest_site(pts, empty, strategy=strategy).first()
        assert row.division is None and row.distance is None


def _haversine(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_points_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    # Clustered sites on a coarse lattice (exact distance ties), a few far away,
    # repeated locations, and points spread from the cluster to the antipode.
    sites = [(i, f"s{i}", round(34 + rnd.randint(0, 40) * 0.01, 4), round(-118 + rnd.randint(0, 40) * 0.01, 4))
             for i in range(60)]
    sites += [(60, "far1", -33.9, 151.2), (61, "far2", 51.5, -0.1), (62, "dup", sites[0][2], sites[0][3])]
    pts = [(j, round(34 + rnd.uniform(-0.5, 0.9), 4), round(-118 + rnd.uniform(-0.5, 0.9), 4))
           for j in range(300)]
    pts += [(1000 + j, rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for j in range(40)]
    pts += [(2000, -34.05, 61.75), (2001, 34.2, -118.2)]
    sdf = spark.createDataFrame(sites, "ord long, division string, lat double, lon double")
    pdf = spark.createDataFrame(pts, "id long, lat double, lon double")
    want = {}
    for pid, la, lo in pts:
        want[pid] = min((_haversine(la, lo, s[2], s[3]), s[0], s[1]) for s in sites)
    for strategy, kw in (("array", {}), ("grid", {}), ("grid", {"tile_sites": 5})):
        got = {r.id: (r.distance, r.division) for r in
               nearest_site(pdf, sdf, strategy=strategy, **kw).collect()}
        assert set(got) == set(want)
        for pid, (dist, _, division) in want.items():
            assert got[pid][1] == division, (strategy, pid)
            assert got[pid][0] == pytest.approx(dist, rel=1e-12, abs=1e-9)


def test_haversine_expression_matches_python(spark):
    df = spark.createDataFrame([(34.05, -118.25, 34.2, -118.45), (0.0, 0.0, 0.0, 180.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(_haversine(34.05, -118.25, 34.2, -118.45), rel=1e-14)
    assert got[1] == pytest.approx(math.pi * 6371.0, rel=1e-14)


@pytest.mark.parametrize("strategy", ["array", "grid"])
def test_text_coordinates_with_junk_are_rejected_not_fatal(spark, strategy):
    pts = spark.createDataFrame([(1, "34.05", "-118.25"), (2, "n/a", "-118.2"), (3, None, "1"),
                                 (4, "NaN", "0"), (6, "95.0", "-118"), (7, "-Infinity", "3"), (5, "34.2", "-118.45")], "id long, lat string, lon string")
    sites = spark.createDataFrame([("0", "A", "34.05", "-118.25"), ("x", "B", "oops", "1"),
                                   ("2", "C", "34.2", "-118.45")], "ord string, division string, lat string, lon string")
    got = {r.id: r.division for r in nearest_site(pts, sites, strategy=strategy).collect()}
    assert set(got) == {1, 5, 6} and (got[1], got[5]) == ("A", "C")
    assert point_rejects(pts).first().bad_coordinates == 4
    inside = nearest_site(pts, sites, strategy=strategy, box=(33, 35, -119, -117))
    assert sorted(r.id for r in inside.collect()) == [1, 5]
    assert point_rejects(pts, box=(33, 35, -119, -117)).first().bad_coordinates == 5


@pytest.mark.parametrize("strategy", ["array", "grid"])
def test_site_without_order_loses_ties(spark, strategy):
    pts = spark.createDataFrame([(1, 34.05, -118.25)], "id long, lat double, lon double")
    sites = spark.createDataFrame([(None, "NO_ORDER", 34.06, -118.25), (9, "NINE", 34.06, -118.25)],
                                  "ord long, division string, lat double, lon double")
    row = nearest_site(pts, sites, strategy=strategy).first()
    assert row.division == "NINE"  # same place, an exact tie: the ordered site wins


def test_auto_chooses_the_plan_from_the_site_bound(spark):
    # 12 site rows at 4 locations: over a bound of 5 as listed but within it
    # once repeated locations are folded (array plan); over a bound of 3 even
    # then, so the grid plan answers from the folded list.
    from urbanlens.plans.inspect import physical_plan

    locs = [(34.0, -118.0), (34.1, -118.1), (34.2, -118.3), (35.0, -117.0)]
    sites = [(i, f"s{i}", *locs[i % 4]) for i in range(12)]
    pts = [(j, 34 + j * 0.013, -118 - j * 0.007) for j in range(60)]
    sdf = spark.createDataFrame(sites, "ord long, division string, lat double, lon double")
    pdf = spark.createDataFrame(pts, "id long, lat double, lon double")
    want = {pid: min((_haversine(la, lo, s[2], s[3]), s[0], s[1]) for s in sites) for pid, la, lo in pts}
    for bound, array_plan in ((20, True), (5, True), (3, False)):
        out = nearest_site(pdf, sdf, strategy="auto", max_array_sites=bound)
        assert ("Join" not in physical_plan(out)) == array_plan, bound
        got = {r.id: (r.distance, r.division) for r in out.collect()}
        assert set(got) == set(want)
        for pid, (dist, _, division) in want.items():
            assert got[pid][1] == division, (bound, pid)
            assert got[pid][0] == pytest.approx(dist, rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("bound", [2, 5, 100])
def test_plans_agree_on_ids_types_and_ties(spark, bound):
    """Duplicate and null ids, null and equal orders, text coordinates: same rows and types everywhere."""
    pts = spark.createDataFrame(
        [(1, "34.05", "-118.25"), (1, "34.05", "-118.25"), (None, "34.06", "-118.25"), (None, "34.20", "-118.40"),
         (2, "95", "-118.3"), (3, None, "1"), (4, "34.05", "-118.2499")], "id long, lat string, lon string")
    sites = spark.createDataFrame(
        [(5, "B", 34.05, -118.25), (5, "A", 34.05, -118.25), (None, "N", 34.2, -118.4), (None, None, 34.2, -118.4),
         (7, "D", 34.05, -118.2498), (7, "C", 34.05, -118.2498), (9, "far", 10.0, 10.0)],
        "ord long, division string, lat double, lon double")
    want = nearest_site(pts, sites, strategy="array")
    rows = sorted(map(tuple, want.collect()), key=repr)
    assert len(rows) == 6 and [r[3] for r in rows if r[0] == 1] == ["A", "A"]
    assert [r[3] for r in rows if r[1] == "34.20"] == [None]
    for out in (nearest_site(pts, sites, strategy="grid"), nearest_site(pts, sites, max_array_sites=bound),
                nearest_site(pts, sites, strategy="grid", tile_sites=1),
                nearest_site(pts, sites, strategy="array", max_array_sites=bound)):
        assert out.dtypes == want.dtypes and out.columns == ["id", "lat", "lon", "division", "distance"]
        assert sorted(map(tuple, out.collect()), key=repr) == rows


def test_byte_bound_sends_the_search_to_the_grid(spark, monkeypatch):
    import urbanlens.operators.nearest as nearest
    from urbanlens.plans.inspect import physical_plan

    pts = spark.createDataFrame([(1, 34.0, -118.0)], "id long, lat double, lon double")
    sites = spark.createDataFrame([(0, "d" * 1000, 34.0, -118.0), (1, "e" * 1000, 35.0, -118.0)],
                                  "ord long, division string, lat double, lon double")
    assert "Join" not in physical_plan(nearest_site(pts, sites))
    monkeypatch.setattr(nearest, "MAX_ARRAY_BYTES", 1500)
    out = nearest_site(pts, sites)
    assert "Join" in physical_plan(out) and out.first().division == "d" * 1000


def test_dense_cluster_and_hot_points(spark, monkeypatch):
    """Sites 10,000 times denser in one place, and a third of the points on one spot."""
    import urbanlens.operators.nearest as nearest

    monkeypatch.setattr(nearest, "PART_POINTS", 100)
    rnd = random.Random(7)
    sites = [(i, f"c{i}", 34.05 + rnd.randint(0, 900) * 1e-6, -118.25 + rnd.randint(0, 900) * 1e-6) for i in range(900)]
    sites += [(1000 + i, f"s{i}", 34 + rnd.uniform(0, 1), -118.7 + rnd.uniform(0, 1)) for i in range(60)]
    pts = [(j, 34.0501, -118.2499) for j in range(400)]
    pts += [(1000 + j, 34.05 + rnd.uniform(-0.002, 0.003), -118.25 + rnd.uniform(-0.002, 0.003)) for j in range(150)]
    pts += [(2000 + j, 34 + rnd.uniform(-2, 2), -118.7 + rnd.uniform(-2, 2)) for j in range(150)]
    sdf = spark.createDataFrame(sites, "ord long, division string, lat double, lon double")
    pdf = spark.createDataFrame(pts, "id long, lat double, lon double").repartition(3)
    want = {pid: min((_haversine(la, lo, t[2], t[3]), t[0], t[1]) for t in sites) for pid, la, lo in pts}
    for kw in ({"strategy": "array"}, {"strategy": "grid", "tile_sites": 64}):
        got = {r.id: (r.distance, r.division) for r in nearest_site(pdf, sdf, **kw).collect()}
        assert set(got) == set(want)
        for pid, (dist, _, division) in want.items():
            assert got[pid][1] == division, (kw, pid)
            assert got[pid][0] == pytest.approx(dist, rel=1e-12, abs=1e-9)


def test_index_meets_few_sites_per_point():
    """The work per point hardly grows with the sites: pairs met, over 1,000 and 20,000 sites."""
    import numpy as np

    from urbanlens.operators.nearest import SiteIndex, _unit

    rng = np.random.default_rng(3)
    met = {}
    for n in (1_000, 20_000):
        index = SiteIndex(rng.uniform(33, 35, n), rng.uniform(-119, -117, n), np.arange(n), np.array(["d"] * n, object))
        xyz = _unit(np.radians(rng.uniform(33, 35, 2_000)), np.radians(rng.uniform(-119, -117, 2_000)))
        met[n] = len(index.tree.near(xyz)[0]) * 16 / 2_000
    assert met[20_000] < 3 * met[1_000] and met[20_000] < 400


def test_nearest_summary_reads_two_columns(spark, tmp_dir):
    from urbanlens.plans.inspect import physical_plan

    crimes = read_crimes(spark, write_crime_files(tmp_dir))
    stations = read_stations(spark, write_stations(tmp_dir), order_col="PREC")
    plan = physical_plan(nearest_site_summary(nearest_site(crimes, stations)))
    schemas = [line for line in plan.split("\n") if "ReadSchema" in line]
    assert len(schemas) == 2 and all("struct<LAT:string,LON:string>" in x or "struct<LON:string,LAT:string>" in x
                                     for x in schemas)


def test_checkpoint_folder_is_required_on_a_cluster():
    from urbanlens.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_far_points_and_neighbours_meet_few_sites():
    """Points far from all sites meet the near edge, points among them their neighbourhood; found as by brute force."""
    import numpy as np

    from urbanlens.operators.nearest import SiteIndex, _unit

    rng = np.random.default_rng(5)
    n = 20_000
    lat, lon = rng.uniform(33, 35, n).round(3), rng.uniform(-119, -117, n).round(3)
    index = SiteIndex(lat, lon, np.arange(n), np.array([f"d{i}" for i in range(n)], object))
    sites = _unit(np.radians(lat), np.radians(lon))
    for low, high, most in ((33, 35, 160), (89, 97, 2_000)):
        a, b = rng.uniform(low, high, 400), rng.uniform(-119, -117, 400)
        xyz = _unit(np.radians(a), np.radians(b))
        assert len(index.tree.near(xyz)[0]) * 16 / len(xyz) < most
        found, distance = index.nearest(a, b)
        least = ((xyz[:, None, :] - sites) ** 2).sum(axis=2).min(axis=1)
        assert distance == pytest.approx(2 * 6371.0 * np.arcsin(np.sqrt(least) / 2), rel=1e-6, abs=1e-6)
        assert (np.abs(((xyz - index.xyz[found]) ** 2).sum(axis=1) - least) <= 1e-9 * least + 1e-18).all()


def test_tiles_met_by_a_point(spark, tmp_dir):
    """Few points lie so near an edge that a second tile can hold their nearest site."""
    from urbanlens.session import checkpoint_dir
    import glob

    rnd = random.Random(11)
    sdf = spark.createDataFrame([(i, f"s{i}", 34 + rnd.uniform(0, 1), -118 + rnd.uniform(0, 1)) for i in range(4_000)],
                                "ord long, division string, lat double, lon double")
    pdf = spark.createDataFrame([(j, 34 + rnd.uniform(0, 1), -118 + rnd.uniform(0, 1)) for j in range(3_000)],
                                "id long, lat double, lon double")
    known = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/scratch/point-tiles-*"))
    out = nearest_site(pdf, sdf, strategy="grid", tile_sites=500)
    new = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/scratch/point-tiles-*")) - known
    assert out.count() == 3_000 and spark.read.parquet(*new).count() < 2 * 3_000


def test_many_sites_and_points_of_one_task(spark, monkeypatch):
    """30,000 sites are searched as arrays, by more than the one task the points come in; the rows of the grid plan."""
    from pyspark.sql import functions as F

    import urbanlens.operators.nearest as nearest
    from urbanlens.plans.inspect import physical_plan

    monkeypatch.setattr(nearest, "PART_POINTS", 1_000)
    sdf = spark.range(30_000).select(
        F.col("id").alias("ord"), F.concat(F.lit("s"), "id").alias("division"),
        (34 + (F.col("id") * 6151 % 9973) / 9973).alias("lat"), (-118 + (F.col("id") * 4957 % 7919) / 7919).alias("lon"))
    pdf = spark.range(0, 3_000, 1, 1).select(
        "id", (34 + (F.col("id") * 7877 % 3001) / 3001).alias("lat"), (-118 + (F.col("id") * 1237 % 2999) / 2999).alias("lon"))
    out = nearest_site(pdf, sdf)
    assert "Join" not in physical_plan(out)
    used = out.withColumn("task", F.spark_partition_id()).select("id", "division", "distance", "task").collect()
    assert len({r.task for r in used}) == 3
    grid = nearest_site(pdf, sdf, strategy="grid").select("id", "division", "distance").collect()
    assert sorted((r.id, r.division, r.distance) for r in used) == sorted(map(tuple, grid))


def test_grid_deals_its_points_though_they_are_few_bytes(spark, monkeypatch):
    """Adaptive execution merges small partitions; the search of tiles is work, and keeps its tasks."""
    import glob

    from pyspark.sql import functions as F

    import urbanlens.operators.nearest as nearest
    from urbanlens.session import checkpoint_dir

    monkeypatch.setattr(nearest, "PART_POINTS", 100)
    sdf = spark.range(2_000).select(F.col("id").alias("ord"), F.concat(F.lit("s"), "id").alias("division"),
                                    (34 + F.col("id") % 43 / 43).alias("lat"), (-118 + F.col("id") % 47 / 47).alias("lon"))
    pdf = spark.range(0, 500, 1, 1).select("id", (34 + F.col("id") / 500).alias("lat"), F.lit(-117.5).alias("lon"))
    made = f"{checkpoint_dir(spark).removeprefix('file:')}/scratch/point-tiles-*"
    known = set(glob.glob(made))
    out = nearest_site(pdf, sdf, strategy="grid", tile_sites=500)
    new, = set(glob.glob(made)) - known
    assert len(glob.glob(f"{new}/*.parquet")) == 5
    assert out.count() == 500
