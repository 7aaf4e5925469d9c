"""Nearest site per point by great-circle distance, and a per-site summary.

Every point with numeric coordinates comes back once, with all its columns as
they were, and ``division`` and ``distance`` added.  Only null, non-numeric,
NaN and infinite coordinates are left out (see ``point_rejects``); a box
filter is optional.  Ties go to the lower (``ord``, ``division``), missing
values of ``ord`` last and of ``division`` first, whatever the plan.

Two exact plans with the same rows, types and column order:

* **array**: the sites fit a checked bound of rows and bytes.  They go once
  to every executor as an indexed set of arrays (``SiteIndex``); a vectorised
  scalar function maps (lat, lon) to (division, distance).  A query that needs
  few columns reads few.  Over few sites points are not shuffled; over many a
  point's search costs more than its way, so many points are dealt over tasks
  of some PART_POINTS each.
* **grid**: any number of sites.  They are range-partitioned along a
  space-filling curve into tiles of bounded size, so a dense cluster is cut
  into as many tiles as its sites need.  Small boxes of each tile's sites,
  with one site of every box (their number is bounded), tell each point the
  few tiles that can hold its nearest site.  Points meet those tiles by
  (tile, part of the tile's points), so a tile with very many points is many
  tasks, each with one tile's sites.  A point's best candidates are then
  joined back by a row number of our own: no point id is needed.  The plan is
  a fixed number of jobs, run while it is built; intermediate tables are
  written to the shared folder.

The index is a tree of boxes over sites in curve order; every box names one of
its sites.  A point descends it with two bounds: a box is left out if its
nearest corner is farther than some box's named site.  The sites of the
likeliest last box come first and tighten the bound for the others.
Straight-line (chord) distance grows with the great-circle distance, so there
are no special cases at the poles or the date line; the exact haversine with
the tie rule decides among the closest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.clean import round_to
from urbanlens.functions.exact import exact_mean
from urbanlens.functions.geo import EARTH_RADIUS_KM, unit_vector, usable_coordinates
from urbanlens.session import written

try:  # ship this module's code with the Python tasks
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # pragma: no cover
    pass

# Bounds of the array plan: no more sites than the grid plan has boxes.
MAX_ARRAY_SITES = 200_000
MAX_ARRAY_BYTES = 64 << 20
# Array plan: with more sites than this, more points than PART_POINTS are dealt over several tasks.
DEAL_SITES = 1_000
# Grid plan: sites of a tile (more where that would make over MAX_TILES), points of one task's part (both plans).
TILE_SITES = 4_096
MAX_TILES = 50_000
PART_POINTS = 50_000
MAX_TASKS = 100_000
# Boxes that tell points their tiles: sites of one (more where that would make over MAX_BOXES).
BOX_SITES = 16
MAX_BOXES = 200_000

_FAN = 16                 # sites in a leaf box, boxes in a parent
_CHUNK = 1_024            # points that descend together: their pairs stay in the processor's cache
_MAX_PAIRS = 2_000_000    # (point, box) pairs held at once before the points are split
_MARGIN = 1e-9
_LAST = 2**63 - 1         # order of a site whose order value is missing

Box = tuple[float, float, float, float]


def _valid(lat: Column, lon: Column, box: Box | None = None) -> Column:
    ok = usable_coordinates(lat, lon)
    if box is not None:
        ok = ok & lat.between(box[0], box[1]) & lon.between(box[2], box[3])
    return ok


def point_rejects(points: DataFrame, lat: str = "lat", lon: str = "lon", box: Box | None = None) -> DataFrame:
    """One row: how many points ``nearest_site`` leaves out."""
    la, lo = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    return points.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(~_valid(la, lo, box), 1)).alias("bad_coordinates"),
    )


def site_columns(
    sites: DataFrame, lat: str = "lat", lon: str = "lon",
    division: str = "division", order: str = "ord",
) -> DataFrame:
    """Usable sites as (lat, lon, ord, division); unreadable coordinates dropped.

    A site without a usable order value loses every tie (it sorts last).
    """
    return sites.select(
        F.col(lat).try_cast("double").alias("lat"), F.col(lon).try_cast("double").alias("lon"),
        F.coalesce(F.col(order).try_cast("long"), F.lit(_LAST)).alias("ord"),
        F.col(division).cast("string").alias("division"),
    ).where(_valid(F.col("lat"), F.col("lon")))


def prepare_sites(sites: DataFrame) -> DataFrame:
    """``site_columns`` with one row per distinct location, the winner of its ties."""
    s = sites.groupBy("lat", "lon").agg(F.min(F.struct("ord", "division")).alias("w"))
    return s.select("lat", "lon", "w.ord", "w.division")


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    site_lat: str = "lat",
    site_lon: str = "lon",
    division: str = "division",
    order: str = "ord",
    strategy: str = "auto",
    digits: int | None = None,
    max_array_sites: int = MAX_ARRAY_SITES,
    tile_sites: int = TILE_SITES,
    box: Box | None = None,
) -> DataFrame:
    """Every usable point with its nearest ``division`` and ``distance`` (km).

    ``strategy``: ``"array"``, ``"grid"`` or ``"auto"`` (array when the
    distinct site locations are within ``max_array_sites`` and
    MAX_ARRAY_BYTES).  A forced array plan beyond that is answered by the
    grid.  With no sites at all, division and distance are null.  ``digits``
    rounds the distance (half-up).  ``box`` (lat from, to, lon from, to)
    leaves out points outside it; off by default.
    """
    if strategy not in ("auto", "array", "grid"):
        raise ValueError(f"unknown strategy {strategy!r}")
    listed = site_columns(sites, site_lat, site_lon, division, order)
    fits = False
    if strategy != "grid":
        n, size = _extent(listed)
        fits = n <= max_array_sites and size <= MAX_ARRAY_BYTES
    if not fits:
        # Repeated locations are folded once, in the shared folder.
        listed = written(prepare_sites(listed), "sites")
        n, size = _extent(listed)
        fits = n <= max_array_sites and size <= MAX_ARRAY_BYTES
    la, lo = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    usable = points.where(_valid(la, lo, box))
    if fits and (strategy != "grid" or not n):
        if n > DEAL_SITES:
            tasks = _tasks(usable.count())
            usable = usable.repartition(tasks) if tasks > 1 else usable
        out = _nearest_by_array(usable, SiteIndex.from_rows(listed.collect()), la, lo)
    else:
        out = _nearest_by_tiles(usable, listed, n, la, lo, tile_sites)
    distance = F.col("_best.distance")
    if digits is not None:
        distance = round_to(distance, digits)
    return out.select(*[F.col(f"`{c}`") for c in points.columns if c not in ("division", "distance")],
                      F.col("_best.division").alias("division"), distance.alias("distance"))


def _extent(sites: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of the arrays they would make."""
    row = sites.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.octet_length("division")), F.lit(0)).alias("text")).first()
    return row["n"], row["n"] * 64 + row["text"]


def _tasks(points: int) -> int:
    """Tasks for the search of so many points.

    It is much work on few bytes: adaptive execution, which goes by bytes, would merge the partitions if it chose.
    """
    return min(-(-points // PART_POINTS), MAX_TASKS)


# --- the index -------------------------------------------------------------------------

def _unit(lat_r: np.ndarray, lon_r: np.ndarray) -> np.ndarray:
    c = np.cos(lat_r)
    return np.stack([c * np.cos(lon_r), c * np.sin(lon_r), np.sin(lat_r)], axis=1)


def curve(xyz: np.ndarray) -> np.ndarray:
    """Place on a space-filling curve: the sphere unfolded by way of an octahedron, then the bits of both axes in turn."""
    x, y, z = (xyz / np.abs(xyz).sum(axis=1, keepdims=True)).T
    fold = z < 0
    x, y = (np.where(fold, np.copysign(1 - np.abs(y), x), x), np.where(fold, np.copysign(1 - np.abs(x), y), y))
    cells = [np.clip((axis + 1) * (1 << 29), 0, (1 << 30) - 1).astype(np.int64) for axis in (x, y)]
    code = np.zeros(len(xyz), np.int64)
    for bit in range(30):
        for axis in range(2):
            code |= ((cells[axis] >> bit) & 1) << (2 * bit + axis)
    return code


def _named(xyz: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of every run of rows (they start at ``at``) the one nearest to the middle of the run's box."""
    run = np.repeat(np.arange(len(at)), np.diff(at, append=len(xyz)))
    gap = xyz - (low + high)[run] / 2
    return xyz[np.lexsort(((gap * gap).sum(axis=1), run))[at]]


def _within(bound: np.ndarray) -> np.ndarray:
    """A squared distance with room for the errors of arithmetic."""
    return bound * (1 + _MARGIN) + 1e-18


class BoxTree:
    """Boxes in curve order, each with one of its sites, under parents of ``_FAN`` consecutive boxes, and so on."""

    def __init__(self, low: np.ndarray, high: np.ndarray, site: np.ndarray):
        # One row per axis: a gather then reads one short array after the other.
        self.levels = [(low.T.copy(), high.T.copy(), site.T.copy())]
        while len(low) > _FAN:
            at = np.arange(0, len(low), _FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            site = _named(site, at, low, high)
            self.levels.append((low.T.copy(), high.T.copy(), site.T.copy()))

    def near(self, xyz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, box) pairs, ordered by point, of the boxes that can hold its nearest site."""
        point, node, _ = self.reach(xyz.T.copy())
        return point, node

    def reach(self, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of ``near`` and the squared distances to the boxes; points as one row per axis."""
        n, top = axes.shape[1], self.levels[-1][0].shape[1]
        point, node = np.repeat(np.arange(n), top), np.tile(np.arange(top), n)
        near = np.empty(0)
        for depth in range(len(self.levels) - 1, -1, -1):
            near, named = np.zeros(len(point)), np.zeros(len(point))
            for p, low, high, site in zip(axes, *self.levels[depth]):
                p = p[point]
                gap = np.maximum(np.maximum(low[node] - p, p - high[node]), 0)
                near += gap * gap
                gap = p - site[node]
                named += gap * gap
            bound = _within(np.minimum.reduceat(named, np.flatnonzero(np.diff(point, prepend=-1))))
            keep = np.flatnonzero(near <= bound[point])
            point, node, near = point[keep], node[keep], near[keep]
            if depth:
                size = self.levels[depth - 1][0].shape[1]
                if len(point) * _FAN > _MAX_PAIRS and n > 1:
                    half = n // 2
                    a, b = self.reach(axes[:, :half]), self.reach(axes[:, half:])
                    return (np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]]),
                            np.concatenate([a[2], b[2]]))
                point, node = _members(point, node, size)
        return point, node, near


def _members(point: np.ndarray, node: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, member) pairs of the ``_FAN`` members of each node; there are ``size`` members in all."""
    member = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
    point = np.repeat(point, _FAN)
    if len(node) and member.max() >= size:
        known = member < size
        point, member = point[known], member[known]
    return point, member


class SiteIndex:
    """Sites as arrays in curve order, with the tree of their boxes."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, ord_: np.ndarray, division: np.ndarray):
        # The place in (ord, division) order breaks ties; one row per location.
        rank = sorted(range(len(lat)), key=lambda i: (ord_[i], division[i] is not None, division[i] or ""))
        seen: set = set()
        rank = [i for i in rank if (key := (lat[i] + 0.0, lon[i] + 0.0)) not in seen and not seen.add(key)]
        lat_r, lon_r = np.radians(lat[rank]), np.radians(lon[rank])
        order = np.argsort(curve(_unit(lat_r, lon_r)), kind="stable") if len(rank) else np.empty(0, np.int64)
        self.tie = order
        self.lat, self.lon = lat_r[order], lon_r[order]
        self.cos, self.xyz = np.cos(self.lat), _unit(self.lat, self.lon)
        self.ord, self.division = ord_[rank][order], division[rank][order]
        if len(rank):
            at = np.arange(0, len(order), _FAN)
            low, high = np.minimum.reduceat(self.xyz, at), np.maximum.reduceat(self.xyz, at)
            self.tree = BoxTree(low, high, _named(self.xyz, at, low, high))
            self.axes = self.xyz.T.copy()

    @classmethod
    def from_rows(cls, rows) -> SiteIndex:
        return cls(np.array([r["lat"] for r in rows], np.float64), np.array([r["lon"] for r in rows], np.float64),
                   np.array([r["ord"] for r in rows], np.int64), np.array([r["division"] for r in rows], object))

    def nearest(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Site number (-1: there is none) and distance of each point, in degrees."""
        site, distance = np.full(len(lat), -1), np.full(len(lat), np.nan)
        if len(self.lat):
            for start in range(0, len(lat), _CHUNK):
                part = slice(start, start + _CHUNK)
                site[part], distance[part] = self._chunk(np.radians(lat[part]), np.radians(lon[part]))
        return site, distance

    def _chunk(self, lat_r, lon_r):
        axes = _unit(lat_r, lon_r).T.copy()
        point, leaf, near = self.tree.reach(axes)
        if len(point) * _FAN > _MAX_PAIRS and len(lat_r) > 1:
            half = len(lat_r) // 2
            a, b = self._chunk(lat_r[:half], lon_r[:half]), self._chunk(lat_r[half:], lon_r[half:])
            return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        # The nearest box first: its closest site bounds the others.
        starts = np.flatnonzero(np.diff(point, prepend=-1))
        first = np.zeros(len(point), bool)
        first[np.lexsort((near, point))[starts]] = True
        at, site = _members(point[first], leaf[first], len(self.lat))
        chord = self._chord(axes, at, site)
        least = np.minimum.reduceat(chord, np.flatnonzero(np.diff(at, prepend=-1)))
        other = np.flatnonzero(~first & (near <= _within(least)[point]))
        at2, site2 = _members(point[other], leaf[other], len(self.lat))
        chord2 = self._chord(axes, at2, site2)
        point, site, chord = np.concatenate([at, at2]), np.concatenate([site, site2]), np.concatenate([chord, chord2])
        if len(at2):
            begin = np.flatnonzero(np.diff(at2, prepend=-1))
            least[at2[begin]] = np.minimum(least[at2[begin]], np.minimum.reduceat(chord2, begin))
        # Candidates within a hair of the closest by chord; the exact rule chooses among them.
        close = np.flatnonzero(chord <= _within(least)[point])
        point, site = point[close], site[close]
        d = _haversine_np(lat_r[point], lon_r[point], np.cos(lat_r)[point], self.lat[site], self.lon[site],
                          self.cos[site])
        order = np.lexsort((self.tie[site], d, point))
        pick = order[np.flatnonzero(np.diff(point[order], prepend=-1))]
        return site[pick], d[pick]

    def _chord(self, axes: np.ndarray, point: np.ndarray, site: np.ndarray) -> np.ndarray:
        """Squared straight-line distances of the pairs."""
        chord = np.zeros(len(point))
        for p, s in zip(axes, self.axes):
            gap = p[point] - s[site]
            chord += gap * gap
        return chord


def _haversine_np(lat1, lon1, cos1, lat2, lon2, cos2):
    """Same formula and operation order as ``haversine_from_radians``."""
    hdlat = np.sin((lat2 - lat1) / 2)
    hdlon = np.sin((lon2 - lon1) / 2)
    a = hdlat * hdlat + cos1 * cos2 * (hdlon * hdlon)
    return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(np.maximum(a, 0.0)), np.sqrt(np.maximum(1 - a, 0.0)))


# --- array plan ------------------------------------------------------------------------

def _nearest_by_array(usable: DataFrame, index: SiteIndex, la: Column, lo: Column) -> DataFrame:
    shared = usable.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

    def assign(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        held = cloudpickle.loads(shared.value)
        for lat, lon in batches:
            site, distance = held.nearest(lat.to_numpy("float64"), lon.to_numpy("float64"))
            division = np.full(len(site), None, dtype=object)
            division[site >= 0] = held.division[site[site >= 0]]
            yield pd.DataFrame({"division": division, "distance": distance})

    best = F.pandas_udf(assign, "struct<division:string,distance:double>")
    return usable.withColumn("_best", best(la, lo))


# --- grid plan -------------------------------------------------------------------------

def _nearest_by_tiles(usable: DataFrame, sites: DataFrame, n_sites: int, la: Column, lo: Column,
                      tile_sites: int) -> DataFrame:
    spark = usable.sparkSession
    n_tiles = max(1, min(-(-n_sites // tile_sites), MAX_TILES))
    x, y, z = unit_vector(F.radians("lat"), F.radians("lon"))
    place = F.pandas_udf(lambda a, b, c: pd.Series(curve(np.stack([a, b, c], axis=1))), "long")
    placed = sites.withColumns({"x": x, "y": y, "z": z}).withColumn("place", place("x", "y", "z"))
    # Equal places are cut too: latitude and longitude follow in the range key.
    # A row's number within its partition is the low part of the increasing id; it goes along the curve.
    box_sites = max(BOX_SITES, -(-n_sites // MAX_BOXES))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tiles = written(placed.repartitionByRange(n_tiles, "place", "lat", "lon")
                    .sortWithinPartitions("place", "lat", "lon")
                    .withColumns({"tile": F.spark_partition_id(), "box": F.floor(number / box_sites),
                                  "at": number % box_sites}), "tiles")
    boxes = tiles.groupBy("tile", "box").agg(
        *[f(c).alias(f"{name}_{c}") for c in "xyz" for name, f in (("low", F.min), ("high", F.max))],
        F.min_by(F.struct("x", "y", "z"), F.abs(F.col("at") - box_sites // 2)).alias("site")).orderBy("tile", "box").collect()
    names = np.array([b["tile"] for b in boxes])
    tree = BoxTree(np.array([[b[f"low_{c}"] for c in "xyz"] for b in boxes], np.float64),
                   np.array([[b[f"high_{c}"] for c in "xyz"] for b in boxes], np.float64),
                   np.array([tuple(b["site"]) for b in boxes], np.float64))
    shared = spark.sparkContext.broadcast(cloudpickle.dumps((names, tree)))

    def tiles_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        numbers, held = cloudpickle.loads(shared.value)
        for lat, lon in batches:
            out: list = []
            lat_r, lon_r = np.radians(lat.to_numpy("float64")), np.radians(lon.to_numpy("float64"))
            for start in range(0, len(lat_r), _CHUNK):
                point, box = held.near(_unit(lat_r[start:start + _CHUNK], lon_r[start:start + _CHUNK]))
                tile = numbers[box]
                # A point's boxes come in the order of their tiles.
                new = (np.diff(point, prepend=-1) != 0) | (np.diff(tile, prepend=-1) != 0)
                point, tile = point[new], tile[new]
                out.extend(np.split(tile, np.flatnonzero(np.diff(point)) + 1))
            yield pd.Series(out)

    near = F.pandas_udf(tiles_of, "array<int>")
    base = written(usable.withColumn("_row", F.monotonically_increasing_id()), "points")
    # Dealt over all tasks: the points may come from few files.
    narrow = base.select("_row", la.alias("lat"), lo.alias("lon")).repartition(max(1, _tasks(base.count())), "_row")
    pairs = written(narrow.select("_row", "lat", "lon", F.explode(near("lat", "lon")).alias("tile")), "point-tiles")
    # One row per tile: at most MAX_TILES, so it may be broadcast.
    load = pairs.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / PART_POINTS).cast("int").alias("parts"))
    load = F.broadcast(load)
    left = pairs.join(load, "tile").withColumn("part", F.pmod(F.xxhash64("_row"), F.col("parts")).cast("int"))
    right = tiles.join(load, "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def compare(points: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        index = SiteIndex(here["lat"].to_numpy(), here["lon"].to_numpy(), here["ord"].to_numpy(),
                          here["division"].to_numpy(object))
        site, distance = index.nearest(points["lat"].to_numpy(), points["lon"].to_numpy())
        return pd.DataFrame({"_row": points["_row"].to_numpy(), "distance": distance, "ord": index.ord[site],
                             "division": index.division[site]})

    found = (left.select("_row", "lat", "lon", "tile", "part").groupBy("tile", "part")
             .cogroup(right.select("lat", "lon", "ord", "division", "tile", "part").groupBy("tile", "part"))
             .applyInPandas(compare, "_row long, distance double, ord long, division string"))
    best = found.groupBy("_row").agg(F.min(F.struct("distance", "ord", "division")).alias("_best"))
    return base.join(best, "_row")


def nearest_site_summary(
    assigned: DataFrame, digits: int = 2, rounding: str = "half_up",
) -> DataFrame:
    """Points per nearest division and their mean distance (unordered).

    The mean is exact up to 2^-41 km, so it is the same however the points are
    partitioned.  Output: division, avg_distance, crime_total.
    """
    return assigned.groupBy("division").agg(
        round_to(exact_mean("distance"), digits, rounding).alias("avg_distance"),
        F.count(F.lit(1)).alias("crime_total"),
    ).select("division", "avg_distance", "crime_total")
