"""Jaccard join of word n-gram sets with PartEnum signatures.

A document's set: the hashes of its distinct ``size``-word shingles (A-Z
lower-cased; fewer words: the whole sequence is one).  Two documents link when
``of`` * intersection >= ``part`` * union, for a similarity ``part/of``.

1. Equal sets are one class (128-bit key of the sorted set); the smallest id
   of a class stands for it from here on.
2. Sets are banded by size.  Every two sets that may link meet in one band,
   where their symmetric difference is at most ``k``.  A band's feature domain
   is dealt into ``g`` groups of ``n2`` partitions; with ``k2`` differences
   allowed in a group there must be a group (in fact ``slack`` + 1 of them)
   that has no more, so one of its subsets of ``n2 - k2`` partitions is the
   same in both sets: its hash is a signature that both emit.
   Partitions without features say nothing: as slack + 1 groups agree, a set
   with at most slack groups that hold an empty subset leaves those out; other
   sets (exact, and rare) emit them.
3. The documents of a signature are a group; equal groups are one.  Inside a
   group an exact lower bound of the symmetric difference, the distance of
   two XOR bitmaps of the sets, rules out pairs that can't link.  What is left
   joins documents into candidate clusters, passed on as a spanning forest.
4. Clusters are compared exactly: an inverted index over the shingles counts
   the intersections of one set with those not yet reached, and the links that
   reach them are passed on, again a spanning forest.
5. Connected components of the links and classes.

Groups and clusters larger than a block take two passes.  The first compares
every block with itself and with a few pivots of the group, which joins most of
a group of near copies in time that grows with its size.  The second compares
what this leaves outside the group's main part with all blocks, a task for
every pair of them.  Only pairs whose ends are linked by then are left out, so
the components are those of all pairs, whatever the pivots.

No step emits the pairs of a group.  The signatures of one place (12 bytes
each, eight places to a shuffle partition) are sorted by one task; set the
shuffle partitions so that a place holds a few million of them, as for any
sort.

Defined results: null or empty text, or text without words, is the empty set
and linked with nothing; rows with a null id are returned unlinked
(component null); rows with the same id are one node of the graph; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.llm.common import cut, join_unique, packed, ranges, row_schema, text_of
from urbanlens.llm.components import connected_components

SLACK, SLACK_SHARE = 2, 0.1    # groups more than needed, at least and as a share
BAND_RATIO = 1.25
GROUP_BLOCK = 4096             # documents of a signature group compared at once
BLOCK_SETS = 1024              # sets in a block of a cluster
BLOCK_FEATURES = 1 << 20       # shingles in a block of a cluster
PIVOTS = 8                     # members that the first pass compares with all blocks of a large group
MAX_SENT_IDS = 500_000         # ids of cluster members that are broadcast
_BUFFER = 1 << 21              # signatures held by a task before they are reduced

_U = np.uint64
_ODD = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD[0]
    x = (x ^ (x >> _U(29))) * _ODD[1]
    return x ^ (x >> _U(32))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LONG_WORD = 1 << 12           # bytes; longer words are hashed one by one
_PIECE = 1 << 20               # bytes hashed at once
_rng = np.random.default_rng(0x5EED)
_LETTER = _rng.integers(0, 1 << 63, (2, 256)).astype(np.uint64) * _U(2) + _U(1)
_POWER = np.cumprod(np.concatenate([np.ones((2, 1), np.uint64), np.repeat(np.array(
    [[0x9E3779B97F4A7C15], [0xD6E8FEB86659FD93]], np.uint64), _LONG_WORD - 1, axis=1)], axis=1), axis=1)


def word_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and length of every word of a lower-cased buffer."""
    data = np.frombuffer(buffer, np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), start, start
    size = stop - start
    letters = data[inside]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.minimum(np.arange(len(letters)) - np.repeat(first, size), _LONG_WORD - 1)
    sums = [np.add.reduceat(_LETTER[k][letters] * _POWER[k][place], first) for k in (0, 1)]
    out = _mix(sums[0]) + _mix(sums[1] ^ _U(0x2545F4914F6CDD1D)) * _ODD[2]
    for k in np.flatnonzero(size >= _LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(buffer[start[k]:stop[k]])
    return out, start, size


def hashed_words(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`word_hashes` of a buffer of any size, in parts that end between words."""
    parts, at = [], 0
    while at < len(buffer):
        end = min(at + _PIECE, len(buffer))
        while end < len(buffer) and not _SPACE[buffer[end]]:
            end += 1
        hashes, start, size = word_hashes(buffer[at:end])
        parts.append((hashes, start + at, size))
        at = end
    if not parts:
        return word_hashes(b"")
    return tuple(np.concatenate(p) for p in zip(*parts))


class Shingles:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, size: int):
        self.size = size

    def _words(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The word hashes of each text."""
        held: list[bytes] = []
        room = 0
        for i, text in enumerate(texts):
            held.append(text)
            room += len(text)
            if room >= _PIECE or i == len(texts) - 1:
                hashes, start, _ = hashed_words(b"\n".join(held).lower())
                ends = np.cumsum([len(t) + 1 for t in held])
                yield from np.split(hashes, np.searchsorted(start, ends[:-1]))
                held, room = [], 0

    def of_all(self, texts: list[bytes]) -> list[np.ndarray]:
        out = []
        for h in self._words(texts):
            n = min(self.size, len(h))
            if not n:
                out.append(h)
                continue
            got = np.zeros(len(h) - n + 1, np.uint64)
            for i in range(n):
                got = (got ^ h[i:len(h) - n + 1 + i]) * _ODD[1]
                got ^= got >> _U(31)
            if n < self.size:
                got = _mix(got + _U(n))
            got.sort()
            if len(got) > 1:
                got = got[np.concatenate([[True], got[1:] != got[:-1]])]
            out.append(got)
        return out

    def of(self, text: bytes) -> np.ndarray:
        return self.of_all([text])[0]


class Signatures:
    """PartEnum for a similarity of ``part``/``of``."""

    def __init__(self, part: int, of: int):
        self.part, self.of = part, of
        self.bands: list[tuple[int, int, int]] = []       # smallest and largest home size, differences
        low = 1
        while low < 1 << 40:
            high = max(low, int(low * BAND_RATIO))
            # Sets of a and b elements that link differ in (a + b)(of - part)/(of + part) at most.
            self.bands.append((low, high, 2 * high * (of - part) // (of + part)))
            low = high + 1
        self.low = np.array([b[0] for b in self.bands])

    def home(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def bands_of(self, n: int) -> list[int]:
        """The home band, and higher ones that hold sets this one may link with."""
        out = [self.home(n)]
        while n * self.of >= self.part * self.bands[out[-1] + 1][0]:
            out.append(out[-1] + 1)
        return out

    @staticmethod
    def plan(k: int) -> tuple[int, int, int, int]:
        """Groups, differences allowed in one, partitions of one, groups that may be left out."""
        if k <= 3:
            return 1, k, k + 2, 0
        slack = SLACK + int(SLACK_SHARE * k / 2)
        return k // 2 + 1 + slack, 1, 3, slack

    def of_sets(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All signatures of the sets, and the number of the set each belongs to."""
        sizes = np.array([len(f) for f in sets], np.int64)
        members: dict[int, list[int]] = {}
        for i, n in enumerate(sizes):
            for band in self.bands_of(int(n)) if n else ():
                members.setdefault(band, []).append(i)
        out, who = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for band, those in members.items():
            k = self.bands[band][2]
            if k == 0:
                continue       # only equal sets link
            g, k2, n2, slack = self.plan(k)
            m, at_once = len(those), np.array(those)
            salt = _U((band + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
            mixed = _mix(np.concatenate([sets[i] for i in those]) ^ salt)
            owner = np.repeat(np.arange(m), sizes[at_once])
            at = owner * (g * n2) + ((mixed >> _U(33)) % _U(g * n2)).astype(np.int64)
            sums = np.zeros(m * g * n2, np.uint64)
            np.add.at(sums, at, mixed)
            counts = np.bincount(at, minlength=m * g * n2).reshape(m, g, n2)
            sums = sums.reshape(m, g, n2)
            groups = np.arange(g, dtype=np.uint64)
            subsets = list(combinations(range(n2), n2 - k2))
            empty = np.stack([counts[:, :, s].sum(axis=2) == 0 for s in subsets])
            # Few groups with an empty subset: those subsets need not be emitted.
            spared = empty.any(axis=0).sum(axis=1) <= (slack if slack else -1)
            for number, subset in enumerate(subsets):
                value = np.zeros((m, g), np.uint64)
                for place in subset:       # partitions keep their places in the hash
                    value = (value ^ _mix(sums[:, :, place] + _U(place + 1))) * _ODD[2]
                found = _mix(value ^ _mix(groups * _U(64) + _U(number)) ^ salt)
                said = ~(empty[number] & spared[:, None])
                out.append(found[said])
                who.append(at_once[np.nonzero(said)[0]])
        return np.concatenate(out), np.concatenate(who)

    def of_set(self, features: np.ndarray) -> np.ndarray:
        return self.of_sets([features])[0]


class Forest:
    """Disjoint sets of 0 .. n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def bitmap(features: np.ndarray) -> bytes:
    """Parity of the features by place; a power of two of places, about as many as features."""
    places = 64 << max(0, (len(features) * 3 // 4 - 1) // 64).bit_length()
    odd = np.bincount((features >> _U(20)).astype(np.int64) & (places - 1), minlength=places) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _set_body(size: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            n, k1, k2, bits = [], [], [], []
            for got in shingles.of_all(text_of(batch, "text").to_pylist()):
                digest = xxhash.xxh3_128_digest(got.tobytes())
                n.append(len(got))
                k1.append(int.from_bytes(digest[:8], "little", signed=True))
                k2.append(int.from_bytes(digest[8:], "little", signed=True))
                bits.append(bitmap(got))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(bits, pa.binary())], names=["row", "id", "n", "k1", "k2", "bits"])

    return body


_TAIL = 4                      # bytes of a signature that are sent; its place tells more of it


def _signature_body(size: int, part: int, of: int, places: int):
    """Signatures packed by place: their tails, and the steps between the sorted document ids."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signatures = Shingles(size), Signatures(part, of)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0

        def packed_up() -> pa.RecordBatch:
            sig = np.concatenate([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            held.clear()
            place = ((sig >> _U(40)) % _U(places)).astype(np.int64)
            order = np.lexsort((ids, place))
            sig, ids, place = sig[order], ids[order], place[order]
            cuts = np.flatnonzero(np.diff(place)) + 1
            tails = sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TAIL]
            return pa.RecordBatch.from_arrays([
                pa.array(place[np.concatenate([[0], cuts])], pa.int64()).cast(pa.int32()),
                pa.array([t.tobytes() for t in np.split(tails, cuts)], pa.binary()),
                pa.array([np.diff(i, prepend=0).tobytes() for i in np.split(ids, cuts)], pa.binary()),
            ], names=["place", "tails", "steps"])

        for batch in batches:
            names = batch.column("id").to_numpy()
            found, who = signatures.of_sets(shingles.of_all(text_of(batch, "text").to_pylist()))
            if len(found):
                held.append((found, names[who]))
                total += len(found)
                if total >= _BUFFER:
                    yield packed_up()
                    total = 0
        if held:
            yield packed_up()

    return body


def groups_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, id) of the ids that share a key; a group is named by its members' hash and said once."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[new], ids[new]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    name = _mix(np.add.reduceat(_mix(ids.view(np.uint64)), first) + size.astype(np.uint64))
    several = np.flatnonzero(size > 1)
    _, once = np.unique(name[several], return_index=True)
    chosen = several[once]
    at = np.repeat(first[chosen], size[chosen]) + (
        np.arange(size[chosen].sum()) - np.repeat(np.cumsum(size[chosen]) - size[chosen], size[chosen]))
    return np.repeat(name[chosen], size[chosen]).view(np.int64), ids[at]


def _meet_body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of rows sorted by place, one place held at a time."""
    at, keys, ids = None, [], []

    def met() -> Iterator[pa.RecordBatch]:
        group, member = groups_of(np.concatenate(keys), np.concatenate(ids))
        keys.clear()
        ids.clear()
        for start in range(0, len(group), 1 << 16):
            stop = start + (1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array(group[start:stop]), pa.array(member[start:stop])],
                                             names=["grp", "id"])

    for batch in batches:
        for place, tails, steps in zip(*(batch.column(c).to_pylist() for c in ("place", "tails", "steps"))):
            if place != at and keys:
                yield from met()
            at = place
            wide = np.zeros((len(tails) // _TAIL, 8), np.uint8)
            wide[:, :_TAIL] = np.frombuffer(tails, np.uint8).reshape(-1, _TAIL)
            keys.append(wide.view("<u8").ravel() | (_U(place) << _U(8 * _TAIL)))
            ids.append(np.cumsum(np.frombuffer(steps, np.int64)))
    if keys:
        yield from met()


def _near(sizes: list[int], bits: list[bytes], part: int, of: int):
    """A function (i, others): which of the others sizes and bitmaps don't rule out as partners of i."""
    least = min(map(len, bits))
    maps = np.empty((len(bits), least), np.uint8)
    for i, b in enumerate(bits):      # larger bitmaps fold to the smallest
        maps[i] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, least), axis=0)
    words, n = maps.view(np.uint64), np.array(sizes, np.int64)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(words[others] ^ words[i]).sum(axis=1, dtype=np.int64)
        return (apart * (of + part) <= (n[others] + n[i]) * (of - part)) & (
            np.minimum(n[others], n[i]) * of >= np.maximum(n[others], n[i]) * part)

    return near


def near_edges(names: list[int], sizes: list[int], bits: list[bytes], part: int, of: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and bitmaps do not rule out."""
    near, left, edges = _near(sizes, bits, part, of), np.arange(len(names)), []
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            i = waiting.pop()
            reached = near(i, left)
            edges.extend((names[i], names[j]) for j in left[reached])
            waiting.extend(left[reached])
            left = left[~reached]
    return edges


def joined_sides(names, sides, asks, partners) -> list[tuple[int, int]]:
    """Edges from asking rows to others of a side not yet joined with theirs, as a spanning forest of the sides.

    ``partners(i, others)`` tells which of the others i is joined with.
    """
    side, edges = np.unique(sides, return_inverse=True)[1], []
    others = np.flatnonzero(~np.array(asks))
    asking = np.flatnonzero(asks)
    for i in asking[np.argsort(side[asking], kind="stable")]:
        apart = others[side[others] != side[i]]
        if len(apart):
            for j in apart[partners(i, apart)]:
                if side[i] != side[j]:
                    side[side == side[j]] = side[i]
                    edges.append((int(names[i]), int(names[j])))
    return edges


def _filter_body(part: int, of: int):
    """Rows sorted by (grp, block): the candidate edges of each."""

    def edges_of(key, rows) -> list[tuple[int, int]]:
        return near_edges(*zip(*rows), part, of) if len(rows) > 1 else []

    return _by_key(("grp", "block"), ("id", "n", "bits"), edges_of)


def _filter_apart_body(part: int, of: int):
    """Rows sorted by (grp, low, high): the candidate edges that join sides."""

    def edges_of(key, rows) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        names, sides, asks, sizes, bits = zip(*rows)
        return joined_sides(names, sides, asks, _near(sizes, bits, part, of))

    return _by_key(("grp", "low", "high"), ("id", "side", "asks", "n", "bits"), edges_of)


def _by_key(keys: tuple, values: tuple, edges_of):
    """A body over rows sorted by ``keys``: (a, b) edges of each run of equal keys."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out(edges) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                               pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])

        for batch in batches:
            edges: list[tuple[int, int]] = []
            marks = zip(*(batch.column(c).to_pylist() for c in keys))
            for mark, row in zip(marks, zip(*(batch.column(c).to_pylist() for c in values))):
                if mark != key:
                    edges += edges_of(key, rows)
                    key, rows = mark, []
                rows.append(row)
            if edges:
                yield out(edges)
        edges = edges_of(key, rows)
        if edges:
            yield out(edges)

    return body


def _block(blocks: str, *salt: int) -> Column:
    return F.pmod(F.xxhash64("id", *[F.lit(x) for x in salt]), F.col(blocks)).cast("int")


def _first_pass(members: DataFrame, key: str) -> DataFrame:
    """(key, id, block): every member in its block, and the pivots of a large group in all of its blocks."""
    rows = members.select(key, "id", "blocks", _block("blocks").alias("block"))
    pivots = rows.where((F.col("blocks") > 1) & (F.col("block") < PIVOTS)).groupBy(key, "blocks", "block").agg(
        F.min("id").alias("id"))
    pivots = pivots.select(key, "id", F.col("block").alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).where(F.col("own") != F.col("block"))
    return rows.select(key, "id", "block").unionByName(pivots.select(key, "id", "block"))


def _second_pass(members: DataFrame, key: str, edges: DataFrame, name: str) -> DataFrame | None:
    """(key, id, side, blocks, main, askers) of the large groups that the first pass leaves in several sides.

    A side is a component of ``edges``; the members outside the main side,
    dealt into ``askers`` blocks, are to be compared with all blocks.  None if
    there are none.
    """
    large = members.where(F.col("blocks") > 1)
    if large.isEmpty():
        return None
    sides = large.join(connected_components(edges), "id", "left").select(
        key, "id", "blocks", "load", F.coalesce("component", "id").alias("side"))
    sides = cut(sides, f"{name}-sides")
    sizes = sides.groupBy(key, "side").agg(F.count(F.lit(1)).alias("n"), F.sum("load").alias("load"))
    apart = sizes.groupBy(key).agg(
        F.max_by("side", F.struct("n", "side")).alias("main"), F.sum("n").alias("w"), F.max("n").alias("most"),
        (F.sum("load") - F.max_by("load", F.struct("n", "side"))).alias("load"))
    apart = apart.where(F.col("w") > F.col("most")).select(
        key, "main", "w", F.greatest(F.ceil("load"), F.lit(1)).cast("int").alias("askers"))
    apart = cut(apart, f"{name}-apart")
    return None if apart.isEmpty() else join_unique(sides.drop("load"), apart, key, "w")


def _in_pairs(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Rows of :func:`_second_pass`, once for every pair of an asking and another block that they are in."""
    every, own = F.sequence(F.lit(0), F.col("blocks") - 1), _block("blocks")
    asked = F.transform(F.sequence(F.lit(0), F.col("askers") - 1), lambda low: F.struct(
        F.lit(False).alias("asks"), low.alias("low"), own.alias("high")))
    asking = F.transform(every, lambda high: F.struct(
        F.lit(True).alias("asks"), _block("askers", 1).alias("low"), high.alias("high")))
    at = F.explode(F.when(F.col("side") == F.col("main"), asked).otherwise(F.concat(asked, asking)))
    rows = rows.withColumn("at", at).select(key, "at.low", "at.high", "at.asks", "id", "side", *values)
    return rows.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high", "id")


def candidate_edges(docs: DataFrame, maps: DataFrame, size: int, part: int, of: int) -> DataFrame:
    """(a, b) that join all documents that may link; ``maps``: (id, n, bits)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = min(8 * partitions, 1 << 20)
    rows = docs.mapInArrow(_signature_body(size, part, of, places), "place int, tails binary, steps binary")
    members = rows.repartition(partitions, "place").sortWithinPartitions("place").mapInArrow(
        _meet_body, "grp long, id long")
    members = cut(members.distinct(), "jaccard-groups")
    large = members.groupBy("grp").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > GROUP_BLOCK)
    large = large.select("grp", F.ceil(F.col("m") / GROUP_BLOCK).cast("int").alias("parts"))
    members = members.join(large, "grp", "left").select(
        "grp", "id", F.coalesce("parts", F.lit(1)).alias("blocks"), F.lit(1.0 / GROUP_BLOCK).alias("load"))
    values = ["id", "n", "bits"]
    first = _first_pass(members, "grp").join(maps, "id").select("grp", "block", *values)
    first = first.repartition("grp", "block").sortWithinPartitions("grp", "block", "id")
    edges = cut(first.mapInArrow(_filter_body(part, of), "a long, b long"), "jaccard-near")
    apart = _second_pass(members, "grp", edges, "jaccard-groups")
    if apart is None:
        return edges
    pairs = _in_pairs(apart.join(maps, "id"), "grp", ["n", "bits"])
    return edges.unionByName(pairs.mapInArrow(_filter_apart_body(part, of), "a long, b long"))


def _features_body(size: int, columns: list[str]):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            column = text_of(batch, "text")
            for start, stop in ranges(column, 4 << 20):
                sets = [f.tobytes() for f in shingles.of_all(column[start:stop].to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[start:stop] for c in columns] + [pa.array(sets, pa.binary())],
                    names=[*columns, "features"])

    return body


class Postings:
    """The sets that hold each shingle; shingles of one set alone never count and are left out."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        found, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = counts[where] > 1
        self.where, self.owner, self.features = where[common], owner[common], len(found)
        self.own = np.searchsorted(self.owner, np.arange(len(sets) + 1))
        self.keep(np.ones(len(sets), bool))

    def keep(self, wanted: np.ndarray) -> None:
        """Only the ``wanted`` sets are met from now on."""
        kept = wanted[self.owner]
        where, owner = self.where[kept], self.owner[kept]
        order = np.argsort(where, kind="stable")
        self.posting = owner[order]
        self.start = np.searchsorted(where[order], np.arange(self.features + 1))
        self.held = int(wanted.sum())

    def linked(self, i: int, part: int, of: int) -> np.ndarray:
        """Whether each of the sets met links with set i."""
        mine = self.where[self.own[i]:self.own[i + 1]]
        first, many = self.start[mine], self.start[mine + 1] - self.start[mine]
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(self.posting[at], minlength=len(self.sizes))
        return (common > 0) & (of * common >= part * (self.sizes[i] + self.sizes - common))


def block_links(names, sets: list[np.ndarray], part: int, of: int) -> list[tuple[int, int]]:
    """Links that join the sets of a block, as a spanning forest.

    Only sets not yet reached are met, so near copies cost about one look each.
    """
    postings, left, links = Postings(sets), np.ones(len(sets), bool), []
    for seed in range(len(sets)):
        waiting = [seed] if left[seed] else []
        left[seed] = False
        while waiting:
            n = int(left.sum())
            if not n:
                break
            if 2 * n <= postings.held:
                postings.keep(left)
            i = waiting.pop()
            reached = np.flatnonzero(postings.linked(i, part, of) & left)
            left[reached] = False
            links.extend((int(names[i]), int(names[j])) for j in reached)
            waiting.extend(reached)
    return links


def apart_links(names, sides, asks, sets: list[np.ndarray], part: int, of: int) -> list[tuple[int, int]]:
    """Links of asking sets with others of another side, as a spanning forest of the sides."""
    postings, others = Postings(sets), ~np.array(asks)
    side = np.unique(sides, return_inverse=True)[1]
    asking, at = np.bincount(side[~others], minlength=side.max() + 1), -1

    def partners(i: int, apart: np.ndarray) -> np.ndarray:
        nonlocal at
        if side[i] != at:
            at = side[i]
            if asking[at] > 8:       # a side of near copies would mostly meet itself
                postings.keep(others & (side != at))
            elif postings.held != others.sum():
                postings.keep(others)
        return postings.linked(i, part, of)[apart]

    return joined_sides(names, sides, asks, partners)


def _compare_body(part: int, of: int):
    """Rows sorted by (cluster, block): the links of each block's sets."""

    def links_of(key, rows) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        names, sets = zip(*rows)
        return block_links(names, [np.frombuffer(f, np.uint64) for f in sets], part, of)

    return _by_key(("cluster", "block"), ("id", "features"), links_of)


def _compare_apart_body(part: int, of: int):
    """Rows sorted by (cluster, low, high): the links of each block pair's sets that join sides."""

    def links_of(key, rows) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        names, sides, asks, sets = zip(*rows)
        return apart_links(names, sides, asks, [np.frombuffer(f, np.uint64) for f in sets], part, of)

    return _by_key(("cluster", "low", "high"), ("id", "side", "asks", "features"), links_of)


def _sent(ids: DataFrame) -> DataFrame:
    """Ids of bounded number go to the texts; more of them meet the texts in a shuffle."""
    return F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids


def _with_features(docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    met = docs.join(_sent(rows), "id").select(*rows.columns, "text")
    schema = T.StructType([*rows.schema.fields, T.StructField("features", T.BinaryType())])
    return met.mapInArrow(_features_body(size, rows.columns), schema)


def verified_links(docs: DataFrame, members: DataFrame, size: int, part: int, of: int) -> DataFrame:
    """(a, b) links that join what links inside each cluster; ``members``: (id, cluster, n)."""
    load = F.greatest(F.lit(1.0 / BLOCK_SETS), F.col("n") / BLOCK_FEATURES)
    members = members.withColumn("load", load)
    totals = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("load").alias("blocks"))
    totals = totals.where(F.col("sets") > 1).select("cluster", "sets", F.ceil("blocks").cast("int").alias("blocks"))
    wanted = join_unique(members, cut(totals, "jaccard-totals"), "cluster", "sets")
    wanted = cut(wanted.select("id", "cluster", "blocks", "load"), "jaccard-wanted")
    first = _with_features(docs, cut(_first_pass(wanted, "cluster"), "jaccard-dealt"), size)
    first = first.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "id")
    links = cut(first.mapInArrow(_compare_body(part, of), "a long, b long"), "jaccard-links")
    apart = _second_pass(wanted, "cluster", links, "jaccard-clusters")
    if apart is None:
        return links
    pairs = _in_pairs(_with_features(docs, cut(apart, "jaccard-askers"), size), "cluster", ["features"])
    return links.unionByName(pairs.mapInArrow(_compare_apart_body(part, of), "a long, b long"))


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                   part: int = 80, of: int = 100, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or none but the id), ``id``, ``n_shingles``, ``component``.

    ``component`` is the smallest id reachable by links, the row's own if it
    has none (null for a null id).
    """
    rows = packed(df, keep or [id_col], id=F.col(id_col).cast("long"), text=F.col(text_col))
    slim = cut(rows.mapInArrow(_set_body(size), row_schema(
        rows, "id long, n long, k1 long, k2 long, bits binary")), "jaccard-sets")
    nodes = slim.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = cut(nodes.groupBy("k1", "k2", "n").agg(
        F.min("id").alias("rep"), F.max("id").alias("last"), F.first("bits").alias("bits"),
        F.count(F.lit(1)).alias("w")), "jaccard-classes")
    # The rows of a class that holds very many are joined by broadcast.
    several = classes.where(F.col("rep") < F.col("last")).select(
        F.xxhash64("k1", "k2", "n").alias("key"), F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep", "w")
    keyed = nodes.select("id", "k1", "k2", F.xxhash64("k1", "k2", "n").alias("key"))
    copies = join_unique(keyed, several, "key", "w").where(
        (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("id") != F.col("rep")))
    copies = cut(copies.select(F.col("id").alias("a"), F.col("rep").alias("b")), "jaccard-copies")
    reps = classes.select(F.col("rep").alias("id"), "n", "bits")
    spare = cut(copies.select(F.col("a").alias("id")).distinct().join(reps, "id", "left_anti"), "jaccard-spare")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    docs = docs.join(_sent(spare), "id", "left_anti")
    edges = cut(candidate_edges(docs, reps, size, part, of), "jaccard-candidates")
    members = connected_components(edges).join(reps.select("id", "n"), "id").select(
        "id", F.col("component").alias("cluster"), "n")
    links = verified_links(docs, cut(members, "jaccard-members"), size, part, of)
    groups = connected_components(links.unionByName(copies))
    met = slim.join(groups, "id", "left")
    return met.select("row", "id", F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with the smallest id of every group of linked documents; rows with a null id stay."""
    out = similar_groups(df, id_col, text_col, **options)
    lost = out.where(F.col("id") != F.col("component")).select(F.col("id").alias("lost_id")).distinct()
    return df.join(lost, df[id_col].cast("long") == lost["lost_id"], "left_anti")
