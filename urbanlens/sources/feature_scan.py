"""Multi-line GeoJSON collections read by many tasks a file.

The multi-line JSON reader takes a whole document in one task.  Here the text
scan cuts a file into splits, with ``}`` as its record separator, so a split
begins behind some closing brace, which may stand inside a string.

1. One pass sums every split up for both cases, begun inside or outside a
   string: whether the quotes change that, how the nesting depth moves, its
   minimum, and whether the last array opened at the lowest depths is the
   ``features`` member.
2. The sums, one row a split, are chained per file: now each split's string
   state, depth and member are known.  A document that does not end at depth 0
   is unreadable.
3. A second pass cuts the features out.  One that lies in one split is parsed
   there; the pieces of others are grouped by the split they begin in, put
   together and parsed.  Only the declared properties are written to the
   shared folder.

Brackets, quotes and escapes of a batch are found with array operations.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.session import settings_of, written
from urbanlens.sources.readers import feature_collection_schema

if __name__ != "__main__":
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FEATURES_KEY = re.compile(rb'"features"\s*:\s*\Z')
_COMPRESSED = (".gz", ".bz2", ".zst", ".deflate", ".lz4", ".snappy")
_UNKNOWN, _OTHER, _FEATURES = -1, 0, 1
_KEY_REACH = 4_096              # bytes before an opening bracket in which its key is looked for


def _brackets(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of all brackets, +1 or -1 each, quotes before each (parity), and the parity at the end."""
    data = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(data == 34)
    slash = data == 92
    if slash.any():
        # A quote behind an odd number of backslashes is a character of its string.
        plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        before = np.where(quotes > 0, plain[quotes - 1], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    folded = data | 0x20
    at = np.flatnonzero((folded == 0x7B) | (folded == 0x7D))        # [ ] { }
    at = at[(data[at] == 0x5B) | (data[at] == 0x5D) | (data[at] == 0x7B) | (data[at] == 0x7D)]
    step = np.where(folded[at] == 0x7B, 1, -1)
    return at, step, np.searchsorted(quotes, at) & 1, len(quotes) & 1


def _opens_features(text: bytes, at: int) -> int:
    found = text[at:at + 1] == b"[" and _FEATURES_KEY.search(text[max(0, at - _KEY_REACH):at])
    return _FEATURES if found else _OTHER


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], bytes]]:
    """((file, split start, file size), text with its closing braces) for each batch and split in it."""
    for batch in batches:
        files, blocks, sizes = (batch.column(c) for c in ("file", "block", "size"))
        starts = blocks.to_numpy(zero_copy_only=False)
        codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
        values = batch.column("value").cast(pa.binary())
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield ((files[int(a)].as_py(), int(starts[a]), sizes[int(a)].as_py()),
                       b"}".join(values[int(a):int(b)].to_pylist()) + b"}")


class _Sum:
    """What a split does to the state, if it begins inside (1) or outside (0) a string."""

    def __init__(self, inside: int):
        self.inside, self.depth, self.least, self.opened = inside, 0, 0, {}

    def add(self, text: bytes, at, step, parity, flips: int) -> None:
        mine = np.flatnonzero(parity == self.inside)
        if len(mine):
            depth = self.depth + np.cumsum(step[mine])
            self.least = min(self.least, int(depth.min()))
            before = depth - step[mine]
            for level in (self.least, self.least + 1):
                opens = np.flatnonzero((step[mine] > 0) & (before == level))
                if len(opens):
                    self.opened[level] = _opens_features(text, int(at[mine[opens[-1]]]))
            self.depth = int(depth[-1])
        self.inside ^= flips

    def row(self) -> list[int]:
        return [self.inside, self.depth, self.least,
                *[self.opened.get(self.least + i, _UNKNOWN) for i in (0, 1)]]


_SUMS = ["inside", "depth", "least", "low", "next"]


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "block", "size", "bytes"] + [f"{c}{i}" for i in (0, 1) for c in _SUMS]
    held, sums, total = None, [], 0

    def row() -> pa.RecordBatch:
        values = [*held, total, *sums[0].row(), *sums[1].row()]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

    for name, text in _splits(batches):
        if name != held:
            if held is not None:
                yield row()
            held, sums, total = name, [_Sum(0), _Sum(1)], 0
        at, step, parity, flips = _brackets(text)
        total += len(text)
        for s in sums:
            s.add(text, at, step, parity, flips)
    if held is not None:
        yield row()


_SUM_SCHEMA = "file string, block long, size long, bytes long, " + ", ".join(
    f"{c}{i} long" for i in (0, 1) for c in _SUMS)


def chain(rows: list[dict]) -> tuple[dict, list[str]]:
    """(file, split) -> (inside, depth, member, split that the open feature begins in); and the unreadable files."""
    states, bad = {}, []
    files: dict[str, list[dict]] = {}
    for r in rows:
        files.setdefault(r["file"], []).append(r)
    for file, splits in files.items():
        inside, depth, member, owner, total = 0, 0, _OTHER, None, 0
        for r in sorted(splits, key=lambda r: r["block"]):
            states[(file, r["block"])] = (inside, depth, member == _FEATURES, owner)
            at, least = 1 - depth, r[f"least{inside}"]
            opened = {least: r[f"low{inside}"], least + 1: r[f"next{inside}"]}.get(at, _UNKNOWN)
            member = member if opened == _UNKNOWN else opened
            if depth + least <= 2:          # a feature that is open at the end begins here
                owner = r["block"]
            depth, inside = depth + r[f"depth{inside}"], r[f"inside{inside}"]
            total += r["bytes"]
        # The text scan drops the last separator: the text ends with a brace, or we added one.
        extra = splits[0]["size"] - total
        whole = depth in (0, -1) if file.lower().endswith(_COMPRESSED) else depth == extra
        if inside or not whole:
            bad.append(file)
    return states, bad


def _cut_out(states):
    """(file, begins, block, text): whole features (``begins`` null), and the pieces of those across splits."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = states.value
        held = None
        inside = depth = 0
        member, owner, parts, across = False, None, [], False

        def rows(found: list[tuple]) -> pa.RecordBatch:
            file, begins, block, text = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(file, pa.string()), pa.array(begins, pa.int64()), pa.array(block, pa.int64()),
                 pa.array(text, pa.binary()).cast(pa.string())], names=["file", "begins", "block", "text"])

        def rest() -> list[tuple]:
            """The piece of a feature that the split leaves open."""
            return [(held[0], owner if across else held[1], held[1], b"".join(parts))] if parts else []

        for name, text in _splits(batches):
            found = []
            if name != held:
                if held is not None:
                    found += rest()
                held = name
                if (name[0], name[1]) not in known:
                    raise RuntimeError(f"{name[0]} was split in another way than before; read it again")
                inside, depth, member, owner = known[(name[0], name[1])]
                parts, across = [], member and depth >= 3
            at, step, parity, flips = _brackets(text)
            mine = np.flatnonzero(parity == inside)
            at, step = at[mine], step[mine]
            after = depth + np.cumsum(step)
            before = after - step
            # Where members of the document open, and where objects of an array in it begin or end.
            events = np.flatnonzero(((step > 0) & (before == 1)) | ((step > 0) & (before == 2)) | ((step < 0) & (after == 2)))
            begin = 0 if parts or across else None
            for i in events.tolist():
                place, char = int(at[i]), text[at[i]:at[i] + 1]
                if step[i] > 0 and before[i] == 1:
                    member = _opens_features(text, place) == _FEATURES
                elif not member:
                    continue
                elif char == b"{":
                    begin, across, parts = place, False, []
                elif char == b"}" and begin is not None:
                    parts.append(text[begin:place + 1])
                    found.append((held[0], owner if across else None, held[1], b"".join(parts)))
                    begin, across, parts = None, False, []
            if begin is not None:
                parts.append(text[begin:])
            if len(after):
                depth = int(after[-1])
            inside ^= flips
            if found:
                yield rows(found)
        if held is not None and rest():
            yield rows(rest())

    return body


def split_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(value, file, block, size): pieces of text between closing braces, in order inside a split."""
    raw = (spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
           .text(list(paths) if not isinstance(paths, str) else paths))
    return raw.select("value", F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))


def read_features_split(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: T.StructType,
    geometry: T.DataType | None = None,
    mode: str = "FAILFAST",
    split_bytes: int | None = None,
) -> DataFrame:
    """``read_features`` with many tasks a document: one row per feature, of the declared properties.

    ``split_bytes`` is the most a task reads (Spark's own setting if None).
    A truncated document fails; with ``mode="PERMISSIVE"`` it gives no rows.
    Reads the text twice when called and writes the properties once; what the
    driver holds is one row a split.  Compressed files are one split each.
    """
    feature = feature_collection_schema(properties, geometry)["features"].dataType.elementType
    settings = {} if split_bytes is None else {"spark.sql.files.maxPartitionBytes": str(split_bytes)}
    with settings_of(spark, settings):
        sums = [r.asDict() for r in split_text(spark, paths).mapInArrow(_sum_up, _SUM_SCHEMA).collect()]
        states, bad = chain(sums)
        if bad and mode.upper() == "FAILFAST":
            raise ValueError(f"no whole FeatureCollection documents: {', '.join(sorted(bad)[:5])}")
        shared = spark.sparkContext.broadcast(states)
        cut = split_text(spark, paths).mapInArrow(_cut_out(shared), "file string, begins long, block long, text string")
        if bad:
            cut = cut.where(~F.col("file").isin(bad))
        whole = F.col("begins").isNull()

        def parsed(text):
            return F.from_json(text, feature, {"mode": mode})

        rows = written(cut.select(F.when(whole, parsed(F.col("text"))).alias("feature"), "file", "begins", "block",
                                  F.when(~whole, F.col("text")).alias("text")), "features")
    pieces = rows.where(~whole).groupBy("file", "begins").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("pieces"))
    joined = pieces.select(parsed(F.array_join(F.col("pieces.text"), "")).alias("feature"))
    return rows.where(whole).select("feature").unionByName(joined).select("feature.*")
