"""Repeated passages removed, by longest-previous-factor arrays over a suffix order.

A passage is repeated if ``min_bytes`` of its bytes stand at another place too,
in the same or any other text.  ``keep="first"`` removes every later copy,
``keep="none"`` all copies, the first included.  Overlaps count, and all is
judged on the input, not on what is left.

The suffixes that have a partner are few, so the order is built of those alone:

1. Each window of ``min_bytes`` belongs to a run of windows with one anchor
   (``repeat_runs``); equal windows have equal anchors.  Spark counts the
   anchors' hashes; a filter of the repeated ones, of bounded size
   (``split_filter``), goes to every task, and a second pass writes the runs
   that pass it as (text, start, anchor, hash of the context).
2. Runs with equal contexts are one class, with its number and its first place
   in text order.  All windows of a class of two or more are repeated.
3. Contexts that share an anchor but differ may share some windows.  One
   context a class, found by its place in one more pass, is shuffled by its
   anchor.  Tasks take anchors in blocks of bounded size, put the windows into
   suffix order and make the array of longest previous factors from the
   previous and next smaller positions in that order; the same array over the
   positions in reverse gives later copies.
4. An anchor with more than ``max_kinds`` contexts never goes to one task.  Its
   runs are halved by the windows' distance from the anchor and regrouped by
   the bytes that all windows of a half share: contexts without a partner
   drop out, equal ones become one, until groups are small.  At single windows
   a group is a class, and Spark has counted it.
5. The found ranges meet their runs by class, and texts by row; a function
   joins a text's ranges and cuts its bytes.

Groups only decide what is compared where; all comparisons are of bytes, but
for contexts held equal by 128 bits of hash.

Defined results: null text is empty; matches never cross texts; rows with the
same id are separate texts, so they are copies if equal; a null id stands
before all others; texts of equal ids stand in the order of a hash.  A cut may
leave a part of a character, so ``kept`` is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.llm.repeat_runs import piece_runs, pieces, shape, text_runs
from urbanlens.llm.split_filter import SplitFilter, build
from urbanlens.llm.common import cut, join_unique, packed, text_of
from urbanlens.llm.previous_factor import SuffixOrder, longest_previous

MIN_BYTES = 200
MAX_KINDS = 2_048               # contexts of one anchor that one task compares
BLOCK_BYTES = 1 << 20           # of contexts compared at once

_RUN = "id long, k long, h long, start int, windows int, times int, place int, anchor long, context long"


def _anchors(min_bytes: int):
    """Distinct anchor hashes of a batch, marked if met twice in it."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [piece_runs(data, first, last, min_bytes)[3] for _, _, data, first, last
                     in pieces(text_of(batch, "text"), min_bytes)]
            if found:
                anchors, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(counts > 1)], names=["h", "again"])

    return body


def _runs(shared, parts: int, min_bytes: int):
    """The runs of repeated anchors; neighbours with equal contexts are one row with ``times``."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = SplitFilter(shared.value, parts).has
        for batch in batches:
            ids = [batch.column(c) for c in ("id", "k", "h")]
            for row, start, windows, place, anchor, context in text_runs(text_of(batch, "text"), min_bytes, wanted):
                if not len(row):
                    continue
                same = ((row[1:] == row[:-1]) & (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
                        & (windows[1:] == windows[:-1]) & (start[1:] == start[:-1] + windows[:-1]))
                head = np.flatnonzero(np.concatenate([[True], ~same]))
                times = np.diff(np.append(head, len(row)))
                at = pa.array(row[head])
                yield pa.RecordBatch.from_arrays(
                    [c.take(at) for c in ids] + [pa.array(x[head], pa.int32()) for x in (start, windows)]
                    + [pa.array(times, pa.int32()), pa.array(place[head], pa.int32()), pa.array(anchor[head]),
                       pa.array(context[head])],
                    names=[f.split()[0] for f in _RUN.split(", ")])

    return body


def _place_hash(k: np.ndarray, h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the places of runs."""
    x = k.astype(np.int64).view(np.uint64) ^ (start.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + h.astype(np.int64).view(np.uint64)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _place_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k, h, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "h", "start"))
        yield pa.RecordBatch.from_arrays([pa.array(_place_hash(k, h, start))], names=["h"])


def _contexts(shared, parts: int, min_bytes: int):
    """The bytes of the runs whose places pass the filter."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = SplitFilter(shared.value, parts)
        for batch in batches:
            ks, hs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "h"))
            for rows, base, data, first, last in pieces(text_of(batch, "text"), min_bytes):
                start, windows, _, _ = piece_runs(data, first, last, min_bytes)
                at = np.searchsorted(first, start, "right") - 1
                row, inside = rows[at], start - first[at] + base[at]
                some = np.flatnonzero(known.has(_place_hash(ks[row], hs[row], inside)))
                if len(some):
                    ends = start[some] + windows[some] + (min_bytes - 1)
                    texts = [data[s:e].tobytes() for s, e in zip(start[some], ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ks[row[some]]), pa.array(hs[row[some]]), pa.array(inside[some], pa.int32()),
                         pa.array(texts, pa.binary())], names=["k", "h", "start", "text"])

    return body


def _ranges(flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true flags inside consecutive segments of ``sizes``: (segment, first, end) by place in the segment."""
    ends = np.cumsum(sizes)
    edge = np.zeros(len(flags) + 1, bool)
    edge[0] = edge[-1] = True
    edge[ends] = True
    before = np.concatenate([[False], flags[:-1]])
    low = np.flatnonzero(flags & (~before | edge[:-1]))
    after = np.concatenate([flags[1:], [False]])
    high = np.flatnonzero(flags & (~after | edge[1:])) + 1
    segment = np.searchsorted(ends, low, "right")
    base = ends[segment] - sizes[segment]
    return segment, low - base, high - base


def _compare_block(block: pa.Table, min_bytes: int, keep: str) -> pa.RecordBatch:
    """The windows of the contexts of whole groups that have an earlier (or any) copy in the block."""
    texts = block.column("text").combine_chunks()
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    low, high, n, k, start = (block.column(c).to_numpy() for c in ("lo", "hi", "n", "k", "start"))
    length = pc.binary_length(texts).to_numpy()
    sizes = (high - low).astype(np.int64)
    offsets = np.cumsum(length) - length
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    starts = np.repeat(offsets + low, sizes) + place
    ids = block.column("id")
    order = np.lexsort((start + low, k, pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy()))
    base = np.empty(len(order), np.int64)
    base[order] = np.cumsum(sizes[order]) - sizes[order]
    position = np.repeat(base, sizes) + place
    suffixes = SuffixOrder(data, starts, min_bytes)
    found = longest_previous(suffixes, position) >= min_bytes
    if keep == "none":
        found |= longest_previous(suffixes, -position) >= min_bytes
        found &= np.repeat(n == 1, sizes)       # the others are whole already
    segment, begin, end = _ranges(found, sizes)
    at = pa.array(segment)
    return pa.RecordBatch.from_arrays(
        [block.column(c).combine_chunks().take(at) for c in ("anchor", "context")]
        + [pa.array(begin + low[segment], pa.int32()), pa.array(end + low[segment], pa.int32())],
        names=["anchor", "context", "lo", "hi"])


def _compare(min_bytes: int, keep: str, block_bytes: int):
    """Blocks of whole groups, from rows sorted by group."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def blocks(rows: pa.Table, last: bool):
            """Whole blocks of ``rows``, and what is left of them."""
            groups = rows.column("grp").to_numpy()
            cuts = np.flatnonzero(groups[1:] != groups[:-1]) + 1
            ends = np.append(cuts, len(groups)) if last else cuts
            size = np.cumsum(pc.binary_length(rows.column("text")).to_numpy())
            done = 0
            while len(ends):
                over = size - (size[done - 1] if done else 0) > block_bytes
                fit = ends[~over[ends - 1]]
                if not last and len(fit) == len(ends):
                    break                   # the block isn't full yet
                end = int(fit[-1]) if len(fit) else int(ends[0])
                yield rows.slice(done, end - done)
                done, ends = end, ends[ends > end]
            left.append(rows.slice(done))

        left: list[pa.Table] = []
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            for block in blocks(held, False):
                yield _compare_block(block, min_bytes, keep)
            held = left.pop().combine_chunks()
        if held is not None and held.num_rows:
            for block in blocks(held, True):
                yield _compare_block(block, min_bytes, keep)

    return body


def _halve(width: int, min_bytes: int):
    """Each run's windows by their distance from the anchor, ``width`` distances a group."""
    span, _ = shape(min_bytes)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, lows, highs, groups, wholes = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "lo", "hi", "place", "text"))
            for i, (anchor, lo, hi, place, text) in enumerate(zip(*columns)):
                shift = place - (span - 1)      # from distance to place in the context
                for cell in range((lo - shift) // width, (hi - 1 - shift) // width + 1):
                    one, two = cell * width + shift, (cell + 1) * width + shift
                    mine, end = max(lo, one), min(hi, two)
                    at.append(i)
                    lows.append(mine)
                    highs.append(end)
                    groups.append(xxhash.xxh3_64_intdigest(text[two - 1:one + min_bytes], (anchor ^ cell) & (1 << 64) - 1))
                    wholes.append(xxhash.xxh3_128_digest(text[mine:end - 1 + min_bytes], mine - shift))
            if at:
                rows = batch.select(["anchor", "context", "n", "id", "k", "start", "place", "text"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    rows.columns + [pa.array(lows, pa.int32()), pa.array(highs, pa.int32()),
                                    pa.array(np.array(groups, np.uint64).view(np.int64)), pa.array(wholes, pa.binary())],
                    names=rows.schema.names + ["lo", "hi", "grp", "whole"])

    return body


_MARK = "anchor long, context long, lo int, hi int"
_PART = ("anchor long, context long, n long, id long, k long, start int, place int, text binary, "
         "lo int, hi int, grp long, whole binary")


def _compare_all(contexts: DataFrame, min_bytes: int, keep: str, max_kinds: int, block_bytes: int) -> DataFrame:
    """(anchor, context, lo, hi): windows of the contexts with an earlier (or any) copy in another context."""
    span, _ = shape(min_bytes)
    max_kinds = max(min(max_kinds, ((1 << 21) - 1) // (min_bytes + span)), 1)
    marks, width = [], span
    while True:
        few = contexts.where(F.col("kinds") <= max_kinds)
        few = few.select("grp", "anchor", "context", "lo", "hi", "n", "id", "k", "start", "text")
        marks.append(few.repartition("grp").sortWithinPartitions("grp")
                     .mapInArrow(_compare(min_bytes, keep, block_bytes), _MARK))
        hot = contexts.where(F.col("kinds") > max_kinds)
        if width == 1 or hot.isEmpty():
            break
        width //= 2
        parts = cut(hot.mapInArrow(_halve(width, min_bytes), _PART), "suffix-parts")
        place = F.struct("id", "k", "start")
        parts = parts.withColumn("key", F.struct("grp", "whole"))
        classes = parts.groupBy("key").agg(F.sum("n").alias("all"), F.min(place).alias("first"),
                                           F.count(F.lit(1)).alias("w")).withColumn("grp", F.col("key.grp"))
        classes = cut(classes, "suffix-classes")
        kinds = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("kinds"))
        known = join_unique(classes, kinds.withColumn("weight", F.col("kinds")), "grp", "weight").drop("grp")
        known = known.where((F.col("all") > 1) | (F.col("kinds") > 1))
        met = cut(join_unique(parts, known, "key", "w").withColumn("leads", place.eqNullSafe(F.col("first"))), "suffix-halves")
        whole = (F.col("all") > 1) if keep == "none" else ~F.col("leads")
        marks.append(met.where(whole).select("anchor", "context", "lo", "hi"))
        contexts = met.where(F.col("leads") & (F.col("kinds") > 1)).withColumn("n", F.col("all"))
    out = marks[0]
    for more in marks[1:]:
        out = out.unionByName(more)
    return out


def repeated_spans(documents: DataFrame, min_bytes: int = MIN_BYTES, keep: str = "first",
                   max_kinds: int = MAX_KINDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(k, h, spans): byte ranges (lo, hi) to remove from each text of ``documents`` (id, k, h, text).

    ``k`` and ``h`` are two hashes of id and text that name a row.  Ranges may overlap.
    """
    spark = documents.sparkSession
    seen = documents.select("text").mapInArrow(_anchors(min_bytes), "h long, again boolean")
    repeated = cut(seen.groupBy("h").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n"))
                   .where(F.col("n") > 1).select("h"), "suffix-anchors")
    data, parts = build(repeated, repeated.count())
    shared = spark.sparkContext.broadcast(data)
    runs = cut(documents.mapInArrow(_runs(shared, parts, min_bytes), _RUN), "suffix-runs")
    shared.unpersist()

    place = F.struct("id", "k", "start")
    classes = runs.groupBy("anchor", "context").agg(
        F.sum("times").alias("n"), F.count(F.lit(1)).alias("w"), F.max("times").alias("times"),
        F.min(F.struct("id", "k", "start", "h", "windows", "place")).alias("first"))
    classes = cut(classes.withColumn("key", F.struct("anchor", "context")), "suffix-classes")
    kinds = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
    mixed = join_unique(classes, kinds.withColumn("weight", F.col("kinds")), "anchor", "weight")
    mixed = cut(mixed.select("anchor", "context", "n", "kinds", "first.*"), "suffix-mixed")

    data, parts = build(mixed.select("k", "h", "start").mapInArrow(_place_hashes, "h long"), mixed.count())
    shared = spark.sparkContext.broadcast(data)
    texts = documents.mapInArrow(_contexts(shared, parts, min_bytes), "k long, h long, start int, text binary")
    # Rows with equal ids and texts give their contexts twice.
    contexts = mixed.join(texts.dropDuplicates(["k", "h", "start"]), ["k", "h", "start"])
    contexts = cut(contexts.select("anchor", "context", "n", "kinds", "id", "k", "start", "place", "text", F.lit(0).alias("lo"),
                                   F.col("windows").alias("hi"), F.col("anchor").alias("grp")), "suffix-contexts")
    shared.unpersist()
    marks = _compare_all(contexts, min_bytes, keep, max_kinds, block_bytes)
    marks = marks.groupBy("anchor", "context").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))

    # What each class gives to its runs: whole windows, or some ranges of them.
    whole = classes.where(F.col("n") > 1).select(
        "key", "w", F.struct("first.id", "first.k", "first.start").alias("first"), F.lit(None).cast("array<struct<lo:int,hi:int>>").alias("ranges"))
    some = marks.join(classes, ["anchor", "context"]).select("key", "w", F.struct("first.id", "first.k", "first.start").alias("first"), "ranges")
    both = whole.unionByName(some).groupBy("key").agg(
        F.max("w").alias("w"), F.max("first").alias("first"), F.max("ranges").alias("ranges"),
        F.max(F.col("ranges").isNull()).alias("whole"))
    both = cut(both, "suffix-marks")
    met = join_unique(runs.select("k", "h", "id", "start", "windows", "times", F.struct("anchor", "context").alias("key")),
                      both, "key", "w")
    every = F.struct(F.col("start").alias("lo"), (F.col("start") + F.col("windows") * F.col("times")).alias("hi"))
    later = F.struct((F.col("start") + F.col("windows")).alias("lo"), every["hi"].alias("hi"))
    leads = place.eqNullSafe(F.col("first"))
    ranges = F.coalesce(F.transform("ranges", lambda r: F.struct((F.col("start") + r["lo"]).alias("lo"),
                                                                 (F.col("start") + r["hi"]).alias("hi"))), F.array())
    if keep == "none":
        got = F.when(F.col("whole"), F.array(every)).otherwise(ranges)
    else:
        got = F.when(~F.col("whole"), ranges).when(~leads, F.array(every)).when(
            F.col("times") > 1, F.concat(F.array(later), ranges)).otherwise(ranges)
    spans = met.select("k", "h", F.explode(got).alias("r"))
    # Windows lo..hi-1 cover the bytes up to hi - 1 + min_bytes.
    spans = spans.select("k", "h", F.struct(F.col("r.lo").alias("lo"), (F.col("r.hi") + (min_bytes - 1)).alias("hi")).alias("r"))
    return spans.groupBy("k", "h").agg(F.collect_list("r").alias("spans"))


_SPAN = T.StructType([T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])


@F.arrow_udf(T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("removed", T.LongType()),
                           T.StructField("spans", T.ArrayType(_SPAN))]))
def _cut_bytes(text: pa.Array, spans: pa.Array) -> pa.Array:
    kept, removed, merged = [], [], []
    for t, found in zip(text.cast(pa.binary()), spans):
        if not t.is_valid:
            kept.append(None)
            removed.append(None)
            merged.append(None)
            continue
        t = t.as_buffer()
        lo, hi = (found.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        order = np.argsort(lo, kind="stable")
        lo, reach = lo[order], np.maximum.accumulate(hi[order])
        head = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
        begin, end = lo[head].tolist(), reach[np.append(head[1:], len(lo)) - 1].tolist()
        view = memoryview(t)
        kept.append(b"".join(view[a:b] for a, b in zip([0, *end], [*begin, len(view)])))
        removed.append(sum(end) - sum(begin))
        merged.append([{"lo": a, "hi": b} for a, b in zip(begin, end)])
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.binary()), pa.array(removed, pa.int64()),
         pa.array(merged, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))], names=["kept", "removed", "spans"])


def dedup_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES,
                   keep: str = "first", columns: list[str] | None = None, max_kinds: int = MAX_KINDS,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (the ``columns`` of ``df``, or all), ``id``, ``kept`` bytes, ``n_bytes``, ``n_removed`` and removed ``spans``.

    ``keep`` is ``first`` (later copies go) or ``none`` (all copies go).  Rows
    equal in id and text are told apart by nothing: with ``first`` they are one
    text and lose the same.
    """
    if keep not in ("first", "none") or min_bytes < 1:
        raise ValueError("keep is 'first' or 'none', min_bytes at least 1")
    rows = packed(df, columns, id=F.col(f"`{id_col}`").cast("long"), text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = rows.withColumns({"k": F.xxhash64("id", "text"), "h": F.xxhash64("text", F.lit(1))})
    spans = repeated_spans(rows.select("id", "k", "h", "text"), min_bytes, keep, max_kinds, block_bytes)
    met = rows.join(spans, ["k", "h"], "left")
    lost = F.col("spans").isNotNull()
    met = met.withColumn("out", _cut_bytes(F.when(lost, F.col("text")), F.col("spans")))
    return met.select("row", "id", F.coalesce("out.kept", F.col("text").cast("binary")).alias("kept"),
                      F.octet_length("text").cast("long").alias("n_bytes"),
                      F.coalesce("out.removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("out.spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
