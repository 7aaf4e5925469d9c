"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine, components.

Vectors are compared only inside their group (label), and only with vectors
of the same length.  Each of ``tables`` hash tables signs a vector by
``bits`` random hyperplanes; vectors of one group with the same signature in
some table meet in a bucket, and are compared by exact cosine in double
precision.

For a cosine c two signs agree with probability p = 1 - arccos(c)/pi, so a
pair at the threshold is found with probability 1 - (1 - p^bits)^tables; the
number of tables is chosen to make that at least ``recall`` (0.999 by
default).  Pairs above the threshold are found more often still.  ``bits``
follows the largest group (:func:`bits_for`), so that strangers in a bucket
stay few at any size of the input, at the same recall.

The signs of all tables together are a sketch of the vector.  Buckets are met
by the sketches alone: a pair whose sketches differ in more places than a pair
at the threshold does (but for one in ``1 / SKETCH_LOSS``) is dropped, and so
is one that met in an earlier table.  Vectors are sent only for what is left,
so a pair is compared in one table and ``n_links`` counts it once.

Equal vectors (by 128 bits of hash) are one class with a count, so copies are
never compared.  A bucket of classes is compared in blocks of at most
``BLOCK`` rows; each pair of blocks is a task's group of its own.  Only links
that join two parts of a block leave a task.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite values, and vectors without a group, link with nothing; rows with
a null id come back unlinked (component null); rows with the same id are one
node of the graph, each with the links of its own vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import cut, join_unique, packed
from urbanlens.llm.components import connected_components
from urbanlens.llm.partenum import Forest

THRESHOLD = 0.98
RECALL = 0.999
BLOCK = 1024
SEED = 20
STRANGERS = 64                  # expected in a bucket of the largest group, at most
SMALL = 32                      # buckets up to this size are met by their rows' distances
SKETCH_LOSS = 1e-6              # of pairs at the threshold
_BUCKET = ["label", "dims", "tab", "sign"]
_GROUP = [*_BUCKET, "low", "high"]
_CLASS = ["k1", "k2"]


def table_count(threshold: float, bits: int, recall: float) -> int:
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def bits_for(largest: int) -> int:
    """Signs of a table, whole bytes: 2^bits buckets hold ``STRANGERS`` of the largest group each, at most."""
    return max(16, 8 * math.ceil(math.log2(max(largest, 1) / STRANGERS) / 8)) if largest > STRANGERS else 16


def sketch_limit(threshold: float, signs: int) -> int:
    """Most places in which two sketches differ, for all pairs at the threshold but ``SKETCH_LOSS``."""
    q = math.acos(threshold) / math.pi
    below, limit = 0.0, -1
    while below < 1 - SKETCH_LOSS and limit < signs:
        limit += 1
        below += math.comb(signs, limit) * q ** limit * (1 - q) ** (signs - limit)
    return limit


def _sign_body(bits: int, tables: int):
    """The signs of all tables as bytes, each table's ``bits / 8`` in a row."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("dims").to_numpy(zero_copy_only=False)
            vectors = batch.column("vector")
            out: list = [None] * len(sizes)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, int(d)]).normal(size=(int(d), bits * tables))
                matrix = _matrix(vectors.take(pa.array(at)), int(d))
                matrix /= np.abs(matrix).max(axis=1, keepdims=True)       # no overflow; signs stay
                for i, row in zip(at, np.packbits(matrix @ planes[d] >= 0, axis=1)):
                    out[i] = row.tobytes()
            kept = [c for c in batch.schema.names if c != "vector"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.binary())],
                                             names=[*kept, "signs"])

    return body


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows with every group whole, and the bounds of the groups."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        new = np.zeros(batch.num_rows - 1, bool)
        for c in keys:
            column = batch.column(c)
            new |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new) + 1
        if len(starts):
            yield batch.slice(0, starts[-1]), np.concatenate([[0], starts])
            batch = batch.slice(starts[-1])
        held = batch
    if held is not None:
        yield held, np.array([0, held.num_rows])


def _sketches(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes, and each table's signature as a number."""
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    parts = data.reshape(len(column), -1, width).astype(np.int64)
    return data, (parts << (8 * np.arange(width))).sum(axis=2)


def _met_before(codes: np.ndarray, table: int) -> np.ndarray:
    """Whether two rows of a group share a table before ``table``, for all pairs."""
    before = np.zeros((len(codes), len(codes)), bool)
    for t in range(table):
        before |= codes[:, None, t] == codes[None, :, t]
    return before


def partners(data, codes, side, table, cross, bounds, limit: int) -> np.ndarray:
    """Which rows have a row of their group, first met in this table, within ``limit`` signs."""
    out = np.zeros(len(data), bool)
    sizes = np.diff(bounds)
    group = np.repeat(np.arange(len(sizes)), sizes)
    group[np.repeat(sizes > SMALL, sizes)] = -1
    for step in range(1, min(SMALL, int(sizes.max()))):
        i = np.flatnonzero((group[step:] == group[:-step]) & (group[step:] >= 0))
        j = i + step
        far = np.bitwise_count(data[i] ^ data[j]).sum(axis=1, dtype=np.int64)
        before = ((codes[i] == codes[j]) & (np.arange(codes.shape[1]) < table[i][:, None])).any(axis=1)
        fit = (far <= limit) & ~before & (~cross[i] | (side[i] != side[j]))
        out[i[fit]] = True
        out[j[fit]] = True
    for k in np.flatnonzero(sizes > SMALL):
        a, b = bounds[k], bounds[k + 1]
        signs = np.unpackbits(data[a:b], axis=1).astype(np.float32) * 2 - 1
        fit = signs @ signs.T >= signs.shape[1] - 2 * limit
        np.fill_diagonal(fit, False)
        if cross[a]:
            fit &= side[a:b, None] != side[None, a:b]
        out[a:b] = (fit & ~_met_before(codes[a:b], int(table[a]))).any(axis=1)
    return out


def _meet_body(width: int, limit: int):
    """Of rows sorted by group, those with a partner."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, _GROUP):
            data, codes = _sketches(rows.column("signs"), width)
            side, table, low, high = [rows.column(c).to_numpy() for c in ("block", "tab", "low", "high")]
            kept = partners(data, codes, side, table, low != high, bounds, limit)
            if kept.any():
                yield rows.filter(pa.array(kept))

    return body


def block_links(unit, codes, side, count, table: int, threshold: float, cross: bool):
    """Other vectors linked with each row, and a spanning forest of the links (row numbers)."""
    n = len(unit)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    if cross:
        linked &= side[:, None] != side[None, :]
    linked &= ~_met_before(codes, table)
    found = linked @ count
    forest, edges = Forest(n), []
    for i, j in zip(*np.nonzero(np.triu(linked))):
        if forest.join(int(i), int(j)):
            edges.append((int(i), int(j)))
    return found, edges


def _compare_body(threshold: float, width: int):
    """Rows sorted by group: (k1, k2, links) for counts, (rep, other) for edges, the rest null."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, _GROUP):
            _, codes = _sketches(rows.column("signs"), width)
            side, table, low, high, count, dims, k1, k2, rep = [rows.column(c).to_numpy() for c in (
                "block", "tab", "low", "high", "copies", "dims", "k1", "k2", "rep")]
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                unit = _unit(_matrix(rows.column("vector").slice(a, b - a), int(dims[a])))
                found, edges = block_links(unit, codes[a:b], side[a:b], count[a:b], int(table[a]), threshold,
                                           low[a] != high[a])
                out += [(k1[a + i], k2[a + i], None, found[i], None) for i in np.flatnonzero(found)]
                out += [(None, None, rep[a + i], None, rep[a + j]) for i, j in edges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 names=["k1", "k2", "rep", "links", "other"])

    return body


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
                    threshold: float = THRESHOLD, bits: int | None = None, recall: float = RECALL,
                    keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or the id), ``id``, ``n_links``, ``component``.

    ``bits`` (a multiple of 8) is the signs of a table; if not given, it follows the largest group.
    """
    narrow = dict(df.dtypes)[vector_col] == "array<float>"        # sent as they are, compared in doubles
    rows = packed(df, keep or [id_col], id=F.col(id_col).cast("long"),
                  vector=F.col(vector_col).cast("array<float>" if narrow else "array<double>"),
                  label=F.col(group_col).cast("string"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
              & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable").withColumn("k1", F.xxhash64("label", "vector")).withColumn(
        "k2", F.xxhash64(F.lit(SEED), "label", "vector"))
    classes = good.groupBy("label", "vector", *_CLASS).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.withColumn("dims", F.size("vector")), "vec-classes")
    if bits is None:
        groups = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n"))
        bits = bits_for(groups.agg(F.max("n").alias("n")).first()["n"] or 0)
    tables, width = table_count(threshold, bits, recall), bits // 8
    signed = cut(classes.select(*_CLASS, "rep", "label", "dims", "vector").mapInArrow(
        _sign_body(bits, tables), "k1 long, k2 long, rep long, label string, dims int, signs binary"), "vec-signs")

    slots = signed.withColumn("tab", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))))
    slots = slots.withColumn("sign", F.substring("signs", F.col("tab") * width + 1, F.lit(width)))
    slots = slots.select(F.struct(*_BUCKET).alias("bucket"), *_CLASS, "rep", "signs")
    sizes = cut(slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "vec-buckets")
    members = join_unique(slots, sizes, "bucket", "n")
    members = members.withColumn("block", F.pmod("k1", "blocks").cast("int")).withColumn(
        "beside", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("bucket.*", F.least("block", "beside").alias("low"),
                             F.greatest("block", "beside").alias("high"), "block", *_CLASS, "rep", "signs")
    sorted_ = members.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    met = cut(sorted_.mapInArrow(_meet_body(width, sketch_limit(threshold, bits * tables)), members.schema), "vec-met")

    sent = met.join(classes.select(*_CLASS, "copies", "vector"), _CLASS)
    found = cut(sent.repartition(*_GROUP).sortWithinPartitions(*_GROUP, *_CLASS).mapInArrow(
        _compare_body(threshold, width), "k1 long, k2 long, rep long, links long, other long"), "vec-links")

    counts = found.where(F.col("links").isNotNull()).groupBy(*_CLASS).agg(F.sum("links").alias("links"))
    groups = connected_components(found.where(F.col("other").isNotNull()), "rep", "other")
    known = cut(classes.select(*_CLASS, "rep", "copies").join(counts, _CLASS, "left")
                .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
                .select(F.struct(*_CLASS).alias("key"), "copies",
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component")), "vec-known")
    linked = join_unique(good.select("row", "id", F.struct(*_CLASS).alias("key")), known, "key", "copies")
    alone = rows.where(~F.col("usable")).select("row", "id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("id").alias("component"))
    return linked.select("row", "id", F.col("n_links").cast("long").alias("n_links"), "component").unionByName(alone)
