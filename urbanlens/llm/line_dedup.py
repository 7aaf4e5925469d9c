"""Line deduplication with two Bloom filters; repeats confirmed exactly.

A line's key is the line without white space at its ends, A-Z lower-cased.
A key of at least ``min_chars`` code points that stands in two or more
documents loses all its lines, except in the document with the smallest id.

1. Each task reduces its documents to distinct 64-bit key hashes with a mark
   for those it met in two documents.
2. The hashes (8 bytes each) go to the task that owns their segment of the
   *once-seen* filter.  A hash already there (or marked) is suspected and
   passed on, whatever was passed on before it; Spark makes these distinct.
3. The suspected hashes build the global *twice-seen* filter.  Its size follows
   their number up to ``max_filter_bits``, a fixed bound, so it can be sent to
   every task.  Beyond that it only lets more lines through to step 4.
4. Only lines that pass the filter shuffle, as (document, key): exact smallest
   and largest document per key, pre-aggregated in each task.  Keys of very
   many documents are joined by broadcast (``common.join_unique``).
5. Documents meet the list of keys they lose by document id.

Filters only ever choose what is checked; results don't depend on them.

Defined results: null or empty text is one empty line; a null id is never
counted and loses no line; rows with the same id are one document, and each
row loses the same keys; repeated lines inside one document alone all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens.llm.common import cut, join_unique, packed, text_of, unpacked

MIN_CHARS = 10
BITS_PER_KEY = 16
SEGMENT_BITS = 1 << 22          # of the once-seen filter, one owner task each
MAX_FILTER_BITS = 1 << 28       # of the broadcast twice-seen filter: 32 MB
PROBES = 4
_BUFFER = 1 << 20               # hashes held by a task before they are reduced


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\r\x0b\x0c").lower()   # bytes.lower(): A-Z only


def long_enough(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= min_chars


def document_keys(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if long_enough(k, min_chars)}


class Bloom:
    """A filter over 64-bit hashes; ``bits`` is a power of two."""

    def __init__(self, bits: int, data: bytes | None = None):
        self.mask = np.uint64(bits - 1)
        self.bytes = np.zeros(bits >> 3, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(17)) | np.uint64(1)
        mixed = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return (mixed[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        at = self._at(hashes).ravel()
        np.bitwise_or.at(self.bytes, (at >> np.uint64(3)).astype(np.int64),
                         (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self._at(hashes)
        got = self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
        return (got & 1).all(axis=1)


def _power_of_two(n: int, least: int, most: int) -> int:
    return min(max(1 << max(n - 1, 1).bit_length(), least), most)


def _task_hashes(min_chars: int):
    """Distinct key hashes of a task's documents, marked if in two of them."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []

        def reduced() -> pa.RecordBatch:
            hashes, counts = np.unique(np.array(held, np.uint64), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts > 1)], names=["h", "again"])

        for batch in batches:
            for text in text_of(batch, "text").to_pylist():
                held.extend(xxhash.xxh3_64_intdigest(k) for k in document_keys(text, min_chars))
                if len(held) >= _BUFFER:
                    yield reduced()
        if held:
            yield reduced()

    return body


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment: hashes that the once-seen filter has met before, once a batch.

    Rows come sorted by segment, so a task holds one segment's filter at a time.
    """
    current, once = None, None
    for batch in batches:
        segments, hashes, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("segment", "h", "again"))
        out = []
        for segment in np.unique(segments):
            if segment != current:
                current, once = segment, Bloom(SEGMENT_BITS)
            here = segments == segment
            found, where, counts = np.unique(hashes[here].view(np.uint64), return_inverse=True, return_counts=True)
            again = (counts > 1) | (np.bincount(where, marks[here]) > 0) | once.has(found)
            once.add(found)
            out.append(found[again])
        passed = np.concatenate(out) if out else np.empty(0, np.uint64)
        if len(passed):
            yield pa.RecordBatch.from_arrays([pa.array(passed.view(np.int64))], names=["h"])


def _filter_parts(bits: int, part_bits: int):
    """Bytes of each part of the twice-seen filter that a task's hashes set."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Bloom(bits)
        for batch in batches:
            whole.add(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
        size = part_bits >> 3
        parts = [(i, whole.bytes[i * size:(i + 1) * size]) for i in range(bits // part_bits)]
        parts = [(i, p.tobytes()) for i, p in parts if p.any()]
        if parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())],
                names=["part", "bits"])

    return body


def _joined_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitwise or of each part's rows, which come sorted by part."""
    part, held = None, np.empty(0, np.uint8)

    def joined() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([held.tobytes()], pa.binary())],
                                          names=["part", "bits"])

    for batch in batches:
        for number, bits in zip(batch.column("part").to_pylist(), batch.column("bits")):
            mine = np.frombuffer(bits.as_buffer(), np.uint8)
            if number == part:
                held |= mine
            else:
                if part is not None:
                    yield joined()
                part, held = number, mine.copy()
    if part is not None:
        yield joined()


def twice_filter(documents: DataFrame, min_chars: int, max_filter_bits: int) -> tuple[int, bytes]:
    """The twice-seen filter of ``documents`` (id, text): its bits and bytes."""
    hashes = cut(documents.select("text").mapInArrow(_task_hashes(min_chars), "h long, again boolean"), "line-hashes")
    segments = max(1, -(-hashes.count() * BITS_PER_KEY // SEGMENT_BITS))
    # Half of a filter's bits stay clear at two keys in three of its room.
    owned = hashes.withColumn("segment", F.pmod(F.shiftright("h", 40), F.lit(2 * segments)))
    suspects = cut(owned.repartition("segment").sortWithinPartitions("segment").mapInArrow(_suspects, "h long").distinct(), "line-suspects")
    bits = _power_of_two(suspects.count() * BITS_PER_KEY, 1 << 12, max_filter_bits)
    # One partial filter a core; Spark joins the parts, so the driver gets each bit once.
    built = bytearray(bits >> 3)
    part_bits = min(bits, 1 << 23)
    cores = max(1, documents.sparkSession.sparkContext.defaultParallelism)
    parts = suspects.coalesce(cores).mapInArrow(_filter_parts(bits, part_bits), "part int, bits binary")
    parts = parts.repartition("part").sortWithinPartitions("part").mapInArrow(_joined_parts, "part int, bits binary")
    for row in parts.toLocalIterator():
        at = row["part"] * (part_bits >> 3)
        built[at:at + len(row["bits"])] = row["bits"]
    return bits, bytes(built)


def _suspected_lines(shared, bits: int, min_chars: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = Bloom(bits, shared.value)
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column("id").to_pylist(), text_of(batch, "text").to_pylist()):
                mine = list(document_keys(text, min_chars))
                if mine:
                    got = twice.has(np.array([xxhash.xxh3_64_intdigest(k) for k in mine], np.uint64))
                    for i in np.flatnonzero(got):
                        ids.append(doc_id)
                        keys.append(mine[i])
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()).cast(pa.string())], names=["id", "key"])

    return body


def lost_keys(documents: DataFrame, min_chars: int = MIN_CHARS,
              max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(id, keys): the line keys each document of ``documents`` (id, text) loses."""
    spark = documents.sparkSession
    known = documents.where(F.col("id").isNotNull())
    bits, data = twice_filter(known, min_chars, max_filter_bits)
    shared = spark.sparkContext.broadcast(data)
    suspected = cut(known.mapInArrow(_suspected_lines(shared, bits, min_chars), "id long, key string"), "line-keys")
    shared.unpersist()
    repeated = cut(suspected.groupBy("key").agg(F.min("id").alias("keeper"), F.max("id").alias("last"),
                                                F.count(F.lit(1)).alias("n"))
                   .where(F.col("keeper") < F.col("last")).drop("last"), "line-repeats")
    lost = join_unique(suspected, repeated, "key", "n").where(F.col("id") != F.col("keeper"))
    return lost.groupBy("id").agg(F.collect_set("key").alias("keys"))


@F.arrow_udf(T.StructType([T.StructField("kept", T.StringType()), T.StructField("dropped", T.LongType())]))
def _drop(text: pa.Array, keys: pa.Array) -> pa.Array:
    kept, dropped = [], []
    for t, lose in zip(text.cast(pa.binary()).to_pylist(), keys):
        if t is None:
            kept.append(None)
            dropped.append(0)
            continue
        lose = set(lose.values.cast(pa.binary()).to_pylist())
        lines = t.split(b"\n")
        stay = [x for x in lines if line_key(x) not in lose]
        kept.append(b"\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())],
                                      names=["kept", "dropped"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, max_filter_bits: int = MAX_FILTER_BITS,
                keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns of ``df``, or all), ``id``, ``kept`` text, ``n_lines`` before, ``n_dropped``.

    ``common.unpacked`` gives the input's columns back from ``row``.
    """
    lost = lost_keys(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
                     min_chars, max_filter_bits)
    rows = packed(df, keep, id=F.col(id_col).cast("long"), text=F.coalesce(F.col(text_col), F.lit("")))
    met = rows.join(lost, "id", "left")
    met = met.withColumn("out", _drop(F.when(F.col("keys").isNotNull(), F.col("text")), F.col("keys")))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    return met.select("row", "id", F.coalesce("out.kept", "text").alias("kept"),
                      n_lines.cast("long").alias("n_lines"),
                      F.coalesce("out.dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines_in_place(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         length_col: str | None = "n_chars", min_chars: int = MIN_CHARS) -> DataFrame:
    """``df`` with repeated lines dropped from its text; ``length_col`` counts the code points anew.

    Text that was null and lost nothing stays null.  No row is dropped.
    """
    out = dedup_lines(df, id_col, text_col, min_chars)
    text = F.when(F.col("row").getField(text_col).isNull(), F.lit(None)).otherwise(F.col("kept"))
    new = {text_col: text}
    if length_col in df.columns:
        new[length_col] = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(
            F.col("row").getField(length_col)).cast(df.schema[length_col].dataType)
    return out.select(*unpacked(df.columns, new))
