"""WARC archives: writing, normalising whole-file gzip, reading back by offset.

``write_archives``  tasks write records into gzip files, one gzip stream a
                    file, closed after about ``max_bytes`` of records.
``normalise``       a task inflates a file once, record by record, and
                    writes every record as a gzip member of its own, with a
                    sidecar index (JSON lines: record id, offset, length,
                    type) beside it.  Members can then be read alone.
``read_records``    tasks open the normalised files at the indexed offsets.

Files lie in the shared folder (any file system that pyarrow opens by its
address: file, hdfs, s3, gs, abfs).  Every attempt of a task writes files with names of its own, and
only names that finished tasks have reported are read, so lost executors and
repeated attempts leave no double record.  A task holds one record at a time.
A gzip stream can't be split, so one file is one task; ``max_bytes`` bounds it.

Equal payloads (``min_revisit`` bytes at least) are stored once: the record
with the largest id is a response, the others revisit it.

Defined results: null payload is empty; a null id is a response of its own
and is never referred to; rows with the same id and payload are equal records; a truncated or
damaged archive raises an error that names the file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import cut, join_unique
from urbanlens.session import scratch_path

MAX_BYTES = 64 << 20
MIN_REVISIT = 1_000
GZIP = 31                    # zlib's window bits for a gzip stream
_CHUNK = 1 << 18
PIECE = 1 << 20                # most bytes inflated at once
_LINE = b"\r\n"

INDEX = "path string, offset long, length long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(record: dict, payload: bytes) -> bytes:
    """One WARC record (headers, body, two line ends) from a row of ``write_archives``."""
    digest = base64.b32encode(bytes.fromhex(record["digest"])).decode()
    number = "null" if record["id"] is None else str(record["id"])
    head = [("WARC-Type", record["type"]), ("WARC-Record-ID", f"<urn:record:{number}>"),
            ("WARC-Target-URI", _clean(record["uri"] or "")), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(record["n"]))]
    if record["type"] == "revisit":
        head.append(("WARC-Refers-To", f"<urn:record:{record['refers_to']}>"))
    head.append(("Content-Length", str(len(payload))))
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in head)]
    return _LINE.join(lines) + _LINE + _LINE + payload + _LINE + _LINE


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def stream_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record in gzip bytes, whether one stream or many members.

    Holds one record and one piece of at most ``PIECE`` inflated bytes, however far a chunk inflates.
    """
    inflate, held = zlib.decompressobj(GZIP), bytearray()
    ended = False

    def plain() -> Iterator[bytes]:
        nonlocal inflate, ended
        for chunk in chunks:
            more = bool(chunk)
            while more:
                ended = False
                piece = inflate.decompress(chunk, PIECE)
                yield piece
                if inflate.eof:
                    chunk, inflate, ended = inflate.unused_data, zlib.decompressobj(GZIP), True
                    more = bool(chunk)
                else:
                    chunk = inflate.unconsumed_tail
                    more = bool(chunk) or len(piece) == PIECE

    wanted, head = None, {}
    for piece in plain():
        held += piece
        at = 0
        while True:
            if wanted is None:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                head = parse_head(bytes(held[at:end]))
                wanted = end + 4 - at + int(head["Content-Length"]) + 4
            if len(held) - at < wanted:
                break
            yield head, bytes(held[at:at + wanted])
            at += wanted
            wanted = None
        if at:
            del held[:at]
    if held or not ended:
        raise ValueError("the archive ends inside a record or stream")


def _write_body(folder: str, max_bytes: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        out, deflate, name, size, count = None, None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.write(deflate.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())],
                                              names=["path", "records"])

        for batch in batches:
            plain = [c for c in batch.schema.names if c != "payload"]
            rows = batch.select(plain).to_pylist()
            for row, payload in zip(rows, batch.column("payload")):
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(_open(name)[1], compression=None)
                    deflate, size, count = zlib.compressobj(1, zlib.DEFLATED, GZIP), 0, 0
                data = record_bytes(row, payload.as_py() or b"")
                out.write(deflate.compress(data))
                size += len(data)
                count += 1
                if size >= max_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return body


def write_archives(records: DataFrame, folder: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Writes (id, uri, type, digest, n, refers_to, payload) rows; returns (path, records) of the files."""
    return cut(records.mapInArrow(_write_body(folder, max_bytes), "path string, records long"), "warc-files")


def _chunks(source) -> Iterator[bytes]:
    while True:
        got = source.read(_CHUNK)
        if not got:
            return
        yield got


def _normalise_body(folder: str):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                stem = f"{folder}/{uuid.uuid4().hex}"
                offsets, lengths, at = [], [], 0
                old_system, old = _open(path)
                with old_system.open_input_stream(old, compression=None) as source, \
                        system.open_output_stream(_open(stem + ".warc.gz")[1], compression=None) as out, \
                        system.open_output_stream(_open(stem + ".idx.jsonl")[1], compression=None) as index:
                    try:
                        for head, record in stream_records(_chunks(source)):
                            member = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                            data = member.compress(record) + member.flush()
                            out.write(data)
                            index.write(json.dumps({"id": head["WARC-Record-ID"], "offset": at, "length": len(data),
                                                    "type": head["WARC-Type"]}).encode() + b"\n")
                            offsets.append(at)
                            lengths.append(len(data))
                            at += len(data)
                    except (ValueError, zlib.error) as error:
                        raise ValueError(f"{path}: {error}") from error
                yield pa.RecordBatch.from_arrays(
                    [pa.array([stem + ".warc.gz"] * len(offsets), pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())], names=["path", "offset", "length"])

    return body


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrites whole-file gzip archives (``path``); returns the index (path, offset, length).

    Each file of ``files`` is one task's work; the index is also written
    beside each archive.
    """
    n = max(1, files.count())
    spread = files.select("path").repartition(min(n, 10_000), "path")
    return cut(spread.mapInArrow(_normalise_body(folder), INDEX), "warc-index")


def _number(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:record:").removesuffix(">")
    return None if value in ("", "null") else int(value)


def _read_body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, source = None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["path"] != path:
                if source is not None:
                    source.close()
                path = row["path"]
                system, place = _open(path)
                source = system.open_input_file(place)
            data = zlib.decompress(source.read_at(row["length"], row["offset"]), GZIP)
            end = data.index(b"\r\n\r\n")
            head = parse_head(data[:end])
            payload = data[end + 4:end + 4 + int(head["Content-Length"])]
            named = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            size = int(head["X-Payload-Length"])
            if head["WARC-Type"] == "response":
                digest = hashlib.sha1(payload).hexdigest()
                if digest != named or len(payload) != size:
                    raise ValueError(f"{path}: the payload at {row['offset']} doesn't match its headers")
            else:
                payload = None
            out.append((_number(head["WARC-Record-ID"]), head["WARC-Type"], head["WARC-Target-URI"], size, named,
                        _number(head.get("WARC-Refers-To")), payload))
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        names = ("id", "type", "uri", "n", "digest", "refers_to", "payload")
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                         names=list(names))


def read_records(index: DataFrame) -> DataFrame:
    """(id, type, uri, n, digest, refers_to, payload) of every indexed record; a revisit's payload is null."""
    near = index.repartition("path", F.floor(F.col("offset") / F.lit(8 << 20))).sortWithinPartitions("path", "offset")
    return near.mapInArrow(_read_body, "id long, type string, uri string, n long, digest string, refers_to long, "
                                       "payload binary")


def records_of(df: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
               min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows for ``write_archives``: equal payloads refer to the one with the largest id."""
    payload: Column = F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"),
                     payload.alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"),
                             "same": F.concat_ws("-", F.sha2("payload", 256), F.octet_length("payload"))})
    slim = rows.where((F.col("n") >= min_revisit) & F.col("id").isNotNull()).select("id", "same")
    keepers = slim.groupBy("same").agg(F.max("id").alias("refers_to"), F.min("id").alias("least"),
                                       F.count(F.lit(1)).alias("w"))
    keepers = cut(keepers.where(F.col("least") < F.col("refers_to")).drop("least"), "warc-equal")
    revisits = join_unique(slim, keepers, "same", "w").where(F.col("id") != F.col("refers_to")).distinct()
    met = rows.join(revisits, ["id", "same"], "left")
    known = F.col("refers_to").isNotNull()
    return met.select("id", "uri", F.when(known, "revisit").otherwise("response").alias("type"), "digest", "n",
                      "refers_to", F.when(known, F.lit(None)).otherwise(F.col("payload")).alias("payload"))


def archive(df: DataFrame, **columns) -> DataFrame:
    """Writes ``df`` as archives, normalises them and reads every record back."""
    spark = df.sparkSession
    files = write_archives(records_of(df, **columns), scratch_path(spark, "warc-stream"))
    return read_records(normalise(files, scratch_path(spark, "warc")))
