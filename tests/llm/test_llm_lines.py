import random

import numpy as np
import pyarrow as pa

from brute import dedup_lines, sha
from odd_rows import ODD_ROWS
from urbanlens.llm import line_dedup
from urbanlens.llm.line_dedup import Bloom


def _got(df, **options):
    rows = line_dedup.dedup_lines(df, keep=["doc_id"], **options).collect()
    return sorted(((r["id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in rows), key=repr)


def test_odd_rows(odd):
    assert _got(odd) == sorted(dedup_lines(ODD_ROWS), key=repr)


def test_random_lines(ready):
    rng = random.Random(3)
    lines = [f"line number {i} of the pool" for i in range(40)] + ["short", "", " Line number 3 of the POOL\t"]
    docs = [(i // 2 * 2, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(120)]
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert _got(df) == sorted(dedup_lines(docs), key=repr)
    # A filter that lets everything through changes nothing.
    assert _got(df, max_filter_bits=1 << 12) == sorted(dedup_lines(docs), key=repr)


def test_every_repeated_line_goes_beyond_one_segment(ready):
    """Over 262,144 repeated lines (the global filter is larger than a segment's), two copies of each."""
    docs, lines = 1040, 1000
    df = ready.range(docs, numPartitions=4).selectExpr(
        "id AS doc_id", f"array_join(transform(sequence(0, {lines - 1}), i -> concat('repeated line ', "
                        f"id div 2 * {lines} + i)), '\n') AS text")
    got = line_dedup.dedup_lines(df, keep=["doc_id"]).selectExpr("id % 2 AS second", "n_dropped").groupBy("second").sum()
    assert {r["second"]: r["sum(n_dropped)"] for r in got.collect()} == {0: 0, 1: docs // 2 * lines}


def test_no_suspect_is_withheld():
    """A segment with more keys than its filter has room for passes them all on."""
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(-1 << 63, (1 << 63) - 1, 300_000))
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(h), np.int64)), pa.array(h), pa.array([True] * len(h))],
                                          names=["segment", "h", "again"]) for h in np.array_split(hashes, 30)]
    passed = np.concatenate([b.column("h").to_numpy() for b in line_dedup._suspects(iter(batches))])
    assert np.array_equal(np.unique(passed), hashes)


def test_empty_table_and_one_document(ready):
    empty = ready.createDataFrame([], "doc_id long, text string")
    assert _got(empty) == []
    alone = ready.createDataFrame([(1, "the same long line\nthe same long line")], "doc_id long, text string")
    assert _got(alone) == [(1, 2, 0, "the same long line\nthe same long line")]


def test_in_place_keeps_columns(odd):
    out = line_dedup.dedup_lines_in_place(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    rows = out.collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        if r["doc_id"] == 0:
            assert r["text"] is None
        if r["doc_id"] == 7:
            assert r["n_chars"] == len(r["text"])
    want = sorted(sha(k) for _, _, _, k in dedup_lines(ODD_ROWS))
    assert sorted(sha(r["text"] or "") for r in rows) == want


def test_bloom_has_no_false_negatives():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5_000).astype(np.uint64)
    bloom = Bloom(1 << 17)
    bloom.add(hashes)
    assert bloom.has(hashes).all()
    others = rng.integers(0, 1 << 63, 5_000).astype(np.uint64)
    assert bloom.has(others).mean() < 0.01


def test_parts_of_the_filter_are_joined():
    rng = np.random.default_rng(5)
    rows = sorted((int(p), rng.integers(0, 256, 64, np.uint8).tobytes()) for p in rng.integers(0, 4, 50))
    batches = [pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.int32()), pa.array([b for _, b in some], pa.binary())],
                                          names=["part", "bits"]) for some in (rows[:7], rows[7:8], rows[8:])]
    want: dict = {}
    for p, b in rows:
        want[p] = bytes(x | y for x, y in zip(want.get(p, bytes(64)), b))
    got = {r["part"]: r["bits"] for b in line_dedup._joined_parts(iter(batches)) for r in b.to_pylist()}
    assert got == want and list(line_dedup._joined_parts(iter([]))) == []
