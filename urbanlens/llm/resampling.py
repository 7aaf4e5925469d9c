"""Importance resampling towards a target distribution, by hashed n-gram counts.

Every run of ``least`` to ``most`` consecutive words is a feature; its bucket
is the CRC-32 of its bytes modulo ``buckets``.  A bucket's gain is the log
ratio of its smoothed share in the target and in the documents; a document's
weight is the sum of the gains of its features.  Weights with Gumbel noise
drawn from the id, taken from the top, are a sample without replacement.

Inside a task whole batches go through Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``.  Dictionary
indices shifted by one word against themselves give the next longer n-grams as
pairs of numbers; only distinct pairs are hashed (the CRC of a longer n-gram
continues that of the shorter one).  ``take`` puts gains in place of features
and a segment sum reduces them to documents.

1. Each task adds up its bucket counts and sends at most ``buckets`` of them.
2. The gains, ``buckets`` whole numbers, go to every task; one pass scores all.
3. The draw needs the rank of the drawn rows alone.  A histogram of at most
   ``BINS`` score ranges finds a score that the last drawn row reaches; rows
   below it are never moved.  The others are range-partitioned by (score, id),
   written, and numbered by the sizes of the parts before theirs.

Defined results: null or empty text has no features and weight 0; a null id
has no noise, so a null score, and is neither counted nor drawn; rows with the
same id are separate documents with the same noise; equal scores go to the
smaller id, then to fewer features.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from urbanlens.llm.arrow_words import NO_WORD, split_words
from urbanlens.llm.common import cut, row_schema, ship, shipped, text_of, with_text

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
BINS = 4_096


def gram_buckets(texts: pa.Array, least: int, most: int, buckets: int) -> tuple[np.ndarray, list]:
    """Words per row, and per n-gram size (row of each n-gram, index of its distinct pair, bucket of each distinct pair)."""
    rows, words, dictionary = split_words(texts, NO_WORD)
    spelled = dictionary.to_pylist()
    n_words = np.bincount(rows, minlength=len(texts))
    starts = np.arange(len(rows))
    grams, crc = words, np.array([zlib.crc32(w) for w in spelled], np.int64)
    found = [(rows, grams, crc % buckets)] if least <= 1 else []
    for n in range(2, most + 1):
        # The n-gram at i: the (n-1)-gram at i and the word n-1 places on, both in one row.
        inside = np.flatnonzero(rows[starts] == rows[np.minimum(starts + n - 1, len(rows) - 1)])
        inside = inside[starts[inside] + n - 1 < len(rows)]
        starts = starts[inside]
        pairs, grams = np.unique(grams[inside] * len(spelled) + words[starts + n - 1], return_inverse=True)
        heads, tails = np.divmod(pairs, max(len(spelled), 1))
        crc = np.array([zlib.crc32(b" " + spelled[t], int(crc[h])) for h, t in zip(heads, tails)], np.int64)
        if n >= least:
            found.append((rows[starts], grams, crc % buckets))
    return n_words, found


def _count(least: int, most: int, buckets: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, grams, bucket in gram_buckets(text_of(batch, "text"), least, most, buckets)[1]:
                np.add.at(total, bucket, np.bincount(grams, minlength=len(bucket)))
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return body


def bucket_counts(df: DataFrame, text_col: str = "text", least: int = 1, most: int = 1,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts of ``df`` per bucket, buckets without any left out."""
    rows = df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_count(least, most, buckets), "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares, floored, per bucket."""
    s_all, t_all = sum(documents.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(1000 * math.log(
        float(target.get(b, 0) + 1) * float(s_all) / (float(documents.get(b, 0) + 1) * float(t_all))))
        for b in range(buckets)], np.int64)


def _weigh(shared, text_col: str, least: int, most: int, buckets: int):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = pa.array(shipped(shared))
        for batch in batches:
            n_words, found = gram_buckets(text_of(batch, text_col), least, most, buckets)
            features, weight = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
            for rows, grams, bucket in found:
                each = pc.take(pc.take(gains, pa.array(bucket)), pa.array(grams)).to_numpy(zero_copy_only=False)
                ends = np.searchsorted(rows, np.arange(len(n_words) + 1))
                sums = np.concatenate([[0], np.cumsum(each)])
                features += np.diff(ends)
                weight += np.diff(sums[ends])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words), pa.array(features), pa.array(weight)],
                names=["row", "n_words", "n_features", "weight"])

    return body


def _noise(id_col: Column, seed: int) -> Column:
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def weigh(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
          least: int = 1, most: int = 1, buckets: int = BUCKETS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns of ``df``, or all), ``id``, ``n_words``, ``n_features``, ``weight`` and ``score``."""
    if not 1 <= least <= most:
        raise ValueError("1 <= least <= most words a feature")
    # At most ``buckets`` rows each: a parameter, whatever the data.
    have, want = ({r["bucket"]: r["n"] for r in bucket_counts(d, c, least, most, buckets).collect()}
                  for d, c in ((df, text_col), (target, target_text_col)))
    shared = ship(df.sparkSession, bucket_gains(have, want, buckets))
    rows = with_text(df, text_col, sorted(set(keep or df.columns) | {id_col}, key=df.columns.index))
    out = rows.mapInArrow(_weigh(shared, text_col, least, most, buckets),
                          row_schema(rows, "n_words long, n_features long, weight long"))
    doc = F.col("row").getField(id_col)
    return out.withColumn("id", doc).withColumn("score", F.col("weight") + _noise(doc, seed))


def _candidates(scored: DataFrame, able: Column, draws: int) -> Column:
    """A condition that the best ``draws`` able rows fulfil, and few others."""
    low, high = scored.where(able).agg(F.min("score"), F.max("score")).first()
    width = (high - low) // BINS + 1
    bins = scored.where(able).groupBy(F.expr(f"(score - {low}L) div {width}L").alias("bin")).count().collect()
    least, held = high, 0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        least, held = low + row["bin"] * width, held + row["count"]
        if held >= draws:
            break
    return able & (F.col("score") >= least)


def resample(df: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             **options) -> DataFrame:
    """All rows of :func:`weigh` with ``rank``: 1, 2, 3... for the drawn ones in order of the draw, else null."""
    scored = cut(weigh(df, target, **options), "resample-scores")
    able = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    draws = percent * scored.where(able).count() // 100
    if draws == 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    chosen = _candidates(scored, able, draws)
    order = [F.col("score").desc(), F.col("id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    # Written before it is counted: a range partitioning made anew may cut elsewhere.
    parts = cut(scored.where(chosen).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "resample-order")
    before, offsets = 0, []
    for row in parts.groupBy("part").count().orderBy("part").collect():     # one row a partition
        offsets.append((row["part"], before))
        before += row["count"]
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "part int, before long"))
    ranked = parts.join(starts, "part").withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(rest.columns).unionByName(rest)
