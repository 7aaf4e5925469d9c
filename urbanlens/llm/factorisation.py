"""Quality classifier: a factorisation machine over words, structure and metadata.

Inputs of a document: its words hashed to ``WORD_SLOTS`` slots (weights
1 + log count, scaled to length one), structure statistics of the whole text
(standardised on the training rows), and one slot for the size class of its
length column.  Label, language, source and id are never inputs.

    score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pair sum takes linear time by the sum-of-squares identity
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The model is fitted on at most ``max_rows`` labelled rows (smallest hash of
the id first): a bounded sample, whose inputs alone reach the driver.  The
documents are scored in one pass without a shuffle.

Defined results: null text is empty; empty text has a score (bias, structure
and length slots alone); rows without a label don't teach; of several labels
of one id the lowest counts; with no labelled row every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import packed, ranges, row_schema, ship, shipped, text_of

WORD_SLOTS = 1 << 15
SIZE_SLOTS = 24
RANK = 8
MAX_ROWS = 8_000
THRESHOLD = 0.7
EPOCHS = 12
BATCH = 200
LEARN = 0.01
DECAY = 1e-4
_CACHE = 1 << 18

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_STOP = b".!?"
_COMMON = b",;:'\"-()"
_HIGH = bytes(range(128, 256))
_SYMBOL = bytes(set(range(33, 127)) - set(_UPPER + _LOWER + _DIGIT + _STOP + _COMMON))

STATISTICS = (
    "log_bytes", "upper", "digit", "space", "stop", "exclaim", "comma", "symbol", "high", "log_words", "word_length",
    "distinct_words", "top_word", "repeated_next", "one_letter", "log_lines", "distinct_lines", "line_length",
    "line_stop", "words_with_symbol",
)


def statistics(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    size, n = len(text), len(words)
    per, each = 1.0 / max(size, 1), 1.0 / max(n, 1)
    lines = [line for line in text.split(b"\n") if line]
    few = 1.0 / max(len(lines), 1)
    letters = len(text) - len(text.translate(None, _UPPER + _LOWER + _HIGH))

    def share(of: bytes) -> float:
        return (size - len(text.translate(None, of))) * per

    return [
        np.log1p(size), (size - len(text.translate(None, _UPPER))) / max(letters, 1), share(_DIGIT), share(_SPACE),
        share(_STOP), share(b"!"), share(_COMMON), share(_SYMBOL), share(_HIGH), np.log1p(n),
        sum(map(len, words)) * each, len(counts) * each, max(counts.values(), default=0) * each,
        sum(map(eq, words, words[1:])) * each, sum(1 for w in words if len(w) == 1) * each, np.log1p(len(lines)),
        len(set(lines)) * few, np.log1p(sum(map(len, lines)) * few),
        sum(1 for line in lines if line[-1:] in (b".", b"!", b"?")) * few,
        sum(1 for w in words if not w[-1:].isalnum() and w[-1:] not in b".,!?;:" and w[-1:] < b"\x80") * each,
    ]


class Inputs:
    """Turns texts into sparse rows (slot, value) and statistics."""

    def __init__(self) -> None:
        self.slot: dict[bytes, int] = {}

    def rows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Slots and values of all texts' words in a row, how many each text has, and the statistics."""
        slots, values, sizes, stats = [], [], [], []
        known = self.slot
        for text in texts:
            words = text.lower().split()
            counts = Counter(words)
            stats.append(statistics(text, words, counts))
            if len(known) > _CACHE:
                known.clear()
            for word in counts:
                slot = known.get(word)
                if slot is None:
                    slot = known[word] = zlib.crc32(word) & (WORD_SLOTS - 1)
                slots.append(slot)
            values.extend(counts.values())
            sizes.append(len(counts))
        sizes_ = np.array(sizes, np.int64)
        value = 1 + np.log(np.array(values, np.float64))
        row = np.repeat(np.arange(len(texts)), sizes_)
        norm = np.sqrt(np.bincount(row, value * value, len(texts)))
        return (np.array(slots, np.int32), (value / norm[row]).astype(np.float32), sizes_,
                np.array(stats, np.float64).reshape(len(texts), len(STATISTICS)))


class Machine:
    """The fitted model: bias, weights and factors by slot, scale of the statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(7)
        n = WORD_SLOTS + len(STATISTICS) + SIZE_SLOTS
        self.bias = np.zeros(1)
        self.weight = np.zeros(n)
        self.factor = rng.normal(0, 0.02, (n, RANK))
        self.mean, self.spread = mean, spread

    def assemble(self, slots, values, sizes, stats, size_class):
        """Words, statistics and size class of each row as one sparse matrix (slot, value, row)."""
        n, m = len(sizes), len(STATISTICS)
        scaled = np.clip((stats - self.mean) / self.spread, -5, 5) * 0.3
        rows = np.arange(n)
        slot = np.concatenate([slots, np.tile(np.arange(m, dtype=np.int32) + np.int32(WORD_SLOTS), n),
                               (WORD_SLOTS + m + size_class).astype(np.int32)])
        value = np.concatenate([values, scaled.astype(np.float32).ravel(), np.full(n, 0.3, np.float32)])
        rows = rows.astype(np.int32)
        row = np.concatenate([np.repeat(rows, sizes), np.repeat(rows, m), rows])
        return slot, value, row

    def margin(self, slot, value, row, n):
        """The margins, and the sums by row that the gradient needs again."""
        v = self.factor[slot] * value[:, None]
        sums = np.stack([np.bincount(row, v[:, f], n) for f in range(RANK)], axis=1)
        squares = np.bincount(row, (v * v).sum(axis=1), n)
        linear = np.bincount(row, self.weight[slot] * value, n)
        return self.bias[0] + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, v

    def fit(self, slot, value, start, label: np.ndarray, epochs: int) -> None:
        """``slot`` and ``value`` by row; row i is ``start[i]:start[i + 1]``."""
        rng = np.random.default_rng(11)
        params = [self.bias, self.weight, self.factor]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            shuffled = rng.permutation(len(label))
            for at in range(0, len(label), BATCH):
                pick = shuffled[at:at + BATCH]
                take = np.concatenate([np.arange(start[i], start[i + 1]) for i in pick])
                r = np.repeat(np.arange(len(pick)), start[pick + 1] - start[pick])
                s, x = slot[take], value[take]
                margin, sums, v = self.margin(s, x, r, len(pick))
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[pick]) / len(pick)
                each = error[r] * x
                to_factor = each[:, None] * (sums[r] - v)
                kinds, where = np.unique(s, return_inverse=True)
                grads = [np.array([error.sum()]), np.zeros_like(self.weight), np.zeros_like(self.factor)]
                grads[1][kinds] = np.bincount(where, each)
                for f in range(RANK):
                    grads[2][kinds, f] = np.bincount(where, to_factor[:, f])
                step += 1
                for p, g, a, b in zip(params, grads, first, second):
                    g = g + DECAY * p
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    p -= LEARN * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)


def size_class(lengths: list[int | None], texts: list[bytes]) -> np.ndarray:
    out = [min(int(n if n is not None and n >= 0 else len(t)).bit_length(), SIZE_SLOTS - 1)
           for n, t in zip(lengths, texts)]
    return np.array(out, np.int64)


def _length(df: DataFrame, length_col: str | None) -> Column:
    return (F.col(f"`{length_col}`").try_cast("long") if length_col in df.columns else F.lit(None).cast("long"))


def _input_body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inputs = Inputs()
    for whole in batches:
        column = text_of(whole, "text")
        for start, stop in ranges(column):
            texts = column[start:stop].to_pylist()
            slots, values, sizes, stats = inputs.rows(texts)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays([
                whole.column("label")[start:stop],
                pa.array(size_class(whole.column("length")[start:stop].to_pylist(), texts)),
                pa.array([s.tobytes() for s in np.split(slots, ends[1:-1])], pa.binary()),
                pa.array([v.tobytes() for v in np.split(values, ends[1:-1])], pa.binary()),
                pa.array([row.tobytes() for row in stats], pa.binary()),
            ], names=["label", "size", "slots", "values", "stats"])


def fit(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        length_col: str | None = "n_chars", label_id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Machine | None:
    """The model from at most ``max_rows`` rows of ``labels`` (1 good, 0 bad) that ``df`` has; None without any."""
    known = labels.select(F.col(label_id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                     _length(df, length_col).alias("length"))
    # Of several rows with one id the least text teaches: max_rows rows at most.
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("text", "length", "label")).alias("r"))
    got = rows.select("r.label", "r.length", "r.text").mapInArrow(
        _input_body, "label int, size long, slots binary, values binary, stats binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["slots"], r["stats"]))
    stats = np.stack([np.frombuffer(r["stats"], np.float64) for r in got])
    machine = Machine(stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6))
    slots = np.concatenate([np.frombuffer(r["slots"], np.int32) for r in got])
    values = np.concatenate([np.frombuffer(r["values"], np.float32) for r in got])
    sizes = np.array([len(r["slots"]) // 4 for r in got])
    label = np.array([r["label"] for r in got], np.float64)
    classes = np.array([r["size"] for r in got])
    del got
    slots, values, rows = machine.assemble(slots, values, sizes, stats, classes)
    order = np.argsort(rows, kind="stable").astype(np.int32)
    start = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(label)))])
    del rows
    slots, values = slots[order], values[order]
    del order
    machine.fit(slots, values, start, label, epochs)
    return machine


def _score_body(shared, text_col: str):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs, machine = Inputs(), shipped(shared)
        for whole in batches:
            column = text_of(whole, text_col)
            for start, stop in ranges(column, 4 << 20):
                texts = column[start:stop].to_pylist()
                if machine is None:
                    score = np.full(len(texts), 0.5)
                else:
                    sizes = size_class(whole.column("length")[start:stop].to_pylist(), texts)
                    matrix = machine.assemble(*inputs.rows(texts), sizes)
                    margin, _, _ = machine.margin(*matrix, len(texts))
                    score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                yield pa.RecordBatch.from_arrays([whole.column("row")[start:stop], pa.array(score, pa.float64())],
                                                 names=["row", "score"])

    return body


def score(df: DataFrame, machine: Machine | None, text_col: str = "text", length_col: str | None = "n_chars",
          keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or all) and ``score``, the probability of a good label."""
    shared = ship(df.sparkSession, machine)
    columns = {"length": _length(df, length_col)}
    if text_col not in (keep or df.columns):
        columns["text"] = F.col(f"`{text_col}`")
    rows = packed(df, keep, **columns)
    return rows.mapInArrow(_score_body(shared, text_col), row_schema(rows, "score double"))


def keep_good(df: DataFrame, machine: Machine | None, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """``df`` without the rows that score below ``threshold`` (none goes where nothing was learnt)."""
    if machine is None:
        return df
    out = score(df, machine, **columns).where(F.col("score") >= threshold)
    return out.select(*[F.col("row").getField(c).alias(c) for c in df.columns])
