"""Language-model scoring: marginal likelihood over all subword segmentations.

The vocabulary is an existing one (a sentencepiece file, read by path); it is
never trained.  Every way to spell a text with its pieces counts: a text's
probability is the sum over all segmentations of the product of the pieces'
probabilities, taken by a forward recursion in log space.  A piece with the
word mark opens a word, so the recursion of a document falls apart at its
words; a document ends with an end symbol.  Characters that no piece covers
are spelt by byte pieces, so every text has a probability, and the
probabilities of all texts add up to no more than one.

The pieces' weights start from the vocabulary's own scores (ranks) and are
re-estimated from the corpus by expectation maximisation, every round over all
its distinct words, each word whole.  Words of the corpus are arcs of the lattice too: a word seen c
times in N tokens has an arc of weight (c - D) / N, and the discounted mass
D V / N (V distinct tokens) is what all spellings by pieces share, so words
never seen keep a probability and frequent ones are not spelt badly.

Beside it stands a word unigram with add-1/2 smoothing (``base_score``).

Words are counted in each task before they are shuffled.  Counts of frequent
words (at most ``MAX_SHIPPED`` of at most ``SHIPPED_BYTES``, the rest by a shuffled join) go to the tasks;
lattice scores of words are computed in batches, and kept in a bounded cache.

Defined results: A-Z are lower-cased; null or empty text is the end symbol
alone; repeated rows are scored one by one (and counted once each in
training); with nothing to learn from, every count is 0 and the pieces keep
the vocabulary's weights.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import cut, packed, ranges, row_schema, ship, shipped, text_of
from urbanlens.llm.partenum import hashed_words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ROUNDS = 1                  # of expectation maximisation, each over all words
MAX_SHIPPED = 200_000       # words whose counts are sent to every task
SHIPPED_BYTES = 256         # and the bytes of the longest of them; longer words take the join
LONG = 64                   # code points of a word that the batched recursion takes
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FLUSH = 300_000            # distinct words held by a task
_CACHE = 400_000
_FLOOR = 0.05               # smallest expected count of a piece


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """The pieces that can occur in lower-cased text, and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if MARK in piece[1:] or any("A" <= c <= "Z" for c in piece):
            continue
        pieces.append(piece)
        scores.append(model.get_score(i))
    return pieces, np.array(scores)


def _points(word: str) -> list[int]:
    return [ord(c) for c in word]


def _hash(points) -> int:
    h = 0
    for p in points:
        h = ((h + p + 1) * int(_BASE)) & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
    return h


class Lattice:
    """The pieces with their log probabilities (natural), and the recursions."""

    def __init__(self, pieces: list[str], scores: np.ndarray):
        self.pieces = pieces
        n = len(pieces)
        self.longest = max(map(len, pieces))
        self.by_text = {p: i for i, p in enumerate(pieces)}
        # All prefixes of pieces by hash (open addressing): slot, or -1 where only longer pieces begin so.
        values: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            for stop in range(1, len(piece)):
                values.setdefault(_hash(_points(piece[:stop])), -1)
            values[_hash(_points(piece))] = i
        bits = max(8, (4 * len(values)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -2, np.int32)
        for h, value in values.items():
            at = h >> (64 - bits)
            while self.keys[at]:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = h, value
        # Slots: pieces, 256 bytes, end.  Ranks of the vocabulary's scores give the first weights.
        rank = np.empty(n)
        rank[np.argsort(-scores, kind="stable")] = np.arange(n)
        weight = np.concatenate([1 / (rank + 10), np.full(256, 1e-3 / 256), [1e-3]])
        self.set_weights(weight)

    def set_weights(self, weight: np.ndarray) -> None:
        self.log = np.log(weight / weight.sum())

    @property
    def end(self) -> float:
        return float(self.log[-1])

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The value of each prefix hash; -2 where there is none."""
        at = (h >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == h, self.values[at], -2)
        left = np.flatnonzero((self.keys[at] != h) & (self.keys[at] != 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            key = self.keys[at[left]]
            hit = key == h[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def _bytes_log(self, char: str) -> float:
        n = len(self.pieces)
        return float(sum(self.log[n + b] for b in char.encode("utf-8", "surrogatepass")))

    def _edges(self, points: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, stop, words, slots, logs) in a matrix of words of one length; slots are None for bytes.

        Marked pieces open words and stand nowhere else; a character that is
        no piece of its own is spelt in bytes.
        """
        n, size = points.shape
        for i in range(size):
            alive = np.flatnonzero(points[:, i] != ord(MARK)) if i else np.arange(n)
            h = np.zeros(len(alive), np.uint64)
            covered = np.zeros(n, bool)
            for stop in range(i + 1, min(size, i + self.longest) + 1):
                h = (h + points[alive, stop - 1].astype(np.uint64) + np.uint64(1)) * _BASE
                h ^= h >> np.uint64(29)
                value = self._find(h)
                on = value > -2
                alive, h, value = alive[on], h[on], value[on]
                if not len(alive):
                    break
                known = value >= 0
                if known.any():
                    words, slots = alive[known], value[known]
                    if stop == i + 1:
                        covered[words] = True
                    yield i, stop, words, slots, self.log[slots]
            if i and not covered.all():
                words = np.flatnonzero(~covered)
                kinds, where = np.unique(points[words, i], return_inverse=True)
                yield i, i + 1, words, None, np.array([self._bytes_log(chr(int(k))) for k in kinds])[where]

    def _forward(self, points: np.ndarray, edges: Iterator) -> np.ndarray:
        n, size = points.shape
        forward = np.full((size + 1, n), -np.inf)
        forward[0] = 0
        for i, stop, words, _, log in edges:
            row = forward[stop]
            row[words] = np.logaddexp(row[words], forward[i][words] + log)
        return forward

    def _matrices(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers, code points) of words of the same length, with the word mark in front."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            for part in np.array_split(at, max(1, len(at) * (int(size) + 1) // 200_000)):
                text = "".join(MARK + words[k] for k in part)
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                yield part, points.reshape(len(part), int(size) + 1).astype(np.int64)

    def _arcs(self, text: str, start: int) -> Iterator[tuple[int, int | None, float]]:
        """(stop, slot, log) of the arcs that leave one place of a marked word; slots are None for bytes."""
        if start and text[start] == MARK:
            yield start + 1, None, self._bytes_log(MARK)
            return
        covered = False
        for stop in range(start + 1, min(len(text), start + self.longest) + 1):
            slot = self.by_text.get(text[start:stop])
            if slot is not None:
                covered = covered or stop == start + 1
                yield stop, slot, float(self.log[slot])
        if start and not covered:
            yield start + 1, None, self._bytes_log(text[start])

    def _long_forward(self, text: str) -> list[float]:
        forward = [-math.inf] * (len(text) + 1)
        forward[0] = 0.0
        for i in range(len(text)):
            if forward[i] > -math.inf:
                for stop, _, log in self._arcs(text, i):
                    forward[stop] = float(np.logaddexp(forward[stop], forward[i] + log))
        return forward

    def _long(self, word: str) -> float:
        """The forward recursion of one very long word."""
        return self._long_forward(MARK + word)[-1]

    def _long_expected(self, word: str, times: float, total: np.ndarray) -> None:
        """Adds the expected counts of one very long word, whole, to ``total``."""
        text = MARK + word
        forward = self._long_forward(text)
        backward = [-math.inf] * (len(text) + 1)
        backward[-1] = 0.0
        for i in range(len(text) - 1, -1, -1):
            if forward[i] == -math.inf:
                continue
            for stop, slot, log in self._arcs(text, i):
                if backward[stop] == -math.inf:
                    continue
                backward[i] = float(np.logaddexp(backward[i], log + backward[stop]))
                share = times * math.exp(forward[i] + log + backward[stop] - forward[-1])
                if slot is not None:
                    total[slot] += share
                else:
                    for b in text[i].encode("utf-8", "surrogatepass"):
                        total[len(self.pieces) + b] += share

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (with its mark)."""
        out = np.empty(len(words))
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        for part, points in self._matrices([words[k] for k in short]):
            out[[short[k] for k in part]] = self._forward(points, self._edges(points))[-1]
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self._long(w)
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected counts of all slots over the words, without the end."""
        n = len(self.pieces)
        total = np.zeros(n + 257)
        short = np.array([k for k, w in enumerate(words) if len(w) <= LONG], np.int64)
        weights = np.asarray(counts, np.float64)[short]
        for word, times in zip(words, counts):
            if len(word) > LONG:
                self._long_expected(word, float(times), total)
        for part, points in self._matrices([words[k] for k in short]):
            edges = list(self._edges(points))
            forward = self._forward(points, edges)
            backward = np.full(forward.shape, -np.inf)
            backward[-1] = 0
            for i, stop, words, _, log in reversed(edges):
                row = backward[i]
                row[words] = np.logaddexp(row[words], backward[stop][words] + log)
            for i, stop, words, slots, log in edges:
                share = np.exp(forward[i][words] + log + backward[stop][words] - forward[-1][words]) * weights[part[words]]
                if slots is not None:
                    np.add.at(total, slots, share)
                    continue
                for point in np.unique(points[words, i]):
                    mass = share[points[words, i] == point].sum()
                    for b in chr(int(point)).encode("utf-8", "surrogatepass"):
                        total[n + b] += mass
        return total


def _decode(word: bytes) -> str:
    return word.decode("utf-8", "surrogatepass")


def _count_body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                            pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return batch

    for batch in batches:
        for text in text_of(batch, "text").to_pylist():
            counts.update(text.lower().split())
            if len(counts) >= _FLUSH:
                yield out()
    if counts:
        yield out()


def _expect_body(shared):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = shipped(shared)
        total = None
        for batch in batches:
            words = [_decode(w) for w in batch.column("word").to_pylist()]
            got = lattice.expected(words, np.ones(len(words)))     # each distinct word once
            total = got if total is None else total + got
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                             names=["slot", "mass"])

    return body


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) of all words of ``texts`` (text)."""
    pairs = texts.mapInArrow(_count_body, "word binary, c long")
    return cut(pairs.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


def estimate(lattice: Lattice, counts: DataFrame, documents: int, rounds: int = ROUNDS) -> Lattice:
    """Re-estimates the weights from the word counts; what is collected is one number a piece."""
    spark = counts.sparkSession
    if documents == 0:
        return lattice
    for _ in range(rounds):
        shared = ship(spark, lattice)
        rows = counts.mapInArrow(_expect_body(shared), "slot int, mass double").groupBy("slot").agg(
            F.sum("mass").alias("mass")).collect()
        weight = np.full(len(lattice.pieces) + 257, _FLOOR)
        for row in rows:
            weight[row["slot"]] += row["mass"]
        weight[-1] = 1.0
        lattice.set_weights(weight)
        shared.unpersist()
    return lattice


def _mixed(c: float, lattice: float, discount: float, n: int, spare: float) -> float:
    """log10 of (c - D)/N + spare 10^lattice."""
    if c <= discount:
        return lattice + (math.log10(spare) if spare else 0.0)
    return math.log10((c - discount) / n + spare * 10 ** lattice)


def _score_body(shared, text_col: str):
    """Words are told apart by 64-bit hashes inside a batch; each distinct one is looked up once."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, known, documents, n, below, discount, spare = shipped(shared)
        ten = math.log(10)
        end_base = math.log10(documents + 0.5) - below
        end_score = _mixed(documents, lattice.end / ten, discount, n, spare)
        # base, score (others: the lattice's alone), the lattice's score, frequent
        cache: dict[bytes, tuple[float, float, float, bool]] = {}

        def looked_up(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            if len(cache) > _CACHE:
                cache.clear()
            new = [w for w in words if w not in cache]
            for at in range(0, len(new), 50_000):
                part = new[at:at + 50_000]
                for w, log in zip(part, (lattice.score([_decode(w) for w in part]) / ten).tolist()):
                    c = known.get(w)
                    cache[w] = (0.0, log, log, False) if c is None else (
                        math.log10(c + 0.5) - below, _mixed(c, log, discount, n, spare), log, True)
            got = [cache[w] for w in words]
            base, score, spelt, frequent = zip(*got) if got else ((), (), (), ())
            return np.array(base), np.array(score), np.array(spelt), np.array(frequent, bool)

        for whole in batches:
            column = text_of(whole, text_col)
            for start, stop in ranges(column, 8 << 20):
                texts = column[start:stop].to_pylist()
                buffer = b"\n".join(texts).lower()
                hashes, at, size = hashed_words(buffer)
                begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
                bound = np.searchsorted(at, begin)
                count = np.diff(bound)
                code, kinds = pd.factorize(hashes)
                first = np.empty(len(kinds), np.int64)
                first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
                words = [buffer[a:a + s] for a, s in zip(at[first].tolist(), size[first].tolist())]
                base, score, spelt, frequent = looked_up(words)
                some = np.flatnonzero(count)

                def sums(of_word: np.ndarray) -> np.ndarray:
                    out = np.zeros(len(texts))
                    if len(some):
                        out[some] = np.add.reduceat(of_word[code], bound[some])
                    return out

                # The other words of each document, with how often they stand there.
                doc = np.repeat(np.arange(len(texts)), count)
                left = np.flatnonzero(~frequent[code]) if len(code) else np.empty(0, np.int64)
                pair, times = np.unique(doc[left] * max(len(kinds), 1) + code[left], return_counts=True)
                word = pair % max(len(kinds), 1)
                ends = np.searchsorted(pair, np.arange(len(texts) + 1) * max(len(kinds), 1))
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(words, pa.binary()).take(pa.array(word, pa.int64())), pa.array(times, pa.int64()),
                     pa.array(score[word] if len(word) else np.empty(0))], names=["word", "tf", "log"]))
                seen = sums(frequent.astype(np.float64)).astype(np.int64) + int(documents > 0)
                yield pa.RecordBatch.from_arrays(
                    [whole.column("row")[start:stop], whole.column("rid")[start:stop], pa.array(count + 1, pa.int64()),
                     pa.array(seen), pa.array(sums(base) + end_base),
                     pa.array(sums(np.where(frequent, score, 0.0)) + end_score),
                     pa.array(sums(spelt) + lattice.end / ten), rare],
                    names=["row", "rid", "n_tokens", "seen", "base", "score", "lattice", "rare"])

    return body


def score_documents(df: DataFrame, learn: Column, text_col: str = "text", vocabulary: str = VOCABULARY,
                    keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``row`` (the ``keep`` columns, or all), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``lattice_score``.

    Learns from the rows where ``learn`` is true.  Scores are log10
    probabilities; the words and the end of a text are its tokens.
    ``lattice_score`` is that of the pieces alone, without word arcs.
    """
    teaching = df.where(learn).select(F.col(text_col).alias("text"))
    counts = count_words(teaching)
    documents = teaching.count()
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
                      F.count(F.when(F.col("c") == 1, 1)).alias("once"),
                      F.count(F.when(F.col("c") == 2, 1)).alias("twice")).first()
    n, v = (sums["n"] or 0) + documents, sums["v"] + (documents > 0)
    below = math.log10(n + 0.5 * (v + 1))
    discount = sums["once"] / (sums["once"] + 2 * sums["twice"]) if sums["once"] and sums["twice"] else 0.5
    spare = discount * v / n if n else 1.0
    lattice = estimate(Lattice(*read_vocabulary(vocabulary)), counts, documents, rounds)

    # The least count of which no more than MAX_SHIPPED short words have as much.
    short = F.octet_length("word") <= SHIPPED_BYTES
    classes = counts.where(short).groupBy(F.floor(F.log2("c")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    least, room = 62, MAX_SHIPPED
    for row in sorted(classes.collect(), reverse=True):
        room -= row["n"]
        if room < 0:
            break
        least = row["k"]
    frequent = short & (F.col("c") >= F.lit(1 << least))
    known = {bytes(r["word"]): r["c"] for r in counts.where(frequent).collect()}     # MAX_SHIPPED at most
    shared = ship(df.sparkSession, (lattice, known, documents, n, below, discount, spare))

    rows = packed(df, keep, text=F.col(f"`{text_col}`"), rid=F.monotonically_increasing_id())
    scored = cut(rows.mapInArrow(_score_body(shared, "text"), row_schema(
        rows, "rid long, n_tokens long, seen long, base double, score double, lattice double, "
              "rare array<struct<word:binary,tf:bigint,log:double>>")), "lm-scored")
    rare = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.tf", "r.log")
    met = rare.join(counts.where(~frequent), "word", "left")
    base = F.log10(F.coalesce("c", F.lit(0)) + 0.5) - F.lit(below)
    mixed = F.when(F.col("c").isNull(), F.col("log") + F.lit(math.log10(spare) if spare else 0.0)).otherwise(
        F.log10((F.col("c") - F.lit(discount)) / F.lit(float(n or 1)) + F.lit(spare) * F.pow(F.lit(10.0), F.col("log"))))
    left = met.groupBy("rid").agg(F.sum(F.col("tf") * base).alias("rare_base"),
                                  F.sum(F.col("tf") * mixed).alias("rare_score"),
                                  F.sum(F.when(F.col("c").isNotNull(), F.col("tf"))).alias("rare_seen"))
    out = scored.drop("rare").join(left, "rid", "left")
    zero = F.lit(0.0)
    return out.select("row", "n_tokens", (F.col("seen") + F.coalesce("rare_seen", F.lit(0))).alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
                      (F.col("score") + F.coalesce("rare_score", zero)).alias("score"),
                      F.col("lattice").alias("lattice_score"))
