"""Language identification by interpolated Kneser-Ney character models.

One model of order ``ORDER`` per language.  Text is reduced to lower-cased
letters and single spaces; every letter is one symbol.  The n-grams of a
language are kept in arrays sorted by the n-gram's hash (``CODE_BITS`` bits a
symbol, so no two n-grams share one), with the interpolated log probability
of the last symbol after the others.  Lower orders use continuation counts.
Unseen n-grams fall back through the interpolation weights of their context.

A document's cross-entropy per symbol is the mean over all its positions; the
language with the lowest wins.  Documents whose lowest cross-entropy is above
the ``rejection`` limit of the winning language are marked ``rejected``.  The
limit is calibrated on texts that the model hasn't seen: the language's texts
are dealt into ``FOLDS`` folds, each scored by a model of the others, and the
limit is the ``REJECT_QUANTILE`` of these cross-entropies (by rank of n + 1).
With too few texts for that rank, it is the largest of them or their mean and
the quantile's number of standard deviations, whichever is more; with fewer
than two texts, nothing is rejected.

The models are fitted on at most ``per_language`` documents of a language,
those with the smallest hash of their id and text, and on at most
``max_chars`` characters of all languages together (a bounded, documented
sample, see :func:`sample`); scoring reads every text whole.

Defined results: null text or text without a letter gives ``und``, score 0;
with nothing to learn from, every text gives ``und``; ties go to the
language first by name; rows with equal ids are judged one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import join_unique, ranges, row_schema, ship, shipped, text_of, with_text

ORDER = 4
CODE_BITS = 16
PER_LANGUAGE = 1_000
_PLACES = 1 << 30
MAX_TRAIN_CHARS = 1 << 26       # all languages together
UNKNOWN = "und"
REJECT_QUANTILE = 0.999
FOLDS = 4                       # of the texts that the rejection limit is calibrated on
SCALE = 0.25                    # softening of per-document posteriors, see Models.score


def symbol_table() -> np.ndarray:
    """Code point -> symbol: 0 for no letter, else the lower-cased letter folded to 16 bits."""
    table = np.zeros(0x110000, np.uint16)
    for cp in range(0x32400):
        if chr(cp).isalpha():
            table[cp] = ord(chr(cp).lower()[0]) % 65521 + 1
    return table


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols in a row, each text behind a 0, single 0 between words; starts of the texts."""
    joined = "\n".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])      # each text's leading newline
    codes = table[points]
    first = np.zeros(len(codes), bool)
    first[begin] = True
    keep = (codes > 0) | first
    keep[1:] |= codes[:-1] > 0       # the first space behind a letter
    # A text's leading mark and a space before it would be two zeros in a row: harmless.
    at = np.cumsum(keep) - 1
    return codes[keep], at[begin]


def ngrams(codes: np.ndarray, order: int) -> np.ndarray:
    """The hash of the ``order`` symbols that end at each position (zeros before the first)."""
    out = codes.astype(np.uint64)
    whole = out.copy()
    for back in range(1, order):
        shifted = np.zeros_like(out)
        shifted[back:] = out[:-back]
        whole |= shifted << np.uint64(CODE_BITS * back)
    return whole


class Model:
    """Interpolated Kneser-Ney of one language, from its texts' symbols."""

    def __init__(self, codes: np.ndarray, order: int, n_symbols: int):
        one = np.uint64(CODE_BITS)
        grams, counts = np.unique(ngrams(codes, order), return_counts=True)
        levels = {order: (grams, counts.astype(np.float64))}
        for n in range(order - 1, 0, -1):
            # Continuation count: how many symbols stand before the n-gram.
            low = levels[n + 1][0] & ((np.uint64(1) << np.uint64(CODE_BITS * n)) - np.uint64(1))
            g, c = np.unique(low, return_counts=True)
            levels[n] = (g, c.astype(np.float64))
        self.base = 1.0 / n_symbols
        self.order = order
        self.grams: dict[int, np.ndarray] = {}
        self.prob: dict[int, np.ndarray] = {}
        self.contexts: dict[int, np.ndarray] = {}
        self.weight: dict[int, np.ndarray] = {}
        for n in range(1, order + 1):
            g, c = levels[n]
            ones, twos = float((c == 1).sum()), float((c == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            context = g >> one
            ctx, where = np.unique(context, return_inverse=True)
            total = np.bincount(where, c)
            kinds = np.bincount(where)
            weight = discount * kinds / total
            if n == 1:
                lower = np.full(len(g), self.base)
            else:
                lower = self.probability(g & ((np.uint64(1) << np.uint64(CODE_BITS * (n - 1))) - np.uint64(1)), n - 1)
            self.prob[n] = np.maximum(c - discount, 0) / total[where] + weight[where] * lower
            self.grams[n], self.contexts[n], self.weight[n] = g, ctx, weight

    @staticmethod
    def _find(sorted_, wanted):
        at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
        return at, sorted_[at] == wanted

    def probability(self, grams: np.ndarray, n: int | None = None) -> np.ndarray:
        """Of the last symbol of each n-gram after the symbols before it."""
        n = self.order if n is None else n
        at, known = self._find(self.grams[n], grams)
        out = np.where(known, self.prob[n][at], 0.0)
        miss = np.flatnonzero(~known)
        if len(miss):
            rest = grams[miss]
            if n == 1:
                lower = np.full(len(rest), self.base)
            else:
                lower = self.probability(rest & ((np.uint64(1) << np.uint64(CODE_BITS * (n - 1))) - np.uint64(1)), n - 1)
            at, seen = self._find(self.contexts[n], rest >> np.uint64(CODE_BITS))
            out[miss] = np.where(seen, self.weight[n][at], 1.0) * lower
        return out


def cross_entropy(models: list[Model], order: int, texts: list[str],
                  table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nats per symbol of each text under each model, and how many symbols are letters."""
    codes, start = symbols(texts, table)
    where, kinds = pd.factorize(ngrams(codes, order))
    steps = start[:-1]
    length = np.diff(start)
    out = np.empty((len(texts), len(models)))
    for k, model in enumerate(models):
        nats = -np.log(model.probability(kinds))
        out[:, k] = np.add.reduceat(nats[where], steps) / np.maximum(length, 1) if len(texts) else 0
    letters = np.add.reduceat((codes > 0).astype(np.int64), steps) if len(texts) else np.zeros(0, np.int64)
    return out, letters


def unseen_entropy(texts: list[str], order: int, n_symbols: int, table: np.ndarray) -> np.ndarray:
    """Cross-entropy of each text with letters, under a model of the folds it isn't in."""
    out = [np.empty(0)]
    for fold in range(min(FOLDS, len(texts)) if len(texts) > 1 else 0):
        mine = texts[fold::FOLDS]
        others = [t for i, t in enumerate(texts) if i % FOLDS != fold]
        model = Model(symbols(others, table)[0], order, n_symbols)
        for start in range(0, len(mine), 100):
            entropy, letters = cross_entropy([model], order, mine[start:start + 100], table)
            out.append(entropy[letters > 0, 0])
    return np.concatenate(out)


def rejection_limit(entropy: np.ndarray) -> float:
    """What a fresh text of the language exceeds with probability 1 - ``REJECT_QUANTILE``, about."""
    n = len(entropy)
    if n < 2:
        return np.inf
    rank = math.ceil((n + 1) * REJECT_QUANTILE)
    if rank <= n:
        return float(np.sort(entropy)[rank - 1])
    tail = NormalDist().inv_cdf(REJECT_QUANTILE) * entropy.std(ddof=1) * math.sqrt(1 + 1 / n)
    return max(float(entropy.max()), float(entropy.mean() + tail))


class Models:
    """The models of all languages."""

    def __init__(self, by_language: dict[str, list[str]], order: int = ORDER):
        self.languages = sorted(by_language)
        table = symbol_table()
        parts = {lang: symbols(texts, table) for lang, texts in by_language.items()}
        n_symbols = len(np.unique(np.concatenate([c for c, _ in parts.values()]))) + 1 if parts else 1
        self.order = order
        self.models = [Model(parts[lang][0], order, n_symbols) for lang in self.languages]
        self.limit = np.full(len(self.languages), np.inf)
        for k, lang in enumerate(self.languages):
            self.limit[k] = rejection_limit(unseen_entropy(by_language[lang], order, n_symbols, table))

    def entropy(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol of each text under each language, and how many symbols are letters."""
        return cross_entropy(self.models, self.order, texts, table)

    def score(self, texts: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score (posterior, softened), lowest cross-entropy, rejected."""
        if not self.models or not texts:
            n = len(texts)
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        entropy, letters = self.entropy(texts, table)
        best = entropy.argmin(axis=1)
        rows = np.arange(len(texts))
        low = entropy[rows, best]
        # Symbols of one text are far from independent: count a share of them.
        odds = np.exp(-np.minimum(SCALE * letters[:, None] * (entropy - low[:, None]), 700))
        score = 1.0 / odds.sum(axis=1)
        none = letters == 0
        score[none], low[none] = 0.0, np.nan
        return ([UNKNOWN if n else self.languages[b] for n, b in zip(none, best)], score, low,
                none | (low > self.limit[best]))


def sample(df: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int,
           max_chars: int = MAX_TRAIN_CHARS) -> dict[str, list[str]]:
    """At most ``per_language`` texts of each language, smallest hash of id and text first.

    What reaches the driver is bounded: ``per_language`` texts a language, of
    which ``max_chars`` characters together are kept.  A text that doesn't fit
    any more is left out by itself; the first text of a language always
    stays, and one longer than ``max_chars`` only if its language has no other.
    """
    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                     F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # Of a large language only about twice as many as wanted, those with the smallest hashes, are shuffled.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod("h", F.lit(_PLACES))
    few = join_unique(rows, sizes.withColumn("most", F.lit(2.0 * per_language + 200) / F.col("n") * _PLACES), "lang", "n")
    few = few.where(place < F.col("most"))
    first = Window.partitionBy("lang").orderBy(place, "h", "text")
    rows = few.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    out: dict[str, list[str]] = {}
    long: dict[str, str] = {}
    total = 0
    for row in rows.orderBy("n", "lang").select("lang", "text").toLocalIterator():
        lang, text = row["lang"], row["text"]
        if len(text) > max_chars:
            if lang not in out:
                long.setdefault(lang, text)
        elif lang not in out or total + len(text) <= max_chars:
            total += len(text)
            out.setdefault(lang, []).append(text)
            long.pop(lang, None)
    return out | {lang: [text] for lang, text in long.items()}


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_language: int = PER_LANGUAGE, order: int = ORDER, max_chars: int = MAX_TRAIN_CHARS) -> Models:
    """The models of :func:`sample`'s texts: ``per_language`` of each, ``max_chars`` characters of all together."""
    return Models(sample(df, text_col, lang_col, id_col, per_language, max_chars), order)


def _score_body(shared, text_col: str):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, table = shipped(shared), symbol_table()
        for whole in batches:
            column = text_of(whole, text_col).cast(pa.string())
            for start, stop in ranges(column, 2 << 20):
                lang, score, entropy, rejected = models.score(column[start:stop].to_pylist(), table)
                yield pa.RecordBatch.from_arrays(
                    [whole.column("row")[start:stop], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=["row", "lang_pred", "score", "cross_entropy", "rejected"])

    return body


def identify(df: DataFrame, models: Models, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or all), ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``."""
    shared = ship(df.sparkSession, models)
    rows = with_text(df, text_col, keep)
    return rows.mapInArrow(_score_body(shared, text_col), row_schema(
        rows, "lang_pred string, score double, cross_entropy double, rejected boolean"))
