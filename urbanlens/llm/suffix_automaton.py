"""Benchmark decontamination with a generalised suffix automaton.

The automaton accepts every run of words of every benchmark item.  Document
words stream through it; the state after a word stands for the longest run of
words, ending there, that some item holds.  Where that run has ``window``
words or more, the last ``window`` of them are an occurrence of an item
window; an item shorter than a window must occur whole.  All words inside
occurrences are *hit*.

The automaton grows with the benchmark, not with the documents.  The driver
builds it once and sends it as flat arrays (sorted transitions, links,
lengths), which tasks open without building anything.  Past ``max_states``
states a further automaton is begun, and a single item larger than that is cut
into pieces that share ``window - 1`` words, so all its windows stay; one scan
of the documents goes through several automata.  Arrays beyond
``max_pass_bytes`` make a further pass, which adds to what the passes before
have found, so what is built and sent at once has a fixed bound.

Defined results: null or empty text has no words and no hits; items without
words are ignored; equal items each count; items whose id is null hit like
any other and stand together as one null, last, in the list of items; an
empty benchmark hits nothing;
rows with equal ids are judged one by one.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import cut, ranges, text_of, unpacked, with_text

WINDOW = 13
COVERAGE = (1, 20)              # hit words to all words
MAX_STATES = 200_000            # of an automaton; about 200 MB and six seconds while the driver builds it
MAX_PASS_BYTES = 64 << 20       # of the arrays that tasks open at once

# Word characters: digits, letters and everything beyond ASCII.  A-Z lower-cased.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Builder:
    """A generalised suffix automaton of word sequences, grown word by word; states know which items end in them."""

    def __init__(self, window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names: list[str | None] = []
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.holds: dict[int, set[int]] = {}             # items with an occurrence that ends in the state
        self.whole: dict[int, dict[int, set[int]]] = {}  # short items that end in the state, by length

    def add(self, name: str | None, sequence: list[bytes]) -> None:
        number, last = len(self.names), 0
        self.names.append(name)
        for word in sequence:
            last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
            self.holds.setdefault(last, set()).add(number)
        if sequence and len(sequence) < self.window:
            self.whole.setdefault(last, {}).setdefault(len(sequence), set()).add(number)

    def _state(self, transitions: dict[int, int], link: int, length: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._state({}, 0, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._clone(at, word, target)
        return state

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(dict(self.next[target]), self.link[target], self.length[at] + 1)
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def arrays(self) -> dict:
        """The automaton as flat arrays (bytes), which a task opens without building anything."""
        n, window, holds = len(self.length), self.window, self.holds
        order = sorted(range(1, n), key=self.length.__getitem__)
        # What ends in a state ends in every shorter suffix of it too.
        for state in reversed(order):
            if self.link[state] > 0 and state in holds:
                holds.setdefault(self.link[state], set()).update(holds[state])
        full, members, ends = [-1] * n, array("i"), array("i", [0])
        short, shorts = [0] * n, [()]
        for state in order:
            up = self.link[state]
            if self.length[state] >= window:
                if self.length[up] < window:      # the state whose lengths include ``window``
                    full[state] = len(ends) - 1
                    members.extend(sorted(holds[state]))
                    ends.append(len(members))
                else:
                    full[state] = full[up]
            short[state] = short[up]
            if state in self.whole:
                mine = tuple((k, tuple(sorted(who))) for k, who in sorted(self.whole[state].items()))
                short[state] = len(shorts)
                shorts.append(shorts[short[up]] + mine)
        begin, word, to = array("i", [0]), array("i"), array("i")
        for transitions in self.next:
            for key in sorted(transitions):
                word.append(key)
                to.append(transitions[key])
            begin.append(len(word))
        flat = {"begin": begin, "word": word, "to": to, "link": array("i", self.link),
                "length": array("i", self.length), "full": array("i", full), "short": array("i", short),
                "members": members, "ends": ends}
        return {k: v.tobytes() for k, v in flat.items()} | {
            "words": b"\n".join(self.ids), "names": self.names, "shorts": shorts, "window": window}


class SuffixAutomaton:
    """The opened arrays of a :class:`Builder`; scans word sequences."""

    def __init__(self, parts: dict):
        self.names, self.shorts, self.window = parts["names"], parts["shorts"], parts["window"]
        self.flat = {k: memoryview(v).cast("i") for k, v in parts.items() if k in (
            "begin", "word", "to", "link", "length", "full", "short", "members", "ends")}
        found = parts["words"].split(b"\n") if parts["words"] else []
        self.ids = dict(zip(found, range(len(found))))

    def scan(self, sequence: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words as (first, behind last), in order, and the items that occur."""
        begin, words_, targets, link, length, full, short, members, ends = (self.flat[k] for k in (
            "begin", "word", "to", "link", "length", "full", "short", "members", "ends"))
        ids, shorts, window = self.ids.get, self.shorts, self.window
        spans: list[list[int]] = []
        items: set[int] = set()
        state = run = 0
        for i, text in enumerate(sequence):
            word = ids(text)
            if word is None:
                state = run = 0
                continue
            while True:              # ends at the root, whose transitions are all words, in order
                stop = begin[state + 1]
                at = bisect_left(words_, word, begin[state], stop) if state else word
                if at < stop and words_[at] == word:
                    break
                state = link[state]
                run = length[state]
            state = targets[at]
            run += 1
            back = 0
            if run >= window:
                back = window
                items.update(members[ends[full[state]]:ends[full[state] + 1]])
            if short[state]:
                for n, who in shorts[short[state]]:
                    if n <= run:
                        back = max(back, n)
                        items.update(who)
            if back:
                first = i + 1 - back
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = i + 1
                    spans[-1][0] = min(spans[-1][0], first)
                else:
                    spans.append([first, i + 1])
        # A long window may reach back over earlier short runs.
        return _merge([(a, b) for a, b in spans]), items


def _cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans`` (and what stands between them)."""
    marks = text.translate(_TO_WORDS)
    begin, end, at = [], [], 0
    for word in marks.split(b" "):
        if word:
            begin.append(at)
            end.append(at + len(word))
        at += len(word) + 1
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:begin[a]])
        at = end[b - 1]
    out.append(text[at:])
    return b"".join(out)


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_body(shared, text_col: str, clean: bool):
    """Adds one pass's items to what earlier passes have found."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [SuffixAutomaton(parts) for parts in shared.value]
        for whole in batches:
            column = text_of(whole, text_col)
            for start, stop in ranges(column):
                batch = whole.slice(start, stop - start)
                count, spans_out, found, cleaned = [], [], [], []
                for text, old_spans, old_items in zip(column[start:stop].to_pylist(),
                                                      batch.column("spans").to_pylist(),
                                                      batch.column("items").to_pylist()):
                    sequence = words(text)
                    spans, names = [(s["first"], s["behind"]) for s in old_spans], list(old_items)
                    for automaton in automata:
                        more, items = automaton.scan(sequence)
                        spans += more
                        names += [automaton.names[i] for i in items]
                    spans = _merge(spans)
                    count.append(len(sequence))
                    spans_out.append([{"first": a, "behind": b} for a, b in spans])
                    found.append(names)
                    cleaned.append(_cut_spans(text, spans) if clean and spans else None)
                new = {"n_words": pa.array(count, pa.int64()), "spans": pa.array(spans_out, SPANS),
                       "items": pa.array(found, pa.list_(pa.string())),
                       "clean": pa.array(cleaned, pa.binary()).cast(pa.string())}
                names = batch.schema.names
                yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    return body


def _pieces(sequence: list[bytes], window: int, most: int) -> Iterator[list[bytes]]:
    """The words in pieces of at most ``most`` (at least a window), which together have all its windows."""
    step = max(1, most - window + 1)
    for start in range(0, max(1, len(sequence) - window + 1), step):
        yield sequence[start:start + step + window - 1]


def automata(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_states: int,
             max_pass_bytes: int) -> Iterator[list[dict]]:
    """The items' automata as arrays, in passes of bounded size; one pass at least.

    An automaton takes pieces until it has ``max_states`` states; a piece of
    n words adds 2 n at most, so none has over twice that.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    items = items.where(F.col("text").isNotNull())
    ready: list[dict] = []
    size = 0
    builder = Builder(window)

    def closed() -> None:
        nonlocal builder, size
        ready.append(builder.arrays())
        size += sum(len(v) for v in ready[-1].values() if isinstance(v, bytes))
        builder = Builder(window)

    for row in items.toLocalIterator():
        sequence = words(row["text"].encode("utf-8", "surrogatepass"))
        if not sequence:
            continue
        for piece in _pieces(sequence, window, max(window, max_states // 2)):
            if len(builder.length) >= max_states:
                closed()
                if size >= max_pass_bytes:
                    yield ready
                    ready, size = [], 0
            builder.add(row["item"], piece)
    closed()
    yield ready


def scan_documents(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW, coverage: tuple[int, int] = COVERAGE,
                   keep: list[str] | None = None, clean: bool = False,
                   max_states: int = MAX_STATES, max_pass_bytes: int = MAX_PASS_BYTES) -> DataFrame:
    """``row``, ``n_words``, ``spans`` (hit word runs), ``items`` (sorted), ``clean``, ``n_hit``, ``contaminated``.

    ``row`` has the ``keep`` columns (or all).  ``contaminated``: a word is hit,
    and hit words are at least ``coverage`` (a fraction) of all words.
    ``clean=True`` fills ``clean`` with the text without its hit runs (null
    where nothing is hit).
    """
    spark = df.sparkSession
    out = with_text(df, text_col, keep).select(
        "*", F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:bigint,behind:bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"), F.lit(None).cast("string").alias("clean"))
    passes = automata(benchmark, item_col, item_text_col, window, max_states, max_pass_bytes)
    now, more = next(passes), True
    while more:
        following = next(passes, None)
        shared = spark.sparkContext.broadcast(now)
        out = out.mapInArrow(_scan_body(shared, text_col, clean and following is None), out.schema)
        more = following is not None
        if more:
            out = cut(out, "contamination")
            shared.unpersist()
            now = following
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["behind"] - s["first"])
    out = out.withColumns({"items": F.array_sort(F.array_distinct("items")), "n_hit": n_hit})
    part, of = coverage
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * of >= F.col("n_words") * part))


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                  max_span: int | None = None, **options) -> DataFrame:
    """``df`` without contaminated documents.

    ``max_span`` also removes, from the documents that stay, every run of hit
    words if one of them is longer than that (``length_col`` then counts the
    code points anew); None leaves their texts as they are.
    """
    out = scan_documents(df, benchmark, text_col, clean=max_span is not None, **options).where(~F.col("contaminated"))
    if max_span is None:
        return out.select(*unpacked(df.columns))
    long = F.exists("spans", lambda s: s["behind"] - s["first"] > max_span)
    new = {text_col: F.when(long, F.col("clean")).otherwise(F.col("row").getField(text_col))}
    if length_col in df.columns:
        new[length_col] = F.when(long, F.length("clean")).otherwise(
            F.col("row").getField(length_col)).cast(df.schema[length_col].dataType)
    return out.select(*unpacked(df.columns, new))
