"""Divergence audit, importance resampling and suffix-array dedup against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from odd_rows import ODD_ROWS
from urbanlens.llm import divergence, previous_factor, repeat_runs, resampling, split_filter, suffix_dedup


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Divergence ---------------------------------------------------------------------------------

def plain_audit(docs, min_docs, top=10):
    """(text, lang, source) rows -> the audit's rows."""
    words = [(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", _lower(t)), g or "", s or "") for t, g, s in docs]
    found = defaultdict(Counter)
    for w, g, _ in words:
        found[g].update(set(w))
    kept = {g: sorted(t for t, n in c.items() if n >= min_docs) for g, c in found.items()}
    counts = defaultdict(Counter)
    for w, g, s in words:
        for key in ((g, s), (g, None)):
            counts[key].update(t for t in w if t in set(kept.get(g, ())))
    share = {}
    for g, s in {(g, s) for _, g, s in words} | {(g, None) for _, g, _ in words}:
        c, v = counts[(g, s)], len(kept.get(g, ()))
        total = sum(c.values()) + 2 * v
        share[(g, s)] = {t: 1 + 10**9 * (c[t] + 2) // total for t in kept.get(g, ())}

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for g, s in sorted({(g, s) for _, g, s in words}):
        p, q = share[(g, s)], share[(g, None)]
        pairs = [(sum(apart(p[t], share[(g, o)][t]) for t in p), o)
                 for g2, o in sorted({(g, s) for _, g, s in words}) if g2 == g and o != s]
        terms = [(apart(p[t], q[t]), t) for t in p if counts[(g, s)][t] and p[t] > q[t]]
        for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
            rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:most]
            out += [(g, s, part, item, value, i + 1) for i, (value, item) in enumerate(rows)]
    return sorted(out)


def _audited(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def test_audit_of_random_groups(ready):
    rng = random.Random(5)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(6)] + ["É", "ß", "Zz"]
    docs = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) + rng.choice(["", " 12 a-b.C"]),
             rng.choice(["en", "en", "de", None, ""]), rng.choice([f"s{i}" for i in range(9)] + [None])) for _ in range(400)]
    docs += [("", "fr", "only"), (None, "it", "x"), ("rare words", "it", "y")]
    df = ready.createDataFrame(docs, "text string, lang string, source string").repartition(5)
    want = plain_audit(docs, 10)
    assert _audited(df) == want
    # Many small blocks on every axis give the same sums.
    assert _audited(df, group_block=2, term_block=5) == want


def test_audit_of_odd_rows(ready, odd):
    docs = [(t, "en", "a" if i is not None and i % 3 == 0 else None) for i, t in ODD_ROWS]
    assert _audited(odd, min_docs=2) == plain_audit(docs, 2)
    assert _audited(odd.where("false")) == []


def test_shares_are_exact_beyond_64_bits(ready):
    from pyspark.sql import functions as F
    n, total, terms = 9 * 10**12, 10**13 + 7, 10**6
    row = ready.range(1).select(divergence._share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 2) // (total + 2 * terms)


# Resampling ----------------------------------------------------------------------------------

def plain_resample(docs, target, least=1, most=1, percent=10, least_words=20, buckets=10_000):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", _lower(text))
        grams = [" ".join(w[i:i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    mine = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in mine for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in s}
    rows = []
    for d, n, f in mine:
        weight = sum(gain[b] for b in f)
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, n, len(f), weight, score, None])
    able = sorted((r for r in rows if r[4] is not None and r[1] >= least_words), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=repr)


def _resampled(df, target, **options):
    out = resampling.resample(df, target, **options)
    return sorted(((r["id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3), (2, 2), (3, 4)])
def test_resampling_of_random_texts(ready, least, most):
    rng = random.Random(least * 10 + most)
    words = [f"Word{i}" for i in range(60)] + ["É", "naïve", "7"]
    docs = [(i // 2 if i < 40 else i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(300)]
    target = [" ".join(rng.choices(words[:20], k=30)) for _ in range(20)] + [None]
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(4)
    goal = ready.createDataFrame([(t,) for t in target], "text string")
    assert _resampled(df, goal, least=least, most=most, percent=30) == plain_resample(docs, target, least, most, 30)


def test_resampling_of_odd_rows(ready, odd):
    goal = ready.createDataFrame([("one two w1 w2",)], "text string")
    assert _resampled(odd, goal, percent=100, least_words=1) == plain_resample(
        ODD_ROWS, ["one two w1 w2"], percent=100, least_words=1)
    assert _resampled(odd.where("false"), goal) == []
    assert _resampled(odd, goal.where("false"), percent=50, least_words=0) == plain_resample(
        ODD_ROWS, [], percent=50, least_words=0)


def test_equal_scores_go_to_smaller_ids(ready):
    scored = ready.range(1000).selectExpr("id % 7 AS score")
    from pyspark.sql import functions as F
    for draws in (1, 10, 143, 500, 1000):
        able = F.lit(True)
        assert scored.where(resampling._candidates(scored, able, draws)).count() >= draws


# Suffix arrays -------------------------------------------------------------------------------

def plain_passages(docs, size, keep):
    """(id, text) -> (id, n_bytes, n_removed, n_spans, kept), by all windows."""
    texts = [(t or "").encode() for _, t in docs]
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    seen = defaultdict(list)
    for i in order:
        for p in range(len(texts[i]) - size + 1):
            seen[texts[i][p:p + size]].append((i, p))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places[1 if keep == "first" else 0:]:
                gone[i][p:p + size] = b"\1" * size
    out = []
    for (d, _), t, g in zip(docs, texts, gone):
        spans = len(re.findall(b"\1+", bytes(g)))
        out.append((d, len(t), sum(g), spans, bytes(c for c, x in zip(t, g) if not x)))
    return sorted(out, key=repr)


def _deduped(df, **options):
    rows = suffix_dedup.dedup_passages(df, columns=["doc_id"], **options).collect()
    return sorted(((r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows), key=repr)


def _passages(rng, n):
    pool = ["".join(rng.choices("abcé \n", k=rng.randint(5, 60))) for _ in range(12)]
    return [(i, "".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=rng.randint(1, 30)))
                        for _ in range(rng.randint(0, 8)))) for i in range(n)]


@pytest.mark.parametrize("size,keep", [(1, "none"), (4, "first"), (20, "none"), (33, "first")])
def test_passages_of_random_texts(ready, size, keep):
    docs = _passages(random.Random(size), 60) + [(100, "x" * 300), (101, "xy" * 100), (102, "x" * 40)]
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain_passages(docs, size, keep)
    assert _deduped(df, min_bytes=size, keep=keep) == want
    # Blocks of a group each, and every group halved down to single windows.
    assert _deduped(df, min_bytes=size, keep=keep, max_kinds=3, block_bytes=1) == want


@pytest.mark.parametrize("keep", ["none", "first"])
def test_one_passage_in_most_texts_with_other_surroundings(ready, keep):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefghij ", k=260))
    docs = [(i, "".join(rng.choices("klmnop", k=rng.randint(0, 150))) + (passage if i % 3 else "")
             + "".join(rng.choices("qrstuv", k=rng.randint(0, 150)))) for i in range(90)]
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(6)
    # Hot groups are halved, and the task's groups stay small.
    assert _deduped(df, keep=keep, max_kinds=5) == plain_passages(docs, 200, keep)


def test_passages_of_odd_rows(odd):
    got = _deduped(odd, min_bytes=8, keep="none")
    assert got == plain_passages(ODD_ROWS, 8, "none")
    assert _deduped(odd.where("false")) == []
    assert suffix_dedup.dedup_passages(odd).schema["row"].dataType == odd.schema


def test_long_texts_are_cut_into_pieces(ready, monkeypatch):
    """Windows of all pieces together are all windows, each once."""
    monkeypatch.setattr(repeat_runs, "PIECE", 64)
    texts = [b"a" * 500, bytes(random.Random(1).choices(b"abc", k=777)), b"", b"short", bytes(range(200)) * 2]
    for size in (1, 8, 33):
        seen = defaultdict(list)
        for row, start, windows, *_ in repeat_runs.text_runs(pa.array(texts, pa.binary()), size):
            for r, s, w in zip(row.tolist(), start.tolist(), windows.tolist()):
                seen[r].extend(range(s, s + w))
        for i, t in enumerate(texts):
            assert sorted(seen[i]) == list(range(max(len(t) - size + 1, 0)))


def test_longest_previous_factors():
    rng = random.Random(1)
    for cap in (1, 3, 8, 9, 24, 30, 73):
        text = bytes(rng.choices(b"ab", k=150))
        text += text[:100]
        starts = np.arange(len(text) - cap + 1)
        got = previous_factor.longest_previous(
            previous_factor.SuffixOrder(np.frombuffer(text, np.uint8), starts, cap), starts)
        for i in starts:
            common = [next((k for k in range(cap) if text[j + k] != text[i + k]), cap) for j in range(i)]
            assert got[i] == max(common, default=0)


def test_split_filter_holds_every_hash(ready):
    df = ready.range(40_000).selectExpr("xxhash64(id) AS h")
    hashes = np.array([r["h"] for r in df.collect()], np.int64)
    for parts in (1, 32):
        data, made = split_filter.build(df, 40_000 if parts == 1 else 30_000_000)
        assert made == parts and split_filter.SplitFilter(data, made).has(hashes).all()
    data, made = split_filter.build(df, 40_000)
    assert split_filter.SplitFilter(data, made).has(np.random.default_rng(1).integers(0, 1 << 62, 20_000)).mean() < 0.05
    data, made = split_filter.build(df.where("false"), 0)
    assert not split_filter.SplitFilter(data, made).has(hashes).any()
