import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import ODD_ROWS, ODD_TEXTS
from urbanlens.llm import factorisation, kneser_ney, lattice
from urbanlens.llm.factorisation import Machine
from urbanlens.llm.kneser_ney import Model, Models, symbol_table, symbols
from urbanlens.llm.lattice import MARK, Lattice
from urbanlens.llm.queries import QUERIES, quality_machine

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"


# --- lattice -----------------------------------------------------------------

def _small_lattice():
    pieces = [MARK, MARK + "a", MARK + "ab", "a", "b", "ab", "ba", "bab", MARK + "b"]
    return Lattice(pieces, -np.arange(len(pieces), dtype=float))


def _all_spellings(lat, word):
    """Sum over all cuts of the marked word, by enumeration."""
    text, n = MARK + word, len(lat.pieces)
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append((at, text[at:i]))
                at = i
        parts.append((at, text[at:]))
        options = [1.0]
        for start, p in parts:
            ways = []
            if p in lat.by_text and not (start and p[0] == MARK):
                ways.append(math.exp(lat.log[lat.by_text[p]]))
            if len(p) == 1 and start and (p == MARK or p not in lat.by_text):
                ways.append(math.exp(sum(lat.log[n + b] for b in p.encode())))
            options = [o * w for o in options for w in ways]
        total += sum(options)
    return total


def test_lattice_sums_all_segmentations():
    lat = _small_lattice()
    words = ["a", "b", "ab", "abab", "babba", "xay", "é", "ba" + MARK + "a"]
    got = lat.score(words)
    for w, g in zip(words, got):
        assert g == pytest.approx(math.log(_all_spellings(lat, w)), rel=1e-9)
        assert lat._long(w) == pytest.approx(g, rel=1e-9)
    long = "ab" * 60
    assert lat.score([long])[0] == pytest.approx(lat._long(long))
    assert np.isfinite(lat.score(["q" * 3000])[0])


def test_expectation_raises_likelihood():
    lat = _small_lattice()
    words, counts = ["abab", "ab", "ba", "xab"], np.array([5, 9, 2, 1.0])
    before = (lat.score(words) * counts).sum()
    for _ in range(5):
        lat.set_weights(lat.expected(words, counts) + 1e-9)
        after = (lat.score(words) * counts).sum()
        assert after >= before - 1e-6
        before = after


def test_lattice_documents(odd):
    learn = F.col("doc_id") != 11
    out = lattice.score_documents(odd, learn, keep=["doc_id", "row"]).collect()
    assert len(out) == len(ODD_ROWS)
    teaching = [(t or "").encode().lower().split() for d, t in ODD_ROWS if d is not None and d != 11]
    counts = {}
    for words in teaching:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()) + len(teaching), len(counts) + 1
    want = sorted((len(w := (t or "").encode().lower().split()) + 1, sum(x in counts for x in w) + 1,
                   round(sum(math.log10((counts.get(x, 0) + .5) / (n + .5 * (v + 1))) for x in w)
                         + math.log10((len(teaching) + .5) / (n + .5 * (v + 1))), 6)) for _, t in ODD_ROWS)
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def test_rare_words_take_the_join(odd, monkeypatch):
    """Scores don't depend on which words are sent to the tasks."""
    def scores(limit, longest=256):
        monkeypatch.setattr(lattice, "MAX_SHIPPED", limit)
        monkeypatch.setattr(lattice, "SHIPPED_BYTES", longest)
        rows = lattice.score_documents(odd, F.col("doc_id") < 9, rounds=1, keep=["doc_id"]).collect()
        return sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 8), round(r["score"], 8)) for r in rows)

    assert scores(0) == scores(3) == scores(10_000) == scores(10_000, 4)


def test_long_words_are_learnt_whole(monkeypatch):
    """A word's length decides how it is computed, never what: one opening piece each, however long."""
    pieces, scores = lattice.read_vocabulary()
    lat = Lattice(pieces, scores)
    opens = np.array([i for i, p in enumerate(pieces) if p.startswith(MARK)])
    for word in ("a" * 65, "hello" * 26, "x中q" * 30, "ét" * 320):
        assert lat.expected([word], np.ones(1))[opens].sum() == pytest.approx(1.0)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé中▁xyz") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    counts = np.array([rng.randint(1, 5) for _ in words], float)
    want, scores = lat.expected(words, counts), lat.score(words)
    monkeypatch.setattr(lattice, "LONG", 0)
    assert np.allclose(lat.expected(words, counts), want, atol=1e-9) and np.allclose(lat.score(words), scores)


def test_every_round_learns_from_every_word(ready):
    """The fitted weights are those of rounds over all distinct words, made by hand."""
    texts = ["one two two " + "long" * 40, "two three", "seen once", None]
    df = ready.createDataFrame([(t,) for t in texts], "text string")
    counts = lattice.count_words(df)
    pieces = lattice.read_vocabulary()
    got = lattice.estimate(Lattice(*pieces), counts, len(texts), rounds=2)
    want = Lattice(*pieces)
    words = sorted({w for t in texts for w in (t or "").split()})
    for _ in range(2):
        weight = want.expected(words, np.ones(len(words))) + lattice._FLOOR
        weight[-1] = 1.0
        want.set_weights(weight)
    assert np.allclose(got.log, want.log)


def test_scores_of_whole_documents(odd):
    """Against a plain recursion over each word and the counts of all training texts."""
    learn = [(t or "").encode().lower().split() for d, t in ODD_ROWS if d is not None and d < 9]
    counts = {}
    for words in learn:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()) + len(learn), len(counts) + 1
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    spare = discount * v / n
    lat = Lattice(*lattice.read_vocabulary())       # no rounds: the vocabulary's own weights

    def spelt(word):
        text = MARK + word
        ways = [1.0] + [0.0] * len(text)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + lat.longest) + 1):
                part = text[i:j]
                p = 0.0
                if part in lat.by_text and not (i and part[0] == MARK):
                    p = math.exp(lat.log[lat.by_text[part]])
                elif j == i + 1 and i and (part == MARK or part not in lat.by_text):
                    p = math.exp(sum(lat.log[len(lat.pieces) + b] for b in part.encode()))
                ways[j] += ways[i] * p
        return math.log10(ways[-1]) if ways[-1] else None

    def mixed(c, log):
        return math.log10(spare) + log if c <= discount else math.log10((c - discount) / n + spare * 10 ** log)

    out = lattice.score_documents(odd, F.col("doc_id") < 9, rounds=0, keep=["doc_id"]).collect()
    want = []
    for _, t in ODD_ROWS:
        words = (t or "").encode().lower().split()
        logs = [spelt(w.decode()) for w in words]
        if None in logs:        # beyond the range of plain floats: the long word of one letter
            continue
        end = lat.end / math.log(10)
        want.append((len(words) + 1, round(sum(logs) + end, 5),
                     round(sum(mixed(counts.get(w, 0), x) for w, x in zip(words, logs)) + mixed(len(learn), end), 5)))
    got = [(r["n_tokens"], round(r["lattice_score"], 5), round(r["score"], 5)) for r in out]
    assert len(want) >= len(ODD_ROWS) - 1 and all(min(
        abs(w[1] - g[1]) + abs(w[2] - g[2]) for g in got if g[0] == w[0]) < 1e-4 for w in want)


def test_lattice_nothing_to_learn(odd, ready):
    out = lattice.score_documents(odd, F.lit(False), rounds=1, keep=["doc_id"])
    assert {(r["n_known"], r["train_tokens"]) for r in out.collect()} == {(0, 0)}
    empty = ready.createDataFrame([], "doc_id long, text string")
    assert lattice.score_documents(empty, F.lit(True), keep=["doc_id"]).count() == 0


def test_lattice_query_and_word_distribution(ready):
    out = QUERIES["op2_lattice"](ready, SF).toPandas()
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in out.doc_id]
    assert (out.held_out == held).all() and len(out) == 200
    # Word arcs help on words that were seen: within a tenth of the word unigram on training texts.
    seen = out[~out.held_out]
    assert seen.score.sum() > 1.1 * seen.base_score.sum()


# --- Kneser-Ney --------------------------------------------------------------

def test_probabilities_sum_to_one():
    table = symbol_table()
    codes, _ = symbols(["the cat sat on the mat", "that cat", "a hat"], table)
    kinds = np.unique(codes)
    model = Model(codes, 3, len(kinds))
    for context in [(0, 0), (kinds[3], kinds[1]), (kinds[-1], kinds[-1]), (int(table[ord("t")]), int(table[ord("h")]))]:
        grams = np.array([(int(context[0]) << 32) | (int(context[1]) << 16) | int(k) for k in kinds], np.uint64)
        assert model.probability(grams).sum() == pytest.approx(1.0, abs=1e-9)


def test_symbols_keep_texts_apart():
    table = symbol_table()
    codes, start = symbols(["ab  c!", "", "!!", "Z"], table)
    a, b, c, z = (int(table[ord(x)]) for x in "abcz")
    assert codes.tolist()[:6] == [0, a, b, 0, c, 0]
    assert len(start) == 5 and codes[start[3] + 1] == z and start[-1] == len(codes) - 1


def test_language_of_held_out_documents(ready):
    out = QUERIES["op9_language"](ready, BIG).toPandas()
    lang = ready.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").toPandas()
    met = out.merge(lang, on="doc_id")
    held = met[met.held_out]
    assert len(met) == 1000 and len(held) > 150
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert met.score.between(0, 1).all()
    assert (met.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in met.doc_id]).all()


def test_language_odd_rows(odd, ready):
    models = kneser_ney.fit(odd)
    out = kneser_ney.identify(odd, models, keep=["doc_id", "text", "row", "score"]).collect()
    assert len(out) == len(ODD_ROWS)
    for r in out:
        letters = any(c.isalpha() for c in (r["row"]["text"] or ""))
        assert r["lang_pred"] == ("en" if letters else "und")
        assert (r["score"] == 0) == (not letters)
    nothing = kneser_ney.fit(odd.where("false"))
    assert {r["lang_pred"] for r in kneser_ney.identify(odd, nothing).collect()} == {"und"}
    assert kneser_ney.identify(odd.where("false"), models).count() == 0


def test_rejection_is_calibrated():
    rng = random.Random(2)
    english = [" ".join(rng.choices(["the", "of", "and", "that", "with", "from"], k=40)) for _ in range(30)]
    german = [" ".join(rng.choices(["der", "und", "nicht", "mit", "auf", "eine"], k=40)) for _ in range(30)]
    models = Models({"en": english, "de": german})
    lang, score, entropy, rejected = models.score(english[:3] + german[:3] + ["qxzj wvkq zzxq jjqk " * 9], symbol_table())
    assert lang[:6] == ["en"] * 3 + ["de"] * 3 and not rejected[:6].any() and rejected[6]
    assert (score[:6] > 0.9).all() and entropy[6] > entropy[:6].max()


def test_sample_is_bounded(odd):
    df = odd.where(F.col("text").isNotNull())
    got = kneser_ney.sample(df, "text", "lang", "doc_id", 4)
    assert {k: len(v) for k, v in got.items()} == {"en": 4}


def test_an_over_long_text_is_skipped_alone(ready):
    """Of 30 texts, the one longer than the bound leaves no other out, whatever its place in the sample."""
    texts = [f"{lang} text number {i}" for i in range(15) for lang in ("de", "en")]
    for long in range(0, 30, 7):
        rows = [(i, "en" if i % 2 else "de", t * 200 if i == long else t) for i, t in enumerate(texts)]
        df = ready.createDataFrame(rows, "doc_id long, lang string, text string")
        got = kneser_ney.sample(df, "text", "lang", "doc_id", 100, max_chars=1000)
        assert sorted(t for v in got.values() for t in v) == sorted(t for i, t in enumerate(texts) if i != long)
    # The bound holds, and a language whose only text is over-long learns from it.
    rows = [(i, "en", "x" * 10) for i in range(30)] + [(50, "de", "y" * 500)]
    got = kneser_ney.sample(ready.createDataFrame(rows, "doc_id long, lang string, text string"), "text", "lang",
                            "doc_id", 100, max_chars=105)
    assert {k: len(v) for k, v in got.items()} == {"en": 10, "de": 1}


# --- factorisation machine ---------------------------------------------------

def test_square_identity_equals_all_pairs():
    rng = np.random.default_rng(4)
    m = Machine(np.zeros(20), np.ones(20))
    m.factor = rng.normal(size=m.factor.shape)
    m.weight = rng.normal(size=m.weight.shape)
    slots = rng.choice(len(m.weight), 30, replace=False)
    values = rng.normal(size=30)
    margin, _, _ = m.margin(slots, values, np.zeros(30, int), 1)
    pairs = sum(m.factor[a] @ m.factor[b] * x * y
                for (a, x), (b, y) in itertools.combinations(zip(slots, values), 2))
    assert margin[0] == pytest.approx(m.bias[0] + m.weight[slots] @ values + pairs)


def test_quality_of_held_out_documents(ready):
    out = QUERIES["op4_quality"](ready, BIG).toPandas()
    labels = ready.read.parquet(f"{BIG}/labels.parquet").toPandas()
    met = out.merge(labels, on="doc_id")
    held = met[met.held_out]
    assert len(out) == 1000 and out.score.between(0, 1).all()
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()
    assert (held.quality == held.predicted).mean() > 0.93
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()


def test_quality_never_reads_forbidden_columns(ready):
    """Scores stay the same with label, language, source and id replaced."""
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    machine = quality_machine(ready, docs, SF)
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.lit(5)})
    plain = sorted(r["score"] for r in factorisation.score(docs, machine, keep=["doc_id"]).collect())
    other = sorted(r["score"] for r in factorisation.score(changed, machine, keep=["doc_id"]).collect())
    assert plain == other


def test_quality_odd_rows(odd, ready):
    labels = ready.createDataFrame([(1, 1), (1, 0), (5, 1), (None, 1), (10, None), (10, 1), (14, 0), (2, 0)],
                                   "doc_id long, quality int")
    machine = factorisation.fit(odd, labels, epochs=2)
    out = factorisation.score(odd, machine, keep=["doc_id", "score"]).collect()
    assert len(out) == len(ODD_TEXTS) + 4 and all(0 <= r["score"] <= 1 for r in out)
    assert factorisation.fit(odd, labels.where("false")) is None
    assert {r["score"] for r in factorisation.score(odd, None).collect()} == {0.5}
    kept = factorisation.keep_good(odd, machine)
    assert kept.columns == odd.columns and factorisation.keep_good(odd, None).count() == odd.count()
    assert factorisation.score(odd.where("false"), machine).count() == 0
    without = odd.drop("n_chars")
    assert factorisation.score(without, machine).count() == len(ODD_ROWS)


def test_fresh_texts_of_a_rich_vocabulary_are_not_rejected():
    """The limit comes from unseen texts, so fresh ones of the language pass whatever the size of the sample."""
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 11))) for _ in range(5000)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(900)]
    for n in (20, 100, 400):
        models = Models({"en": texts[:n]})
        rejected = models.score(texts[500:], symbol_table())[3]
        assert rejected.mean() <= (0.02 if n < 100 else 0.01)
        assert models.score(["ΑΒΓ ΔΕΖ ΗΘΙ " * 20], symbol_table())[3].all()


def test_limit_by_rank():
    values = np.random.default_rng(1).permutation(np.arange(2000.0))
    assert kneser_ney.rejection_limit(values) == 1998.0           # ceil(2001 * 0.999) = 1999th smallest
    assert kneser_ney.rejection_limit(values[:1]) == np.inf and kneser_ney.rejection_limit(values[:0]) == np.inf
    assert kneser_ney.rejection_limit(np.array([2.0, 2.0, 2.0])) == 2.0
