import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import contamination, dedup_lines, jaccard_components
from odd_rows import ODD_ROWS
from urbanlens.llm import factorisation, mixing
from urbanlens.llm.common import table
from urbanlens.llm.queries import quality_machine

SF = "/root/testdata/sf0.001"


def _corpus(ready):
    rows = [(i, ["big", "mid", "small"][0 if i % 10 < 7 else 1 if i % 10 < 9 else 2], "w " * (5 + i % 23))
            for i in range(900)]
    return ready.createDataFrame(rows, "doc_id long, source string, text string").withColumns(
        {"key": F.lit(1), "epoch": F.lit(2), "blocks": F.lit(3)}), rows


@pytest.mark.parametrize("target", [mixing.Target("entropy", 0.97, 1.0), mixing.Target("max_epochs", 2.0, 1.0),
                                    mixing.Target("max_epochs", 3.0, 2.0), mixing.Target("entropy", 1.0, 0.5)])
def test_weights_and_budget(ready, target):
    df, rows = _corpus(ready)
    out = mixing.mix(df, target, block_tokens=200).collect()
    size, total = Counter(), sum(len(t.split()) for _, _, t in rows)
    for _, s, t in rows:
        size[s] += len(t.split())
    drawn, copies, epochs = Counter(), Counter(), Counter()
    for r in out:
        drawn[r["source"]] += r["n_tokens"]
        copies[(r["source"], r["epoch"], r["id"])] += 1
        epochs[r["source"]] = max(epochs[r["source"]], r["epoch"])
    assert max(copies.values()) == 1
    assert sum(drawn.values()) == pytest.approx(target.budget * total, abs=3 * 30)
    weight = {s: n / sum(drawn.values()) for s, n in drawn.items()}
    if target.kind == "entropy":
        assert -sum(w * math.log(w) for w in weight.values()) >= target.value * math.log(3) - 0.01
    else:
        assert max(drawn[s] / size[s] for s in size) == pytest.approx(target.value, rel=0.02)
    for s, last in epochs.items():
        for e in range(last):      # whole epochs hold every document
            assert sum(1 for k in copies if k[0] == s and k[1] == e) == sum(1 for _, x, _ in rows if x == s)


def test_epochs_are_different_permutations(ready):
    df, _ = _corpus(ready)
    out = mixing.mix(df, mixing.Target("max_epochs", 3.0, 2.0), block_tokens=200).where("source = 'small'")
    order = {e: [r["id"] for r in out.where(F.col("epoch") == e).orderBy("block_rank", "draw", "id").collect()]
             for e in (0, 1)}
    assert sorted(order[0]) == sorted(order[1]) and order[0] != order[1]
    again = mixing.mix(df.repartition(7), mixing.Target("max_epochs", 3.0, 2.0), block_tokens=200)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.where("source = 'small'").collect()))


def test_mixing_odd_rows(odd, ready):
    out = mixing.mix(odd, mixing.Target("entropy", 0.9, 3.0), block_tokens=10).collect()
    assert {r["source"] for r in out} == {"a", None}
    assert {r["id"] for r in out} == {d for d, _ in ODD_ROWS}
    assert mixing.mix(odd.where("false")).count() == 0
    blank = ready.createDataFrame([(1, "a", ""), (2, "b", None)], "doc_id long, source string, text string")
    assert mixing.mix(blank).count() == 0
    one = ready.createDataFrame([(1, "a", "x y")], "doc_id long, source string, text string")
    assert [tuple(r)[:4] for r in mixing.mix(one).collect()] == [(1, "a", 2, 0)]


def test_mixing_is_native(ready):
    df, _ = _corpus(ready)
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_pipeline_stages_match_brute_force(ready):
    """Every stage against a plain version on what the stage before it kept."""
    docs = table(ready, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "jaccard", "decontamination", "mixing"]

    good = stages["quality"](ready, docs, SF).cache()
    machine = quality_machine(ready, docs, SF)
    scores = factorisation.score(docs, machine, keep=["doc_id"]).select("row.doc_id", "score").collect()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores if r["score"] >= 0.7}

    lines = stages["line_dedup"](ready, good, SF).cache()
    before = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert {(r["doc_id"], r["text"]) for r in lines.collect()} == {(d, k) for d, _, _, k in dedup_lines(before)}

    apart = stages["jaccard"](ready, lines, SF).cache()
    texts = [(r["doc_id"], r["text"]) for r in lines.collect()]
    group = jaccard_components(texts, 5, 80, 100)
    assert {r["doc_id"] for r in apart.collect()} == {d for d, _ in texts if group[d] == d}

    clean = stages["decontamination"](ready, apart, SF).cache()
    items = [(r["item_id"], r["text"]) for r in table(ready, SF, "benchmark").collect()]
    want = set()
    for d, t in [(r["doc_id"], r["text"]) for r in apart.collect()]:
        n, hit, _ = contamination(t, items)
        if not hit or 20 * len(hit) < n:
            want.add(d)
    assert {r["doc_id"] for r in clean.collect()} == want
    for df in (good, lines, apart, clean):
        assert df.columns == docs.columns

    mixed = stages["mixing"](ready, clean, SF)
    drawn = mixed.agg(F.sum("n_tokens")).first()[0]
    assert drawn >= clean.agg(F.sum(mixing.tokens(F.col("text")))).first()[0] * 0.999
    run = corpus_pipeline.run(ready, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, mixed.collect()))


def test_pipeline_on_empty_and_odd_rows(odd, ready):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(*names), odd.select(*names).where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(ready, docs, SF)
            if name != "mixing":
                assert out.columns == names
            docs = out.cache()
            docs.count()


def test_fewer_blocks_leave_no_document_out(ready):
    """``max_blocks`` only makes blocks larger: a whole epoch holds every document once."""
    df = ready.range(300).selectExpr("id AS doc_id", "concat('s', id % 2) AS source", "repeat('word ', 20) AS text")
    for most in (1, 3, 1_000):
        out = mixing.mix(df, mixing.Target("entropy", 1.0, 1.0), block_tokens=40, max_blocks=most)
        assert sorted(r["id"] for r in out.where("epoch = 0").collect()) == list(range(300))
        assert out.select("source", "block_rank").distinct().count() <= 2 * most
