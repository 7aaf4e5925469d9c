import random

import numpy as np
import pytest

from brute import components, jaccard_components, shingles
from odd_rows import ODD_ROWS
from urbanlens.llm import hyperplanes, partenum
from urbanlens.llm.components import connected_components
from urbanlens.llm.partenum import Shingles, Signatures


def test_components_match_union_find(ready):
    rng = random.Random(5)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(2000, i) for i in range(1900, 2100)] + [(7, 7)]
    df = ready.createDataFrame(links + links[:20] + [(None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    want = components(nodes, [(a, b) for a, b in links if a != b])
    assert got == want
    assert connected_components(ready.createDataFrame([], "a long, b long")).count() == 0


def _near_copies(rng, n, groups):
    words = [f"v{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([3, 5, 8, 12, 30, 80, 200]))
        for _ in range(n):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                at = rng.randrange(len(copy) + 1)
                copy[at:at + rng.randint(0, 1)] = [rng.choice(words)]
            out.append(" ".join(copy))
    rng.shuffle(out)
    return [(i * 3, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("size,part,of", [(4, 85, 100), (5, 80, 100)])
def test_jaccard_groups_match_brute_force(ready, size, part, of):
    docs = _near_copies(random.Random(size), 12, 25)
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component"])
           for r in partenum.similar_groups(df, size=size, part=part, of=of).collect()}
    want = jaccard_components(docs, size, part, of)
    assert got == {d: (len(shingles(t, size)), want[d]) for d, t in docs}


def test_large_clusters_are_compared_in_blocks(ready, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_SETS", 7)
    monkeypatch.setattr(partenum, "GROUP_BLOCK", 5)
    monkeypatch.setattr(partenum, "MAX_SENT_IDS", 3)
    docs = _near_copies(random.Random(9), 40, 4)
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["id"]: r["component"] for r in partenum.similar_groups(df).collect()}
    assert got == jaccard_components(docs, 5, 80, 100)


def _sets(rng, families, n, size):
    """``families`` groups of near copies, n sets each, the second half of every group off by a fifth."""
    out = []
    for _ in range(families):
        whole = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
        for i in range(n):
            core = whole[:size] if i < n // 2 else np.concatenate([whole[:size - size // 6], whole[size:size + size // 6]])
            out.append(np.unique(np.concatenate([core[int(rng.integers(0, 3)):], rng.integers(0, 1 << 63, 2).astype(np.uint64)])))
    return out


def _all_links(sets, part, of):
    out = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(a, sets[j]))
            if of * common >= part * (len(a) + len(sets[j]) - common):
                out.append((i, j))
    return out


def test_links_of_a_block_are_those_of_all_pairs():
    sets = _sets(np.random.default_rng(3), 4, 14, 60)
    names = list(range(len(sets)))
    links = partenum.block_links(names, sets, 80, 100)
    want = _all_links(sets, 80, 100)
    assert components(names, links) == components(names, want) and set(map(frozenset, links)) <= set(map(frozenset, want))
    assert len(links) == len(names) - len(set(components(names, want).values()))


def test_links_of_what_is_apart():
    """Askers of large, small and mixed sides: with the links inside the sides, all components are found."""
    rng = np.random.default_rng(4)
    sets = _sets(rng, 3, 24, 60)
    names, want = list(range(len(sets))), _all_links(sets, 80, 100)
    inside = [e for e in want if rng.random() < 0.03]
    sides = components(names, inside)
    asking = [i for i in names if i % 3 or sides[i] != i]
    links = partenum.apart_links(names + asking, [sides[i] for i in names + asking], [False] * len(names) + [True] * len(asking),
                                 sets + [sets[i] for i in asking], 80, 100)
    kept = [(i, j) for i, j in want if i in asking or j in asking]
    assert components(names, inside + links) == components(names, inside + kept)
    assert set(map(frozenset, links)) <= set(map(frozenset, want))


def test_a_block_of_near_copies_takes_one_look_each(monkeypatch):
    whole = np.random.default_rng(5).integers(0, 1 << 63, 1000).astype(np.uint64)
    sets = [np.unique(np.delete(whole, i % 1000)) for i in range(500)]
    looks, linked = [], partenum.Postings.linked
    monkeypatch.setattr(partenum.Postings, "linked", lambda *a: looks.append(a[1]) or linked(*a))
    assert len(partenum.block_links(range(500), sets, 80, 100)) == 499 and len(looks) == 1


def test_large_groups_left_apart_take_a_second_pass(ready, monkeypatch):
    """Chains of documents that pivots can't join, and one signature that most documents share."""
    monkeypatch.setattr(partenum, "BLOCK_SETS", 4)
    monkeypatch.setattr(partenum, "GROUP_BLOCK", 4)
    monkeypatch.setattr(partenum, "PIVOTS", 1)
    words = [f"w{i}" for i in range(260)]
    docs = [(i, " ".join(words[2 * i:2 * i + 60])) for i in range(90)]       # each like its next ones alone
    docs += [(200 + i, " ".join(words[:60] + [f"x{i}"])) for i in range(40)]
    docs += [(300 + i, " ".join(words[40:100] + [f"y{i}", f"z{i}"])) for i in range(40)]
    passes, second = [], partenum._second_pass
    monkeypatch.setattr(partenum, "_second_pass", lambda *a: passes.append(second(*a)) or passes[-1])
    df = ready.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["id"]: r["component"] for r in partenum.similar_groups(df).collect()}
    assert got == jaccard_components(docs, 5, 80, 100)
    assert any(p is not None for p in passes)


def test_odd_rows(odd):
    got = partenum.similar_groups(odd, keep=["doc_id", "row"]).collect()
    assert len(got) == len(ODD_ROWS)
    for r in got:
        if r["id"] is None:
            assert r["component"] is None
    linked = {r["id"]: r["component"] for r in got if r["id"] is not None}
    assert linked[11] == 10 and linked[0] == 0 and linked[1] == 1
    kept = partenum.keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(ODD_ROWS) - sum(1 for d, _ in ODD_ROWS if d is not None and linked[d] != d)


def test_empty_table(ready):
    empty = ready.createDataFrame([], "doc_id long, text string")
    assert partenum.similar_groups(empty).count() == 0 and partenum.keep_first(empty).count() == 0


@pytest.mark.parametrize("part,of", [(85, 100), (80, 100), (1, 2)])
def test_similar_sets_share_a_signature(part, of):
    """The guarantee itself, at sizes over all bands, for pairs just above the threshold."""
    rng = np.random.default_rng(part)
    signatures = Signatures(part, of)
    tried = 0
    for n in [2, 6, 7, 9, 13, 20, 40, 77, 150, 400, 1500]:
        for _ in range(25):
            whole = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
            a = np.unique(whole[:n])
            # Drop some, add some, as many as the threshold allows.
            out = int(rng.integers(0, n + 1))
            add = int(rng.integers(0, n + 1))
            while out + add and of * (n - out) < part * (n + add):
                out, add = (out - 1, add) if out and (rng.random() < 0.5 or not add) else (out, add - 1)
            b = np.unique(np.concatenate([whole[out:n], whole[n:n + add]]))
            if len(b) and out + add:
                tried += 1
                assert np.intersect1d(signatures.of_set(a), signatures.of_set(b)).size, (n, out, add)
    assert tried > 50


def test_shingles_count_like_brute_force():
    for text in ["", "a b c", "a b c d", "A b  c\td e", "x y x y x y x y", "é É a"]:
        assert len(Shingles(4).of(text.encode())) == len(shingles(text, 4))


def _vectors(seed, n, d=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, d))
    rows = []
    for i in range(n):
        v = base[i % len(base)] + rng.normal(size=d) * rng.choice([0, 0.02, 0.1, 0.2, 1])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3) if i % 17 else None))
    return rows


def _cosine_brute(rows, threshold=0.98):
    ok = {}
    for i, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = (np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)), label)
    ids = sorted(ok)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= threshold]
    return links


@pytest.mark.parametrize("block", [1024, 5])
def test_vectors_match_brute_force(ready, monkeypatch, block):
    monkeypatch.setattr(hyperplanes, "BLOCK", block)
    rows = _vectors(2, 300)
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 0), (902, [2 * x for x in rows[0][1]], 0)]
    rows += [(903, None, 0), (904, [], 0), (905, [0.0] * 24, 0), (906, [float("nan")] + [1.0] * 23, 0),
             (907, [None] + [1.0] * 23, 0), (908, [float("inf")] * 24, 0), (909, [1.0, 2.0], 1), (910, [1.0, 2.0], 1)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r["id"]: (r["n_links"], r["component"]) for r in hyperplanes.near_duplicates(df).collect()}
    links = _cosine_brute(rows)
    group = components([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = sum(n for n, _ in got.values())
    assert found >= 0.999 * 2 * len(links) and all(got[i][0] <= degree[i] for i in degree)
    assert got[900][0] >= 2 and got[903] == (0, 903) and got[905] == (0, 905) and got[910] == (1, 909)
    assert sum(got[i][1] == group[i] for i in group) >= 0.99 * len(group)


def test_one_vector_and_one_bucket_hold_most_rows(ready, monkeypatch):
    """Most rows are copies of one vector, most others lie in its bucket; also with more signs a table."""
    monkeypatch.setattr(hyperplanes, "BLOCK", 32)
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    near = [base + rng.normal(size=16) * 0.03 for _ in range(150)]
    rows = [(i, [float(x) for x in base], 0) for i in range(2500)]
    rows += [(3000 + i, [float(x) for x in v], 0) for i, v in enumerate(near)]
    rows += [(4000 + i, None, 0) for i in range(1500)] + [(6000, [float(x) for x in base], 1)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    want = {r[0]: (0, r[0]) for r in rows}
    want |= {r[0]: (2649, 0) for r in rows if r[0] < 4000}
    for bits in (None, 24):
        out = hyperplanes.near_duplicates(df, bits=bits).collect()
        assert len(out) == len(rows)
        assert {r["id"]: (r["n_links"], r["component"]) for r in out} == want


def test_signs_follow_the_largest_group():
    assert [hyperplanes.bits_for(n) for n in (0, 1, 64, 10 ** 6, 1 << 22, (1 << 22) + 1, 10 ** 9, 10 ** 11)] == [
        16, 16, 16, 16, 16, 24, 24, 32]
    assert hyperplanes.table_count(0.98, 16, 0.999) == 17 and hyperplanes.table_count(0.98, 24, 0.999) == 30
    limit = hyperplanes.sketch_limit(0.98, 272)
    assert 30 < limit < 60                       # strangers that share 16 signs differ in about 128
    differ = np.random.default_rng(1).binomial(272, np.arccos(0.98) / np.pi, 1_000_000)
    assert (differ > limit).mean() <= 1e-5


def test_partners_match_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = [1, 2, 3, 9, 40]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    n = bounds[-1]
    data = np.repeat(rng.integers(0, 256, (5, 6), np.uint8), sizes, axis=0)
    data ^= (1 << rng.integers(0, 8, (n, 6))).astype(np.uint8) * (rng.random((n, 6)) < 0.5)
    side, codes = rng.integers(0, 2, n), data[:, :3].astype(np.int64)
    table = np.repeat([0, 1, 2, 1, 2], sizes)
    cross = np.repeat([False, True, False, False, True], sizes)
    want = np.zeros(n, bool)
    for k in range(5):
        for i in range(bounds[k], bounds[k + 1]):
            want[i] = any(
                i != j and np.bitwise_count(data[i] ^ data[j]).sum() <= 4 and (codes[i] != codes[j])[:table[i]].all()
                and (not cross[i] or side[i] != side[j]) for j in range(bounds[k], bounds[k + 1]))
    assert 0 < want.sum() < n
    for small in (32, 1, 100):
        monkeypatch.setattr(hyperplanes, "SMALL", small)
        assert (hyperplanes.partners(data, codes, side, table, cross, bounds, 4) == want).all()


def test_vector_edges(ready):
    schema = "vec_id long, embedding array<float>, label int, row string, signs string, component int"
    assert hyperplanes.near_duplicates(ready.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1, "r", "s", 1), (5, [1.0, 0.0], 1, "r", "s", 1), (5, [1.0, 0.0], 1, "r", "s", 1)]
    got = hyperplanes.near_duplicates(ready.createDataFrame(rows, schema), keep=["vec_id", "row"]).collect()
    assert sorted((r["id"] or -1, r["n_links"], r["component"]) for r in got) == [(-1, 0, None), (5, 1, 5), (5, 1, 5)]


def test_bitmaps_never_rule_out_a_link():
    """The filter joins all sets that link, whatever their sizes and bitmap lengths."""
    rng = np.random.default_rng(6)
    for n in (8, 40, 90, 171, 400):
        whole = rng.integers(0, 1 << 63, 3 * n).astype(np.uint64)
        sets = [np.unique(np.concatenate([whole[int(rng.integers(0, n // 8)):n], whole[n:n + int(rng.integers(0, n // 8))]]))
                for _ in range(30)] + [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for _ in range(30)]
        edges = partenum.near_edges(list(range(60)), [len(s) for s in sets], [partenum.bitmap(s) for s in sets], 85, 100)
        group = components(range(60), edges)
        for i in range(60):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    assert group[i] == group[j]
        assert len({group[i] for i in range(30, 60)}) == 30 or n < 40     # unrelated sets are ruled out
