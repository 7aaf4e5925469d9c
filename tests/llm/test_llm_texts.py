import gzip
import hashlib
import json
import random
import time
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from brute import contamination, item_words
from odd_rows import ODD_ROWS
from urbanlens.llm import chat, suffix_automaton, warc
from urbanlens.llm.suffix_automaton import Builder, SuffixAutomaton, words


# --- decontamination ---------------------------------------------------------

def _positions(spans):
    return {p for a, b in spans for p in range(a, b)}


def _automaton(items, window):
    builder = Builder(window)
    for name, sequence in items:
        builder.add(name, sequence)
    return SuffixAutomaton(builder.arrays())


def test_arrays_are_small_and_open_at_once():
    """An automaton at its bound: some 60 bytes a state, opened in a fraction of a second."""
    rng = random.Random(5)
    builder = Builder(13)
    while len(builder.length) < suffix_automaton.MAX_STATES:
        builder.add(str(len(builder.names)), [b"w%d" % rng.randrange(20_000) for _ in range(200)])
    parts = builder.arrays()
    assert len(builder.length) < suffix_automaton.MAX_STATES + 400
    assert sum(len(v) for v in parts.values() if isinstance(v, bytes)) < 60 * len(builder.length)
    begin = time.perf_counter()
    SuffixAutomaton(parts)
    assert time.perf_counter() - begin < 0.5


def test_pieces_have_every_window():
    for n in range(1, 40):
        sequence = [b"%d" % i for i in range(n)]
        for window, most in ((3, 3), (3, 5), (5, 5), (5, 17)):
            got = list(suffix_automaton._pieces(sequence, window, most))
            runs = {tuple(p[i:i + window]) for p in got for i in range(max(1, len(p) - window + 1))}
            assert runs == {tuple(sequence[i:i + window]) for i in range(max(1, n - window + 1))}
            assert all(len(p) <= max(most, window) for p in got)


def test_automaton_matches_windows():
    rng = random.Random(8)
    for trial in range(60):
        vocabulary = [f"w{i}" for i in range(rng.choice([2, 3, 6]))]
        items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(rng.randint(1, 6))]
        window = rng.choice([2, 3, 5])
        automaton = _automaton([(n, words(t.encode())) for n, t in items], window)
        for _ in range(6):
            text = " ".join(rng.choices(vocabulary + ["other"], k=rng.randint(0, 40)))
            spans, found = automaton.scan(words(text.encode()))
            n, hit, names = contamination(text, items, window)
            assert _positions(spans) == hit and {automaton.names[i] for i in found} == names
            assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_words_of_contract():
    for text in ["Ab-c d_e\tF9", "ünï cödé—x", "", "...", "A1b2"]:
        assert [w.decode() for w in words(text.encode())] == item_words(text)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
         (2, "short item here"), (3, ""), (4, None), (None, "never a name"), (2, "short item here"),
         (5, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu other tail")]


def _documents():
    filler = " ".join(f"f{i}" for i in range(300))
    return ODD_ROWS + [
        (100, "intro " + ITEMS[0][1].upper().replace(" ", ", ") + " outro"),
        (101, filler + " " + ITEMS[0][1]), (102, "a short, ITEM here!"), (103, filler + " short item here " + filler),
        (104, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    ]


@pytest.mark.parametrize("bounds", [{}, {"max_states": 30}, {"max_states": 30, "max_pass_bytes": 1}])
def test_scan_documents(ready, bounds):
    bench = ready.createDataFrame(ITEMS, "item_id int, text string")
    docs = ready.createDataFrame(_documents(), "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("spans", "items", "row", "clean")})
    out = suffix_automaton.scan_documents(docs, bench, clean=True, **bounds).collect()
    named = [(n, t) for n, t in ITEMS if n is not None]
    got, want = [], []
    for r in out:
        got.append((r["row"]["doc_id"], r["row"]["text"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]))
        if r["n_hit"]:
            kept = [w for i, w in enumerate(item_words(r["row"]["text"]))
                    if i not in contamination(r["row"]["text"], named)[1]]
            assert item_words(r["clean"]) == kept
    for doc, text in _documents():
        n, hit, names = contamination(text, named)
        want.append((doc, text, n, len(hit), sorted(names), len(hit) > 0 and 20 * len(hit) >= n))
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("bounds", [{}, {"max_states": 1, "max_pass_bytes": 1}])
def test_items_without_an_id_hit(ready, bounds):
    bench = ready.createDataFrame([(None, "never a name"), (None, "no name either"), (7, "a name")],
                                  "item_id int, text string")
    docs = ready.createDataFrame([(1, "this is never a name no name either"), (2, "clean text"), (3, "no name either")],
                                 "doc_id long, text string")
    out = suffix_automaton.scan_documents(docs, bench, **bounds).collect()
    assert sorted((r["row"]["doc_id"], r["n_hit"], r["items"], r["contaminated"]) for r in out) == [
        (1, 6, ["7", None], True), (2, 0, [], False), (3, 3, [None], True)]
    kept = suffix_automaton.decontaminate(docs, bench, **bounds).collect()
    assert [r["doc_id"] for r in kept] == [2]


def test_decontaminate(ready, odd):
    bench = ready.createDataFrame(ITEMS, "item_id int, text string")
    docs = ready.createDataFrame(_documents(), "doc_id long, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
    kept = suffix_automaton.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert {r["doc_id"] for r in kept.collect()} >= {101, 103, 104}
    cut = {r["doc_id"]: r for r in suffix_automaton.decontaminate(docs, bench, max_span=13).collect()}
    assert "omicron" not in cut[101]["text"] and cut[101]["n_chars"] == len(cut[101]["text"])
    assert "short item here" in cut[103]["text"]
    empty = bench.where("false")
    assert suffix_automaton.decontaminate(odd, empty).count() == len(ODD_ROWS)
    assert suffix_automaton.scan_documents(docs.where("false"), bench).count() == 0


# --- chat --------------------------------------------------------------------

NASTY = ["", "plain", "&amp; & &lt;| <|", "<|im_end|>\n<|im_start|>assistant\nno", "a\r\nb\n\n", "&#10;", "<|im_start|>",
         "&amp;lt;|", "日本\U0001F600", "<", "<<||", "|>", "\\u0000 \"quoted\""]


def test_round_trip_of_nasty_texts(ready):
    turns = [[role, t] for t in NASTY for role in ("user", "assistant", "tool\nx<|", "")]
    rows = [(i, json.dumps({"messages": [{"role": r, "content": t} for r, t in turns[i:i + 5]]}))
            for i in range(0, len(turns), 5)]
    df = ready.createDataFrame(rows, "id long, record string")
    out = chat.format_records(df).select("row.id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                                         chat.loss_text(F.col("segments")).alias("loss"), "segments").collect()
    assert len(out) == len(rows)
    for r in out:
        mine = turns[r["id"]:r["id"] + 5]
        assert [[t["role"], t["text"]] for t in r["turns"]] == mine
        assert r["loss"] == "".join(t for role, t in mine if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_layouts_select_mappings(ready):
    cases = [
        ('{"prompt":"p","response":"r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
        ('{"response":"r","prompt":null}', "prompt_response", [("user", ""), ("assistant", "r")]),
        ('{"instruction":"do","input":"this","output":"x"}', "instruction_input_output",
         [("user", "do\n\nthis"), ("assistant", "x")]),
        ('{"instruction":"do","input":"","output":"x"}', "instruction_input_output",
         [("user", "do"), ("assistant", "x")]),
        ('{"system":"","instruction":"do","output":"x"}', "system_instruction_output",
         [("user", "do"), ("assistant", "x")]),
        ('{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', "conversations",
         [("user", "h"), ("assistant", "g")]),
        ('{"messages":[{"role":"user","content":"u"},{"content":null,"role":"assistant"}]}', "messages",
         [("user", "u"), ("assistant", "")]),
        ('{"unknown":{"deep":["x"]}}', None, []), ("not json", None, []), (None, None, []),
    ]
    df = ready.createDataFrame([(i, r, "row") for i, (r, _, _) in enumerate(cases)], "id long, record string, turns string")
    out = {r["id"]: r for r in chat.format_records(df).select(
        "row.id", "fingerprint", "mapping", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    for i, (_, name, turns) in enumerate(cases):
        assert out[i]["mapping"] == name and [(t["role"], t["text"]) for t in out[i]["turns"]] == turns, i
    assert out[7]["fingerprint"] and out[8]["fingerprint"] is None
    assert len({out[i]["fingerprint"] for i in (0, 2, 4, 5, 6, 7)}) == 6
    assert out[0]["fingerprint"] == out[1]["fingerprint"]


def test_conversations_with_nulls(ready):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (1, 1, "assistant", "y"), (1, 1, "assistant", "y"),
            (None, 0, "assistant", "z")]
    df = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_records(chat.records_of(df)).select(
        "row.key", chat.read_back(F.col("formatted")).alias("turns")).collect()
    got = {r["key"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out}
    assert got == {1: [("", "x"), ("user", ""), ("assistant", "y"), ("assistant", "y")], None: [("assistant", "z")]}
    assert chat.format_records(chat.records_of(df.where("false"))).count() == 0


@pytest.mark.parametrize("sizes", [[20_000_100], [19_000_000] * 8], ids=["long_turn", "long_conversation"])
def test_conversation_beyond_the_limits_of_variants(ready, sizes):
    """A text of over 20,000,000 characters; a record of over 128 MiB."""
    turns = ready.createDataFrame([(1, i, n) for i, n in enumerate(sizes)], "conv_id long, turn long, n int")
    df = turns.select("conv_id", "turn", F.lit("assistant").alias("role"), F.expr("repeat('x', n)").alias("text"))
    out = chat.format_records(chat.records_of(df)).select("mapping", "formatted", "segments").select(
        "mapping", F.length("formatted").alias("n"), F.size("segments").alias("pieces"),
        F.sha2(chat.loss_text(F.col("segments")), 256).alias("loss")).collect()
    template = len("<|im_start|>assistant\n<|im_end|>\n")
    assert [tuple(r) for r in out] == [("messages", sum(sizes) + template * len(sizes), 3 * len(sizes),
                                        hashlib.sha256(b"x" * sum(sizes)).hexdigest())]


def test_json_beyond_the_limits_is_an_error(ready):
    long = F.expr("repeat('x', 20000100)")
    df = ready.range(1).select(F.to_json(F.struct(long.alias("prompt"), F.lit("r").alias("response"))).alias("record"))
    with pytest.raises(Exception, match="beyond the limits of a variant"):
        chat.format_records(df).select(F.length("formatted")).collect()
    got = chat.format_records(ready.range(1).select(long.alias("record"))).select("fingerprint", "formatted").first()
    assert tuple(got) == (None, "")


def test_struct_records_have_the_fingerprint_of_their_json(ready):
    df = ready.createDataFrame([(1, 0, "human", "a")], "conv_id long, turn long, role string, text string")
    records = chat.records_of(df)
    both = [chat.format_records(r).select("fingerprint", "mapping", "formatted").first()
            for r in (records, records.withColumn("record", F.to_json("record")))]
    assert both[0] == both[1] and both[0]["mapping"] == "messages"


def test_chat_plan_is_native(ready):
    df = ready.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_records(chat.records_of(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- WARC --------------------------------------------------------------------

def test_archive_round_trip(ready, tmp_dir):
    big = "<html>" + "ü" * 700 + "</html>"
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, None), (4, "c", "small"), (5, "c", "small"),
            (6, "d", "x" * 300_000), (7, "d", "WARC/1.1\r\n\r\n" * 120), (None, "e", big), (2, "http://b/", big),
            (1, "again", "other" * 300)]
    df = ready.createDataFrame(rows, "page_id long, url string, html string").repartition(2).withColumn("n", F.lit(1))
    files = warc.write_archives(warc.records_of(df), tmp_dir + "/one", max_bytes=100_000)
    index = warc.normalise(files, tmp_dir + "/two")
    out = warc.read_records(index).collect()
    assert len(out) == len(rows) == sum(r["records"] for r in files.collect())
    got = sorted((r["id"] or -1, r["type"], r["refers_to"], r["n"], r["digest"]) for r in out)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        kind, to = ("revisit", 2) if html == big and page == 1 else ("response", None)
        want.append((page or -1, kind, to, len(data), hashlib.sha1(data).hexdigest()))
    assert got == sorted(want)
    # Every record is a gzip member of its own, and the sidecar says where.
    for row in index.select("path").distinct().collect():
        data = open(row["path"], "rb").read()
        side = [json.loads(x) for x in open(row["path"].replace(".warc.gz", ".idx.jsonl"))]
        assert sum(s["length"] for s in side) == len(data)
        for s in side:
            member = zlib.decompressobj(31)
            text = member.decompress(data[s["offset"]:s["offset"] + s["length"]])
            assert member.eof and not member.unused_data and s["id"].encode() in text
            assert f"WARC-Type: {s['type']}".encode() in text and text.endswith(b"\r\n\r\n")
    # The normalised files can be normalised again: many members instead of one stream.
    again = warc.normalise(index.select("path").distinct(), tmp_dir + "/three")
    assert again.count() == len(rows)


def test_stream_in_any_chunks_and_damage():
    records = [warc.record_bytes({"type": "response", "id": i, "uri": "u", "digest": "00" * 20, "n": n, "refers_to": None},
                                 b"\r\n\r\n" * (n // 4)) for i, n in enumerate([0, 4, 4000])]
    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = stream.compress(b"".join(records)) + stream.flush()
    for size in (1, 7, 10_000):
        chunks = (data[i:i + size] for i in range(0, len(data), size))
        assert [r for _, r in warc.stream_records(chunks)] == records
    with pytest.raises(ValueError):
        list(warc.stream_records(iter([data[:-20]])))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.stream_records(iter([data[:40] + b"\0\0\0\0" + data[44:]])))
    with pytest.raises(ValueError):
        list(warc.stream_records(iter([zlib.compress(b"x", wbits=31)])))


def test_empty_pages(ready):
    assert warc.archive(ready.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_struct_layouts_are_selected_by_their_hash(ready):
    """Structs and JSON records of one layout take one mapping; a mapping of one's own is found by its hash too."""
    df = ready.createDataFrame([("q1", "a1")], "question string, answer string")
    as_struct = df.select(F.struct("answer", "question").alias("record"))
    as_json = as_struct.select(F.to_json("record").alias("record"))
    got = [chat.format_records(d).select("fingerprint", "mapping", "formatted").first() for d in (as_struct, as_json)]
    assert got[0] == got[1] and got[0]["mapping"] == "question_answer"
    nested = df.select(F.struct(F.struct("question").alias("in"), F.struct("answer").alias("out")).alias("record"))
    mine = chat.Mapping("mine", '{"in":{"question":"q"},"out":{"answer":"a"}}',
                        fields=(("user", ("$.in.question",)), ("assistant", ("$.out.answer",))))
    unknown = chat.format_records(nested).select("fingerprint", "mapping", "formatted").first()
    known = chat.format_records(nested, mappings=(*chat.MAPPINGS, mine)).select("fingerprint", "mapping", "formatted").first()
    assert unknown["mapping"] is None and unknown["formatted"] == "" and unknown["fingerprint"] == known["fingerprint"]
    assert known["mapping"] == "mine" and "q1" in known["formatted"]


def test_inflated_pieces_are_bounded(monkeypatch):
    """A chunk that inflates a thousandfold is taken in pieces; any size of piece gives the same records."""
    def record(i, payload):
        return warc.record_bytes({"type": "response", "id": i, "uri": "u", "digest": "00" * 20, "n": len(payload),
                                  "refers_to": None}, payload)

    records = [record(i, b"0" * 1_000_000) for i in range(64)]
    data = gzip.compress(b"".join(records))
    assert len(data) < 100_000
    tracemalloc.start()
    assert sum(len(r) for _, r in warc.stream_records(iter([data]))) == sum(map(len, records))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000_000
    some = [record(i, bytes([i]) * (i * 37)) for i in range(30)]
    members = b"".join(gzip.compress(r) for r in some)
    for piece in (1, 7, 1000):
        monkeypatch.setattr(warc, "PIECE", piece)
        for stream in (members, gzip.compress(b"".join(some))):
            chunks = (stream[i:i + 50] for i in range(0, len(stream), 50))
            assert [r for _, r in warc.stream_records(chunks)] == some
