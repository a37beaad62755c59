"""WARC archives, chat formatting, neighbours, toxicity, quality, the pipeline."""

import base64
import collections
import hashlib
import io
import os
import random
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from contrail.llm import chat_render, hnsw, queries, toxic_spans, warc_zstd, weak_quality
from contrail.llm.common import open_store, work_folder

SF = "/root/testdata/sf0.001"


# -- WARC -----------------------------------------------------------------

PAGE = "page_id long, url string, html string, first long, sha1 string, name string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 9, "x", "y") for i, u, h in rows], PAGE)


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = collections.Counter()
    for i, u, h in rows:
        data = (h or "").encode()
        low = first.get(h or "")
        revisit = len(data) >= min_bytes and i != low
        out[i, len(data), b32(data), "revisit" if revisit else "response", low if revisit else None] += 1
    return out


ODD_PAGES = [(1, "http://a/1", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://a/3\r\nX: y", ""), (4, "u", None),
             (None, "u", "<p>same</p>"), (5, "u", "alone\r\n\r\nWARC/1.1"), (5, "u", "alone\r\n\r\nWARC/1.1"),
             (6, "u", "é" * 400_000), (None, "v", "only null ids")]


@pytest.mark.parametrize("min_bytes", [0, 12])
def test_archives(spark, min_bytes):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    for some in (rows, ODD_PAGES):
        got = warc_zstd.write_and_read(pages(spark, some), min_bytes=min_bytes).collect()
        assert collections.Counter(map(tuple, got)) == expected(some, min_bytes)
    assert warc_zstd.write_and_read(pages(spark, [])).count() == 0


def test_archives_give_back_payloads(spark):
    folder = work_folder(spark, "test-warc")
    manifest = warc_zstd.write_archives(pages(spark, ODD_PAGES), folder)
    got = warc_zstd.read_archives(manifest, folder).where("record_type = 'response'").collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in got} >= {
        (1, "<p>same</p>"), (5, "alone\r\n\r\nWARC/1.1"), (6, "é" * 400_000)}
    assert {r.url for r in got if r.page_id == 3} == {"http://a/3%0D%0AX: y"}


def test_archive_layout():
    recs = [warc_zstd.record(i, f"http://h/{i}", f"<p>page {i} of many</p>".encode() * 9, b32(f"<p>page {i} of many</p>".encode() * 9))
            for i in range(60)]
    d = warc_zstd.train_dictionary(recs, 2048)
    out = io.BytesIO()
    w = warc_zstd.Writer(out, d)
    for r in recs:
        w.add(r)
    data = out.getvalue()
    assert len(data) == w.bytes
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D and data[8:8 + len(d)] == d
    assert list(warc_zstd.read_records(io.BytesIO(data), read_bytes=7)) == recs
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d)).decompressobj().decompress(data[8 + len(d):])
    assert one == recs[0]
    bare = io.BytesIO()
    warc_zstd.Writer(bare, b"").add(recs[0])
    assert list(warc_zstd.read_records(io.BytesIO(bare.getvalue()))) == recs[:1]
    assert list(warc_zstd.read_records(io.BytesIO(b""))) == []
    with pytest.raises(Exception):
        list(warc_zstd.read_records(io.BytesIO(data[:-3])))


# -- chat -----------------------------------------------------------------

BITS = st.lists(st.sampled_from(["\\", "#", "##", "###", "</turn>", "</", "turn>", "a", "\n", ": ", "### User: ", "x", "y"]),
                max_size=6).map("".join)
ROLES = st.sampled_from(["user", "assistant", "system", "", "x:y", "\\", "Assistant", "=", "###"])


@given(st.lists(st.tuples(ROLES, BITS), max_size=12), st.booleans())
@settings(max_examples=200, deadline=None)
def test_rendering_round_trip(messages, long):
    messages = messages * (5 if long else 1)
    text, turns, loss, rewritten = chat_render.render(messages, chat_render.marked_turns)
    assert rewritten is None and text == chat_render.marked_turns(messages)
    assert chat_render.parse_marked(text) == messages
    assert "".join(text[a:b] for a, b in turns) == text and len(turns) == len(messages)
    assert [chat_render.unescape(text[a:b]) for a, b in loss] == [t for r, t in messages if r == "assistant"]


@pytest.mark.parametrize("n", [2, 40])
def test_rewriting_templates_are_found(n):
    def counted(ms):
        return f"[{len(ms)}]" + chat_render.marked_turns(ms)

    def trimmed(ms):                           # drops what the turn before last said
        return chat_render.marked_turns([(r, t if i >= len(ms) - 2 else "") for i, (r, t) in enumerate(ms)])

    messages = [("user", "q"), ("assistant", "a")] * n
    assert chat_render.render(messages, counted)[3] == 0
    text, _, _, at = chat_render.render(messages, trimmed)
    assert at == 2 and text == trimmed(messages)


@pytest.mark.parametrize("n", [3, 33, 90])
def test_how_spans_are_found_depends_on_the_template_alone(n):
    """A note after some turn that the next one takes back is history rewritten, in long conversations too."""
    def noted(ms):
        return chat_render.marked_turns(ms) + ("(note)" if len(ms) == n // 2 else "")

    messages = [(("user", "assistant")[i % 2], f"t{i} ###") for i in range(n)]
    text, turns, _, at = chat_render.render(messages, noted)
    assert at == n // 2 and text == chat_render.marked_turns(messages)
    assert text[turns[at][0]:turns[at][1]] == chat_render.marked_turns(messages[at:at + 1])
    # an appending template has the spans that all its prefixes give
    assert chat_render.render(messages, chat_render.marked_turns) == chat_render.render(
        messages, lambda ms: chat_render.marked_turns(ms))


def test_the_registered_template_is_rendered_on_every_prefix(monkeypatch):
    said, escape = [], chat_render.escape
    monkeypatch.setattr(chat_render, "escape", lambda t: said.append(t) or escape(t))
    text, turns, _, rewrote = chat_render.render([("user", f"t{i}") for i in range(7)], chat_render.marked_turns)
    assert said == [f"t{i}" for k in range(7) for i in range(k + 1)]
    assert rewrote is None and [text[a:b] for a, b in turns] == [f"### User: t{i}</turn>\n" for i in range(7)]


def test_a_trained_text_without_a_place_is_told():
    def measured(ms):                          # gives the lengths of texts, not the texts
        return "".join(f"{r}:{len(t)};" for r, t in ms)

    messages = [("user", "q"), ("assistant", "abc"), ("assistant", "zz")]
    text, turns, loss, rewrote, untold = chat_render.spans(messages, measured)
    assert (text, loss, rewrote, untold) == ("user:1;assistant:3;assistant:2;", [], None, [1, 2])
    assert chat_render.spans(messages, chat_render.marked_turns)[4] == []


@given(st.text("ab", max_size=9), st.text("ab", max_size=9))
def test_the_common_beginning(a, b):
    assert chat_render._shared(a, b) == len(os.path.commonprefix([a, b]))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, loss string, turns int"
    rows = [(1, 1, "assistant", "b\\### x</turn>"), (1, 0, "user", None), (2, 0, None, ""), (3, 0, "user", "a"),
            (3, 0, "user", "a"), (None, 0, "user", "n"), (4, None, "assistant", "first"), (4, 0, "user", "second"),
            (5, 0, "assistant", "long " * 30_000)] + [(6, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(90)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(5)
    got = {r.conv_id: r for r in chat_render.format_and_read(df, work_folder(spark, "test-chat")).collect()}
    by = collections.defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((role or "", text or ""))
    assert set(got) == set(by)
    for c, messages in by.items():
        loss = "".join(t for r, t in messages if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (
            len(messages), sha("".join(f"{a}\n{b}\n" for a, b in messages)), len(loss), sha(loss),
            len(chat_render.marked_turns(messages)))
    assert chat_render.format_and_read(df.limit(0), work_folder(spark, "test-chat")).count() == 0


def test_chat_query_has_the_probe(spark):
    r = queries.op8_chat_render(spark, SF).where("conv_id = -7").first()
    t = "\\### Assistant: </turn> ok"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(t), sha(t))
    assert r.turns_sha256 == sha(f"user\n{t}\nassistant\n{t}\n")


# -- neighbours -----------------------------------------------------------

EMB = "vec_id long, embedding array<float>, v int, ids string, shard int, dims string, r int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2, "y", 3)
                                  for i, v in rows], EMB)


def brute(rows, every=20, top=20):
    good = {(i, tuple(map(float, np.float32(v)))) for i, v in rows if i is not None and v is not None
            and None not in v and len(v) and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, v in good:
        if q % every == 0:
            best = {}
            for i, w in good:
                if i != q and len(w) == len(v):
                    best[i] = max(best.get(i, -np.inf), float(np.dot(v, w)))
            out.setdefault(q, {})
            for i, s in best.items():
                out[q][i] = max(s, out[q].get(i, -np.inf))
    return {q: sorted(b.items(), key=lambda x: (-x[1], x[0]))[:top] for q, b in out.items()}


def neighbours(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


@pytest.mark.parametrize("kind", ["random", "clustered", "norms"])
def test_recall_over_shards(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 16))
    if kind == "clustered":
        x = x[rng.integers(0, 9, 700)] + 0.01 * x
    if kind == "norms":
        x *= rng.uniform(0.1, 10, (700, 1))
    rows = list(enumerate(x.tolist()))
    got, want = neighbours(hnsw.nearest(vectors(spark, rows), shard_rows=250)), brute(rows)
    assert recall(got, want) >= 0.95
    for q, w in want.items():
        scores = dict(w)
        assert all(abs(s - scores[i]) < 1e-9 for i, s in got[q] if i in scores)


def test_copies_ties_and_odd_vectors(spark):
    e = [1.0, 0.0]
    rows = [(i, e) for i in range(0, 400)] + [(400, [0.9, 0.1]), (401, None), (402, []), (403, [0.0, 0.0]),
            (404, [None, 1.0]), (405, [float("nan"), 1.0]), (406, [float("inf"), 1.0]), (None, e), (20, e),
            (440, [1.0, 2.0, 3.0]), (441, [1.0, 2.0, 3.0]), (460, [5.0])]
    got, want = neighbours(hnsw.nearest(vectors(spark, rows))), brute(rows)
    assert {q: [i for i, _ in g] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items() if w}
    assert hnsw.nearest(vectors(spark, [])).count() == 0


def test_every_node_can_be_reached():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + 1e-4 * rng.normal(size=(60, 8)) for c in rng.normal(size=(8, 8))])
    g = hnsw.Graph.build(x, links=4, lowest=6, candidates=8)
    n, offsets, flat = g.layers[0]
    assert n == len(x) == len(hnsw._reach([flat[offsets[i]:offsets[i + 1]] for i in range(n)], n))
    back, ids, _ = hnsw.Graph.load(g.dump(np.arange(len(x)), np.arange(len(x) + 1)))
    assert back.search(x[3], 5, 20) == g.search(x[3], 5, 20) and len(ids) == len(x)


def test_recall_over_many_blocks():
    """Several times as many nodes as are inserted at once, in directions that have no order."""
    x = np.random.default_rng(2).normal(size=(6000, 32))
    g = hnsw.Graph.build(x)
    assert [n for n, _, _ in g.layers] == sorted((n for n, _, _ in g.layers), reverse=True)
    q = x[::20]
    want = np.argsort(-(q @ x.T), axis=1)[:, :20]
    got = g.search_many(q, 20, hnsw.BEAM)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(got.tolist(), want.tolist())]) >= 0.95
    few = hnsw.Graph.build(x[:3])
    assert few.search_many(q[:2], 20, 64)[:, 3:].max() == -1 and hnsw.Graph.build(x[:1]).search(x[0], 5, 9) == [0]


def test_graphs_are_files_that_no_row_carries(spark):
    """A shard's graph is read by the tasks that search it; rows of joins and shuffles hold its name."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 8))
    rows, folder = hnsw.usable(vectors(spark, list(enumerate(x)))), work_folder(spark, "test-hnsw")
    index, shards = hnsw.build_index(rows, folder, shard_rows=200)
    assert shards == 2 and dict(index.dtypes) == {"dims": "int", "shard": "int", "graph": "string"}
    held = 0
    for r in index.collect():
        assert len(r.graph) < 100
        store, root = open_store(folder)
        with store.open_input_file(f"{root}/{r.graph}") as file:
            g, ids, offsets = hnsw.Graph.read(file)
        order = np.lexsort(g.vectors.T)
        assert np.array_equal(g.vectors[order], x[ids].astype(np.float32)[order]) and offsets[-1] == len(ids) == len(g.vectors)
        held += len(ids)
    assert held == 400
    few = hnsw.search_index(index, folder, shards, rows.where("vec_id < 30"), block_rows=10)
    assert few.groupBy("query_id").count().where("count <> 40").count() == 0


# -- toxicity -------------------------------------------------------------

def test_words_are_found_before_they_are_lowered():
    """Lowering some letters moves the borders of words: the screen must see the words that the field sees."""
    model = {"bias": -3.0, "stay": 0.0, "enter": 0.0, "leave": 0.0, "weights": {"w i\u0307nsan": 14.0, "w ος": 14.0},
             "logistic": [-1.0, 1.0, 1.0]}
    for text in ("bir \u0130nsan var", "\u0130NSAN"[:1] + "nsan", "a ΟΣ b"):
        scorer = toxic_spans.Scorer(model)
        chains = toxic_spans.sentences(text)
        x, spans = toxic_spans.document_features(scorer.field, chains, {})
        hit = any(w in ("i\u0307nsan", "ος") for c in chains for w, _, _ in c)
        score, found = scorer.score(text)
        assert hit and spans == found and score == scorer._score(x) > scorer.plain


def brute_marginals(field, emissions):
    from itertools import product
    from math import exp
    n, total, on = len(emissions), 0.0, [0.0] * len(emissions)
    for y in product((0, 1), repeat=n):
        s = sum(e for e, t in zip(emissions, y) if t)
        s += sum({(1, 1): field.stay, (0, 1): field.enter, (1, 0): field.leave}.get(p, 0.0) for p in zip(y, y[1:]))
        w = exp(s)
        total += w
        for i, t in enumerate(y):
            on[i] += w * t
    return [o / total for o in on]


@given(st.lists(st.floats(-5, 5), min_size=1, max_size=7), st.floats(-2, 2), st.floats(-2, 2), st.floats(-2, 2))
@settings(max_examples=80, deadline=None)
def test_marginals_by_enumeration(emissions, stay, enter, leave):
    f = toxic_spans.Field(stay=stay, enter=enter, leave=leave)
    p, pairs = f.marginals(emissions)
    assert np.allclose(p, brute_marginals(f, emissions), atol=1e-9) and len(pairs) == len(p) - 1


def toxic_corpus(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(20, 120))
        y = int(rng.random() < 0.25)
        if y:
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(["nasty", "rotten", "vex" + rng.choice(words)])
        rows.append((i, ". ".join(" ".join(w[j:j + 9]) for j in range(0, len(w), 9)), y))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_corpus(900)
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t, _ in rows], "doc_id long, text string, score int, y string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxic_spans.train_model(docs, labels)
    got = {r.doc_id: r for r in toxic_spans.score_documents(docs, model).collect()}
    truth = {i: (t, y) for i, t, y in rows}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((got[i].score >= 0.3) == truth[i][1] for i in out)
    assert right >= 0.97 * len(out)
    spans = [truth[i][0][s.start:s.stop] for i in out if truth[i][1] for s in got[i].spans]
    assert spans and sum(any(k in s for k in ("nasty", "rotten", "vex")) for s in spans) >= 0.95 * len(spans)
    flipped = labels.withColumn("toxic", labels["toxic"] if False else toxic_spans.F.when(
        toxic_spans.held_out("doc_id"), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    assert toxic_spans.train_model(docs, flipped) == model          # held-out labels are never seen


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (None, "some text"), (3, "x"), (3, "x"), (4, "word " * 50_000)],
                                 "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (4, 1, 0)], none.schema)
    for labels in (none, one):
        got = toxic_spans.score_documents(docs, toxic_spans.train_model(docs, labels)).collect()
        assert len(got) == 6 and {r.score for r in got} == {0.0}
    assert toxic_spans.score_documents(docs.limit(0), toxic_spans.train_model(docs, none)).count() == 0
    model = toxic_spans.json.dumps(toxic_spans.train([(t, y) for _, t, y in toxic_corpus(300)], 75, 225))
    got = {r.doc_id: r.score for r in toxic_spans.score_documents(docs, model).collect()}
    assert got[1] == got[2] == got[3] < 0.3


def test_training_holds_few_bytes_a_word():
    """The training documents stand in one task beside the other workers: words are kept as places in a vocabulary."""
    import tracemalloc
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    texts = [(". ".join([t] + [" ".join(rng.choices(words, k=9)) for _ in range(100)]), y) for _, t, y in toxic_corpus(160)]
    n = sum(len(t.split()) for t, _ in texts)
    tracemalloc.start()
    model = toxic_spans.train(texts, 40, 120)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 140_000 and peak < 100 * n and model["weights"]


# -- quality --------------------------------------------------------------

def junk(rng, words, kind):
    w = rng.choices(words, k=rng.randint(60, 200))
    if kind == 0:
        return " ".join(x.upper() + "!!" for x in w)
    if kind == 1:
        return " ".join(x + "$$$" for x in w)
    if kind == 2:
        return " | ".join(w)
    return " ".join(x for x in w[:9] for _ in range(15))


def quality_corpus(n):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(900)]
    rows = []
    for i in range(n):
        if i % 5 == 0:
            rows.append((i, junk(rng, words, (i // 5) % 4), 0))
        else:
            s = [" ".join(rng.choices(words, k=rng.randint(3, 12))).capitalize() + "." for _ in range(rng.choice([1, 2, 9, 20]))]
            rows.append((i, " ".join(s), 1))
    return rows


def test_quality_keeps_clean_texts(spark):
    rows = quality_corpus(400)
    odd = [(1000, ""), (1001, None), (None, "A short clean text."), (7, rows[7][1]), (1002, "Word here. " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in [r[:2] for r in rows] + odd],
                                 "doc_id long, text string, votes int, at string")
    got = weak_quality.score_quality(docs).collect()
    assert len(got) == 405
    score = {r.doc_id: r.predicted for r in got}
    assert sum(score[i] == y for i, _, y in rows) >= 395
    assert all(score[i] for i, _, y in rows if y)
    assert score[1000] == score[1001] == score[None] == 1
    kept = weak_quality.good_documents(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in got if r.predicted)
    assert weak_quality.score_quality(docs.limit(0)).count() == 0
    assert weak_quality.good_documents(docs.limit(0)).count() == 0


def test_words_are_read_to_their_end():
    read = weak_quality.Reader().read
    a, b = read("字" * 50 + "、" + "字"), read("字" * 50 + "7" * 9 + "字")
    assert a[1] != b[1]
    names = [m for m, *_ in weak_quality.LABELLERS]
    worded = " ".join(f"{i:045d}letters" for i in range(30))
    assert read(worded)[0][names.index("wordless")] == weak_quality.GOOD
    ended = " ".join("w" * 40 + f"{i}z." for i in range(70))
    assert read(ended)[0][names.index("unended")] == weak_quality.GOOD


def test_scorer_sample_counts_ids(spark, monkeypatch):
    rows = [(i, "g" if i % 2 else "b", [i], [1.0]) for i in range(12)]
    rows += [(i, v, at, value) for i, v, at, value in rows for _ in range(30)]
    read = spark.createDataFrame(rows + [(3, "g", [900], [1.0]), (4, "g", [901], [1.0])], weak_quality.READ)

    def fit(got):
        return [float(len(got)), *sorted(float(at[0]) for at, _, _ in got)]

    monkeypatch.setattr(weak_quality, "fit_scorer", fit)
    got = weak_quality.train_scorer(read, {"g": 0.9, "b": 0.1}, sample=5)["weights"]
    assert got[0] == 10 and len(set(got[1:])) == 10


def test_expectation_maximisation_finds_accuracies():
    rng = random.Random(6)
    right = [0.95, 0.9, 0.8, 0.7]
    counts = collections.Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        counts["".join("-" if rng.random() < 0.2 else "g" if good == (rng.random() < a) else "b" for a in right)] += 1
    share, odds, posterior = weak_quality.expectation_maximisation(counts)
    assert abs(share - 0.8) < 0.03
    for a, o in zip(right, odds):
        assert abs(o["g"][1] - a) < 0.04 and abs(o["b"][0] - a) < 0.06
    assert abs(posterior["----"] - share) < 1e-6 if "----" in posterior else True


# -- the pipeline ---------------------------------------------------------

def test_pipeline_stages(spark):
    rng = random.Random(4)
    clean = [(i, t) for i, t, y in quality_corpus(120) if y and len(t.split()) > 30]
    junk_rows = [(i + 1000, t) for i, t, y in quality_corpus(120) if not y]
    item = " ".join(f"bench{j}" for j in range(20))
    leak = [(2000 + i, f"{t} {item}.") for i, t in clean[:4]]
    copies = [(3000 + i, t + " Extra.") for i, t in clean[:6] if len(t.split()) > 80]
    bad = [(4000 + i, t) for i, t, y in toxic_corpus(300, 9) if y]
    fine = [(5000 + i, t) for i, t, y in toxic_corpus(300, 9) if not y]
    rows = clean + junk_rows + leak + copies + bad + fine
    rng.shuffle(rows)
    folder = work_folder(spark, "test-pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long, gone int, words string"
    spark.createDataFrame([(i, t, "en", "s", len(t), 1, "w") for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 5000)) for i, _ in bad + fine], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    assert not left & {i for i, _ in junk_rows + leak + copies}
    assert {i for i, _ in clean} <= left
    assert len(left & {i for i, _ in bad}) <= 0.15 * len(bad)
    assert len(left & {i for i, _ in fine}) >= 0.97 * len(fine)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), folder)
        assert out.columns == docs.columns and out.count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "tokens"]
