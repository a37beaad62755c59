"""Whitening, conversation repair, trie BPE."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm.common import work_folder
from contrail.llm import bpe_trie, oracles, turn_repair, whitening

SF = "/root/testdata/sf0.001"


# -- whitening ------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n long, whitened string"


def whitened(spark, rows, **options):
    return whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS), **options).collect()


def check_whitened(got, vectors, top=8):
    """Against the definition; ``vectors`` are the rows that take part."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)) + 100000
    n, centred = len(x), x - x.mean(axis=0)
    cov = centred.T @ centred / n
    e = np.sort(np.linalg.eigvalsh(cov))[::-1][:top]
    e = e[e > 1e-9]
    assert len(got) == n * len(e)
    by = collections.defaultdict(list)
    for r in got:
        by[r.component].append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(cov), rel=1e-9)
    exact = [[int(v) for v in row] for row in x]
    sums = [sum(c) for c in zip(*exact)]
    far = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in exact]
    want = collections.Counter(v if v < 1 << 63 else None for v in far)
    for rows in by.values():
        assert collections.Counter(r.deviation for r in rows) == want
    return e


def test_whitening_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    got = whitening.whiten(df).collect()
    e = check_whitened(got, [r.embedding for r in rows])
    x = np.floor(1024 * np.array([r.embedding for r in rows], float)) + 100000
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    by = {(r.vec_id, r.component): r.whitened for r in got}
    for k in range(len(e)):
        want = centred @ axes[:, -1 - k] / np.sqrt(e[k])
        mine = np.array([by[r.vec_id, k + 1] for r in rows])
        sign = np.sign(mine @ want)
        assert np.abs(mine * sign - want).max() < 1e-8


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist()) for i in range(30)] + [(None, [1.0, 2.0, 3.0, 4.0])] * 2 + [(3, [0.0] * 4)]
    odd = [(90, None), (91, []), (92, [1.0, None, 0.0, 0.0]), (93, [float("nan"), 0.0, 0.0, 0.0]),
           (94, [float("inf"), 0.0, 0.0, 0.0]), (95, [1.0, 2.0]), (96, [3e38, 0.0, 0.0, 0.0])]
    got = whitened(spark, good + odd)
    check_whitened(got, [v for _, v in good])
    assert sum(r.vec_id is None for r in got) == 8 and not any(r.vec_id and r.vec_id >= 90 for r in got)


def test_whitening_multiple_roots(spark):
    """Equal eigenvalues still get orthonormal components; a dimension that stands still has none."""
    rows = [(i, v) for i, v in enumerate(itertools.product((0.0, 1.0), (0.0, 1.0), (0.0, 1.0), (2.0,)))]
    got = whitened(spark, [(i, list(v)) for i, v in rows])
    assert {r.component for r in got} == {1, 2, 3}
    check_whitened(got, [v for _, v in rows])


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_whitening_without_variance(spark, rows):
    assert whitened(spark, rows) == []


def test_whitening_large_entries(spark):
    rows = [(i, [float(1 << 20) * i, float(i * i % 7), 4096.0 * (i % 5)]) for i in range(9)]
    got = whitened(spark, rows)
    check_whitened(got, [v for _, v in rows])


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.randoms(use_true_random=False))
def test_polynomial_and_roots(d, rnd):
    y = np.array([[rnd.randint(-9, 9) for _ in range(d)] for _ in range(d + 2)], object)
    a = (y.T @ y).tolist()
    p = 2_147_483_647
    assert p in whitening.primes_below(1 << 31, 1)
    residue = whitening.polynomial_mod(np.array([[v % p for v in row] for row in a], np.int64), p)
    exact = faddeev(a)
    assert residue.tolist() == [c % p for c in exact]
    trace = sum(a[i][i] for i in range(d))
    roots, s = whitening.largest_roots(exact, max(trace, 1), d)
    mine = [r / 2 ** s for r, size in roots for _ in range(size)]
    theirs = [v for v in sorted(np.linalg.eigvalsh(np.array(a, float)), reverse=True) if v > 1e-6]
    assert mine == pytest.approx(theirs, rel=1e-6)


def faddeev(a):
    """Coefficients of det(x - a) by exact traces, the constant first."""
    d = len(a)
    a, m, c = np.array(a, object), np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a @ m + c[-1] * np.eye(d, dtype=int).astype(object)
        am = a @ m
        c.append(-sum(am[i, i] for i in range(d)) // k)
    return c[::-1]


# -- conversation repair --------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, audit string, cost long"


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of damaged rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t")
        seen.add((role, text))
    best = {("", 0): (0, "", [])}             # (initials so far, rows used): cost, audit, lines
    for _ in range(3 * len(rows) + 6):
        for (done, i), (cost, audit, lines) in list(best.items()):
            ways = []
            if i < len(rows):
                _, role, text = rows[i]
                ways.append((done, i + 1, 4, "D", None))
                if faults[i] not in ("b", "d"):
                    extra = 3 if faults[i] == "t" else 0
                    if role:
                        ways.append((done + role[0], i + 1, extra, "K", f"{role}:{text}"))
                    ways += [(done + r[0], i + 1, 3 + extra, "R", f"{r}:{text}") for r in ("user", "assistant")]
            ways += [(done + r[0], i, 3, "I", f"{r}:") for r in ("user", "assistant")]
            for word, j, price, edit, line in ways:
                if not re.fullmatch(r"s?(ua)*u?", word):
                    continue
                # only the last letter and whether there is any matter for what may follow
                key = ("ua" if word.endswith("a") else word[-1:], j)
                new = (cost + price, audit + edit, lines + [line] * (line is not None))
                if key not in best or new[:2] < best[key][:2]:
                    best[key] = new
    ends = [best[k, len(rows)] for k in ("", "ua") if (k, len(rows)) in best]
    cost, audit, lines = min(ends, key=lambda e: e[:2])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def expected_repairs(rows, damage=True):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in brute_damage(rows) if damage else rows:
        groups[conv].append((turn, role, text))
    ids = {r[0] for r in rows}
    return {c: brute_repair(ordered(groups[c])) if groups[c] else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for c in ids}


def repairs(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def random_turns(seed, conversations=60):
    rnd = random.Random(seed)
    texts = ["Hello.", "Why?", "no end", "", " \t", None, "Yes!  ", "same", "é.", "a\x85", "\x0b!\x0b"]
    rows = []
    for conv in [*range(conversations), None]:
        for k in range(rnd.choice([1, 2, 3, 6, 9])):
            turn = rnd.choice([k, k, k, k + 1, k + 5, None])
            rows.append((conv, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "ua", ""]),
                         rnd.choice(texts)))
    return rows + rows[:5]


def test_repair_against_brute_force_and_sql(spark):
    rows = random_turns(3)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    got = turn_repair.damage_and_repair(df)
    assert got.count() == len({r[0] for r in rows})
    assert repairs(got) == expected_repairs(rows)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    sql = con.sql(oracles.oracle_sql()["op12_turn_repair"]).fetchall()
    assert {r[0]: tuple(r[1:]) for r in sql} == repairs(got)


def test_repair_of_cut_conversations(spark, monkeypatch):
    """The same results however conversations are cut into pieces, one hot conversation and one hot turn included."""
    rnd = random.Random(9)
    rows = [(7, k if k % 3 else None, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", "c!", f"{k}."]))
            for k in range(400)] + [(8, 1, "user", "again.")] * 60 + random_turns(4, 20)
    for size, tasks in ((1 << 20, 1), (3, 5), (1, 2)):
        monkeypatch.setattr(turn_repair, "PIECE_ROWS", size)
        monkeypatch.setattr(turn_repair, "SHORT", 2)
        df = spark.createDataFrame([(*(" " if k > 1 and v is None else v for k, v in enumerate(r)),) for r in rows],
                                   "conv_id long, turn long, role string, text string").repartition(tasks)
        want = expected_repairs([tuple(" " if k > 1 and v is None else v for k, v in enumerate(r)) for r in rows], False)
        assert repairs(turn_repair.repaired(df, work_folder(spark, "test"))) == want


def test_repair_of_nothing(spark):
    assert turn_repair.damage_and_repair(spark.createDataFrame([], TURNS)).collect() == []
    gone = [c for c in range(300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    df = spark.createDataFrame([(c, 0, "user", "x.", "", 0) for c in gone], TURNS)
    zero = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert repairs(turn_repair.damage_and_repair(df)) == {c: zero for c in gone}


def test_repair_of_long_texts(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], "word " * 200_000 + ".") for k in range(6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    assert repairs(turn_repair.damage_and_repair(df)) == expected_repairs(rows)


# -- trie BPE -------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def codec():
    with open(WORDS, encoding="utf-8") as f:
        return bpe_trie.Codec(f.read())


ODD_TEXTS = ["", " ", "a", "ab" * 3000, "x" * 20_000, "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>c",
             "<|ENDOFTEXT|> <|endoftext", "it's I'LL we've 's'", "\x1ca\x85b c\xa0d", "é ́x İß ſ Σς", "中日本語 🙂🙂",
             "1234 ½ ²", "\x00�", "word\n\tword   word ", "</w> a</w>b"]


def same(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert codec.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_trie_odd_texts(codec, library):
    same(codec, library, ODD_TEXTS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aabcdeeghinorstuw'<|>. \n12éİßСтр中🙂́‍"), max_size=60), max_size=4))
def test_trie_is_the_library(codec, library, texts):
    same(codec, library, texts)


def test_trie_documents(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, None), (None, "x"), (1, ""), (1, "twice"), (1, "twice"), (5, "long " * 300_000)]
    rows += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame([(i, t, 4, "z") for i, t in rows], "doc_id long, text string, n_tokens long, ids string")
    want = collections.Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, bpe_trie.trie_digests(df, WORDS).collect())) == want
    assert bpe_trie.trie_digests(df.limit(0), WORDS).collect() == []


def test_trie_memo_keeps_its_bound(library):
    with open(WORDS, encoding="utf-8") as f:
        small = bpe_trie.Codec(f.read(), memo_bytes=20_000)
    rnd = random.Random(1)
    texts = [" ".join("".join(rnd.choices("aeinorst.", k=6)) for _ in range(50)) for _ in range(40)]
    for _ in range(2):
        for t in texts:
            same(small, library, [t])
            assert small.size <= 10_000


def test_trie_shares_prefixes(codec):
    """A state is computed once for each prefix of the distinct words."""
    words = ["inter", "interest", "interested", "interesting", "internal", "in"]
    before = codec.merges.nodes
    assert set(dict(codec.merges.encode(words * 3))) == set(words)
    assert codec.merges.nodes - before == len({w[:k] for w in words for k in range(1, len(w))}) + len(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=12), st.lists(st.text("abc", max_size=9), max_size=6))
def test_trie_on_any_merges(pairs, words):
    """Any vocabulary whose tokens are made once, against merging the lowest rank first, leftmost first."""
    vocab, merges = {c: i for i, c in enumerate("abc")}, []
    vocab |= {c + "$": 3 + i for i, c in enumerate("abc")}
    for a, b in pairs:
        names = list(vocab)
        x, y = names[a % len(names)], names[b % len(names)]
        if "$" not in x and x + y not in vocab:
            vocab[x + y] = len(vocab)
            merges.append([x, y])
    model = bpe_trie.Merges({"type": "BPE", "vocab": vocab, "merges": merges, "end_of_word_suffix": "$"})
    ranks = {tuple(m): r for r, m in enumerate(merges)}
    for word, got in model.encode(words):
        parts = [*word[:-1], word[-1] + "$"] if word else []
        while True:
            found = min(((ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
            if found is None:
                break
            parts[found[1]:found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
        assert got.tolist() == [vocab[p] for p in parts], (word, merges)


def test_trie_refuses_what_it_cannot_follow():
    with pytest.raises(ValueError):
        bpe_trie.Merges({"type": "BPE", "vocab": {}, "merges": [], "byte_fallback": True})
    with pytest.raises(ValueError):
        bpe_trie.Merges({"type": "BPE", "vocab": {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5},
                         "merges": [["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]]})
