"""Operators on documents: shards, tokens, token files, containment, near duplicates."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import bpe_tree, contamination, jump_shards, near_dups, pfor_ids
from contrail.llm.common import work_folder
from contrail.llm.components import connected_components

SF = "/root/testdata/sf0.001"
RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [(1, "", "a"), (2, None, "b"), (None, "null id has a text of a few words", None), (3, "x", "a"), (3, "x", "a"),
       (4, " \t\n\x0b ", "a"), (5, "word " * 40_000, "a"), (6, "w" * 120_000, "c"), (7, "Same Text here OK now", "c"),
       (8, "same text HERE ok now", "c"), (9, "é 中文 🙂\x85 <|endoftext|> 's", "c")]
CLASH = ("doc_id long, text string, source string, item_id long, words string, h long, rep long, band long, "
         "gone long, leak long, shard int, bucket int, slot long, name string")


def odd(spark, rows=ODD):
    return spark.createDataFrame([(d, t, s, 1, "w", 2, 3, 4, 5, 6, 7, 8, 9, "n") for d, t, s in rows], CLASH)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# -- shards ---------------------------------------------------------------

def jump_once(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@given(st.lists(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=30), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_jump_as_published_and_monotone(keys, n):
    got = jump_shards.jump(np.array(keys, np.int64), n)
    assert got.tolist() == [jump_once(k, n) for k in keys]
    grown = jump_shards.jump(np.array(keys, np.int64), n + 1)
    assert all(a == b or b == n for a, b in zip(got, grown))


def check_shards(docs, rows):
    by = collections.defaultdict(list)
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        t = (r.text or "").encode()
        want[r.doc_id, len(t) + 1, zlib.crc32(t), jump_once(r.doc_id or 0, 16), jump_once(r.doc_id or 0, 17)] += 1
    for r in rows:
        want[r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard] -= 1
        by[r.shard].append(r.slot)
        assert r.law == "key"
    assert not any(want.values())
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_shards(spark):
    for docs in (documents(spark), odd(spark)):
        check_shards(docs, jump_shards.shard_documents(docs).collect())
    assert jump_shards.shard_documents(odd(spark, [])).count() == 0


# -- byte-level BPE -------------------------------------------------------

@pytest.mark.parametrize("leaf", [2, 3, 7, 64])
def test_tree_is_the_library_encoding(leaf):
    plain, c = plain_encoding(), bpe_tree.TreeCodec(bpe_tree.read_ranks(RANKS), P.PATTERN, leaf)
    rng = random.Random(leaf)
    for alphabet in ("a", "ab '\n", "thein s", "é 中文，。a", "'stredl m'", "0 1a.\t\n ", "🙂a 　\x1c\x85"):
        for _ in range(120):
            s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90)))
            ids = c.encode(s)
            assert ids == plain.encode_ordinary(s), repr(s)
            assert c.decode(ids) == s.encode()


@given(st.text(max_size=60), st.text(max_size=60), st.text(max_size=60))
@settings(max_examples=80, deadline=None)
def test_join_is_associative(a, b, c):
    codec = bpe_tree.codec("t", bpe_tree.read_ranks(RANKS), P.PATTERN, 4) if not bpe_tree._CODECS else next(
        iter(bpe_tree._CODECS.values()))
    x, y, z = map(codec.encode, (a, b, c))
    assert codec.join(codec.join(x, y), z) == codec.join(x, codec.join(y, z)) == codec.encode(a + b + c)


def test_bpe_digests(spark):
    plain = plain_encoding()
    for docs in (documents(spark), odd(spark)):
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = plain.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        got = collections.Counter(tuple(r) for r in bpe_tree.bpe_digests(docs, RANKS, P.PATTERN).collect())
        assert got == want
    assert bpe_tree.bpe_digests(odd(spark, []), RANKS, P.PATTERN).count() == 0
    r = bpe_tree.bpe_tokens(odd(spark).where("doc_id = 9"), RANKS, P.PATTERN).first()
    assert r.ids == plain.encode_ordinary(ODD[-1][1]) and bytes(r.decoded) == ODD[-1][1].encode()


# -- token files ----------------------------------------------------------

@given(st.lists(st.one_of(st.integers(0, 70), st.integers(0, 2**32 - 1)), max_size=700), st.floats(0.01, 1.0))
@settings(max_examples=80, deadline=None)
def test_blocks_round_trip(ids, percentile):
    x = np.array(ids, np.uint32)
    starts, data = pfor_ids.pack(x, percentile)
    assert (pfor_ids.unpack(data, starts, len(x)) == x).all()


def test_outliers_become_exceptions():
    x = np.array([5] * 127 + [4_000_000_000], np.uint32)
    starts, data = pfor_ids.pack(x)
    assert len(data) == 8 + 5                  # a block head, width 0, one exception
    s = pfor_ids.segment([1, None, 3], [x[:1], x[:0], np.arange(300, dtype=np.uint32)])
    ids, docs = pfor_ids.read_segment(s)
    assert ids == [1, None, 3] and [len(d) for d in docs] == [1, 0, 300]
    assert pfor_ids.read_block(s, 2).tolist() == list(range(255, 300))


def test_word_memo_is_the_library_encoding():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    memo, rng, texts = pfor_ids.WordMemo(t, size=50), random.Random(2), []
    for alphabet in ("ab ", "a ' \n", "thein s", "é 中文，。a", "0 1a.\t\n ", "🙂a 　\x1c\x85", "<|endoftext|> "):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b <|endoftext", " <|endoftext|><|endoftext|> c"]
    for some in (texts[:700], texts[700:], texts):
        want = [e.ids for e in t.encode_batch_fast(some, add_special_tokens=False)]
        assert [x.tolist() for x in memo.encode(some)] == want


def test_a_known_word_is_looked_up_once():
    from tokenizers import Tokenizer

    class Counting(dict):
        looks = 0

        def get(self, key):
            self.looks += 1
            return dict.get(self, key)

        def __getitem__(self, key):
            self.looks += 1
            return dict.__getitem__(self, key)

        def __contains__(self, key):
            self.looks += 1
            return dict.__contains__(self, key)

    memo = pfor_ids.WordMemo(Tokenizer.from_file(JSON))
    texts = ["the sun and the moon", "é 中文 ends with \n a\tline \x00", "", "moon"]
    want = [x.tolist() for x in memo.encode(texts)]
    memo.rest = Counting(memo.rest)
    assert [x.tolist() for x in memo.encode(texts)] == want
    assert memo.rest.looks == len({w for t in texts for w in t.split(" ")})
    for words in ([""], ["a"], ["", "é", "\x85", "中文", "\x00"]):
        assert pfor_ids._listed(pfor_ids.pa.array(words, pfor_ids.pa.large_string())) == words


@pytest.mark.parametrize("segment", [50, 1 << 20])
def test_token_files(spark, segment):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    for docs in (documents(spark), odd(spark)):
        rows = docs.select("doc_id", "text").collect()
        want = collections.Counter()
        for r in rows:
            ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
        folder = work_folder(spark, "test-ids")
        manifest = pfor_ids.write_ids(docs, JSON, folder, segment_tokens=segment)
        got = pfor_ids.read_digests(manifest, folder).collect()
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
        got.sort(key=lambda r: r.start)
        at = 0
        for r in got:
            assert r.start == at
            at += r.n_tokens
        ids = [-1 if r.doc_id is None else r.doc_id for r in got]
        assert ids == sorted(ids)
    assert pfor_ids.write_and_read(odd(spark, []), JSON).count() == 0


# -- containment ----------------------------------------------------------

def words(text):
    return [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def contained(docs, items, share=0.8):
    out = {}
    sets = [(i, shingles(t, 5)) for i, t in items]
    for d, t in docs:
        s = shingles(t, 5)
        for i, q in sets:
            if q and len(q & s) >= share * len(q):
                out[d, i] = max(out.get((d, i), (0, 0)), (len(q & s) / len(q), len(q & s)))
    return out


def found(df):
    return {(r.doc_id, r.item_id): (r.containment, r.shared_shingles) for r in df.collect()}


@pytest.mark.parametrize("limit", [0, 200_000])
def test_containment_against_brute_force(spark, limit):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 12, 30, 36, 37, 60, 90])))) for i in range(30)]
    docs = []
    for d in range(80):
        body = rng.choices(vocabulary, k=rng.choice([0, 4, 50, 400, 3000]))
        for _ in range(rng.choice([0, 1, 2])):
            w = items[rng.randrange(30)][1].split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = w
        docs.append((d, " ".join(body).upper()))
    items += [(30, None), (31, ""), (None, items[7][1]), (7, items[7][1])]
    docs += [(None, docs[3][1]), (3, docs[3][1]), (500, None), (501, items[0][1])]
    got = contamination.find_contained(odd(spark, [(d, t, "s") for d, t in docs]),
                                       spark.createDataFrame(items, "item_id long, text string"),
                                       broadcast_rows=limit)
    assert found(got) == contained(docs, items)


def test_long_items_with_one_id_are_found_each(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"i{k}x{j}" for j in range(60))) for i in (None, 4) for k in range(10 * (i or 1), 10 * (i or 1) + 10)]
    docs = [(d, " ".join([f"a{rng.random()}" for _ in range(80)] + [t] + [f"b{rng.random()}" for _ in range(80)]))
            for d, (_, t) in enumerate(items)]
    docs.append((99, "none of them is in this text"))
    docs_df, items_df = odd(spark, [(d, t, "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string")
    want = contained(docs, items)
    assert len(want) == 20
    for limit in (0, 200_000):
        assert found(contamination.find_contained(docs_df, items_df, broadcast_rows=limit)) == want
    assert [r.doc_id for r in contamination.decontaminated(docs_df, items_df).collect()] == [99]


def test_containment_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contamination.find_contained(odd(spark, []), items).count() == 0
    assert contamination.find_contained(odd(spark), items.limit(0)).count() == 0
    assert contamination.decontaminated(odd(spark), items.limit(0)).count() == len(ODD)


def test_least_hits_keeps_the_miss_bound():
    from math import comb
    m = contamination.least_hits(32, 0.8)
    tail = lambda k: sum(comb(32, i) * 0.8 ** i * 0.2 ** (32 - i) for i in range(k))
    assert m > 1 and tail(m) <= contamination.MISS < tail(m + 1)


# -- near duplicates ------------------------------------------------------

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def linked(rows, n, percent):
    """{doc_id: (size, component)} by comparing all pairs."""
    sets = []
    for d, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(_LOW))
        sets.append((d, {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {(d, len(s)): root(d) for d, s in sets}


def near_rows(df):
    return {(r.doc_id, r.n_shingles): r.component_id for r in df.collect()}


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        text = rng.choices(vocabulary, k=rng.choice([2, 3, 20, 120, 300]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.3:
                text = copy                     # chains: the ends need not be near
    rng.shuffle(rows)
    for n, percent in ((3, 85), (5, 80)):
        got = near_dups.near_duplicates(odd(spark, [(d, t, "s") for d, t in rows]), n, percent)
        assert near_rows(got) == linked(rows, n, percent)


@pytest.mark.parametrize("room, block", [(0, 1024), (10**9, 7)])
def test_clouds_of_near_copies(spark, monkeypatch, room, block):
    """Texts around one original, many of them just too far from each other:
    by further pivots, and by blocks smaller than a bucket."""
    monkeypatch.setattr(near_dups, "ROOM", room)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rng = random.Random(3)
    base = [f"s{i}" for i in range(120)]
    rows = []
    for d in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append((d, " ".join(w)))
    want = linked(rows, 3, 85)
    assert 2 < len(set(want.values())) < 60
    assert near_rows(near_dups.near_duplicates(odd(spark, [(d, t, "s") for d, t in rows]), 3, 85)) == want


def test_near_duplicates_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in near_dups.near_duplicates(odd(spark), 3, 85).collect()), key=repr)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (4, 0, 4, True), (5, 1, 5, True),
            (6, 1, 6, True), (7, 3, 7, True), (8, 3, 7, False), (9, 2, 9, True), (None, 7, None, True)]
    assert got == sorted(want, key=repr)
    assert near_dups.near_duplicates(odd(spark, []), 3, 85).count() == 0
    left = near_dups.deduplicated(odd(spark), words=3, percent=85)
    assert left.columns == odd(spark).columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 2, None, 3, 3, 4, 5, 6, 7, 9], key=repr)


def test_rows_of_one_id_are_one_node(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(5, a), (5, b), (9, a), (2, b)]
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(odd(spark, [(d, t, "") for d, t in rows]), 3, 85).collect()}
    assert got == {5: 2, 9: 2, 2: 2}


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    other = [w if rng.random() < 0.95 else "z" + w for w in base]
    docs = odd(spark, [(1, " ".join(base), ""), (2, " ".join(other), "")])
    a, b = near_dups.signatures(near_dups._texts(docs), 3).orderBy("doc_id").collect()
    true = len(shingles(" ".join(base), 3) & shingles(" ".join(other), 3)) / len(
        shingles(" ".join(base), 3) | shingles(" ".join(other), 3))
    got = spark.createDataFrame([(a.bits, b.bits)], "x array<long>, y array<long>").select(
        near_dups.estimate("x", "y")).first()[0]
    assert abs(got - true) < 0.08


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, work_folder(spark, "test-cc"), "x").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert connected_components(df.limit(0), work_folder(spark, "test-cc"), "x").count() == 0
