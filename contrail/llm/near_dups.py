"""Operator 1: near duplicates by b-bit MinHash.

Every text becomes the set of its word shingles.  One pass keeps of each the
size, a digest of the set, and a key for each band of ``ROWS`` minima under
random hash functions.

1. Texts with equal sets form a class; only its smallest id goes on.
2. Classes that share a band key meet in a bucket.  Those that meet any get a
   b-bit signature: ``HASHES`` minima of which the low ``BITS`` bits are kept
   and packed in 64-bit words.
3. A bucket never emits its pairs: its members are first compared with a pivot,
   drawn anew for each band, so that a member meets many of its neighbours.
4. A pair is a candidate when the similarity estimated from the signatures
   (equal groups by bit counts, corrected for the 2**-BITS chance that two
   different minima agree) reaches the threshold less five standard deviations
   (a link is missed with a probability below 3e-7).
5. Candidates are confirmed on their full sets; confirmed links are contracted
   to connected components.
6. Members of a bucket that are still in different components were not all
   compared.  While such pairs are more than ``ROOM`` times the rows of all
   buckets, further pivots are drawn, eight times as many each round, in
   ``PIVOT_ROUNDS`` rounds at most.  Then the
   signatures of a bucket are compared in blocks of ``BLOCK`` members, each
   pair in the first band that it shares: at first each member hands on its
   ``BEST`` candidates, then, between the components that are left, all of
   them.  So no link between different texts that share a bucket is lost, a
   task holds two blocks, and only candidates are emitted.

Two texts at the threshold 0.8 (0.85) miss each other in all bands with a
probability below 1e-7 (1e-10).

Words are parted by blank, \\t to \\r; A-Z are lower-cased.  A text with fewer
words than a shingle has its whole sequence as its one shingle.
Defined results: a null or empty text, or one of white space, has no shingles
and links with nothing; rows with a null id are returned, kept, without a
component; rows with one id are one node of the graph, each returned; an empty
table gives no rows; other columns don't matter here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import settled, sized, work_folder
from contrail.llm.components import connected_components

ROWS, BANDS = 4, 32
HASHES, BITS = 2048, 2
WORDS64 = HASHES * BITS // 64
ROOM = 256
PIVOT_ROUNDS = 3
BLOCK = 1024
BEST = 4
ROWS_A_TASK, PAIRS_A_TASK = 20_000, 2_000
SIGMAS = 5.0

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)   # fixed values of a published mixer


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A = (_SEEDS[:HASHES] | np.uint64(1))[:, None]
_B = _SEEDS[HASHES:, None]
_BAND = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_SHIFTS = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))
_ONES = sum(1 << (BITS * i) for i in range(64 // BITS))       # the lowest bit of each group


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a UTF-8 text."""
    words = text.lower().split()               # bytes: A-Z, and blank, \t to \r
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(h))
    acc = _mix(h[:len(h) - n + 1])
    for k in range(1, n):
        acc = _mix(acc + h[k:len(h) - n + 1 + k])
    return np.unique(acc)


def minima(shingles: np.ndarray, count: int, cells: int = 1 << 19) -> np.ndarray:
    """Minima under the first ``count`` hash functions, a bounded number of values at once."""
    out = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, cells // count)
    for i in range(0, len(shingles), step):
        np.minimum(out, (_A[:count] * shingles[None, i:i + step] + _B[:count]).min(axis=1), out=out)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """The low bits of each minimum in 64-bit words."""
    low = (_mix(mins) & np.uint64((1 << BITS) - 1)).reshape(WORDS64, -1)
    return np.bitwise_or.reduce(low << _SHIFTS, axis=1)


def band_keys(mins: np.ndarray) -> np.ndarray:
    rows = mins.reshape(BANDS, ROWS)
    acc = _BAND.copy()
    for k in range(ROWS):
        acc = _mix(acc + rows[:, k])
    return acc


SKETCH = "doc_id long, n_shingles long, set_id binary, bands array<long>"


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """A sketch of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                out = []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text, words)
                    if not len(s):
                        out.append((0, None, None))
                        continue
                    out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()),
                                band_keys(minima(s, ROWS * BANDS)).view(np.int64)))
                size, set_id, bands = zip(*out)
                yield pa.record_batch([part.column(0), pa.array(size, pa.int64()), pa.array(set_id, pa.binary()),
                                       pa.array(bands, pa.list_(pa.int64()))],
                                      ["doc_id", "n_shingles", "set_id", "bands"])

    return _texts(docs).mapInArrow(rows, SKETCH)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))


def signatures(texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, text, bits) of (doc_id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                bits = [packed(minima(shingle_set(t, words), HASHES)).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(bits, pa.list_(pa.int64()))],
                                      ["doc_id", "text", "bits"])

    return texts.mapInArrow(rows, "doc_id long, text binary, bits array<long>")


def least_estimate(percent: int) -> float:
    """The threshold less ``SIGMAS`` standard deviations of the estimate."""
    chance, share = 2.0 ** -BITS, percent / 100
    equal = share + (1 - share) * chance
    return share - SIGMAS * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def estimate(bits_a: str, bits_b: str) -> Column:
    """Similarity from packed bits: the share of equal groups, corrected for chance."""
    ones = F.lit(_ONES)
    unequal = F.lit(0)
    for w in range(WORDS64):
        x = F.element_at(bits_a, w + 1).bitwiseXOR(F.element_at(bits_b, w + 1))
        any_bit = x
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, k))
        unequal = unequal + F.bit_count(any_bit.bitwiseAND(ones))
    chance = 2.0 ** -BITS
    return ((1 - unequal / HASHES) - chance) / (1 - chance)


def confirmed(pairs: DataFrame, needed: DataFrame, words: int, percent: int, count: int) -> DataFrame:
    """The pairs (a, b) whose signatures and then full sets reach the threshold;
    ``needed`` has their texts and signatures."""
    left = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"), F.col("bits").alias("bits_a"))
    right = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"), F.col("bits").alias("bits_b"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                keep = []
                for text_a, text_b in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if text_a != last:          # pairs of one pivot often follow each other
                        last, held = text_a, shingle_set(text_a, words)
                    other = shingle_set(text_b, words)
                    shared = len(np.intersect1d(held, other, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(held) + len(other) - shared) and shared > 0)
                yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sized(pairs.join(right, "b"), count, PAIRS_A_TASK)
    both = sized(one.join(left, "a"), count, PAIRS_A_TASK)
    return (both.where(estimate("bits_a", "bits_b") >= least_estimate(percent)).select("a", "b", "text_a", "text_b")
            .mapInArrow(rows, "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, folder: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    folder = folder or work_folder(docs.sparkSession, "near-dups")
    sk = settled(sketches(docs, words), folder, "sketches")
    whole = sk.where("n_shingles > 0 and doc_id is not null")
    least = whole.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    members = settled(whole.select("doc_id", "set_id").join(least, "set_id").select("doc_id", "set_id", "rep"),
                      folder, "members")
    band_rows = settled(_shared_bands(whole, members), folder, "bands")
    text, met = _texts(docs), band_rows.select(F.col("doc_id").alias("id")).distinct()
    # always shuffled: whether these ids would fit a broadcast depends on the data
    needed = settled(signatures(text.join(met.hint("merge"), text["doc_id"] == met["id"], "left_semi"), words),
                     folder, "texts")

    n = band_rows.count()
    draw = F.struct(F.xxhash64("doc_id", "band").alias("draw"), "doc_id")
    pivots = sized(band_rows.groupBy("band").agg(F.min(draw)["doc_id"].alias("pivot")), n, ROWS_A_TASK)
    met = sized(band_rows.join(pivots, "band"), n, ROWS_A_TASK).select(
        F.col("pivot").alias("a"), F.col("doc_id").alias("b"))
    links = _repeated_ids(members).unionByName(_confirm(met, needed, words, percent, folder, "pivots"))
    comps = _components(links, folder, "0")
    room, turn = ROOM * n, 0
    while True:
        live, open_pairs = _live(band_rows, comps, n, folder, str(turn))
        if open_pairs <= room or turn == PIVOT_ROUNDS:
            break
        turn += 1
        found = _confirm(_more_pivots(live, 8 ** turn), needed, words, percent, folder, f"pivots-{turn}")
        links = links.unionByName(found)
        comps = _components(links, folder, str(turn))
    for name, best in (("best", BEST), ("all", None)):
        if not open_pairs:
            break
        pairs = _compared(live, needed.select("doc_id", "bits"), band_rows, percent, best)
        found = _confirm(pairs, needed, words, percent, folder, name)
        if not found.isEmpty():
            links = links.unionByName(found)
            comps = _components(links, folder, name)
        live, open_pairs = _live(band_rows, comps, n, folder, name) if best else (live, 0)

    rows = (sk.select("doc_id", "n_shingles", "set_id")
            .join(least, "set_id", "left")
            .join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left"))
    component = F.coalesce("component", "rep", "doc_id")
    return rows.select("doc_id", "n_shingles",
                       F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _shared_bands(whole: DataFrame, members: DataFrame) -> DataFrame:
    """(band, doc_id) of the bands in which two classes or more meet."""
    reps = members.where("doc_id = rep").select("doc_id", "set_id").distinct()
    rows = (whole.join(reps, ["doc_id", "set_id"], "left_semi")
            .select("doc_id", F.explode("bands").alias("band")).distinct())
    met = (rows.groupBy("band").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
           .where("lo < hi").select("band"))
    return rows.join(met, "band", "left_semi")


def _repeated_ids(members: DataFrame) -> DataFrame:
    """Links between classes that share an id on different rows."""
    many = (members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
            .where("a < b").select("doc_id", "a"))
    return members.join(many, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()


def _components(links: DataFrame, folder: str, name: str) -> DataFrame:
    return settled(connected_components(links, folder, f"cc-{name}"), folder, f"components-{name}")


def _confirm(pairs, needed, words, percent, folder, name) -> DataFrame:
    """The linked ones among (a, b), in either order and repeated."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = settled(pairs, folder, f"pairs-{name}")
    return settled(confirmed(pairs, needed, words, percent, pairs.count()), folder, f"links-{name}")


def _live(band_rows: DataFrame, comps: DataFrame, n: int, folder: str, name: str) -> tuple[DataFrame, int]:
    """Members of buckets that hold several components (band, doc_id, component,
    size, minor: outside the largest component), and how many pairs with a
    minor member they make."""
    named = (sized(band_rows.join(comps, band_rows["doc_id"] == comps["node"], "left"), n, ROWS_A_TASK)
             .select("band", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    parts = sized(named.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")), n, ROWS_A_TASK)
    buckets = (parts.groupBy("band")
               .agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"),
                    F.max(F.struct("n", "component")).alias("most"))
               .where("parts > 1 and size > 2")       # the two of a pair have met as pivot and member
               .select("band", "size", F.col("most.component").alias("largest")))
    live = settled(sized(named.join(sized(buckets, n, ROWS_A_TASK), "band"), n, ROWS_A_TASK)
                   .select("band", "doc_id", "component", "size", (F.col("component") != F.col("largest")).alias("minor")),
                   folder, f"live-{name}")
    return live, live.where("minor").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def _more_pivots(live: DataFrame, count: int) -> DataFrame:
    """(a, b): each member of a bucket with one pivot of each of its ``count``
    first components in a random order."""
    one = (live.groupBy("band", "component")
           .agg(F.min(F.struct(F.xxhash64("doc_id", "band", F.lit(count)).alias("draw"), "doc_id")).alias("p")))
    order = F.row_number().over(Window.partitionBy("band").orderBy("p"))
    pivots = (one.withColumn("nth", order).where(F.col("nth") <= count)
              .select("band", F.col("p.doc_id").alias("a"), F.col("component").alias("c")))
    return live.join(pivots, "band").where("component <> c").select("a", F.col("doc_id").alias("b"))


def _compared(live: DataFrame, bits: DataFrame, band_rows: DataFrame, percent: int, best: int | None) -> DataFrame:
    """(a, b): candidates between components, from signatures compared in blocks.

    ``best``: only so many of each minor member, the nearest first.
    """
    keys = band_rows.groupBy("doc_id").agg(F.sort_array(F.collect_list("band")).alias("bands"))   # BANDS at most
    rows = (live.join(bits, "doc_id").join(keys, "doc_id")
            .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("doc_id", "band"), F.col("blocks")).cast("int")))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cols = ["band", "i", "j", "side", "doc_id", "component", "minor", "bits", "bands"]
    left = rows.where("minor").withColumn("i", F.col("block")).withColumn("j", others).withColumn("side", F.lit(0))
    right = rows.withColumn("j", F.col("block")).withColumn("i", others).withColumn("side", F.lit(1))
    dealt = (left.select(cols).unionByName(right.select(cols))
             .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "side", "doc_id"))
    least = least_estimate(percent)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            a, b, near = _candidates(rows, least, best)
            if len(a):
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near, pa.float64())],
                                      ["a", "b", "near"])

    found = dealt.mapInArrow(pairs, "a long, b long, near double")
    if best is not None:
        nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("near"), "b"))
        found = found.withColumn("nth", nth).where(F.col("nth") <= best)
    return found.select("a", "b")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows with one (band, i, j)."""
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            now = tuple(key[:, x].tolist())
            if now != at and held:
                yield held
                held = []
            held, at = [*held, batch.slice(x, y - x)], now
    if held:
        yield held


def _candidates(rows: list[pa.RecordBatch], least: float, best: int | None
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a left and a right row of a block pair that the signatures call
    near, and their estimates."""
    t = pa.Table.from_batches(rows).combine_chunks()
    side, ids, comp = (t.column(k).to_numpy() for k in ("side", "doc_id", "component"))
    minor = t.column("minor").to_numpy()
    n = int((side == 0).sum())
    if not n or n == len(side):
        return ids[:0], ids[:0], np.zeros(0)
    band = t.column("band")[0].as_py()
    bits = t.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(side), WORDS64)
    bands = t.column("bands").combine_chunks()
    chance, out_a, out_b, out_near = 2.0 ** -BITS, [], [], []
    step = max(1, (1 << 21) // (WORDS64 * (len(side) - n)))
    for x in range(0, n, step):
        d = bits[x:min(n, x + step), None, :] ^ bits[None, n:, :]
        any_bit = d.copy()
        for k in range(1, BITS):
            any_bit |= d >> np.uint64(k)
        unequal = np.bitwise_count(any_bit & np.uint64(_ONES)).sum(axis=2, dtype=np.int64)
        near = ((1 - unequal / HASHES) - chance) / (1 - chance)
        rows_x = np.arange(x, min(n, x + step))
        ok = (near >= least) & (comp[rows_x][:, None] != comp[None, n:])
        ok &= ~(minor[None, n:] & (ids[rows_x][:, None] >= ids[None, n:]))      # two minor members: once
        r, c = np.nonzero(ok)
        # each pair in the first band that it shares
        first = np.array([_first_shared(bands, rows_x[i], n + j) == band for i, j in zip(r, c)], bool)
        r, c = r[first], c[first]
        if best is not None and len(r):
            order = np.lexsort((ids[n + c], -near[r, c], r))
            r, c = r[order], c[order]
            start = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1])
            nth = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r))))
            r, c = r[nth < best], c[nth < best]
        out_a.append(ids[rows_x[r]])
        out_b.append(ids[n + c])
        out_near.append(near[r, c])
    return np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_near)


def _first_shared(bands: pa.ListArray, i: int, j: int) -> int:
    """The smallest band key that two rows share; their keys are sorted."""
    return int(np.intersect1d(bands[int(i)].values.to_numpy(), bands[int(j)].values.to_numpy(), assume_unique=True)[0])


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near duplicates: its smallest id's (null ids all stay)."""
    found = near_duplicates(docs, **options)
    gone = found.where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return (docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti"))
