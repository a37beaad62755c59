"""Operator 10: benchmark decontamination by MinHash containment search.

The question is how much of a short item is inside a long document, so the
similarity is the containment of the item's shingles in the document's, which a
document's own minima can't show: a long document's minima come from the rest
of its text.  The item's minima can: under a random hash function the shingle
of the item with the smallest value is a uniform draw of the item, so it is in
the document with a probability equal to the containment.  How many
draws a threshold needs doesn't depend on the size, so there are two cases, not
a class for each power of two: items of more than ``HASHES`` shingles have a
minimum for each of ``HASHES`` hash functions; smaller ones, where draws would
repeat, keep every shingle instead.  A document that holds at least ``least`` of an
item's draws is a candidate; ``least`` is the largest count for which an item at
the threshold is missed with a probability below ``MISS``.  Candidates are
confirmed by the exact containment of the shingles' strings.

Everything is DataFrame functions.  The corpus side is one scan that turns each
text to shingle hashes and probes the sketches of the items; the sketches are
broadcast up to ``BROADCAST_ROWS`` counted rows and shuffled beyond.  Only
candidate documents are read a second time.

Words are lower-cased and parted by white space (blank, \\t to \\r); a shingle
is five words, and a text with fewer words has its whole sequence as the one.
Defined results: texts without words (null, empty) match nothing; a null
document or item id is an id like others; different texts with one item id are
sketched and searched each for itself and reported once; documents with one id
are compared each for itself and reported once, at the best containment;
repeated items are reported once; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 5
THRESHOLD = 0.8
HASHES = 32
MISS = 1e-9
BROADCAST_ROWS = 200_000

SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")


def _starts(words: Column, n: int) -> Column:
    """First positions (from 0) of the shingles; none without words."""
    last = F.greatest(F.size(words) - n, F.lit(0))
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, n: int = WORDS) -> Column:
    """64-bit hashes of the shingles, in order; places past the end don't count."""
    return F.transform(_starts(words, n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))


def shingle_strings(words: Column, n: int = WORDS) -> Column:
    return F.array_distinct(F.transform(_starts(words, n), lambda i: F.array_join(F.slice(words, i + 1, n), " ")))


def least_hits(hashes: int, threshold: float, miss: float = MISS) -> int:
    """Largest m with P(fewer than m of the draws hit) <= miss at the threshold."""
    total, m = 0.0, 0
    while m < hashes:
        total += math.comb(hashes, m) * threshold ** m * (1 - threshold) ** (hashes - m)
        if total > miss:
            break
        m += 1
    return max(1, m)


def sketches(items: DataFrame, hashes: int = HASHES, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """(item_id, item_key, size, size_class, h, draws, least): the minima of each item text.

    ``item_key`` tells the texts of one id apart: each is drawn from alone and
    has its hits counted alone.  Items of at most ``hashes`` shingles keep all
    of them (a draw each, and exactly the threshold's share has to be found);
    larger ones have one minimum for each hash function.
    """
    each = (items.select("item_id", "item_key", F.array_distinct(shingle_hashes(F.col("words"), n)).alias("hs"))
            .where(F.size("hs") > 0)
            .select("item_id", "item_key", "hs", F.size("hs").alias("size"),
                    F.floor(F.log2(F.size("hs").cast("double"))).cast("int").alias("size_class"))
            .withColumn("whole", F.col("size") <= hashes))
    rows = each.select("item_id", "item_key", "size", "size_class", "whole", F.explode("hs").alias("h"))
    kept = rows.where("whole").select("item_id", "item_key", "size", "size_class", "h",
                                      F.lit(1).cast("long").alias("draws"),
                                      F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("long").alias("least"))
    drawn = (rows.where("not whole")
             .select("item_id", "item_key", "size", "size_class", "h",
                     F.explode(F.sequence(F.lit(1), F.lit(hashes))).alias("k"))
             .groupBy("item_id", "item_key", "size", "size_class", "k")
             .agg(F.min_by("h", F.struct(F.xxhash64("k", "h"), "h")).alias("h"))
             .groupBy("item_id", "item_key", "size", "size_class", "h").agg(F.count(F.lit(1)).alias("draws"))
             .withColumn("least", F.lit(least_hits(hashes, threshold)).cast("long")))
    return kept.unionByName(drawn)


def find_contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS,
                   hashes: int = HASHES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment) of every pair
    whose item is contained at ``threshold`` or more."""
    docs = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    items = items.select(items["item_id"].alias("item_id"), words_of(items["text"]).alias("words")) \
        .withColumn("item_key", F.xxhash64("words"))
    sketch = sketches(items, hashes, threshold, n)
    fits = sketch.count() <= broadcast_rows
    hint = F.broadcast if fits else (lambda x: x)

    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    probes = words.select("doc_id", F.explode(F.array_distinct(shingle_hashes(F.col("words"), n))).alias("h"))
    found = (probes.join(hint(sketch), "h")
             .groupBy("doc_id", "item_id", "item_key", "least").agg(F.sum("draws").alias("hits"))
             .where("hits >= least"))

    sets = items.select("item_id", "item_key", shingle_strings(F.col("words"), n).alias("item")).dropDuplicates()
    pairs = found.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"), F.col("item_key").alias("k"))
    # texts meet the candidates as they are; their words are many times as large
    texts = docs.join(pairs, docs["doc_id"].eqNullSafe(pairs["d"])).select(
        "doc_id", "i", "k", words_of(F.col("text")).alias("words"))
    # one row an item text, so within the bound that its sketch (a row at least) was counted for
    both = texts.join(hint(sets), (texts["k"] == sets["item_key"]) & texts["i"].eqNullSafe(sets["item_id"]))
    exact = (both.select("doc_id", "item_id", F.size("item").cast("long").alias("item_shingles"),
                         F.size(F.array_intersect("item", shingle_strings(F.col("words"), n))).cast("long")
                         .alias("shared_shingles"))
             .withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
             .where(F.col("containment") >= threshold))
    best = F.max(F.struct("containment", "shared_shingles", "item_shingles")).alias("b")
    return (exact.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.item_shingles", "b.shared_shingles", "b.containment"))


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found."""
    leaks = find_contained(docs, items, **options).select(F.col("doc_id").alias("leak")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak"]), "left_anti")


SPACE_SQL = "[ \\t\\n\\x0B\\f\\r]+"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE_SQL}'), lambda x: x <> '') AS w
           FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{SPACE_SQL}'), lambda x: x <> '') AS w
      FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - {WORDS - 1}, 1)),
         lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(generate_series(1, greatest(len(w) - {WORDS - 1}, 1)),
         lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id),
m AS (SELECT ds.doc_id, bs.item_id, count(*) AS shared_shingles FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT m.doc_id, m.item_id, n.item_shingles, m.shared_shingles,
       m.shared_shingles::DOUBLE / n.item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE m.shared_shingles::DOUBLE / n.item_shingles >= {THRESHOLD}
"""
