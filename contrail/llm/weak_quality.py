"""Operator 5: quality from weak labels.

Overlapping heuristic labellers vote on each text: bad, good, or nothing.
Expectation-maximisation over the table of vote patterns (at most 3**labellers
rows, counted by Spark over all documents) estimates the class shares and how
often each labeller votes what in either class; the accuracies give every
pattern a posterior.  The posteriors then label a linear scorer on hashed
features (shapes of words, their ends, repetition), which also sees what no
labeller looks at.  No hand-made label is used.

One pass over the whole texts yields votes and features, which are written
once; counting, training and scoring read those rows.  The scorer is fitted in
one task on at most ``SAMPLE`` documents of each side of the posterior, those
with the smallest id hashes, an id with several rows by one of them; the model
has ``DIMS`` weights.

Defined results: a null or empty text gets no vote and no feature, so its score
is the scorer's constant, held at the share of good documents at least; rows
repeat as given; a null id is kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from sys import intern

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import rows_kept, settled, work_folder

DIMS = 1024
SAMPLE = 2000
STEPS = 200
EVEN = 30                # words that a text's features are diluted by: a short text says little
MEMO = 120_000           # words whose shape a worker remembers, about 200 bytes each
SHORT = 40               # characters of a word whose shape is remembered
KEEP_AT = 0.5

GOOD, BAD, NONE = "g", "b", "-"

# -- labellers ------------------------------------------------------------

#: measure, good up to, bad from, fewest words: between the two a labeller abstains
LABELLERS = (
    ("capitals", 0.20, 0.40, 8),       # upper-case share of A-Z and a-z
    ("symbols", 0.02, 0.06, 8),        # share of bytes that prose seldom has
    ("repeats", 0.04, 0.15, 20),       # words equal to the one before
    ("loops", 0.15, 0.40, 40),         # four-word runs seen before in the text
    ("marked", 0.03, 0.20, 8),         # words that end in a run of marks
    ("wordless", 0.05, 0.20, 8),       # words without a letter
    ("unended", 30.0, 60.0, 40),       # words for each end of a sentence
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*!|@^~<>{}[]\\=+_")] = True
_UPPER, _LOWER = slice(65, 91), slice(97, 123)
_RUN = re.compile(r"(\W)\1+$")


class Reader:
    """Measures and features of texts; one a Python worker."""

    def __init__(self):
        self.shapes: dict[str, str] = {}

    def shape(self, word: str) -> str:
        """Classes of all characters, runs once, marks as they are, a bar, the last run of marks
        (four of them, if it is longer: all long runs are one kind)."""
        s = self.shapes.get(word)
        if s is None:
            classes = re.sub(r"(.)\1+", r"\1+", "".join(
                "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
            end = _RUN.search(word)
            s = f"{classes}|{end[0][:4] if end else ''}"
            if len(word) <= SHORT:
                if len(self.shapes) > MEMO:
                    self.shapes.clear()
                self.shapes[word] = s = intern(s)             # shapes are few
        return s

    def read(self, text: str) -> tuple[str, dict[int, float]]:
        """(votes, features) of a text."""
        words = text.split()
        n = len(words)
        if not n:
            return NONE * len(LABELLERS), {}
        data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
        upper, lower = int(data[_UPPER].sum()), int(data[_LOWER].sum())
        shapes = Counter(map(self.shape, words))
        grams = n - len(set(zip(words, words[1:], words[2:], words[3:]))) - 3 if n > 3 else 0
        measures = {
            "capitals": upper / max(1, upper + lower),
            "symbols": int(data[_SYMBOLS].sum()) / max(1, int(data.sum())),
            "repeats": sum(map(eq, words, words[1:])) / n,
            "loops": grams / n,
            "marked": sum(k for s, k in shapes.items() if s[-1] != "|") / n,
            "wordless": sum(k for s, k in shapes.items() if "a" not in s and "A" not in s) / n,
            "unended": n / (1 + sum(k for s, k in shapes.items() if s[s.rfind("|") - 1] in ".!?")),
        }
        votes = "".join(NONE if n < least else GOOD if measures[m] <= good else BAD if measures[m] >= bad else NONE
                        for m, good, bad, least in LABELLERS)
        out: dict[int, float] = {}
        for s, k in shapes.items():
            body, _, end = s.rpartition("|")
            for f in ("s" + body, "e" + end, "b" + body[:2]):
                j = xxhash.xxh3_64_intdigest(f) % DIMS
                out[j] = out.get(j, 0.0) + k / (n + EVEN)
        for name in ("repeats", "loops", "capitals"):
            for f in (name, f"{name}{min(9, int(10 * measures[name]))}"):
                j = xxhash.xxh3_64_intdigest(f) % DIMS
                out[j] = out.get(j, 0.0) + (measures[name] if f == name else 1.0) * n / (n + EVEN)
        return votes, out


# -- accuracies -----------------------------------------------------------

def expectation_maximisation(counts: dict[str, int], rounds: int = 200, tiny: float = 1e-9
                             ) -> tuple[float, list[dict[str, tuple[float, float]]], dict[str, float]]:
    """(share of good texts, odds of each labeller's votes (in bad, in good), posterior of each pattern).

    It starts from the majority of the votes, so that "good" is what most
    labellers call good.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    if not patterns:
        return 1.0, [], {}
    k = len(patterns[0])
    good = np.array([(1 + p.count(GOOD)) / (2 + p.count(GOOD) + p.count(BAD) * 2) for p in patterns])
    votes = {v: np.array([[c == v for c in p] for p in patterns], float) for v in (GOOD, BAD)}
    cast = votes[GOOD] + votes[BAD]
    share, odds = 0.5, {}
    for _ in range(rounds):
        share_was = share
        w = np.stack([n * (1 - good), n * good])                       # class x pattern
        share = min(1 - 1e-6, max(1e-6, float(w[1].sum() / n.sum())))
        total = w @ cast + 2.0                                          # a labeller that abstains says nothing
        odds = {v: (w @ votes[v] + 1.0) / total for v in votes}        # class x labeller, smoothed
        log = np.stack([np.full(len(n), math.log(1 - share)), np.full(len(n), math.log(share))])
        for v in votes:
            log = log + np.log(odds[v]) @ votes[v].T
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if abs(share - share_was) < tiny:
            break
    table = [{v: (float(odds[v][0, j]), float(odds[v][1, j])) for v in odds} for j in range(k)]
    return share, table, {p: float(g) for p, g in zip(patterns, good)}


# -- the scorer -----------------------------------------------------------

def fit_scorer(rows: list[tuple[list[int], list[float], float]], steps: int = STEPS, rate: float = 0.5,
               ridge: float = 1e-4) -> list[float]:
    """Weights (the constant last) of a logistic scorer on soft labels, both sides of equal weight."""
    used = np.unique([DIMS, *(j for at, _, _ in rows for j in at)])
    place = {int(j): i for i, j in enumerate(used)}
    x = np.zeros((len(rows), len(used)))
    y = np.zeros(len(rows))
    for i, (at, values, p) in enumerate(rows):
        x[i, [place[j] for j in at]] = values
        x[i, place[DIMS]] = 1.0
        y[i] = p
    share = min(0.99, max(0.01, float(y.mean()))) if len(rows) else 0.5
    s = (y / (2 * share) + (1 - y) / (2 * (1 - share))) / max(1, len(rows))
    w, seen = np.zeros(len(used)), np.full(len(used), 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (s * (y - p)) - ridge * w
        seen += g * g
        w += rate * g / np.sqrt(seen)
    out = np.zeros(DIMS + 1)
    out[used] = w
    return out.tolist()


# -- Spark ----------------------------------------------------------------

READ = "doc_id long, votes string, at array<int>, value array<float>"
_READERS: list[Reader] = []


def reader() -> Reader:
    if not _READERS:
        _READERS.append(Reader())
    return _READERS[0]


def readings(docs: DataFrame) -> DataFrame:
    """Votes and hashed features of each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = [reader().read(t or "") for t in part.column(1).to_pylist()]
                yield pa.record_batch([
                    part.column(0), pa.array([v for v, _ in got], pa.string()),
                    pa.array([list(f) for _, f in got], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for _, f in got], pa.list_(pa.float32()))],
                    ["doc_id", "votes", "at", "value"])

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
            .mapInArrow(rows, READ))


def train_scorer(read: DataFrame, posterior: dict[str, float], sample: int = SAMPLE) -> dict:
    """The scorer, fitted in one task on a bounded sample of both sides."""
    spark = read.sparkSession
    share = spark.createDataFrame(sorted(posterior.items()) or [(NONE, 1.0)], "votes string, good double")
    known = (read.select("doc_id", "votes").where("doc_id is not null")
             .join(F.broadcast(share), "votes")                # a row a vote pattern
             .groupBy("doc_id").agg(F.min(F.struct("good", "votes")).alias("least")).select("doc_id", "least.*"))
    few = [known.where(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
           for side in ("good >= 0.5", "good < 0.5")]
    ids = F.broadcast(few[0].unionByName(few[1]))
    one = F.struct("at", "value")
    rows = (read.join(ids, ["doc_id", "votes"])                # one reading an id, however often it is there
            .groupBy("doc_id").agg(F.min_by(one, F.struct(F.xxhash64("at", "value"), one)).alias("one"),
                                   F.min("good").alias("good"))
            .select("doc_id", "one.at", "one.value", "good"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        w = fit_scorer([(at, value, good) for _, at, value, good in got])
        yield pa.record_batch([pa.array([json.dumps(w)])], ["w"])

    made = rows.coalesce(1).mapInArrow(fit, "w string").first()      # none where there is no row at all
    return {"weights": json.loads(made[0]) if made else [0.0] * (DIMS + 1)}


def fit_model(read: DataFrame, sample: int = SAMPLE) -> dict:
    """Everything learned from the readings: posteriors of the vote patterns,
    weights, and the score of a text without features."""
    counts = {r.votes: r.n for r in read.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    share, _, posterior = expectation_maximisation(counts)
    weights = np.array(train_scorer(read, posterior, sample)["weights"])
    weights[DIMS] += math.log(share / (1 - share)) if share < 1 else 0.0     # fitted at equal shares
    return {"posterior": posterior, "weights": weights,
            "plain": max(share, float(1 / (1 + np.exp(-weights[DIMS]))))}


def score_quality(docs: DataFrame, folder: str | None = None, sample: int = SAMPLE, keep_at: float = KEEP_AT
                  ) -> DataFrame:
    """(doc_id, votes, posterior, score, predicted) of each row; score and
    posterior are probabilities of a good text."""
    folder = folder or work_folder(docs.sparkSession, "quality")
    read = settled(readings(docs), folder, "read")
    model = fit_model(read, sample)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, posterior = model["weights"], model["posterior"]
        for b in batches:
            at, value = b.column(2), b.column(3)
            sizes = np.diff(at.offsets.to_numpy())
            z = np.full(b.num_rows, weights[DIMS])
            np.add.at(z, np.repeat(np.arange(b.num_rows), sizes),
                      weights[at.flatten().to_numpy()] * value.flatten().to_numpy())
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            score[sizes == 0] = model["plain"]
            votes = b.column(1).to_pylist()
            yield pa.record_batch([b.column(0), b.column(1), pa.array([posterior.get(v) for v in votes], pa.float64()),
                                   pa.array(score, pa.float64()), pa.array((score >= keep_at).astype(np.int32))],
                                  ["doc_id", "votes", "posterior", "score", "predicted"])

    return read.mapInArrow(rows, "doc_id long, votes string, posterior double, score double, predicted int")


def good_documents(docs: DataFrame, folder: str | None = None, sample: int = SAMPLE, keep_at: float = KEEP_AT
                   ) -> DataFrame:
    """The rows that score ``keep_at`` or more, with all their columns.

    The texts are read a second time with the fitted model instead of shuffling
    them to their scores.
    """
    folder = folder or work_folder(docs.sparkSession, "quality")
    model = fit_model(settled(readings(docs), folder, "read"), sample)

    def keep(texts: list[str]) -> list[bool]:
        w, out = model["weights"], []
        for text in texts:
            f = reader().read(text)[1]
            # features as they are written: single precision
            z = w[DIMS] + sum(w[j] * float(np.float32(v)) for j, v in f.items())
            out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if f else model["plain"]) >= keep_at)
        return out

    return rows_kept(docs, keep)
