"""Operator 4: toxic spans by a linear-chain conditional random field.

Tokens are words; chains are sentences.  A token's features are the word and
its prefixes; two labels, toxic or not, with transitions between neighbours.

Labels come for documents, so the training tokens are labelled first: a feature
is a marker when it stands in toxic documents so much more often than chance
that the bound ``n * KL(share in toxic || share of toxic documents)`` reaches
``EVIDENCE``, and the tokens of toxic documents that bear a marker are labelled
toxic.  Near copies among the training documents count once.  The field is then
fitted to these tokens by gradient steps on the exact likelihood (forward and
backward sums) with an L1 penalty.

Scoring reads whole texts.  Forward-backward marginals give each token's
probability; a document's score is a logistic function of its largest marginal
and of the expected number of toxic tokens, fitted on the training documents at
their true class shares.  A sentence in which no token scores above the
field's constant can't raise either and takes part with the floor.  Offending
spans are runs of tokens with a marginal of at least ``SPAN``.

Training takes at most ``TOXIC`` toxic and ``CLEAN`` other documents, those
with the smallest id hashes, of at most ``TRAIN_BYTES`` bytes; it runs in one
task, and the model (bounded by ``FEATURES`` weights) is shipped to the others.

Defined results: a null or empty text has the score of a text without a toxic
token; rows repeat as given, with equal scores; a null id is kept; label rows
whose label or id is null are not learned from; without labels of both kinds
every score is the share of toxic labels (0 without labels); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import random
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import rows_kept

TOXIC, CLEAN = 1500, 4500
TRAIN_BYTES = 32 * 1024
SENTENCES = 5_000          # of each kind, for the field
EVIDENCE = 16.0             # natural log of the odds against chance
EPOCHS = 3
RATE, PENALTY = 0.5, 1e-3
FEATURES = 20_000
SPAN = 0.5
MEMO = 120_000              # words whose emission a worker remembers, about 200 bytes each
FLOOR = 1e-4                # a marginal below it counts as it

WORD = re.compile(r"\w+")
BREAK = re.compile(r"[.!?\n]")
PREFIXES = (4, 5, 6)


@lru_cache(maxsize=20_000)
def features(word: str) -> tuple[str, ...]:
    """Of a lower-cased word."""
    return ("w " + word, *(f"{n} {word[:n]}" for n in PREFIXES if len(word) > n))


def sentences(text: str) -> list[list[tuple[str, int, int]]]:
    """(word, start, stop) of each word, sentence by sentence."""
    out, last = [], None
    for m in WORD.finditer(text):
        if last is None or BREAK.search(text, last, m.start()):
            out.append([])
        out[-1].append((m[0].lower(), m.start(), m.end()))
        last = m.end()
    return out


# -- the field ------------------------------------------------------------

class Field:
    """Two labels; the plain label scores 0, the toxic one its emission."""

    def __init__(self, bias: float = -3.0, weights: dict[str, float] | None = None,
                 stay: float = 0.0, enter: float = 0.0, leave: float = 0.0):
        self.bias, self.weights = bias, weights or {}
        self.stay, self.enter, self.leave = stay, enter, leave

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))

    def marginals(self, emissions: list[float]) -> tuple[list[float], list[tuple[float, float, float]]]:
        """P(toxic) of each token, and of each neighbouring pair P(stay), P(enter), P(leave).

        Sums are scaled at each token, so a chain may be of any length.
        """
        stay, enter, leave = math.exp(self.stay), math.exp(self.enter), math.exp(self.leave)
        on = [math.exp(max(-30.0, min(30.0, e))) for e in emissions]
        n = len(on)
        fwd, z = [], 1.0 + on[0]
        a, b = 1.0 / z, on[0] / z
        fwd.append((a, b))
        for x in on[1:]:
            a, b = a + b * leave, (a * enter + b * stay) * x
            z = a + b
            a, b = a / z, b / z
            fwd.append((a, b))
        p, pairs = [0.0] * n, [None] * (n - 1)
        c, d = 1.0, 1.0
        p[n - 1] = fwd[n - 1][1]
        for i in range(n - 2, -1, -1):
            a, b = fwd[i]
            x = on[i + 1]
            oo, ot, to, tt = a * c, a * enter * x * d, b * leave * c, b * stay * x * d
            z = oo + ot + to + tt
            pairs[i] = (tt / z, ot / z, to / z)
            p[i] = (to + tt) / z
            c, d = c + enter * x * d, leave * c + stay * x * d
            z = c + d
            c, d = c / z, d / z
        return p, pairs

    def fit(self, chains: list[tuple[list[str], list[int]]], epochs: int = EPOCHS, rate: float = RATE,
            penalty: float = PENALTY, seed: int = 11) -> "Field":
        """Adaptive gradient steps on the log likelihood, weights shrunk towards 0."""
        rng = random.Random(seed)
        seen: Counter = Counter()
        special = {"bias": 1e-6, "stay": 1e-6, "enter": 1e-6, "leave": 1e-6}
        for _ in range(epochs):
            rng.shuffle(chains)
            for words, labels in chains:
                p, pairs = self.marginals([self.emission(w) for w in words])
                step: Counter = Counter()
                total = 0.0
                for w, y, q in zip(words, labels, p):
                    g = y - q
                    total += g
                    if abs(g) > 1e-3:
                        for f in features(w):
                            step[f] += g
                for f, g in step.items():
                    seen[f] += g * g
                    r = rate / math.sqrt(1.0 + seen[f])
                    w = self.weights.get(f, 0.0) + r * g
                    w = math.copysign(max(0.0, abs(w) - r * penalty), w)
                    if w:
                        self.weights[f] = w
                    else:
                        self.weights.pop(f, None)
                own = {"bias": total, "stay": 0.0, "enter": 0.0, "leave": 0.0}
                for (y, z), (tt, ot, to) in zip(zip(labels, labels[1:]), pairs):
                    own["stay"] += (y and z) - tt
                    own["enter"] += (z and not y) - ot
                    own["leave"] += (y and not z) - to
                for k, g in own.items():
                    special[k] += g * g
                    setattr(self, k, getattr(self, k) + rate / math.sqrt(1.0 + special[k]) * g)
        return self


# -- training -------------------------------------------------------------

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
                np.uint64)[:, None]      # fixed odd multipliers


def without_near_copies(texts: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Texts of which none of four minima over word triples was seen before."""
    seen, out = set(), []
    for text, label in texts:
        words = text.lower().split()
        grams = [xxhash.xxh3_64_intdigest(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))]
        least = (np.array(grams, np.uint64) * _ODD).min(axis=1)
        keys = set(enumerate(least.tolist()))
        if not keys & seen:
            out.append((text, label))
        seen |= keys
    return out


def numbered(texts: list[tuple[str, int]]) -> tuple[list[str], list[tuple[list[array], int]]]:
    """The different words, and each text's sentences as places in them: four bytes a word, however many there are."""
    place: dict[str, int] = {}
    docs = [([array("I", [place.setdefault(w, len(place)) for w, _, _ in chain]) for chain in sentences(t)], y)
            for t, y in texts]
    return list(place), docs


def markers(words: list[str], docs: list[tuple[list[array], int]], evidence: float = EVIDENCE) -> set[str]:
    """Features that stand in toxic documents far beyond chance."""
    def own(chains: list[array]) -> set[str]:
        return {f for i in set().union(*chains) for f in features(words[i])}

    inside, outside = Counter(), Counter()
    for chains, label in docs:
        if label:
            inside.update(own(chains))
    for chains, label in docs:
        if not label:
            outside.update(own(chains) & inside.keys())
    n_in = sum(label for _, label in docs)
    share = n_in / max(1, len(docs))
    out = set()
    for f, k in inside.items():
        n = k + outside[f]
        q = k / n
        if q > share:
            kl = q * math.log(q / share) + ((1 - q) * math.log((1 - q) / (1 - share)) if q < 1 else 0.0)
            if n * kl >= evidence and q >= 0.5 + share / 2:
                out.add(f)
    return out


def train(texts: list[tuple[str, int]], n_toxic: int, n_clean: int, seed: int = 5) -> dict:
    """The model as a plain dictionary, from (text, label) and the true class counts."""
    prior = n_toxic / max(1, n_toxic + n_clean)
    if not n_toxic or not n_clean or len({y for _, y in texts}) < 2:
        return {"constant": prior}
    words, docs = numbered(without_near_copies(texts))
    marks = markers(words, docs)
    marked = [int(any(f in marks for f in features(w))) for w in words]
    toxic, plain = [], []                                     # the arrays themselves; words only of those drawn
    for chains, label in docs:
        for chain in chains:
            if not label:
                plain.append(chain)
            elif any(marked[i] for i in chain):
                toxic.append(chain)
    rng = random.Random(seed)
    chains = [([words[i] for i in c], [marked[i] for i in c]) for c in rng.sample(toxic, min(len(toxic), SENTENCES))]
    chains += [([words[i] for i in c], [0] * len(c)) for c in rng.sample(plain, min(len(plain), SENTENCES))]
    field = Field().fit(chains) if toxic else Field()
    if len(field.weights) > FEATURES:
        field.weights = dict(sorted(field.weights.items(), key=lambda x: -abs(x[1]))[:FEATURES])
    known = {w: field.emission(w) for w in words}
    rows = [(document_features(field, [[(words[i], 0, 0) for i in c] for c in chains], known)[0], y) for chains, y in docs]
    have = Counter(y for _, y in rows)
    weight = {1: prior / have[1], 0: (1 - prior) / have[0]}
    return {"bias": field.bias, "stay": field.stay, "enter": field.enter, "leave": field.leave,
            "weights": field.weights, "logistic": logistic(rows, weight)}


def logistic(rows: list[tuple[tuple[float, ...], int]], weight: dict[int, float], ridge: float = 1e-4,
             steps: int = 30) -> list[float]:
    """Weights (the constant first) by Newton steps."""
    x = np.array([(1.0, *f) for f, _ in rows])
    y = np.array([float(t) for _, t in rows])
    s = np.array([weight[t] for _, t in rows])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (s * (y - p)) - ridge * w
        h = (x * (s * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, g), -4, 4)
    return w.tolist()


# -- scoring --------------------------------------------------------------

def document_features(field: Field, chains: list[list[tuple[str, int, int]]], emissions: dict[str, float]
                      ) -> tuple[tuple[float, float], list[tuple[int, int, float]]]:
    """((log odds of the largest marginal, log of 1 + expected toxic tokens), spans)."""
    top, expected, spans = FLOOR, 0.0, []
    for chain in chains:
        e = [emissions[w] if w in emissions else field.emission(w) for w, _, _ in chain]
        if max(e) <= field.bias:
            continue
        p, _ = field.marginals(e)
        top = max(top, max(p))
        expected += sum(q for q in p if q >= FLOOR)
        run = None
        for (_, start, stop), q in zip(chain, p):
            if q < SPAN:
                run = None
            elif run is None:
                spans.append(run := [start, stop, q])
            else:
                run[1], run[2] = stop, max(run[2], q)
    top = min(top, 1 - FLOOR)
    return (math.log(top / (1 - top)), math.log1p(expected)), [tuple(s) for s in spans]


class Scorer:
    """One a Python worker and model; knows the words that it has met."""

    def __init__(self, model: dict):
        self.model = model
        self.constant = model.get("constant")
        if self.constant is None:
            self.field = Field(model["bias"], model["weights"], model["stay"], model["enter"], model["leave"])
            self.plain = self._score((math.log(FLOOR / (1 - FLOOR)), 0.0))
        self.known: dict[str, float] = {}

    def _score(self, x: tuple[float, ...]) -> float:
        w = self.model["logistic"]
        z = w[0] + sum(a * b for a, b in zip(w[1:], x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        if self.constant is not None:
            return self.constant, []
        words = {w.lower() for w in set(WORD.findall(text))}      # found first, lowered after, as in ``sentences``
        known, bias = self.known, self.field.bias
        if len(known) > MEMO:
            known.clear()
        top = bias
        for w in words:
            e = known.get(w)
            if e is None:
                e = known[w] = self.field.emission(w)
            if e > top:
                top = e
        if top <= bias:
            return self.plain, []
        x, spans = document_features(self.field, sentences(text), known)
        return self._score(x), spans


_SCORERS: dict[str, Scorer] = {}


def scorer(model: str) -> Scorer:
    if model not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model] = Scorer(json.loads(model))
    return _SCORERS[model]


# -- Spark ----------------------------------------------------------------

def held_out(doc_id: str | Column) -> Column:
    """The rows that nothing is learned from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic: int = TOXIC, clean: int = CLEAN,
                train_bytes: int = TRAIN_BYTES) -> str:
    """The model as JSON, learned from the labels that aren't held out."""
    known = (labels.select(labels["doc_id"].cast("long").alias("id"), labels[label].cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out("id"))
             .groupBy("id").agg(F.max("y").alias("y")))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in ((1, toxic), (0, clean))]
    ids = F.broadcast(some[0].unionByName(some[1]))          # toxic + clean rows at most
    rows = (docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
            .where(F.octet_length("text") <= train_bytes).join(ids, "id")
            .groupBy("id", "y").agg(F.min("text").alias("text")))
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((i, t, y) for b in batches for i, y, t in zip(*(c.to_pylist() for c in b.columns)))
        model = json.dumps(train([(t, y) for _, t, y in got], n_toxic, n_clean))
        yield pa.record_batch([pa.array([model])], ["model"])

    made = rows.select("id", "y", "text").coalesce(1).mapInArrow(fit, "model string").first()
    return made[0] if made else json.dumps(train([], n_toxic, n_clean))      # no labelled document at all


SCHEMA = "doc_id long, score double, spans array<struct<start:int,stop:int,marginal:double>>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                                  ("marginal", pa.float64())])))])


def score_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, score, spans) of each row; spans are character offsets of the text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer(shipped.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = [s.score(t or "") for t in part.column(1).to_pylist()]
                spans = [[dict(zip(("start", "stop", "marginal"), x)) for x in sp] for _, sp in got]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g for g, _ in got], pa.float64()),
                                                  pa.array(spans, _ARROW.field("spans").type)], schema=_ARROW)

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
            .mapInArrow(rows, SCHEMA))


def clean_documents(docs: DataFrame, model: str, toxic_at: float) -> DataFrame:
    """The rows that score below ``toxic_at``, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return rows_kept(docs, lambda texts: [scorer(shipped.value).score(t)[0] < toxic_at for t in texts])
