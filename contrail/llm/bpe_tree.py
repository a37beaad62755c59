"""Operator 9: byte-level BPE by monoid tree reduction.

A text is cut into halves until a leaf is short; leaves are encoded, and two
neighbouring encodings are joined by re-encoding a window around the seam.
The window starts with a few tokens on either side and doubles until both of
its edges are *settled*:

* a left (right) edge is settled at a cut no pre-token can span and after which
  every segmentation restarts: a character that is no white space followed by
  a blank, or a letter followed by a mark that no contraction starts with.
  What lies outside such cuts on both sides doesn't depend on the other half;
* inside one run of letters (one pre-token), an edge is settled when the
  re-encoded window keeps the outermost old token on that side: a sequence of
  tokens is the BPE of its bytes exactly if every two neighbours are, and all
  neighbouring pairs outside the window were neighbours before.

When the window has reached the ends of both halves, its encoding is the
result.  Encodings with this join form a monoid (the empty text is neutral),
so the shape of the tree doesn't matter.  Decoding concatenates the bytes of
the two halves of an id sequence up a tree.

Defined results: a null or empty text has no tokens (and decodes to no bytes);
a null document id is kept; repeated rows give repeated results; a text is
encoded whole, however long; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

LEAF_CHARS = 1024         # a leaf is encoded at once
FIRST_WINDOW = 4          # tokens on either side of a seam at first
MARKS = frozenset(",.;:!?()[]{}|*#$%&-+=/\"。，、！？；：")

SCHEMA = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


class TreeCodec:
    """Encode and decode by tree reduction over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS):
        self._leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        self._bytes = {rank: tok for tok, rank in ranks.items()}
        self.leaf_chars = max(2, leaf_chars)

    # -- encoding ---------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        try:
            text.encode("utf-8")
        except UnicodeEncodeError:      # lone surrogates, as the library replaces them
            text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        return self._tree(text, 0, len(text))

    def _tree(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf_chars:
            return self._leaf(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(self._tree(text, lo, mid), self._tree(text, mid, hi))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two texts' concatenation from their encodings."""
        if not left or not right:
            return left or right
        k = FIRST_WINDOW
        while True:
            nl, nr = min(k, len(left)), min(k, len(right))
            whole_l, whole_r = nl == len(left), nr == len(right)
            head = self._text(left[len(left) - nl:])
            tail = self._text(right[:nr])
            if head is not None and tail is not None:
                done = self._settle(left, right, nl, nr, head, tail, whole_l, whole_r)
                if done is not None:
                    return done
            if whole_l and whole_r:
                return self._leaf(head + tail)
            k *= 2

    def _text(self, tokens: list[int]) -> str | None:
        """The tokens' text, None if an edge cuts a character."""
        try:
            return b"".join([self._bytes[t] for t in tokens]).decode("utf-8")
        except UnicodeDecodeError:
            return None

    def _settle(self, left, right, nl, nr, head, tail, whole_l, whole_r):
        a = 0 if whole_l else _last_cut(head)
        b = len(tail) if whole_r else _first_cut(tail, head[-1])
        if a is not None and b is not None:
            keep_l = left[:len(left) - nl] + (self._count(left[len(left) - nl:], head, a) if a else [])
            rest = self._drop(right[:nr], tail, b) + right[nr:]
            return keep_l + self._leaf(head[a:] + tail[:b]) + rest
        if head.isalpha() and tail.isalpha() and not whole_l and not whole_r:
            new = self._leaf(head + tail)
            if new[0] == left[-nl] and new[-1] == right[nr - 1] and len(new) > 1:
                return left[:len(left) - nl] + new + right[nr:]
        return None

    def _count(self, tokens: list[int], text: str, chars: int) -> list[int]:
        """The leading tokens that make up text[:chars]; a cut is a token edge."""
        size, i = len(text[:chars].encode("utf-8")), 0
        while size > 0:
            size -= len(self._bytes[tokens[i]])
            i += 1
        return tokens[:i]

    def _drop(self, tokens: list[int], text: str, chars: int) -> list[int]:
        return tokens[len(self._count(tokens, text, chars)):]

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4 * self.leaf_chars:
            return b"".join([self._bytes[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def _restarts(before: str, after: str) -> bool:
    """No pre-token spans the place between the two characters, and none looks
    behind it."""
    if after == " ":
        return before.isalnum() or before in MARKS
    return after in MARKS and before.isalpha()


def _last_cut(s: str) -> int | None:
    for i in range(len(s) - 1, 0, -1):
        if _restarts(s[i - 1], s[i]):
            return i
    return None


def _first_cut(s: str, before: str) -> int | None:
    for i in range(len(s)):
        if _restarts(s[i - 1] if i else before, s[i]):
            return i
    return None


_CODECS: dict[tuple, TreeCodec] = {}   # one a Python worker and vocabulary


def codec(key: str, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS) -> TreeCodec:
    if (key, pattern, leaf_chars) not in _CODECS:
        _CODECS[key, pattern, leaf_chars] = TreeCodec(ranks, pattern, leaf_chars)
    return _CODECS[key, pattern, leaf_chars]


def bpe_tokens(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every text.

    ``vocabulary`` is the path of a rank file; the driver reads it once and
    ships it (a vocabulary is a fixed file of about a megabyte).
    """
    run = _runner(docs, vocabulary, pattern, leaf_chars)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tokens, decoded in run(batches):
            yield pa.record_batch([ids, pa.array(tokens, pa.list_(pa.int32())), pa.array(decoded, pa.binary())],
                                  ["doc_id", "ids", "decoded"])

    return _narrow(docs, id_col, text_col).mapInArrow(rows, "doc_id long, ids array<int>, decoded binary")


def bpe_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes of every text.

    The same encoding as :func:`bpe_tokens`; the ids stay in the worker, so
    nothing large leaves it.
    """
    run = _runner(docs, vocabulary, pattern, leaf_chars)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tokens, decoded in run(batches):
            packed = [np.asarray(t, dtype="<u4").tobytes() for t in tokens]
            yield pa.record_batch([
                ids, pa.array([len(t) for t in tokens], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _narrow(docs, id_col, text_col).mapInArrow(rows, SCHEMA)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))


def _runner(docs: DataFrame, vocabulary: str, pattern: str, leaf_chars: int):
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches, at_once: int = 256):
        c = codec(vocabulary, shipped.value, pattern, leaf_chars)
        for batch in batches:
            for i in range(0, batch.num_rows, at_once):
                part = batch.slice(i, at_once)
                tokens = [c.encode(t or "") for t in part.column(1).to_pylist()]
                yield part.column(0), tokens, [c.decode(t) for t in tokens]

    return run
