"""Operator 13: BPE with word ends, encoded by a depth-first walk over a trie of words.

The library's own normaliser and pre-tokeniser turn a text into words; the
merges are this operator's.  Of all ways to write a prefix as tokens, byte-pair
merging makes one, and each beginning of it is again the encoding of a shorter
prefix.  So the encoding of a prefix is told by its last token alone: the only
token t at its end that stands beside the last token of what comes before t
without a merge across their border.  That border test follows the two rows of
ever larger parts that meet there, in the order in which merging makes them
(:meth:`Merges.stand`).

Distinct words are inserted into a trie in sorted order.  Then only the path of
the latest word is open: what later words can't share has been walked already,
so the trie is built and traversed depth-first at once, and the state of each
shared prefix, its last token, is computed once.  A word's last character is
another symbol (it carries the word end) and hangs off its prefix's node.

White space parts words, so blanks part a text into pieces that can be encoded
apart; a worker remembers the ids of pieces, within a bound in bytes.

Defined results: a null or empty text has no tokens; strings of special tokens
in a text are those tokens, as the library has it; null, repeated ids and equal
texts are rows of their own; an empty table gives no rows; other columns are
ignored.  Tokenizers that this way can't follow are refused when loaded.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMO_BYTES = 160 << 20         # of remembered pieces in a worker, both generations together
PAIRS = 200_000                # remembered border tests
STEPS = 200_000                # remembered steps from one prefix's end to the next
SLICE_CHARS = 4 << 20          # texts encoded at once
_NEVER = 1 << 60

Ends = tuple[tuple[int, int], ...]     # tokens at a prefix's end and their letters, the longest first


class Merges:
    """Vocabulary and merges, ranks in the order of the list."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("a plain BPE model is needed")
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}                       # token -> rank of the merge that makes it
        self.parts: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            if made in self.parts or max(self.born.get(left, -1), self.born.get(right, -1)) >= r:
                raise ValueError("a token made twice, or before its parts")
            self.rank[left, right], self.born[made], self.parts[made] = r, r, (left, right)
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._sound: dict[int, bool] = {}
        self._stand: list[dict[int, bool]] = [{} for _ in range(1 + max(self.ids.values(), default=0))]
        self._pairs = 0                                      # of them in all
        self.lengths = {i: len(t) - (len(self.end) if self._ends(t) else 0) for t, i in self.ids.items()}
        whole = [t for t, i in self.ids.items() if self.sound(i)]
        self._inner = {t: self.ids[t] for t in whole if not self._ends(t)}
        self._final = {t[:len(t) - len(self.end)]: self.ids[t] for t in whole if self._ends(t)} if self.end else self._inner
        self._starts = {t[:k] for t in (*self._inner, *self._final) for k in range(len(t) + 1)}
        self._steps: dict[str, tuple[str, Ends]] = {}
        self._stops: dict[str, Ends] = {}
        self.nodes = 0                                       # of all tries walked so far

    def _ends(self, text: str) -> bool:
        return bool(self.end) and text.endswith(self.end)

    def _step(self, met: str) -> tuple[str, Ends]:
        """After a prefix whose longest end that starts some token was met[:-1], and the letter met[-1]:
        the new longest end that starts one, and the tokens that stand at the end."""
        kept = met
        while kept not in self._starts:
            kept = kept[1:]
        found = kept, _at_end(kept, self._inner)
        if len(self._steps) >= STEPS:
            self._steps.clear()
        self._steps[met] = found
        return found

    def _stop(self, met: str) -> Ends:
        """The tokens at the end where met[-1] is a word's last letter."""
        if len(self._stops) >= STEPS:
            self._stops.clear()
        found = self._stops[met] = _at_end(met, self._final)
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at a token's edge, smallest first, each with the rank that uses it up."""
        memo = self._right if side else self._left
        found = memo.get(token)
        if found is None:
            row, at, until = [], token, _NEVER
            while True:
                row.append((at, until))
                if at not in self.parts:
                    break
                until, at = self.born[at], self.parts[at][side]
            found = memo[token] = row[::-1]
        return found

    def _apart(self, left: int, right: int, before: int = _NEVER) -> bool:
        """No merge of a rank under ``before`` joins a part of ``left`` to one of ``right``.

        Two parts meet while neither is used up.  At equal ranks the merge further
        left comes first, so that the border's merge must come before the one that
        takes the left part and not after the one that takes the right part.
        """
        a, b, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            r = self.rank.get((x, y))
            if r is not None and r < x_until and r <= y_until and r < before:
                return False
            if x_until == y_until == _NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def sound(self, token: int) -> bool:
        """Merging the token's own characters gives the token."""
        found = self._sound.get(token)
        if found is None:
            found = True
            if token in self.parts:
                left, right = self.parts[token]
                found = self.sound(left) and self.sound(right) and self._apart(left, right, self.born[token])
            self._sound[token] = found
        return found

    def stand(self, left: int, right: int) -> bool:
        """Merging the characters of both tokens gives just these two."""
        found = self._stand[left].get(right)
        if found is None:
            if self._pairs >= PAIRS:
                for row in self._stand:
                    row.clear()
                self._pairs = 0
            found = self._stand[left][right] = self._apart(left, right)
            self._pairs += 1
        return found

    def _last(self, stop: int, states: list[int], tokens: Ends) -> int:
        """The last token of a prefix of ``stop`` letters: of those at its end, the one that stands
        beside the last token of what comes before it."""
        known = self._stand
        for token, size in tokens:
            if size == stop:
                return token
            left = states[stop - size]
            found = known[left].get(token)
            if found or found is None and self.stand(left, token):
                return token
        raise ValueError("letters without a token")

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, array]]:
        """(word, ids) of distinct words, in the order of the trie's traversal."""
        # of the open path's prefix of i letters: its last token, and its longest end that starts a token
        states, ends, path = [0], [""], ""
        step, stop_at, last, lengths = self._steps.get, self._stops.get, self._last, self.lengths
        for word in sorted(set(words)):
            if not word:
                yield word, array("I")
                continue
            inner = len(word) - 1 if self.end else len(word)
            shared = _common(path, word[:inner])
            del states[shared + 1:], ends[shared + 1:]
            end, stop = ends[shared], shared
            for letter in word[shared:inner]:
                stop += 1
                met = end + letter
                end, tokens = step(met) or self._step(met)
                states.append(last(stop, states, tokens))
                ends.append(end)
            path, at = word[:inner], len(word)
            if self.end:
                met = end + word[-1]
                token = last(at, states, stop_at(met) or self._stop(met))
            else:
                token = states[inner]
            self.nodes += at - shared
            out = array("I", (token,))
            while at := at - lengths[token]:
                token = states[at]
                out.append(token)
            out.reverse()
            yield word, out


def _at_end(text: str, tokens: dict[str, int]) -> Ends:
    return tuple((tokens[text[k:]], len(text) - k) for k in range(len(text)) if text[k:] in tokens)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n                                 # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def _plain_words(definition: dict) -> regex.Pattern | None:
    """The pre-tokeniser's own pattern where it says all about printable ASCII and line breaks: lower case,
    matches kept, each letter its own byte letter.  None for other tokenizers."""
    normal = definition.get("normalizer") or {}
    steps = [n["type"] for n in normal.get("normalizers", [])]
    cut = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cut] != ["Split", "ByteLevel"]:
        return None
    blank, (split, byte) = normal["normalizers"][1], cut
    if (blank["pattern"], blank["content"]) != ({"Regex": r"\s+"}, " ") or byte["use_regex"] or byte["add_prefix_space"] or (
            split["behavior"], split["invert"]) != ("Removed", True) or "Regex" not in split["pattern"]:
        return None
    return regex.compile(split["pattern"]["Regex"])


class Codec:
    """Ids of texts and texts of ids, as the library's ``encode`` and ``decode``."""

    def __init__(self, definition: str, memo_bytes: int = MEMO_BYTES):
        from tokenizers import Tokenizer
        parsed = json.loads(definition)
        self.library = Tokenizer.from_str(definition)
        self.merges = Merges(parsed["model"])
        if parsed.get("decoder") is not None:
            raise ValueError("a decoder is not foreseen: tokens are joined by blanks")
        added = parsed.get("added_tokens") or []
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] or
               a["content"] in self.merges.ids for a in added):
            raise ValueError("added tokens must be found as they stand")
        self.special = {a["content"]: a["id"] for a in added}
        self.find = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = {i: t.encode() for t, i in {**self.merges.ids, **self.special}.items()}
        self.plain = _plain_words(parsed)
        self.limit = memo_bytes // 2
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens, in byte letters."""
        if self.plain is not None and text.isascii() and text.isalpha():
            return [text.lower()]
        if self.plain is not None and text.isascii() and (text.isprintable() or text.replace("\n", " ").isprintable()):
            return self.plain.findall(text.lower())
        made = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(made)]

    def _parts(self, piece: str) -> list[str | int]:
        """Words and ids of special tokens, in order."""
        out, at = [], 0
        for m in self.find.finditer(piece):
            out += [*self._words(piece[at:m.start()]), self.special[m[0]]] if m.start() > at else [self.special[m[0]]]
            at = m.end()
        return out + (self._words(piece[at:]) if at < len(piece) else [])

    def _learn(self, pieces: set[str], split: Callable[[str], list[str | int]]) -> dict[str, bytes]:
        """Ids of all the pieces: a trie of the words of those not remembered."""
        known = {p: self.newer[p] for p in pieces.intersection(self.newer)}
        pieces = pieces.difference(known)
        older = self.older                                   # keeping may put another in its place
        for p in pieces.intersection(older):
            known[p] = older[p]
            self._keep(p, older[p])
        parts = {p: split(p) for p in pieces if p not in known}
        words = set().union(*parts.values())
        ids = {i: array("I", (i,)).tobytes() for i in words.intersection(self.special.values())}
        ids.update((w, some.tobytes()) for w, some in self.merges.encode(words.difference(ids)))
        for p, some in parts.items():
            known[p] = found = ids[some[0]] if len(some) == 1 else b"".join(map(ids.__getitem__, some))
            self._keep(p, found)
        return known

    def _keep(self, piece: str, ids: bytes) -> None:
        cost = piece.__sizeof__() + ids.__sizeof__() + 100           # and its place in the table
        if cost <= 2048:
            if self.size + cost > self.limit:
                self.older, self.newer, self.size = self.newer, {}, 0
            self.newer[piece] = ids
            self.size += cost

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= SLICE_CHARS:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [t.split(" ") for t in texts]
        plain = not any(s in t for s in self.special for t in texts)
        ids = self._learn(set().union(*split), self._words if plain else self._parts)
        for some in split:
            yield b"".join(map(ids.__getitem__, some))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the library's ``decode(ids, skip_special_tokens=False)``."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, Codec] = {}             # the latest of a Python worker


def codec(key: str, definition: str) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


def _mapped(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, columns, schema: str) -> DataFrame:
    with open(vocabulary, encoding="utf-8") as f:            # a fixed file of a few megabytes
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = codec(vocabulary, shipped.value)
        gc.disable()                                  # no cycles are made here, and the memos are large to look through
        try:
            for batch in batches:
                for i in range(0, batch.num_rows, 512):
                    some = batch.slice(i, 512)
                    made = columns(tok, tok.encode([t or "" for t in some.column(1).to_pylist()]))
                    yield pa.RecordBatch.from_arrays([some.column(0), *made], names)
        finally:
            gc.enable()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(rows, schema)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every text."""
    return _mapped(docs, vocabulary, id_col, text_col,
                   lambda tok, made: [pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in made],
                                               pa.list_(pa.int64()))], "doc_id long, ids array<long>")


def trie_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded again."""
    def columns(tok: Codec, made: Iterator[bytes]) -> list[pa.Array]:
        n, ids, back = [], [], []
        for b in made:
            n.append(len(b) // 4)
            ids.append(hashlib.sha256(b).hexdigest())
            back.append(hashlib.sha256(tok.decode(b)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]

    return _mapped(docs, vocabulary, id_col, text_col, columns,
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
