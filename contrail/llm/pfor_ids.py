"""Operator 7: token ids in files of patched frame-of-reference blocks.

File (little endian): segments, then a footer.  A segment holds some whole
documents: their ids and lengths, the byte offset at which each block starts,
and the blocks.  A block holds ``BLOCK`` token ids: their minimum, a width, the
differences to the minimum packed at that width, and the exceptions.  The width
is the smallest that fits ``percentile`` of the block's differences; a wider
difference is stored whole, with its place, in the exception list.  The footer
has the offset of each segment.

One task writes one file, segment by segment, so that memory is bounded by a
segment (or by one document, if that is longer).  Files have names of their
own for each attempt, and the manifest, written by Spark's committer, lists
those of the attempts that count: a lost executor or a task that ran twice
leaves files that nobody reads.

Defined results: a null or empty text is one end id; a null document id comes
first and is null when read back; repeated ids are kept, in the order of their
texts' hashes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import open_store, settled, work_folder

BLOCK = 128
PERCENTILE = 0.9
SEGMENT_TOKENS = 1 << 20
END_ID = 0
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<QQQ")       # documents, tokens, blocks
_BLOCK = struct.Struct("<IBBH")     # minimum, width, exceptions, nothing


# -- blocks ---------------------------------------------------------------

def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)     # exact below 2**53


_SMALL_BITS = _bit_lengths(np.arange(1 << 16))


def _put(out: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> None:
    """Write row i's bytes at starts[i]."""
    if rows.size:
        out[starts[:, None] + np.arange(rows.shape[1])] = rows


def pack(tokens: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """(block starts, bytes) of an array of unsigned 32-bit ids."""
    n = len(tokens)
    m = -(-n // BLOCK)
    ids = np.zeros(m * BLOCK, np.uint32)
    ids[:n] = tokens
    ids[n:] = tokens[-1] if n else 0
    ids = ids.reshape(m, BLOCK)
    low = ids.min(axis=1) if m else np.zeros(0, np.uint32)
    diff = ids - low[:, None]
    bits = _SMALL_BITS[diff] if not m or int(diff.max()) < 1 << 16 else _bit_lengths(diff)
    keep = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = np.partition(bits, keep, axis=1)[:, keep] if m else np.zeros(0, np.uint8)
    over = bits > width[:, None]
    n_over = over.sum(axis=1)
    size = _BLOCK.size + width.astype(np.int64) * (BLOCK // 8) + 5 * n_over
    starts = np.zeros(m + 1, np.int64)
    np.cumsum(size, out=starts[1:])
    out = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros(m, np.dtype([("low", "<u4"), ("w", "u1"), ("n", "u1"), ("_", "<u2")]))
    head["low"], head["w"], head["n"] = low, width, n_over
    _put(out, starts[:-1], head.view(np.uint8).reshape(m, _BLOCK.size))
    for w in np.unique(width[width > 0]):
        sel = np.flatnonzero(width == w)
        vals = (diff[sel] & np.uint32((1 << int(w)) - 1)).T.astype(np.uint64)
        words = np.zeros((2 * int(w), len(sel)), np.uint64)
        for j in range(BLOCK):
            q, r = divmod(j * int(w), 64)
            words[q] |= vals[j] << np.uint64(r)
            if r + w > 64:
                words[q + 1] |= vals[j] >> np.uint64(64 - r)
        packed = np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(sel), -1)
        _put(out, starts[sel] + _BLOCK.size, packed)
    b, place = np.nonzero(over)
    if len(b):
        first = np.zeros(m + 1, np.int64)
        np.cumsum(n_over, out=first[1:])
        nth = np.arange(len(b)) - first[b]
        at = starts[b] + _BLOCK.size + width[b].astype(np.int64) * (BLOCK // 8)
        out[at + nth] = place
        _put(out, at + n_over[b] + 4 * nth, diff[b, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return starts, out.tobytes()


def unpack(data: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``, n of them in all."""
    m = len(starts) - 1
    raw = np.frombuffer(data, np.uint8)
    head = raw[starts[:-1][:, None] + np.arange(_BLOCK.size)]
    low = head[:, :4].copy().view("<u4").reshape(-1)
    width, n_over = head[:, 4], head[:, 5].astype(np.int64)
    diff = np.zeros((m, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        w = int(w)
        sel = np.flatnonzero(width == w)
        words = raw[(starts[sel] + _BLOCK.size)[:, None] + np.arange(16 * w)].copy().view("<u8").astype(np.uint64)
        words = np.ascontiguousarray(words.T)
        mask = np.uint64((1 << w) - 1)
        got = np.empty((BLOCK, len(sel)), np.uint32)
        for j in range(BLOCK):
            q, r = divmod(j * w, 64)
            v = words[q] >> np.uint64(r)
            if r + w > 64:
                v = v | (words[q + 1] << np.uint64(64 - r))
            got[j] = (v & mask).astype(np.uint32)
        diff[sel] = got.T
    b = np.repeat(np.arange(m), n_over)
    if len(b):
        first = np.zeros(m + 1, np.int64)
        np.cumsum(n_over, out=first[1:])
        nth = np.arange(len(b)) - first[b]
        at = starts[b] + _BLOCK.size + width[b].astype(np.int64) * (BLOCK // 8)
        vals = raw[(at + n_over[b] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
        diff[b, raw[at + nth]] = vals
    return (diff + low[:, None]).reshape(-1)[:n]


# -- segments and files ---------------------------------------------------

def segment(doc_ids: list[int | None], docs: list[np.ndarray], percentile: float = PERCENTILE) -> bytes:
    tokens = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    starts, blocks = pack(tokens, percentile)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    lengths = np.array([len(d) for d in docs], "<u8")
    return b"".join([_HEAD.pack(len(docs), len(tokens), len(starts) - 1), ids.tobytes(), null.tobytes(),
                     lengths.tobytes(), starts.astype("<i8").tobytes(), blocks])


def read_segment(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    n_docs, n_tokens, n_blocks = _HEAD.unpack_from(data)
    at = _HEAD.size
    ids = np.frombuffer(data, "<i8", n_docs, at)
    null = np.frombuffer(data, np.uint8, n_docs, at := at + 8 * n_docs)
    lengths = np.frombuffer(data, "<u8", n_docs, at := at + n_docs).astype(np.int64)
    starts = np.frombuffer(data, "<i8", n_blocks + 1, at := at + 8 * n_docs)
    tokens = unpack(data[at + 8 * (n_blocks + 1):], starts.astype(np.int64), n_tokens)
    return [None if z else int(d) for d, z in zip(ids, null)], np.split(tokens, np.cumsum(lengths)[:-1]) if n_docs else []


def read_block(data: bytes, block: int) -> np.ndarray:
    """One block of a segment, found by the index of block starts."""
    n_docs, n_tokens, n_blocks = _HEAD.unpack_from(data)
    if not 0 <= block < n_blocks:
        raise IndexError(block)
    at = _HEAD.size + 17 * n_docs
    starts = np.frombuffer(data, "<i8", 2, at + 8 * block).astype(np.int64)
    base = at + 8 * (n_blocks + 1)
    n = min(BLOCK, n_tokens - block * BLOCK)
    return unpack(data[base + starts[0]:base + starts[1]], starts - starts[0], n)


def write_file(out, segments: Iterator[bytes]) -> int:
    """Magic, segments, footer; the number of bytes."""
    out.write(MAGIC)
    at, where = len(MAGIC), []
    for s in segments:
        where.append(at)
        out.write(s)
        at += len(s)
    out.write(np.array([*where, at], "<i8").tobytes())
    out.write(struct.pack("<Q", len(where)))
    out.write(MAGIC)
    return at + 8 * (len(where) + 2) + len(MAGIC)


def read_file(src, size: int) -> Iterator[bytes]:
    """The segments of a file opened for reading."""
    src.seek(size - len(MAGIC) - 8)
    n = struct.unpack("<Q", src.read(8))[0]
    if src.read(len(MAGIC)) != MAGIC:
        raise ValueError("no such file of token ids")
    src.seek(size - len(MAGIC) - 8 - 8 * (n + 1))
    where = np.frombuffer(src.read(8 * (n + 1)), "<i8")
    for a, b in zip(where[:-1], where[1:]):
        src.seek(int(a))
        yield src.read(int(b - a))


# -- tokens ---------------------------------------------------------------

_TOKENIZERS: dict[str, "WordMemo"] = {}   # one a Python worker and vocabulary


def tokenizer(key: str, definition: str) -> "WordMemo":
    if key not in _TOKENIZERS:
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(definition)
        t.model._resize_cache(0)               # the library's own memory of words costs more than it finds
        _TOKENIZERS[key] = WordMemo(t)
    return _TOKENIZERS[key]


MEMO = 480_000                                 # words of each of two generations whose ids a worker keeps
_AMBIGUOUS = re.compile(r"\s (?:\s|\Z)")


class WordMemo:
    """Ids of texts from the library's ids of their blank-led words.

    No pre-token reaches across a blank that follows a character other than
    white space, nor across one that precedes such a character, so the parts
    between those blanks have ids of their own and each different part goes to
    the library once while it is remembered.  A text with another kind of blank
    (between white space on both sides), or with the string of a special token
    (which is that token), goes to the library whole.  Words that
    were not met since the last generation of ``size`` words are forgotten.
    """

    def __init__(self, tok, size: int = MEMO):
        self.tok, self.size = tok, size
        self.first: dict[str, bytes] = {}          # parts without a blank before them
        self.rest: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}          # the generation before ``rest``
        self.special = [t.content for t in tok.get_added_tokens_decoder().values()]
        n = tok.get_vocab_size(with_added_tokens=True)
        self.token_bytes = np.array([len(tok.id_to_token(i) or "") for i in range(n)], np.int64)

    def encode(self, texts: list[str], batch_bytes: int = 4 << 20) -> list[np.ndarray]:
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= batch_bytes:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held) if held else out

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """Words are told apart by Arrow; only different ones are looked at in Python."""
        whole = [i for i, t in enumerate(texts) if _AMBIGUOUS.search(t) or any(s in t for s in self.special)]
        parts = pc.split_pattern(pa.array(["" if i in set(whole) else t for i, t in enumerate(texts)] if whole else texts,
                                          pa.large_string()), " ")
        ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy().copy(), _listed(coded.dictionary)
        leads = coded.dictionary.take(pa.array(codes[ends[:-1]])).to_pylist()

        if len(self.first) > self.size:
            self.first.clear()
        if len(self.rest) > self.size:
            self.older, self.rest = self.rest, {}
        first, rest, older = self.first, self.rest, self.older
        self._learn(first, [w for w in set(leads) if w not in first], "")
        ids = [*map(rest.get, words)]
        new = [w for w, known in zip(words, ids) if known is None]
        if new:
            rest.update([(w, older[w]) for w in new if w in older])
            self._learn(rest, [w for w in new if w not in older], " ")
            ids = [rest[w] if known is None else known for w, known in zip(words, ids)]

        codes[ends[:-1]] = len(words) + np.arange(len(leads))
        ids += map(first.__getitem__, leads)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), np.uint32)
        starts = np.cumsum(sizes) - sizes
        each = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        at = np.repeat(starts[codes] - upto[:-1], each) + np.arange(upto[-1])
        out = np.split(pool[at], upto[ends[1:-1]])
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        return out

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, memo: dict[str, bytes], new: list[str], lead: str, at_once: int = 512) -> None:
        plain = [w for w in new if w and w == w.strip()] if lead else []
        alone = [w for w in new if not w or w != w.strip()] if lead else new
        memo.update(zip(alone, (ids.tobytes() for ids in self._library([lead + w for w in alone]))))
        groups = [plain[i:i + at_once] for i in range(0, len(plain), at_once)]
        joined = [lead + lead.join(g) for g in groups]
        for words, text, ids in zip(groups, joined, self._library(joined)):
            data = text.encode()
            ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32)[1:], len(data))   # words hold no blank
            stops = (4 * (np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1)).tolist()
            data = ids.tobytes()
            memo.update([(w, data[a:b]) for w, a, b in zip(words, [0, *stops], stops)])


def _listed(words: pa.Array) -> list[str]:
    """Words without blanks, at least one, as Python has them: read as one text, not one by one."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(whole, pa.scalar(" ", words.type))[0].as_py().split(" ")


# -- Spark ----------------------------------------------------------------

def write_ids(docs: DataFrame, vocabulary: str, folder: str, percentile: float = PERCENTILE,
              segment_tokens: int = SEGMENT_TOKENS, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the texts and write their ids in ascending document id order.

    Returns the manifest: (part, path, bytes, documents, tokens), a row a file.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:      # a fixed file of a few megabytes
        shipped = spark.sparkContext.broadcast(f.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary, shipped.value)
        part = TaskContext.get().partitionId()
        n = {"documents": 0, "tokens": 0}

        def segments():
            ids, held, size = [], [], 0
            for batch in batches:
                for i in range(0, batch.num_rows, 2048):
                    some = batch.slice(i, 2048)
                    texts = some.column(1).to_pylist()
                    for d, t in zip(some.column(0).to_pylist(), tok.encode([t or "" for t in texts])):
                        if held and size + len(t) >= segment_tokens:
                            yield segment(ids, held, percentile)
                            ids, held, size = [], [], 0
                        ids.append(d)
                        held.append(np.append(t, np.uint32(end_id)))
                        size += len(t) + 1
                        n["documents"] += 1
                        n["tokens"] += len(t) + 1
            if held:
                yield segment(ids, held, percentile)

        todo = segments()
        first = next(todo, None)
        if first is None:
            return
        fs, path = open_store(folder)
        fs.create_dir(path, recursive=True)
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.pfor"
        with fs.open_output_stream(f"{path}/{name}") as out:
            size = write_file(out, (s for some in ([first], todo) for s in some))
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([size], pa.int64()),
                               pa.array([n["documents"]], pa.int64()), pa.array([n["tokens"]], pa.int64())],
                              ["part", "name", "bytes", "documents", "tokens"])

    ordered = (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    made = ordered.mapInArrow(rows, "part int, name string, bytes long, documents long, tokens long")
    return settled(made, folder, "manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the listed files."""
    return _reading(manifest, folder, "doc_id long, start long, ids array<long>",
                    lambda ids, start, docs: [pa.array(ids, pa.int64()), pa.array(start, pa.int64()),
                                              pa.array([d.astype(np.int64) for d in docs], pa.list_(pa.int64()))])


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the listed files."""
    return _reading(manifest, folder, "doc_id long, start long, n_tokens long, ids_crc32 long",
                    lambda ids, start, docs: [pa.array(ids, pa.int64()), pa.array(start, pa.int64()),
                                              pa.array([len(d) for d in docs], pa.int64()),
                                              pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs],
                                                       pa.int64())])


def _reading(manifest: DataFrame, folder: str, schema: str, columns) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_store(folder)
        for batch in batches:
            for f in batch.to_pylist():
                at = f["base"]
                with fs.open_input_file(f"{path}/{f['name']}") as src:
                    for s in read_file(src, f["bytes"]):
                        ids, docs = read_segment(s)
                        sizes = np.array([len(d) for d in docs], np.int64)
                        start = at + np.cumsum(sizes) - sizes
                        at += int(sizes.sum())
                        yield pa.record_batch(columns(ids, start, docs), names)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row a file
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = max(1, manifest.count())
    return based.select("name", "bytes", "base").repartition(files).mapInArrow(rows, schema)


def write_and_read(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Digests of all documents, read back from the files just written."""
    folder = work_folder(docs.sparkSession, "token-ids")
    return read_digests(write_ids(docs, vocabulary, folder, **options), folder)
