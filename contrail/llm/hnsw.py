"""Operator 6: nearest neighbours by a small-world graph per shard.

Equal vectors are one node that carries its ``top + 1`` smallest ids, which is
all that a result can need, so a vector with very many copies neither bends the
graph nor fills a shard.  Nodes are dealt to shards by a hash of the vector; a
shard has at most about ``SHARD_BYTES`` of vectors and is built by one task.

A node's layer is drawn geometrically.  Nodes come in the order of their layers,
at random within one, so that a layer is a beginning of the order; they are
inserted in blocks.  A block's nodes look for near ones together: by a beam
search of the graph built so far, entered through the layer above, and among the
earlier nodes of their block.  Each is linked to diverse near nodes (a candidate
is passed over when it is nearer to a chosen one than to the node), links go both
ways, and a node with too many keeps a diverse choice.  A node that lost all ways
in gets one back from its nearest earlier node: every node can be reached.  Links
are stored as one flat neighbour array and offsets per layer, a file a shard in the
shared folder: a graph is written and read by the tasks that use it, and no row,
join or shuffle carries one.

Vectors are lifted by one coordinate to a common norm, so that the largest
inner product is the smallest distance whatever their norms.  Every query
searches every shard: with a narrow beam through the upper layers, then with one
of ``beam`` nodes in the lowest.  Queries go in blocks of about ``block_rows``; a
task holds one shard and one block, whose queries are searched together.  The
``top`` of each shard are scored in double precision on the original vectors and
merged.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite
components take no part, nor do rows with a null id; vectors of different
lengths are separate searches; a repeated id is a candidate once for each
different vector and never of itself; ties go to the smaller id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import open_store, settled, work_folder

TOP = 20
LINKS = 24             # links a node makes, and keeps in the upper layers
LINKS_LOWEST = 48      # links a node keeps in the lowest layer
CANDIDATES = 64
BEAM = 256
NARROW = 4             # beam in the upper layers
SHARD_BYTES = 64 << 20 # of a shard's vectors in double precision: 131,072 of 64 dimensions
SPARE = 16             # links a node may have beyond those it keeps, until it is pruned
PRUNED = 96            # nearest links that are looked at when a node is pruned
BLOCK = 512            # nodes inserted, and queries searched, together
BLOCK_ROWS = 1024
ROWS_LIFTED = 8192
SALTS = 61


# -- the graph of one shard ----------------------------------------------

def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, starts: np.ndarray, beam: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """For each row of q the ``beam`` nearest rows of x that a search from its start meets, nearest
    first: (places, similarities); -1 for none.  ``links`` has a row a node, -1 for no link."""
    n, every = len(q), np.arange(len(q))
    places, sims = np.full((n, beam), -1, np.int32), np.full((n, beam), -np.inf, np.float32)
    done, seen = np.ones((n, beam), bool), np.zeros((n, len(x)), bool)
    places[:, 0], sims[:, 0], done[:, 0] = starts, np.einsum("nd,nd->n", q, x[starts]), False
    seen[every, starts] = True
    live = every
    while True:
        waiting = np.where(done[live], -np.inf, sims[live])
        j = waiting.argmax(axis=1)
        going = np.isfinite(waiting[np.arange(len(live)), j])
        live, j = live[going], j[going]
        if not len(live):
            break
        done[live, j] = True
        near = links[places[live, j]]
        ok = near >= 0
        near = np.where(ok, near, 0)
        ok &= ~seen[live[:, None], near]
        r, c = np.nonzero(ok)
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("nd,nd->n", x[near[r, c]], q[live[r]])
        s = np.concatenate([sims[live], s], axis=1)
        by = np.argpartition(-s, beam - 1, axis=1)[:, :beam]
        take = lambda old, new: np.take_along_axis(np.concatenate([old, new], axis=1), by, 1)
        places[live], done[live] = take(places[live], near), take(done[live], ~ok)
        sims[live] = np.take_along_axis(s, by, 1)
    by = np.argsort(-sims, axis=1, kind="stable")
    sims = np.take_along_axis(sims, by, 1)
    return np.where(np.isfinite(sims), np.take_along_axis(places, by, 1), -1), sims


def _entries(x: np.ndarray, above: list[tuple[int, np.ndarray]], q: np.ndarray) -> np.ndarray:
    """Where to enter a layer: the nearest node found in the layers above it, the topmost first."""
    at = np.zeros(len(q), np.int64)
    for n, links in above:
        at = _beam(x[:n], links, q, at, NARROW)[0][:, 0].astype(np.int64)
    return at


def _diverse(x: np.ndarray, places: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """A mask of the candidates to link: diverse ones first, then the nearest left."""
    rows, count = places.shape
    c = x[np.maximum(places, 0)]
    between = c @ c.transpose(0, 2, 1)
    there = places >= 0
    chosen = np.zeros((rows, count), bool)
    for j in range(count):
        covered = (chosen[:, :j] & (between[:, j, :j] > sims[:, j, None])).any(axis=1)
        chosen[:, j] = there[:, j] & ~covered & (chosen.sum(axis=1) < keep)
    spare = there & ~chosen
    room = keep - chosen.sum(axis=1)
    return chosen | (spare & (np.cumsum(spare, axis=1) <= room[:, None]))


def _prune(x: np.ndarray, nodes: np.ndarray, near: np.ndarray, keep: int) -> np.ndarray:
    """A diverse choice of ``keep`` of each node's links (a row a node, -1 for none), at the row's beginning."""
    out = np.full((len(nodes), keep), -1, np.int32)
    for a in range(0, len(nodes), 256):
        some = near[a:a + 256]
        sims = np.einsum("nwd,nd->nw", x[np.maximum(some, 0)], x[nodes[a:a + 256]])
        sims = np.where(some >= 0, sims, -np.inf).astype(np.float32)
        by = np.argsort(-sims, axis=1, kind="stable")[:, :PRUNED]
        some, sims = np.take_along_axis(some, by, 1), np.take_along_axis(sims, by, 1)
        mask = _diverse(x, some, sims, keep)
        r, c = np.nonzero(mask)
        out[a + r, (np.cumsum(mask, axis=1) - 1)[r, c]] = some[r, c]
    return out


def _link_back(x: np.ndarray, links: np.ndarray, degree: np.ndarray, src: np.ndarray, dst: np.ndarray, keep: int) -> None:
    """Links from each dst to its src; a node without room for them is pruned."""
    by = np.argsort(dst, kind="stable")
    src, dst = src[by], dst[by]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    nth = np.arange(len(dst)) - np.repeat(first, count)
    full = degree[nodes] + count > links.shape[1]
    many = np.repeat(full, count)
    links[dst[~many], degree[dst[~many]] + nth[~many]] = src[~many]
    degree[nodes[~full]] += count[~full]
    if full.any():
        hot, at = nodes[full], np.repeat(np.arange(int(full.sum())), count[full])
        new = np.full((len(hot), int(count[full].max())), -1, np.int32)
        new[at, nth[many]] = src[many]
        kept = _prune(x, hot, np.concatenate([links[hot], new], axis=1), keep)
        links[hot] = -1
        links[hot, :keep] = kept
        degree[hot] = (links[hot] >= 0).sum(axis=1)


def _layer(x: np.ndarray, above: list[tuple[int, np.ndarray]], make: int, keep: int, candidates: int) -> np.ndarray:
    """The links of each row of x, which are in order of insertion; ``above`` are the layers over this one."""
    n, known = len(x), above[-1][0] if above else 0
    links, degree = np.full((n, keep + SPARE), -1, np.int32), np.zeros(n, np.int64)
    nearest = np.zeros(n, np.int64)
    for a in range(0, n, BLOCK):
        q = x[a:a + BLOCK]
        s = q @ q.T
        s[np.triu_indices(len(q))] = -np.inf                       # the earlier ones of the block
        wide = min(candidates, len(q))
        places = np.argpartition(-s, wide - 1, axis=1)[:, :wide]
        sims = np.take_along_axis(s, places, 1)
        places = np.where(np.isfinite(sims), places + a, -1)
        if a:
            # only nodes of the upper layers that are in the graph by now can be entered
            starts = _entries(x, above, q) if a >= known else np.zeros(len(q), np.int64)
            found, near = _beam(x[:a], links, q, starts, candidates)
            places, sims = np.concatenate([found, places], axis=1), np.concatenate([near, sims], axis=1)
        by = np.argsort(-sims, axis=1, kind="stable")[:, :candidates]
        places, sims = np.take_along_axis(places, by, 1).astype(np.int32), np.take_along_axis(sims, by, 1)
        nearest[a:a + len(q)] = np.maximum(places[:, 0], 0)
        mask = _diverse(x, places, sims, make)
        r, c = np.nonzero(mask)
        to = places[r, c]
        links[a + r, (np.cumsum(mask, axis=1) - 1)[r, c]] = to
        degree[a:a + len(q)] = mask.sum(axis=1)
        _link_back(x, links, degree, (a + r).astype(np.int32), to, keep)
    over = np.flatnonzero(degree > keep)
    links[over, :keep] = _prune(x, over, links[over], keep)
    links[over, keep:] = -1
    lists = [row[row >= 0] for row in links]
    lost = np.ones(n, bool)
    lost[_reach(lists, n)] = False
    for i in np.flatnonzero(lost):                   # in order: an earlier node is reached by now
        p = int(nearest[i])
        lists[p] = np.append(lists[p], np.int32(i))
    return _rows(lists)


def _rows(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max(1, max(map(len, lists), default=1))), -1, np.int32)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _reach(lists: list[np.ndarray], n: int) -> np.ndarray:
    seen = np.zeros(n, bool)
    seen[0] = True
    todo = [0]
    while todo:
        new = lists[todo.pop()]
        new = new[~seen[new]]
        seen[new] = True
        todo.extend(new.tolist())
    return np.flatnonzero(seen)


class Graph:
    """A hierarchical small-world graph in flat arrays."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, layers: list[tuple[int, np.ndarray, np.ndarray]], norm: float):
        # layer, the lowest first: the first so many of the order; offsets; neighbours as places in the order
        self.vectors, self.order, self.layers, self.norm = vectors, order, layers, norm
        self.x = np.empty((len(order), vectors.shape[1] + 1), np.float32)
        for a in range(0, len(order), ROWS_LIFTED):                # few rows in double precision at a time
            some = vectors[order[a:a + ROWS_LIFTED]]
            lift = np.sqrt(np.maximum(0.0, norm ** 2 - (some ** 2).sum(axis=1)))
            self.x[a:a + ROWS_LIFTED] = np.column_stack([some, lift]) / norm
        self._links = [(n, self._padded(offsets, flat)) for n, offsets, flat in layers]

    @staticmethod
    def _padded(offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
        degree = np.diff(offsets)
        out = np.full((len(degree), max(1, int(degree.max(initial=1)))), -1, np.int32)
        out[np.repeat(np.arange(len(degree)), degree), np.arange(len(flat)) - np.repeat(offsets[:-1], degree)] = flat
        return out

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, lowest: int = LINKS_LOWEST,
              candidates: int = CANDIDATES, seed: int = 7) -> "Graph":
        rng = np.random.default_rng(seed)
        n = len(vectors)
        norm = float(np.sqrt((vectors ** 2).sum(axis=1).max()))
        height = np.floor(-np.log(1.0 - rng.random(n)) / math.log(links)).astype(int)
        order = np.lexsort((rng.random(n), -height)).astype(np.int32)
        x, above, layers = cls(vectors, order, [], norm).x, [], []
        for layer in range(int(height.max()), -1, -1):
            size = int((height >= layer).sum())
            made = _layer(x[:size], above, links, lowest if layer == 0 else links, candidates)
            above.append((size, made))
            layers.append((size, np.concatenate([[0], np.cumsum((made >= 0).sum(axis=1))]).astype(np.int64), made[made >= 0]))
        return cls(vectors, order, layers[::-1], norm)

    def search_many(self, queries: np.ndarray, top: int, beam: int) -> np.ndarray:
        """Rows of about the largest inner products with each query, nearest first; -1 for none."""
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        q = np.column_stack([queries / np.where(length > 0, length, 1.0), np.zeros(len(queries))]).astype(np.float32)
        out = np.full((len(q), top), -1, np.int64)
        for a in range(0, len(q), BLOCK):
            some = q[a:a + BLOCK]
            starts = _entries(self.x, self._links[:0:-1], some)
            got = _beam(self.x, self._links[0][1], some, starts, max(beam, top))[0][:, :top]
            out[a:a + BLOCK] = np.where(got >= 0, self.order[np.maximum(got, 0)], -1)
        return out

    def search(self, query: np.ndarray, top: int, beam: int) -> list[int]:
        return [int(r) for r in self.search_many(np.asarray(query)[None, :], top, beam)[0] if r >= 0]

    # -- as a file -----------------------------------------------------------

    def write(self, file: BinaryIO, ids: np.ndarray, id_offsets: np.ndarray) -> None:
        np.savez(file, vectors=self.vectors, order=self.order, norm=self.norm, ids=ids, id_offsets=id_offsets,
                 sizes=np.array([n for n, _, _ in self.layers], np.int64),
                 **{f"{k}{i}": a for i, (_, o, f) in enumerate(self.layers) for k, a in (("o", o), ("f", f))})

    @classmethod
    def read(cls, file: BinaryIO) -> tuple["Graph", np.ndarray, np.ndarray]:
        with np.load(file) as z:
            layers = [(int(n), z[f"o{i}"], z[f"f{i}"]) for i, n in enumerate(z["sizes"])]
            return cls(z["vectors"], z["order"], layers, float(z["norm"])), z["ids"], z["id_offsets"]

    def dump(self, ids: np.ndarray, id_offsets: np.ndarray) -> bytes:
        out = io.BytesIO()
        self.write(out, ids, id_offsets)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> tuple["Graph", np.ndarray, np.ndarray]:
        return cls.read(io.BytesIO(data))


# -- Spark ----------------------------------------------------------------

def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    v = embeddings[vector_col].cast("array<double>")
    rows = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(False))
                      & F.exists("v", lambda c: c != 0.0)).withColumn("dims", F.size("v"))


def nodes_of(rows: DataFrame, top: int) -> DataFrame:
    """(v, dims, ids): each different vector with its top + 1 smallest ids."""
    few = F.row_number().over(Window.partitionBy("v", "salt").orderBy("vec_id"))
    least = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    salted = (rows.distinct().withColumn("salt", F.pmod("vec_id", F.lit(SALTS)))
              .withColumn("r", few).where(F.col("r") <= top + 1))
    return (salted.withColumn("r", least).where(F.col("r") <= top + 1)
            .groupBy("v", "dims").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def build_index(rows: DataFrame, folder: str, top: int = TOP, shard_rows: int | None = None) -> tuple[DataFrame, int]:
    """(dims, shard, file of the graph in ``folder``) and the number of shards: of ``shard_rows`` nodes or, without it,
    of SHARD_BYTES."""
    nodes = settled(nodes_of(rows, top), folder, "nodes")
    size = nodes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("dims") * F.lit(8)), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size.n // shard_rows) if shard_rows else -(-size.bytes // SHARD_BYTES))

    def graph(key: tuple, group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group["h"].to_numpy(), kind="stable")).combine_chunks()
        vectors, ids = (group[c].chunk(0) for c in ("v", "ids"))
        g = Graph.build(vectors.flatten().to_numpy().reshape(len(vectors), -1))
        store, root = open_store(folder)
        store.create_dir(f"{root}/graphs", recursive=True)
        name = f"graphs/{uuid.uuid4().hex}.npz"               # a name of its own for each attempt
        with store.open_output_stream(f"{root}/{name}") as out:
            g.write(out, ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]))
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "graph": [name]})

    dealt = nodes.withColumn("h", F.xxhash64("v")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    built = dealt.groupBy("dims", "shard").applyInArrow(graph, "dims int, shard int, graph string")
    return settled(built, folder, "index"), shards


def search_index(index: DataFrame, folder: str, shards: int, queries: DataFrame, top: int = TOP, beam: int = BEAM,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, vec_id, score): the top of each shard for each query (vec_id, v, dims)."""
    queries = queries.distinct()
    blocks = max(1, -(-queries.count() // block_rows))
    grouped = (queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
               .groupBy("dims", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    work = grouped.join(index, ["dims", "shard"]).select("graph", "queries").repartition(blocks * shards)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                with store.open_input_file(f"{root}/{batch.column(0)[i].as_py()}") as file:
                    g, ids, offsets = Graph.read(file)
                out = [], [], []
                asked = batch.column(1)[i].as_py()
                vectors = np.array([q["v"] for q in asked], np.float64)
                for q, v, found in zip(asked, vectors, g.search_many(vectors, top + 1, beam).tolist()):
                    best = []
                    for row in found:
                        if row < 0:
                            break
                        score = float(np.dot(v, g.vectors[row]))
                        best += [(-score, int(c)) for c in ids[offsets[row]:offsets[row + 1]] if c != q["vec_id"]]
                    for score, c in sorted(best)[:top]:
                        for o, x in zip(out, (q["vec_id"], c, -score)):
                            o.append(x)
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                       pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    return work.mapInArrow(rows, "query_id long, vec_id long, score double")


def nearest(embeddings: DataFrame, every: int = 20, top: int = TOP, beam: int = BEAM, shard_rows: int | None = None,
            folder: str | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    folder = folder or work_folder(embeddings.sparkSession, "hnsw")
    rows = usable(embeddings)
    index, shards = build_index(rows, folder, top, shard_rows)
    found = search_index(index, folder, shards, rows.where(F.col("vec_id") % every == 0), top, beam)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
