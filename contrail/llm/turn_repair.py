"""Operator 12: conversation structure repair by prefix-doubling path ranking.

A conversation's role initials should read ``(s?(ua)+)?``.  The edits form a
graph: a node is a place between two rows and what has been written so far
(nothing, s, u or a), an arc an edit with its cost.  A cost DP from the end
gives each node its cost to go and thereby the optimal arcs.  Nodes are then
ranked by the letters of their least path of optimal arcs: by one letter, and
from ranks of 2^k letters and pointers 2^k arcs ahead by 2^(k+1) letters, until
the longest audit is covered.  At each node the arc of the least (letter, rank
of its target) is taken, and the doubled pointers spell out the audit.  (An
edit's letter names one arc of a node, since only u or a can follow, never
both; so a least prefix has one end and one pointer for each length is enough.)

Long conversations are not gathered.  Rows are put in order over ranges, which
cut a conversation, even one turn of it, anywhere, and each run of one task's
rows is a piece of at most ``PIECE_ROWS`` rows and ``PIECE_BYTES`` bytes.  A
piece is summed up by its costs from each state to each state (4 x 4, joined
by min-plus products), its counts and its turns; from the last piece to the
first the costs to go are carried back over these sums.  Pieces are ranked
apart, for each state that they may be entered in.  Only the last step walks a
conversation from piece to piece, because its digest and audit are defined over
the whole; it holds one piece at a time, besides the audit.

Defined results: nulls in role and text are one space, and so are null ids and
turns where a row's damage is drawn; rows come by turn (nulls first), role and
the text's md5, repeated rows being rows of their own; rows with a null id form
one conversation; a role whose first letter is none of s, u, a can't be kept,
the empty role included; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import settled, work_folder

PIECE_ROWS = 2048
PIECE_BYTES = 4 << 20

#: Costs of the edits, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing, s, u, a written so far.  The state after a written u or a, whichever fits.
NEXT = np.array([2, 2, 3, 2])
#: After keeping a row of that initial; -1 where it can't follow.
AFTER = {"s": np.array([1, -1, -1, -1]), "u": np.array([2, 2, -1, 2]), "a": np.array([-1, -1, 3, -1])}
INITIALS = "sua"
_NONE = np.full(4, -1)
KEPT = np.stack([_NONE, *(AFTER[c] for c in INITIALS)])          # by 1 + place in INITIALS
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)                     # in ASCII order: rank of one letter
FAR = np.int64(1 << 40)
FINAL = np.array([0, 2 * INSERT, INSERT, 0], np.int64)           # cost to go after the last row
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3


# -- arithmetic of rows ---------------------------------------------------

def _row_arcs(initial: np.ndarray, fault: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state after keeping, cost of keeping, cost of reroling) by row and state."""
    to = KEPT[initial]
    extra = np.where(fault == _TRUNCATED, TRUNCATED, 0)[:, None]
    stays = ~np.isin(fault, (_BLANK, _DUPLICATE))[:, None]
    keep = np.where((to >= 0) & stays, extra, FAR)
    rerole = np.where(stays, REROLE + extra, FAR) + np.zeros((1, 4), np.int64)
    return to, keep, rerole


def costs_back(initial: np.ndarray, fault: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Cost to go before each row (and after the last): [rows + 1, 4, ...] from ``ahead`` [4, ...]."""
    to, keep, rerole = _row_arcs(initial, fault)
    out = np.empty((len(initial) + 1, *ahead.shape), np.int64)
    out[-1] = c = ahead
    more = (slice(None),) + (None,) * (ahead.ndim - 1)
    for i in range(len(initial) - 1, -1, -1):
        row = np.minimum(np.minimum(DELETE + c, rerole[i][more] + c[NEXT]), keep[i][more] + c[np.maximum(to[i], 0)])
        c = np.minimum(np.minimum(row, INSERT + row[NEXT]), 2 * INSERT + row[NEXT[NEXT]])
        out[i] = c
    return out


class Paths:
    """Least optimal paths of a piece from each state: letters and the state at its end."""

    def __init__(self, initial: np.ndarray, fault: np.ndarray, ahead: np.ndarray, last: bool):
        n = len(initial)
        cost = costs_back(initial, fault, ahead)
        nodes, at = 4 * (n + 1), np.arange(4 * (n + 1))
        row, state = at // 4, at % 4
        flat = cost.reshape(-1)
        target, price = np.full((5, nodes), -1), np.full((5, nodes), FAR)       # by letter; letter 0 stays
        inner = at[:4 * n]
        to, keep, rerole = _row_arcs(initial, fault)
        target[1, inner], price[1, inner] = inner + 4, DELETE
        target[3, inner] = np.where(to.reshape(-1) >= 0, 4 * (row[inner] + 1) + to.reshape(-1), -1)
        price[3, inner] = keep.reshape(-1)
        target[4, inner], price[4, inner] = 4 * (row[inner] + 1) + NEXT[state[inner]], rerole.reshape(-1)
        writes = at if last else inner                  # rows may be written before each row, and after the last one
        target[2, writes], price[2, writes] = 4 * row[writes] + NEXT[state[writes]], INSERT
        optimal = (target >= 0) & (price + flat[np.maximum(target, 0)] == flat)
        optimal[0] = ~optimal[1:].any(axis=0)           # a node at the end
        target[0] = at

        longest = 3 * (n + 1)
        first = np.argmax(optimal, axis=0)              # least letter of an optimal arc
        rank, jump, steps = first.copy(), target[first, at], 1
        while steps < longest:
            rank = np.unique(rank * (nodes + 5) + rank[jump], return_inverse=True)[1]
            jump, steps = jump[jump], 2 * steps
        order = np.where(optimal, np.arange(5)[:, None] * (nodes + 5) + rank[np.maximum(target, 0)], FAR)
        chosen = np.argmin(order, axis=0)
        jump, path = target[chosen, at], np.arange(4)[:, None]
        while path.shape[1] < longest + 1:
            path = np.concatenate([path, jump[path]], axis=1)
            jump = jump[jump]
        self.letters = [LETTERS[line[line > 0]].tobytes().decode() for line in chosen[path]]
        self.exits = state[path[:, -1]].tolist()


#: Short pieces repeat a few patterns; longer ones are not remembered.
SHORT = 16


def _sums(initial: np.ndarray, fault: np.ndarray) -> list[int]:
    """Costs from each state before the rows to each state after them, row by row."""
    return costs_back(initial, fault, np.where(np.eye(4, dtype=bool), 0, FAR))[0].reshape(-1).tolist()


@lru_cache(4096)
def _short_paths(initial: tuple, fault: tuple, ahead: tuple, last: bool) -> Paths:
    return Paths(np.array(initial), np.array(fault), np.array(ahead), last)


@lru_cache(4096)
def _short_sums(initial: tuple, fault: tuple) -> list[int]:
    return _sums(np.array(initial), np.array(fault))


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """(``role:text`` of the rows that result, state after them)."""
    lines, at = [], 0
    for edit in audit:
        if edit == "I":
            state = int(NEXT[state])
            lines.append(("user:", "assistant:")[state - 2])
            continue
        if edit == "K":
            state = int(AFTER[roles[at][0]][state])
            lines.append(f"{roles[at]}:{texts[at]}")
        elif edit == "R":
            state = int(NEXT[state])
            lines.append(f"{('user', 'assistant')[state - 2]}:{texts[at]}")
        at += 1
    return lines, state


# -- Spark ----------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """The rows after damage drawn from crc32 of ``conv_id:turn``."""
    blank = F.lit(" ")
    draw = F.crc32(F.concat_ws(":", F.coalesce(turns["conv_id"].cast("string"), blank),
                               F.coalesce(turns["turn"].cast("string"), blank))) % 20
    rows = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                        F.coalesce(turns["role"], blank).alias("role"), F.coalesce(turns["text"], blank).alias("text"),
                        draw.alias("draw")).filter("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")
                                               ).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
            .drop("copy"))


_ROWS = ("turns array<long>, initials array<int>, faults array<int>, keys array<string>, roles array<string>, "
         "texts array<string>")


def pieces(rows: DataFrame) -> DataFrame:
    """(conv, none, piece, arrays of the piece's rows): ``none`` marks the null id; pieces number a conversation's order."""
    seen = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)      # the last character that shows
    fault = F.when(seen == "", _BLANK).when(~seen.isin(".", "!", "?"), _TRUNCATED).otherwise(0)
    initial = F.lit(0)
    for k, c in enumerate(INITIALS):
        initial = F.when(F.col("role").startswith(c), k + 1).otherwise(initial)
    facts = rows.select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"), F.col("conv_id").isNull().alias("none"), "turn",
        initial.cast("int").alias("initial"), fault.cast("int").alias("fault"), "role", F.md5("text").alias("digest"),
        "text").withColumn("key", F.md5(F.concat_ws(":", F.length("role"), "role", "digest")))
    # equal rows are interchangeable, so where a range ends among them any number will do
    facts = facts.withColumn("spread", F.monotonically_increasing_id())
    order = [F.desc("none"), "conv", "turn", "role", "digest", "spread"]
    ordered = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["conv", "none", "turn", "initial", "fault", "key", "role", "text"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv, none = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            size = np.cumsum(pc.binary_length(batch.column(7)).to_numpy().astype(np.int64))
            cut = np.zeros(n, bool)
            cut[0] = True
            cut[1:] = (conv[1:] != conv[:-1]) | (none[1:] != none[:-1])
            part = size // PIECE_BYTES * n + np.arange(n) // PIECE_ROWS
            cut[1:] |= part[1:] != part[:-1]
            starts = np.flatnonzero(cut)
            offsets = pa.array(np.append(starts, n), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, batch.column(i)) for i in range(2, 8)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[starts]), pa.array(none[starts]),
                 pa.array(number + np.arange(len(starts)), pa.int64()), *lists],
                ["conv", "none", "piece", "turns", "initials", "faults", "keys", "roles", "texts"])
            number += len(starts)

    return ordered.select(*names).mapInArrow(runs, f"conv long, none boolean, piece long, {_ROWS}")


def _seen_before(parts: DataFrame) -> DataFrame:
    """(conv, none, piece, seen): keys that an earlier piece of the conversation has; few conversations have several."""
    several = parts.groupBy("conv", "none").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    keys = (parts.select("conv", "none", "piece", F.explode(F.array_distinct("keys")).alias("key"))
            .join(several, ["conv", "none"], "left_semi"))
    first = Window.partitionBy("conv", "none", "key")            # a row a piece
    return (keys.withColumn("first", F.min("piece").over(first)).filter("piece > first")
            .groupBy("conv", "none", "piece").agg(F.collect_list("key").alias("seen")))


def _summaries(parts: DataFrame) -> DataFrame:
    """Each piece's faults, counts, turns and costs from state to state."""
    facts = parts.select("conv", "none", "piece", "turns", "initials", "faults", "keys").join(
        _seen_before(parts), ["conv", "none", "piece"], "left")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                out = []
                for p in batch.slice(i, 512).to_pylist():
                    seen, fault = set(p["seen"] or ()), []
                    for f, key in zip(p["faults"], p["keys"]):
                        fault.append(f if f == _BLANK else _DUPLICATE if key in seen else f)
                        seen.add(key)
                    first = p["initials"]
                    sums = (_short_sums(tuple(first), tuple(fault)) if len(first) <= SHORT
                            else _sums(np.array(first), np.array(fault)))
                    known = [t for t in p["turns"] if t is not None]
                    out.append({
                        "conv": p["conv"], "none": p["none"], "piece": p["piece"], "initials": p["initials"],
                        "faults": fault, "sums": sums,
                        "illegal": sum(not _legal(a, b) for a, b in zip(first[:-1], first[1:])),
                        "low": known[0] if known else None, "high": known[-1] if known else None,
                        "turns": len(set(known))})
                yield pa.RecordBatch.from_pylist(out, _arrow)

    schema = ("conv long, none boolean, piece long, initials array<int>, faults array<int>, sums array<long>, "
              "illegal long, low long, high long, turns long")
    _arrow = pa.schema([("conv", pa.int64()), ("none", pa.bool_()), ("piece", pa.int64()),
                        ("initials", pa.list_(pa.int32())), ("faults", pa.list_(pa.int32())),
                        ("sums", pa.list_(pa.int64())),
                        *((c, pa.int64()) for c in ("illegal", "low", "high", "turns"))])
    return facts.mapInArrow(rows, schema)


def _legal(a: int, b: int) -> bool:
    return (int(a), int(b)) in {(1, 2), (2, 3), (3, 2)}


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _edits(summaries: DataFrame) -> DataFrame:
    """(conv, none, piece, audits, counts): the least audit of each piece for each state it may be
    entered in; the conversation's counts stand in its first piece."""
    ordered = (summaries.repartition("conv", "none").sortWithinPartitions("none", "conv", F.desc("piece")))
    names = ["conv", "none", "piece", "audits", *_COUNTS]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, carry = None, None, None
        out: list[dict] = []
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                for p in batch.slice(i, 512).to_pylist():
                    if (p["none"], p["conv"]) != conv:
                        if held is not None:
                            out.append({**held, **_counts(carry)})
                        conv, held = (p["none"], p["conv"]), None
                        carry = {"ahead": FINAL, "first": None, "low": None, "high": None, "turns": 0, "illegal": 0,
                                 "faults": np.zeros(4, np.int64)}
                    if held is not None:
                        out.append(held)
                    first, fault, last = p["initials"], p["faults"], carry["first"] is None
                    if len(first) <= SHORT:
                        paths = _short_paths(tuple(first), tuple(fault), tuple(carry["ahead"].tolist()), last)
                    else:
                        paths = Paths(np.array(first), np.array(fault), carry["ahead"], last)
                    held = {"conv": p["conv"], "none": p["none"], "piece": p["piece"], "audits": paths.letters}
                    carry["illegal"] += p["illegal"] + (not last and not _legal(first[-1], carry["first"]))
                    carry["turns"] += p["turns"] - (p["high"] is not None and p["high"] == carry["low"])
                    if p["high"] is not None:
                        carry["high"] = p["high"] if carry["high"] is None else carry["high"]
                        carry["low"] = p["low"]
                    carry["first"] = first[0]
                    carry["faults"] += np.bincount(fault, minlength=4)
                    carry["ahead"] = (np.array(p["sums"]).reshape(4, 4) + carry["ahead"]).min(axis=1)
                if out:
                    yield pa.RecordBatch.from_pylist(out, _arrow)
                    out = []
        if held is not None:
            yield pa.RecordBatch.from_pylist([*out, {**held, **_counts(carry)}], _arrow)

    _arrow = pa.schema([("conv", pa.int64()), ("none", pa.bool_()), ("piece", pa.int64()),
                        ("audits", pa.list_(pa.string())), *((c, pa.int64()) for c in _COUNTS)])
    return ordered.mapInArrow(rows, "conv long, none boolean, piece long, audits array<string>, "
                              + ", ".join(f"{c} long" for c in _COUNTS)).select(*names)


def _counts(c: dict) -> dict:
    _, blank, duplicate, truncated = c["faults"].tolist()
    return {"gaps": 0 if c["high"] is None else c["high"] - c["low"] + 1 - c["turns"], "blank": blank,
            "duplicate": duplicate, "truncated": truncated, "illegal": int(c["illegal"]), "cost": int(c["ahead"][0])}


def repaired(rows: DataFrame, folder: str) -> DataFrame:
    """(conv_id, counts, cost, audit, repaired_sha256) of every conversation that has rows."""
    parts = settled(pieces(rows), folder, "pieces")
    edits = settled(_edits(_summaries(parts)), folder, "edits")
    keys = ["conv", "none", "piece"]
    made = ["audits", *_COUNTS]
    # a piece's edits right before its rows: one shuffle of the texts, where a join would ask for another key
    both = edits.withColumn("own", F.lit(0)).unionByName(
        parts.select(*keys, "roles", "texts", F.lit(1).alias("own")), allowMissingColumns=True)
    whole = (both.repartition("conv", "none").sortWithinPartitions("none", "conv", "piece", "own")
             .select("conv", "none", "own", "roles", "texts", *made))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, out = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                for p in batch.slice(i, 1).to_pylist():
                    if not p["own"]:
                        if (p["none"], p["conv"]) != conv:
                            if conv is not None:
                                out.append(_end(conv, counts, audit, seen))
                            conv, counts = (p["none"], p["conv"]), {c: p[c] for c in _COUNTS}
                            audit, seen, state, begun = [], hashlib.sha256(), 0, False
                        audits = p["audits"]
                        continue
                    edits = audits[state]
                    lines, state = apply_edits(edits, state, p["roles"], p["texts"])
                    audit.append(edits)
                    if lines:
                        seen.update((("\n" if begun else "") + "\n".join(lines)).encode())
                        begun = True
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, _arrow)
                    out = []
        if conv is not None:
            yield pa.RecordBatch.from_pylist([*out, _end(conv, counts, audit, seen)], _arrow)

    def _end(conv, counts, audit, seen) -> dict:
        return {"conv_id": None if conv[0] else conv[1], **counts, "audit": "".join(audit),
                "repaired_sha256": seen.hexdigest()}

    _arrow = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])
    return whole.mapInArrow(walk, "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS)
                            + ", audit string, repaired_sha256 string")


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """The repair of each conversation's damaged rows; one that lost all of them has zeros and an empty audit."""
    fixed = repaired(damaged(turns), work_folder(turns.sparkSession, "repair"))
    ids = turns.select(turns["conv_id"].cast("long").alias("id")).distinct()
    made = ids.join(fixed, ids["id"].eqNullSafe(fixed["conv_id"]), "left")
    return made.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS),
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
