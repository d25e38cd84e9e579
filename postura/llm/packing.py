"""Best-fit packing of documents into sequences of at most ``length`` tokens.

A document is its ids and an end id. One longer than a sequence is cut into full pieces, the
first of which may be shorter; so at most one piece a document is not a sequence by itself.

Method: pattern packing by non-negative least squares. The piece lengths are reduced to a histogram
(at most ``length`` numbers, whatever the input). Patterns of one to three lengths that fill a
sequence exactly are enumerated, their repeat counts are fitted to the histogram by non-negative least squares
(active set), rounded and trimmed to what the histogram has. The lengths left over are packed by
best fit, longest first, on the histogram as well. The plan is a list of (pattern, repeats) whose
size depends on ``length`` only. Pieces are then numbered within their length by Spark and
look up their sequence and offset in the plan.

Defined results: null text is the empty text, a piece of the end id alone; rows that repeat a doc_id are
documents of their own; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postura.llm.common import cut, id_text, map_batches
from postura.llm.token_counts import NEWER, byte_letters

ROWS_A_GROUP = 10_000
# Fixed value: the library's pre-token pattern for byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class ByteCodec:
    """Ids as the tokenizers library gives them. The merges of a byte-level vocabulary are its ranks, which
    tiktoken runs several times faster; texts with special strings, or with characters that the two
    libraries' Unicode tables may see differently, go through tokenizers itself."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_of = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.path = path
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if NEWER.search(text) or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@lru_cache(maxsize=2)
def byte_codec(path: str) -> ByteCodec:
    return ByteCodec(path)


def cut_documents(docs: DataFrame, vocabulary_path: str, end_id: int, length: int) -> DataFrame:
    """The pieces of every document: doc_id, piece (from 0), start (ids before it), length, ids (little-endian 32 bits)."""

    def make():
        codec = byte_codec(vocabulary_path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            doc, piece, start, size, ids = [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = np.append(codec.ids(text or ""), np.uint32(end_id)).astype("<u4")
                at, k, n = 0, 0, len(raw) % length or length
                while at < len(raw):
                    doc.append(d)
                    piece.append(k)
                    start.append(at)
                    size.append(n)
                    ids.append(raw[at : at + n].tobytes())
                    at, k, n = at + n, k + 1, length
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

        return each

    return map_batches(id_text(docs), make, PIECES)


def patterns(histogram: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none), ascending, that fill a sequence and are in the histogram."""
    full = len(histogram) - 1
    have = np.flatnonzero(histogram)
    have = have[have > 0]
    there = np.zeros(full + 1, bool)
    there[have] = True
    out = [np.array([[0, 0, full]])] if there[full] else []
    a = have[2 * have <= full]
    a = a[there[full - a]]
    out.append(np.stack([0 * a, a, full - a], 1))
    for a in have[3 * have <= full]:
        b = have[(have >= a) & (2 * have <= full - a)]
        b = b[there[full - a - b]]
        out.append(np.stack([0 * b + a, b, full - a - b], 1))
    return np.concatenate(out)


def fit(rows: np.ndarray, histogram: np.ndarray, at_once: int = 96, rounds: int = 60) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise the squared, weighted miss of the histogram.

    Active set, in blocks: each round lets in the patterns of steepest descent, no two with a common length, solves the
    least squares of those that are in, and drops those that turn out negative until none does. The best
    round counts; three rounds without gain end the fit. Short lengths weigh little, as they fill gaps easily.
    """
    weight = np.where(np.arange(len(histogram)) <= 8, 0.3, 1.0)
    weight[0] = 0
    scale = max(1.0, float(histogram[1:].max(initial=0)))
    goal = histogram / scale * weight
    inside = np.zeros(0, np.int64)

    def matrix(cols: np.ndarray) -> np.ndarray:
        m = np.zeros((len(histogram), len(cols)))
        for k in range(3):
            np.add.at(m, (rows[cols, k], np.arange(len(cols))), 1.0)
        return m * weight[:, None]

    miss, best, best_x, idle = goal, float(goal @ goal), np.zeros(len(rows)), 0
    for _ in range(rounds):
        gain = (miss * weight)[rows].sum(1)
        gain[inside] = 0
        taken, new = np.zeros(len(histogram), bool), []
        for i in np.argsort(-gain, kind="stable")[: 40 * at_once]:
            if gain[i] <= 1e-6 or len(new) == at_once:
                break
            own = rows[i][rows[i] > 0]
            if not taken[own].any():
                taken[own] = True
                new.append(i)
        if not new:
            break
        inside = np.append(inside, new).astype(np.int64)
        solved = np.zeros(0)
        while len(inside):
            m = matrix(inside)
            solved = np.linalg.solve(m.T @ m + 1e-9 * np.eye(len(inside)), m.T @ goal)
            if (solved > 0).all():
                break
            inside, solved = inside[solved > 0], solved[solved > 0]
        miss = goal - (matrix(inside) @ solved if len(inside) else 0)
        if (now := float(miss @ miss)) < best * (1 - 1e-4):
            best, best_x, idle = now, np.zeros(len(rows)), 0
            best_x[inside] = solved
        elif (idle := idle + 1) == 3:
            break
    return best_x * scale


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the histogram exactly."""
    full = len(histogram) - 1
    rest = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if rest[full]:
        out.append(((full,), int(rest[full])))
        rest[full] = 0
    if len(rows := patterns(rest)):
        repeats = np.rint(fit(rows, rest)).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable")[: np.count_nonzero(repeats)]:
            own = [int(v) for v in rows[i] if v]
            n = min(int(repeats[i]), *(int(rest[v]) // own.count(v) for v in own))
            if n > 0:
                out.append((tuple(own[::-1]), n))
                for v in own:
                    rest[v] -= n
    # best fit, longest first; open[free] has the unfinished sequences with that much room
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    room = np.zeros(full + 1, np.int64)

    def put(own: tuple[int, ...], n: int) -> None:
        free = full - sum(own)
        if free:
            opened[free].append((own, n))
            room[free] += n
        else:
            out.append((own, n))

    for v in range(full, 0, -1):
        left = int(rest[v])
        while left and (fits := np.flatnonzero(room[v:])).size:
            free = v + int(fits[0])
            own, n = opened[free].pop()
            room[free] -= n
            used = min(n, left)
            if n > used:
                opened[free].append((own, n - used))
                room[free] += n - used
            put((*own, v), used)
            left -= used
        if left:
            each = full // v
            if left // each:
                put((v,) * each, left // each)
            if left % each:
                put((v,) * (left % each), 1)
    return out + [x for free in sorted(opened) for x in opened[free]]


def slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (rank from, sequence of that rank, offset), by rank."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    cursor: dict[int, int] = defaultdict(int)
    sequence = 0
    for own, n in planned:
        offset = 0
        for v in own:
            rows[v].append((cursor[v], sequence, offset))
            cursor[v] += n
            offset += v
        sequence += n
    return {v: np.array(r, np.int64) for v, r in rows.items()}


def pack(pieces: DataFrame, length: int) -> DataFrame:
    """``pieces`` (any columns; doc_id, piece, start and length decide) with sequence_id and offset."""
    spark = pieces.sparkSession
    # bounded: one row for each length up to ``length``
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(length + 1, np.int64)
    for row in found:
        histogram[row["length"]] = row["n"]
    table = spark.sparkContext.broadcast(slots(plan(histogram)))
    groups = max(1, math.ceil(int(histogram.sum()) / ROWS_A_GROUP))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(groups)).cast("int"))
    # rank of a piece among those of its length: those in earlier groups, and its place in its own
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    placed = salted.withColumn("_place", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")))
    ranked = placed.join(before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_place") - 1)
    ranked = ranked.select(*pieces.columns, "_rank")
    names = pieces.columns
    at = names.index("length")

    def make():
        lookup = table.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            size, rank = batch.column(at).to_numpy(), batch.column(len(names)).to_numpy()
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for v in np.unique(size):
                rows, own = lookup[int(v)], size == v
                k = np.searchsorted(rows[:, 0], rank[own], side="right") - 1
                sequence[own], offset[own] = rows[k, 1] + rank[own] - rows[k, 0], rows[k, 2]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

        return each

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_batches(ranked, make, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int, length: int) -> DataFrame:
    """Every piece with its ids, its sequence and its place there."""
    return pack(cut(cut_documents(docs, vocabulary_path, end_id, length)), length)
