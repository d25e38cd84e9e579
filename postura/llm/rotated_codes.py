"""Approximate nearest neighbours by cosine from randomly rotated one-bit codes.

Method: a unit vector's residual from the nearest of its block's centroids is turned by a random rotation (a fixed seed)
and kept as the signs of its coordinates, packed to bits, times their mean size. What these leave of the residual is turned
and coded again, ``levels`` times in all; each level leaves about 0.6 of the length. The code is scaled so that it has the residual's own inner product with
the residual; then the error of an inner product with a query comes only from that part of the query which is not along the
residual, and that is no longer than the distance of query and vector. With the length z of what the code leaves, the
estimate errs by at most ``spread`` * z * distance / sqrt(dims - 1) for nearly all vectors: the nearer, the smaller, so that close
clusters of any radius are told apart. Every vector is estimated for every query. The (k + 1)th largest lower bound is what
a candidate's upper bound must reach; however many do, all are scored in double precision on the original vectors:
those of best estimate first, of the others the ones whose upper bound reaches the kth best of these scores.

On Spark: equal vectors are one point that keeps its k + 1 smallest ids, as a later copy can't be among the best k of any
query. Points are dealt into blocks by hash, and each block is coded once, into one row of packed bits and scalars. Queries
are dealt into blocks too, and every pair of blocks is searched, which moves codes and query vectors but none
of the points'. A pair gives what reaches the bound among its own points; the bound over all blocks then leaves the
candidates, which are scored by joins that fetch their original vectors.
Every row is coded; nothing is fitted but a block's own centroids, and no number of candidates is set. The error bound is
the index's one approximation; recall is measured in the tests and the README.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do rows
without vec_id; rows equal in vec_id and vector are one row; a row never finds rows of its own vec_id; vectors of
unequal length are padded with zeros; ties go to the smaller vec_id; other input columns are ignored; an empty
table gives an empty one. A vec_id with several vectors ranks by its best one, so bounds are counted by different vec_ids.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postura.llm.common import cut, empty
from postura.llm.vectors import align, asked, finite_vectors, matrix

BLOCK = 8192
QUERY_BLOCK = 1024
FIRST_CHOICE = 8
LEVELS = 8
CELLS = 64
CELL_POINTS = 32
ROUNDS = 3
ROUNDING = 1e-13
AT_ONCE = 64
PAIRS_AT_ONCE = 4096
SCHEMA = "query_id long, rank int, vec_id long, score double"
SEED = 20


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(unit: np.ndarray) -> np.ndarray:
    """Up to ``CELLS`` centres of a block's vectors: far vectors are likelier first centres, which then move to the means of their vectors."""
    r = np.random.default_rng(SEED)
    centres = unit.mean(0)[None]
    near = ((unit - centres) ** 2).sum(1)
    for _ in range(min(CELLS, len(unit) // CELL_POINTS) - 1):
        if not near.sum() > 0:
            break
        new = unit[r.choice(len(unit), p=near / near.sum())]
        centres = np.concatenate([centres, new[None]])
        near = np.minimum(near, ((unit - new) ** 2).sum(1))
    for _ in range(ROUNDS):
        own = nearest_centre(unit, centres) == np.arange(len(centres))[:, None]
        count = own.sum(1)
        centres = np.where(count[:, None] > 0, (own.astype(np.float64) @ unit) / np.maximum(1, count)[:, None], centres)
    return centres


def nearest_centre(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (unit @ centres.T - (centres**2).sum(1) / 2).argmax(1)


class Codes:
    """One-bit codes of unit vectors in ``levels``: more levels, smaller errors. Vectors are in the order of ``ids``."""

    def __init__(self, unit: np.ndarray, ids: np.ndarray, levels: int) -> None:
        n, self.wide = unit.shape
        self.dims = -(-self.wide // 8) * 8
        self.starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        self.centroids = centroids(unit)
        self.cell = nearest_centre(unit, self.centroids).astype(np.int16)
        near = self.centroids[self.cell]
        residual = unit - near
        rest, self.bits, self.sizes = np.pad(residual, ((0, 0), (0, self.dims - self.wide))), [], []
        for _ in range(levels):
            rest = rest @ rotation(self.dims)
            self.bits.append(np.packbits(rest > 0, axis=1, bitorder="little"))
            self.sizes.append(np.abs(rest).mean(1).astype(np.float32))
            rest = rest - self.level(-1)
        coded = self.decoded()
        along = (residual * coded).sum(1)
        self.scale = np.divide((residual**2).sum(1), along, out=np.zeros(n), where=along > 0)
        left = residual - self.scale[:, None] * coded
        self.left = np.sqrt((left**2).sum(1))
        self.shift = (near * left).sum(1)

    def level(self, at: int) -> np.ndarray:
        """One level's codes, unpacked to plus and minus the size."""
        return (np.unpackbits(self.bits[at], axis=1, bitorder="little") * 2.0 - 1) * self.sizes[at][:, None]

    def decoded(self) -> np.ndarray:
        """The residuals as the codes have them, without their scale."""
        out = np.zeros((len(self.cell), self.dims))
        for at in reversed(range(len(self.bits))):
            out = (out + self.level(at)) @ rotation(self.dims).T
        return out[:, : self.wide]

    def vectors(self) -> np.ndarray:
        """The unit vectors as the codes have them."""
        return self.centroids[self.cell] + self.scale[:, None] * self.decoded()

    def estimate(self, queries: np.ndarray, vectors: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with unit queries, and how far they may be off."""
        q, v = align(queries, vectors)
        middle = q @ v.T + self.shift
        # off = reach * distance, and distance^2 = 2 - 2 (middle - off) at most
        reach = (spread * self.left / math.sqrt(self.dims - 1)) ** 2
        off = reach + np.sqrt(reach * (reach + 2 * np.maximum(0, 1 - middle))) + ROUNDING
        return middle, off

    def floors(self, lower: np.ndarray, least: int) -> np.ndarray:
        """The bound that ``least`` different ids reach, for each row of lower bounds."""
        best = lower if len(self.starts) == lower.shape[1] else np.maximum.reduceat(lower, self.starts, axis=1)
        if best.shape[1] < least:
            return np.full(len(best), -np.inf)
        return np.partition(best, -least, axis=1)[:, -least]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision."""
    norm = lambda m: np.sqrt((m * m).sum(1))
    with np.errstate(over="ignore", under="ignore", divide="ignore", invalid="ignore"):
        out = (a * b).sum(1) / (norm(a) * norm(b))
    odd = ~np.isfinite(out)
    if odd.any():  # squares beyond the range of doubles: the cosine of the same vectors scaled to 1
        a, b = (m[odd] / np.abs(m[odd]).max(1, keepdims=True) for m in (a, b))
        out[odd] = (a * b).sum(1) / (norm(a) * norm(b))
    return out


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1))[:, None]


def promising(codes: Codes, queries: np.ndarray, least: int, spread: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(query row, point, estimate, lower bound, upper bound) of each unit query's points whose upper bound reaches the lower bounds
    of ``least`` different ids, some queries at a time."""
    vectors = codes.vectors()
    for at in range(0, len(queries), AT_ONCE):
        middle, off = codes.estimate(queries[at : at + AT_ONCE], vectors, spread)
        lower, upper = middle - off, middle + off
        near = upper >= codes.floors(lower, least)[:, None]
        rows, found = np.nonzero(near)
        yield rows + at, found, middle[near], lower[near], upper[near]


def _encode(levels: int):
    """One block's points to one row with their codes."""

    def encode(block: pa.Table) -> pa.Table:
        block = block.sort_by([("id", "ascending"), ("point", "ascending")])
        ids = block["id"].to_numpy()
        coded = pickle.dumps((Codes(unit(matrix(block["vector"])), ids, levels), block["point"].to_numpy(), ids), protocol=5)
        return pa.table({"d": block["d"][:1], "codes": pa.array([coded], pa.binary())})

    return encode


def _gather(block: pa.Table) -> pa.Table:
    """One block's queries to one row."""
    asked_for = pickle.dumps((unit(matrix(block["vector"])), block["query"].to_numpy()), protocol=5)
    return pa.table({"q": block["q"][:1], "queries": pa.array([asked_for], pa.binary())})


def _within_bounds(least: int, spread: float):
    def pair(queries: pa.Table, data: pa.Table) -> pa.Table:
        vectors, asking = pickle.loads(queries["queries"][0].as_py())
        codes, points, ids = pickle.loads(data["codes"][0].as_py())
        names = ["query", "point", "id", "estimate", "lower", "upper"]
        some = promising(codes, vectors, least, spread)
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(x) for x in (asking[rows], points[found], ids[found], *bounds)], names) for rows, found, *bounds in some])

    return pair


def _scored(pairs: DataFrame, queries: DataFrame, points: DataFrame) -> DataFrame:
    """(query, point, ids, score): exact cosines on the original vectors of ``pairs(query, point)``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS_AT_ONCE):
                rows = batch.slice(at, PAIRS_AT_ONCE)
                a, b = align(matrix(rows.column("asked")), matrix(rows.column("vector")))
                columns = [rows.column(c) for c in ("query", "point", "ids")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cosines(a, b))], names=["query", "point", "ids", "score"])

    both = pairs.join(points.select("point", "vector", "ids"), "point").join(queries.select("query", F.col("vector").alias("asked")), "query")
    return both.mapInArrow(run, "query long, point long, ids array<long>, score double")


def approximate_nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, spread: float = 3.0, levels: int = LEVELS, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """For each row whose vec_id is divisible by ``every`` its k nearest others found: query_id, rank, vec_id, score."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    rows = finite_vectors(vectors, "float" if element == "float" else "double").filter(F.exists("vector", lambda x: x != 0))
    rows = cut(rows.distinct())
    copies = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= k + 1)
    # at most k + 1 ids each; numbered once they are written
    points = cut(kept.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))).withColumn("point", F.monotonically_increasing_id())
    asking = rows.filter(asked(F.col("vec_id"), every)).distinct()
    members = cut(asking.join(points.select("vector", "point"), "vector").select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"), "vector"))
    queries = members.select("query", "vector").dropDuplicates(["query"])
    # two numbers, for the sizes of the blocks
    n, m = points.count(), queries.count()
    if not n or not m:
        return empty(vectors.sparkSession, SCHEMA)
    blocks, query_blocks = math.ceil(n / block), math.ceil(m / query_block)

    def deal(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def every_one(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    dealt = points.select(deal("point", blocks).alias("d"), "point", F.col("ids")[0].alias("id"), "vector")
    codes = cut(dealt.groupBy("d").applyInArrow(_encode(levels), "d int, codes binary")).withColumn("q", every_one(query_blocks))
    gathered = queries.withColumn("q", deal("query", query_blocks)).groupBy("q").applyInArrow(_gather, "q int, queries binary").withColumn("d", every_one(blocks))
    pairs = gathered.groupBy("d", "q").cogroup(codes.groupBy("d", "q"))
    # k + 1 different ids are k others at least
    bounds = pairs.applyInArrow(_within_bounds(k + 1, spread), "query long, point long, id long, estimate double, lower double, upper double").repartition("query")
    of_query, of_id = Window.partitionBy("query"), Window.partitionBy("query", "id")
    by_lower, by_estimate = (of_query.orderBy(F.desc(c), "point") for c in ("lower", "estimate"))
    bounds = bounds.withColumn("leads", (F.row_number().over(of_id.orderBy(F.desc("lower"), "point")) == 1).cast("int"))
    bounds = bounds.withColumn("ids", F.sum("leads").over(by_lower.rowsBetween(Window.unboundedPreceding, 0)))
    bounds = bounds.withColumn("floor", F.max(F.when((F.col("leads") == 1) & (F.col("ids") == k + 1), F.col("lower"))).over(of_query))
    within = bounds.filter("floor is null or upper >= floor").withColumn("n", F.row_number().over(by_estimate))
    candidates = cut(within.select("query", "point", "upper", "n"))
    few = FIRST_CHOICE * (k + 1)
    first = cut(_scored(candidates.filter(F.col("n") <= few).select("query", "point"), queries, points))
    # a query's own id may be its best, so that the score to beat is that of the id after the kth
    each_id = first.select("query", F.explode("ids").alias("id"), "score").groupBy("query", "id").agg(F.max("score").alias("score"))
    beat = F.row_number().over(of_query.orderBy(F.desc("score")))
    floors = each_id.withColumn("n", beat).filter(F.col("n") == k + 1).select("query", F.col("score").alias("floor"))
    others = candidates.filter(F.col("n") > few).join(floors, "query", "left").filter("floor is null or upper >= floor").select("query", "point")
    more = _scored(others, queries, points)
    found = first.union(more).withColumn("vec_id", F.explode("ids")).select("query", "vec_id", "score")
    answered = members.select("query_id", "query").join(found, "query").filter("vec_id <> query_id")
    best = answered.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
