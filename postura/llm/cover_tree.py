"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are quantised to integers, floor(scale * x), and the score is the integer inner product.

Method: queries and data are both indexed by cover trees. A node is a vector of its own and the radius
that covers all vectors below it; its children are separated by, and covered within, half of the
scale above. For a pair of a query node and a data node no score can exceed
<q, d> + rq |d| + rd |q| + rq rd; the pair falls, with all that is below it, once that is under the worst kth score
of the query node's queries. Pairs are visited by falling bound.

On Spark: equal vectors are one point that keeps its k + 1 smallest ids, as a later copy can't be among the best k
of any query but its own. Points are dealt to the nearest of a few pivots, and the points of a pivot that has too many to the nearest of
a few of their own, again and again, so that a block holds points near each other at any size; a block has one tree, in one
row. Queries are dealt likewise. Each query block is first searched against the block that holds most of its queries,
which gives every query a kth score to beat. The bound between the blocks' roots then tells which other blocks
can hold better ones; only those pairs move, one pair at a time. That is a join of a stated query set, in
blocks, against blocks of all rows; the roots meet in packets, so that a query block's root travels once a packet.

Defined results: vectors that are null, or hold null or non-finite components, take no part, nor do rows without
vec_id; rows equal in vec_id and vector are one row; a row never finds rows of its own vec_id; vectors of
unequal length are padded with zeros; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postura.llm.common import cut, empty, join_small
from postura.llm.vectors import align, asked, finite_vectors, matrix

PIVOTS = 16
DEPTH = 12
PACKET = 256
BLOCK = 2048
QUERY_BLOCK = 1024
PIECE = 50_000
LEAF = 24
NET_ROWS = 512
EXACT = 2.0**53
SCHEMA = "query_id long, rank int, vec_id long, score long"


class CoverTree:
    """Cover tree over the rows of a matrix, which are put in tree order: a node's points are adjacent."""

    def __init__(self, points: np.ndarray, ids: list[list[int]]) -> None:
        n = len(points)
        self.center: list[int] = []
        self.radius: list[float] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[list[int]] = []
        order = np.arange(n)

        squares = (points**2).sum(1)
        # distances come from inner products; so much may rounding take from one
        slack = 1e-6 * (1 + math.sqrt(float(squares.max(initial=0))))

        def add(at: int, end: int, center: int, far: np.ndarray) -> int:
            """Node over order[at:end]; far: their distances from its center."""
            node = len(self.center)
            self.center.append(center)
            self.radius.append(float(far.max()) + slack if end - at > 1 else 0.0)
            self.first.append(at)
            self.last.append(end)
            self.children.append([])
            return node

        def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
            d = squares[rows][:, None] + squares[centers] - 2 * (points[rows] @ points[centers].T)
            return np.sqrt(np.maximum(d, 0))

        def net(rows: np.ndarray, start: int, reach: float) -> np.ndarray:
            """Centers among the rows, ``start`` first: each beyond ``reach`` of the others, every row within it of one."""
            centers = np.array([start])
            for at in range(0, len(rows), NET_ROWS):
                some = rows[at : at + NET_ROWS]
                left = some[distances(some, centers).min(1) > reach]
                near = distances(left, left) <= reach
                free, new = np.ones(len(left), bool), []
                for i in range(len(left)):
                    if free[i]:
                        new.append(i)
                        free &= ~near[i]
                centers = np.r_[centers, left[new]]
            return centers

        if n:
            middle = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
            stack = [add(0, n, middle, distances(order, np.array([middle])))]
            while stack:
                node = stack.pop()
                at, end, reach = self.first[node], self.last[node], (self.radius[node] - slack) / 2
                if end - at <= LEAF or reach <= slack:
                    continue
                rows = order[at:end].copy()
                centers = net(rows, self.center[node], reach)
                nearest, near = np.empty(len(rows), np.int64), np.empty(len(rows))
                for k in range(0, len(rows), NET_ROWS):
                    d = distances(rows[k : k + NET_ROWS], centers)
                    nearest[k : k + NET_ROWS], near[k : k + NET_ROWS] = d.argmin(1), d.min(1)
                by = np.argsort(nearest, kind="stable")
                order[at:end], far = rows[by], near[by]
                sizes = np.bincount(nearest, minlength=len(centers))
                begin = at
                for center, size in zip(centers.tolist(), sizes.tolist(), strict=True):
                    if size:
                        child = add(begin, begin + size, center, far[begin - at : begin - at + size])
                        self.children[node].append(child)
                        stack.append(child)
                        begin += size
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.points = points[order]
        self.ids = [ids[i] for i in order]
        self.centers = self.points[place[np.array(self.center, np.int64)]] if n else points
        self.radii = np.array(self.radius)
        self.norms = np.sqrt((self.centers**2).sum(1))


    def __getstate__(self) -> dict:
        state = self.__dict__.copy()
        for name in ("points", "centers"):  # whole numbers travel in the narrowest type that holds them
            m = state[name]
            most = np.abs(m).max(initial=0)
            if most < 1 << 31 and (m == np.rint(m)).all():
                state[name] = m.astype(np.int16 if most < 1 << 15 else np.int32)
        return state

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.points, self.centers = self.points.astype(np.float64), self.centers.astype(np.float64)


class Best:
    """The best points so far of each query: scores falling, ties by the point's smallest id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.point = np.full((queries, k), -1)
        self.floor = floor.astype(np.float64)

    def worst(self, queries: np.ndarray | slice) -> np.ndarray:
        return np.maximum(self.score[queries, -1], self.floor[queries])

    def offer(self, queries: np.ndarray, points: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """scores[i, j]: of query queries[i] and point points[j], whose smallest id is ids[j]."""
        k = self.k
        cutoff = self.worst(queries)
        if scores.shape[1] > k:
            cutoff = np.maximum(cutoff, -np.partition(-scores, k - 1, axis=1)[:, k - 1])
        row, col = np.nonzero(scores >= cutoff[:, None])
        n = len(queries)
        all_row = np.r_[np.repeat(np.arange(n), k), row]
        all_score = np.r_[self.score[queries].ravel(), scores[row, col]]
        all_id = np.r_[self.id[queries].ravel(), ids[col]]
        all_point = np.r_[self.point[queries].ravel(), points[col]]
        order = np.lexsort((all_id, -all_score, all_row))
        sizes = np.bincount(all_row, minlength=n)
        inside = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = order[inside < k]
        self.score[queries], self.id[queries], self.point[queries] = (x[order].reshape(n, k) for x in (all_score, all_id, all_point))


def search(queries: CoverTree, data: CoverTree, k: int, floor: np.ndarray) -> Best:
    """The k best points of every query whose score is at least the query's floor."""
    best = Best(len(queries.points), k, floor)
    if not len(queries.points) or not len(data.points):
        return best
    q, d = align(queries.points, data.points)
    qc, dc = align(queries.centers, data.centers)
    exact = np.abs(q).max() * np.abs(d).max() * q.shape[1] < EXACT
    if not exact:  # beyond doubles: every score in Python's integers, without bounds
        whole = np.array([[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in d] for x in q], object)
        if max(abs(s) for row in whole for s in row) >= 1 << 63:
            raise OverflowError("a score does not fit 64 bits")
    smallest = np.array([i[0] for i in data.ids])

    def visit(a: int, b: int) -> None:
        ca, cb = np.array(queries.children[a] or [a]), np.array(data.children[b] or [b])
        ra, rb, na, nb = queries.radii[ca], data.radii[cb], queries.norms[ca], data.norms[cb]
        top = qc[ca] @ dc[cb].T
        bound = top + np.outer(ra, nb) + np.outer(na, rb) + np.outer(ra, rb)
        bound += np.abs(bound) * 1e-9 + 1e-6
        leaf_a = np.array([not queries.children[i] for i in ca])
        leaf_b = np.array([not data.children[i] for i in cb])
        alive = bound >= np.array([best.worst(slice(queries.first[i], queries.last[i])).min() for i in ca])[:, None]
        both = alive & leaf_a[:, None] & leaf_b
        if both.any():
            rows = np.concatenate([np.arange(queries.first[i], queries.last[i]) for i in ca[both.any(1)]])
            cols = np.concatenate([np.arange(data.first[i], data.last[i]) for i in cb[both.any(0)]])
            best.offer(rows, cols, smallest[cols], q[rows] @ d[cols].T)
        deeper = np.argwhere(alive & ~both)
        for i, j in deeper[np.argsort(-bound[deeper[:, 0], deeper[:, 1]], kind="stable")].tolist():
            node = slice(queries.first[ca[i]], queries.last[ca[i]])
            if bound[i, j] >= best.worst(node).min():
                visit(int(ca[i]), int(cb[j]))

    if exact:
        visit(0, 0)
    else:
        best.offer(np.arange(len(q)), np.arange(len(d)), smallest, whole.astype(np.float64))
        best.whole = whole
    return best


def _plant(block: pa.Table) -> pa.Table:
    """One block's points to one row with its tree."""
    tree = CoverTree(matrix(block["vector"]), [sorted(set(i)) for i in block["ids"].to_pylist()])
    return pa.table(
        {
            "block": block["block"][:1],
            "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary()),
            "root": pa.array([tree.centers[0].tolist()], pa.list_(pa.float64())),
            "radius": pa.array([tree.radius[0]]),
        }
    )


def _hunt(k: int):
    """A query block (query_block, query_tree, floors) and a block (tree) to (query_block, query point, score, vec_id)."""

    def pair(asking: pa.Table, asked_of: pa.Table) -> pa.Table:
        queries, data = pickle.loads(asking["query_tree"][0].as_py()), pickle.loads(asked_of["tree"][0].as_py())
        own = [i[0] for i in queries.ids]
        known = dict((f["query"], f["floor"]) for f in asking["floors"][0].as_py() or [])
        found = search(queries, data, k, np.array([known.get(i, -np.inf) for i in own], np.float64))
        out: list[tuple[int, int, int]] = []
        whole = getattr(found, "whole", None)
        for n, query in enumerate(own):
            entries = sorted((-(int(s) if whole is None else int(whole[n][p])), i) for s, p in zip(found.score[n], found.point[n].tolist(), strict=True) if p >= 0 for i in data.ids[p])
            out += [(query, -s, i) for s, i in entries[:k]]
        numbers = [pa.array([r[c] for r in out], pa.int64()) for c in range(3)]
        return pa.table([pa.repeat(asking["query_block"][0], len(out)), *numbers], names=["query_block", "query", "score", "vec_id"])

    return pair


def _to_nearest(points: pa.Table, pivots: pa.Table) -> pa.Table:
    """Some points of a home to the homes below it: one for each of its pivots."""
    x, p = align(matrix(points["vector"]), matrix(pivots["pivot"]))
    p = p[np.argsort(pivots["number"].to_numpy())]
    nearest = np.argmin((p**2).sum(1) - 2 * (x @ p.T), axis=1)
    own = points["home"][0].as_py()
    home = pa.array([f"{own}{n:x}" for n in nearest.tolist()], pa.string())
    whole = pa.list_(pa.int64())
    return pa.table({"vector": points["vector"].cast(whole), "ids": points["ids"].cast(whole), "home": home})


def dealt(points: DataFrame, size: int, pivots: int = PIVOTS, depth: int = DEPTH) -> DataFrame:
    """``points(vector, ids)`` in blocks of at most ``size`` or so: vector, ids, block.

    A home of more points takes ``pivots`` of them, chosen by hash, and each of its points goes to the home of the nearest.
    The pivots of a home are at most ``pivots`` rows and meet its points in pieces of PIECE. Small homes under one
    parent share a block. A home that is still too large after ``depth`` rounds is dealt by hash: its points lie so
    close together that no bound between them would prune.
    """
    at = cut(points.select("vector", "ids", F.lit("r").alias("home")))
    for _ in range(depth):
        large = cut(at.groupBy("home").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size))
        if not large.limit(1).count():
            break
        pieces = F.ceil(F.col("n") / PIECE).cast("int")
        splitting = join_small(at, large, ["home"])
        number = F.row_number().over(Window.partitionBy("home").orderBy(F.xxhash64("vector"), "vector"))
        chosen = splitting.withColumn("number", number).filter(F.col("number") <= pivots).select("home", "vector", "number", "n")
        chosen = chosen.select(F.col("home").alias("of"), F.col("vector").alias("pivot"), "number", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("one"))
        own = splitting.withColumn("piece", F.pmod(F.xxhash64("vector"), pieces.cast("long")).cast("int")).select("vector", "ids", "home", "piece")
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in at.schema.fields)
        moved = own.groupBy("home", "piece").cogroup(chosen.groupBy("of", "one")).applyInArrow(_to_nearest, types)
        few = large.limit(100_001).count() <= 100_000
        at = cut(at.join(F.broadcast(large) if few else large, "home", "left_anti").select(*at.columns).union(moved))
    homes = at.groupBy("home").agg(F.count(F.lit(1)).alias("n")).withColumn("parent", F.expr("substring(home, 1, length(home) - 1)"))
    # at most ``pivots`` rows a parent
    before = F.coalesce(F.sum("n").over(Window.partitionBy("parent").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = homes.select("home", F.when(F.col("n") > size, F.col("home")).otherwise(F.concat("parent", F.lit("/"), F.floor(before / size).cast("string"))).alias("name"), "n")
    joined = join_small(at, cut(shared), ["home"])
    part = F.when(F.col("n") > size, F.pmod(F.xxhash64("vector"), F.ceil(F.col("n") / size))).otherwise(0)
    return joined.select("vector", "ids", F.concat("name", F.lit("."), part.cast("string")).alias("block"))


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, block: int = BLOCK, query_block: int = QUERY_BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """For each row whose vec_id is divisible by ``every`` its k best others: query_id, rank, vec_id, score."""
    spark: SparkSession = vectors.sparkSession
    quantised = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    rows = cut(finite_vectors(vectors, "double").select("vec_id", quantised.alias("vector")))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("nth", F.dense_rank().over(copies)).filter(F.col("nth") <= k + 1)
    # at most k + 1 ids each
    points = kept.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    asking = rows.filter(asked(F.col("vec_id"), every))
    query_points = cut(asking.groupBy("vector").agg(F.min("vec_id").alias("query")))
    if not query_points.limit(1).count():
        return empty(spark, SCHEMA)
    data = cut(dealt(points, block, pivots))
    queries = cut(dealt(query_points.select("vector", F.array("query").alias("ids")), query_block, pivots))
    row = "block string, tree binary, root array<double>, radius double"
    trees = cut(data.groupBy("block").applyInArrow(_plant, row))
    query_trees = cut(queries.groupBy("block").applyInArrow(_plant, row)).toDF("query_block", "query_tree", "query_root", "query_radius")
    # the block that holds most of a query block's queries
    homes = queries.select("vector", F.col("block").alias("query_block")).join(data.select("vector", "block"), "vector").groupBy("query_block", "block").agg(F.count(F.lit(1)).alias("n"))
    first = cut(homes.groupBy("query_block").agg(F.max_by("block", F.struct("n", "block")).alias("done")))

    def hunted(pairs: DataFrame, floors: DataFrame) -> DataFrame:
        """Results of pairs (query_block, block): each pair's two trees meet alone."""
        key = ["query_block", "block"]
        asking_side = pairs.join(query_trees.select("query_block", "query_tree"), "query_block").join(floors, "query_block", "left")
        asked_side = pairs.join(trees.select("block", "tree"), "block").select(F.col("query_block").alias("a"), F.col("block").alias("b"), "tree")
        return asking_side.groupBy(*key).cogroup(asked_side.groupBy("a", "b")).applyInArrow(_hunt(k + 1), "query_block string, query long, score long, vec_id long")

    no_floors = query_trees.select("query_block", F.expr("cast(null as array<struct<query:long,floor:long>>)").alias("floors"))
    home = cut(hunted(first.withColumnRenamed("done", "block"), no_floors))
    kth = home.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).filter(F.col("n") == k + 1)
    # at most a query block's queries each
    known = cut(kth.groupBy("query_block").agg(F.collect_list(F.struct("query", F.col("score").alias("floor"))).alias("floors"), F.min("score").alias("least"), F.count(F.lit(1)).alias("n")))
    asked_for = queries.groupBy(F.col("block").alias("query_block")).agg(F.count(F.lit(1)).alias("queries"))
    least = asked_for.join(known, "query_block", "left").select("query_block", F.when(F.col("n") == F.col("queries"), F.col("least")).alias("least"))
    pairs = cut(_close_pairs(query_trees.drop("query_tree").join(least, "query_block"), trees.drop("tree")).join(first, "query_block").filter("block <> done").select("query_block", "block"))
    others = hunted(pairs, known.select("query_block", "floors"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    merged = home.union(others).select("query", "score", "vec_id").withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    members = asking.distinct().join(query_points, "vector").select(F.col("vec_id").alias("query_id"), "query")
    answered = members.join(merged, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answered.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _close_pairs(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs (query_block, block) whose roots' bound reaches the least score that the query block has to beat (null: any).
    Blocks come in packets of about PACKET roots, and a query block's root meets each packet once."""
    packets = max(1, math.ceil(blocks.count() / PACKET))
    packed = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(packets)).cast("int").alias("packet")).agg(F.collect_list(F.struct("block", "root", "radius")).alias("roots"))
    met = queries.withColumn("packet", F.explode(F.sequence(F.lit(0), F.lit(packets - 1)))).join(packed, "packet")
    met = met.select("query_block", "query_root", "query_radius", "least", F.inline("roots"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("query_root", "root", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    bound = dot + F.col("query_radius") * norm(F.col("root")) + F.col("radius") * norm(F.col("query_root")) + F.col("query_radius") * F.col("radius")
    return met.filter(F.col("least").isNull() | (bound + F.abs(bound) * 1e-9 + 1e-6 >= F.col("least"))).select("query_block", "block")
