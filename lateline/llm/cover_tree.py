"""Exact top-k search by inner product with two cover trees gone through together.

A bounded sample of vectors gives the tree's centres: farthest-first order, cut into levels of halving distance, so that
centres of a level lie apart by its distance and cover the sample within it. Every vector, sample or not, goes to its
nearest centre; the covering radius of a node is then measured over all vectors below it, once for queries and once for
data. For any query q below a node with centre a and radius r, and any vector below a node with centre b and radius s,
the inner product is at most a.b + r|b| + s|a| + rs.

Search begins with each query group and one data block near it, which gives every query a k-th score to beat. The two
trees are then gone through as pairs of nodes, from the roots: a pair whose bound is below the worst k-th score of its
queries is dropped with all pairs beneath it, others are split at the wider node. What is left are pairs of query blocks
and data blocks; a task holds one of each and multiplies them, after one more test with the block's own ball and each
query's own score. The pruning never loses a result; on vectors without structure it prunes little, and the search is
then the product of queries and data, block by block.

The driver holds the tree, at most ``CENTRES`` nodes with a radius each, and the pairs of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

SAMPLE, CENTRES = 4_096, 256
DATA_BLOCK, QUERY_BLOCK = 4_096, 1_024
#: Integer components beyond this size could overflow a score; vectors that have one take no part.
LARGEST = 1 << 24
BLOCK = "node int, part long, ids binary, vectors binary, width int, centre binary, radius double"
HITS = "query_id long, vec_id long, score long"


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of each component; null for vectors that take no part."""
    scaled = F.transform(vector, lambda x: F.lit(256.0) * x.cast("double"))
    usable = F.forall(scaled, lambda x: F.coalesce((F.abs(x) <= LARGEST) & ~F.isnan(x), F.lit(False)))
    return F.when(vector.isNotNull() & usable, F.transform(scaled, lambda x: F.floor(x).cast("int")))


@dataclass
class Tree:
    """Nodes in an order that puts parents before children; every node is a centre, and a leaf holds what is nearest."""

    centres: np.ndarray
    parent: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's centre and its distances to all centres."""
        squares = (vectors**2).sum(1)[:, None] - 2 * vectors @ self.centres.T + (self.centres**2).sum(1)
        distances = np.sqrt(np.maximum(squares, 0))
        return distances.argmin(1), distances

    def path(self, node: int) -> list[int]:
        found = [node]
        while self.parent[found[-1]] >= 0:
            found.append(int(self.parent[found[-1]]))
        return found


def padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row[:width]
    return out


def grow(sample: np.ndarray) -> Tree:
    """Farthest-first centres; each hangs below the nearest one of at least twice its own distance."""
    if not len(sample):
        return Tree(np.zeros((1, sample.shape[1])), np.array([-1]))
    chosen, reach = [0], [np.inf]
    distance = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < CENTRES and distance.max() > 0:
        far = int(distance.argmax())
        chosen.append(far)
        reach.append(float(distance[far]))
        distance = np.minimum(distance, np.linalg.norm(sample - sample[far], axis=1))
    centres, reach = sample[chosen], np.array(reach)
    parent = np.full(len(chosen), -1)
    for i in range(1, len(chosen)):
        above = np.flatnonzero(reach[:i] >= 2 * reach[i])
        parent[i] = above[np.linalg.norm(centres[above] - centres[i], axis=1).argmin()]
    return Tree(centres, parent)


def measure(rows: DataFrame, tree: Tree, width: int) -> dict[tuple[int, bool], tuple[int, float]]:
    """Rows below each node and its covering radius over all of them, for queries and for data."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths = [tree.path(n) for n in range(len(tree.centres))]
        found: dict[tuple[int, bool], list] = {}
        for batch in batches:
            leaf, distances = tree.nearest(padded(batch["vector"].tolist(), width))
            for is_query in (False, True):
                own = np.flatnonzero(batch["is_query"].to_numpy()) if is_query else np.arange(len(batch))
                for n in np.unique(leaf[own]):
                    below = own[leaf[own] == n]
                    for node in paths[n]:
                        entry = found.setdefault((node, is_query), [0, 0.0])
                        entry[0] += len(below)
                        entry[1] = max(entry[1], float(distances[below, node].max()))
        yield pd.DataFrame([(n, q, c, r) for (n, q), (c, r) in found.items()], columns=["node", "is_query", "n", "radius"])

    schema = "node int, is_query boolean, n long, radius double"
    summed = rows.mapInPandas(measured, schema).groupBy("node", "is_query").agg(F.sum("n"), F.max("radius"))
    return {(r[0], r[1]): (r[2], r[3]) for r in summed.collect()}  # two rows for each node at most


def blocks_of(tree: Tree, stats: dict, is_query: bool, most: int) -> dict[int, int]:
    """Which block each leaf belongs to, named by a node: the highest node with at most ``most`` rows below it, or the leaf
    itself, which is then split."""
    named = {}
    for leaf in range(len(tree.centres)):
        fitting = [n for n in tree.path(leaf) if stats.get((n, is_query), (0, 0))[0] <= most]
        named[leaf] = fitting[-1] if fitting else leaf
    return named


def cut(rows: DataFrame, tree: Tree, width: int, stats: dict, is_query: bool, most: int) -> DataFrame:
    """Blocks of rows, each packed into one row with its own ball. A block too large for ``most`` is dealt into parts."""
    named = blocks_of(tree, stats, is_query, most)
    total: dict[int, int] = {}
    for leaf, node in named.items():
        own = stats.get((leaf, is_query), (0, 0))[0]
        below = own - sum(stats.get((c, is_query), (0, 0))[0] for c in np.flatnonzero(tree.parent == leaf))
        total[node] = total.get(node, 0) + below
    parts = {node: max(1, -(-n // most)) for node, n in total.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf, _ = tree.nearest(padded(batch["vector"].tolist(), width))
            node = np.array([named[n] for n in leaf.tolist()], dtype=np.int64)
            part = batch["deal"].to_numpy() % np.array([parts[n] for n in node.tolist()], dtype=np.int64)
            yield batch[["vec_id", "vector"]].assign(node=node, part=part)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = padded(pdf["vector"].tolist(), width)
        centre = vectors.mean(0)
        radius = float(np.sqrt(((vectors - centre) ** 2).sum(1).max()))
        ids = pdf["vec_id"].to_numpy(dtype=np.int64)
        row = (pdf["node"].iloc[0], pdf["part"].iloc[0], ids.tobytes(), vectors.astype(np.int32).tobytes(), width, centre.tobytes(), radius)
        return pd.DataFrame([row], columns=["node", "part", "ids", "vectors", "width", "centre", "radius"])

    dealt = (rows.where("is_query") if is_query else rows).withColumn("deal", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)))
    placed = dealt.mapInPandas(place, "vec_id long, vector array<int>, node int, part long")
    return placed.groupBy("node", "part").applyInPandas(pack, BLOCK)


def multiply(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of a data block for each query of a query block that the block can still serve."""

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, d_ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.ids, np.int64)
                q = np.frombuffer(row.q_vectors, np.int32).reshape(len(q_ids), -1).astype(np.float64)
                d = np.frombuffer(row.vectors, np.int32).reshape(len(d_ids), -1).astype(np.float64)
                least = np.frombuffer(row.q_least, np.float64) if row.q_least is not None else np.full(len(q_ids), -np.inf)
                bound = q @ np.frombuffer(row.centre) + np.linalg.norm(q, axis=1) * row.radius
                alive = np.flatnonzero(bound * (1 + 1e-9) + 1 >= least)
                exact = np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * q.shape[1] < 2**53
                scores = (q[alive] @ d.T).astype(np.int64) if exact else q[alive].astype(np.int64) @ d.astype(np.int64).T
                for i, own in zip(alive, scores):
                    fit = np.flatnonzero((own >= least[i]) & (d_ids != q_ids[i]))
                    if len(fit) > k:
                        fit = fit[np.lexsort((d_ids[fit], -own[fit]))[:k]]
                    if len(fit):
                        yield pd.DataFrame({"query_id": q_ids[i], "vec_id": d_ids[fit], "score": own[fit]})

    return pairs.mapInPandas(multiplied, HITS)


def surviving(tree: Tree, stats: dict, q_named: dict, d_named: dict, worst: dict[int, float]) -> list[tuple[int, int]]:
    """Pairs of blocks that the dual traversal leaves. ``worst`` is the least k-th score in each query block."""
    children: dict[int, list[int]] = {}
    for n, p in enumerate(tree.parent.tolist()):
        children.setdefault(p, []).append(n)
    norms = np.linalg.norm(tree.centres, axis=1)
    floor: dict[int, float] = {}
    for leaf in range(len(tree.centres)):
        for n in tree.path(leaf):
            floor[n] = min(floor.get(n, np.inf), worst.get(q_named[leaf], -np.inf))
    found, todo = set(), [(0, 0, False, False)]  # a flag says that only what is nearest to the node itself is left
    while todo:
        a, b, a_own, b_own = todo.pop()
        if (a, True) not in stats or (b, False) not in stats:
            continue
        r, s = stats[a, True][1], stats[b, False][1]
        bound = float(tree.centres[a] @ tree.centres[b]) + r * norms[b] + s * norms[a] + r * s
        if bound * (1 + 1e-9) + 1 < floor[a]:
            continue
        a_whole, b_whole = a_own or q_named[a] != a or not children.get(a), b_own or d_named[b] != b or not children.get(b)
        a_whole, b_whole = a_whole or _closed(q_named, children, a), b_whole or _closed(d_named, children, b)
        if a_whole and b_whole:
            found.add((q_named[a], d_named[b]))
        elif b_whole or (not a_whole and r >= s):
            todo += [(a, b, True, b_own), *((c, b, False, b_own) for c in children[a])]
        else:
            todo += [(a, b, a_own, True), *((a, c, a_own, False) for c in children[b])]
    return sorted(found)


def _closed(named: dict, children: dict, node: int) -> bool:
    """All that is below the node lies in its own block."""
    return all(named[c] == named[node] for c in children.get(node, []))


def top_k(
    vectors: DataFrame, *, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """For each row whose id is divisible by ``every``: its ``k`` best other rows by integer inner product, ties to the
    smaller id: query_id, rank (from 1), vec_id, score. Components are floor(256 x); fewer rows if there are fewer.

    Vectors that are null, or hold a null, a non-finite or a huge component (over 2^24 after scaling), and rows without
    an id take no part. Vectors of different lengths are compared as if the shorter went on with zeros. Of rows with
    the same id the least vector counts. No vectors, or only one: no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "cover_tree")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(embedding)).alias("vector"))
    rows = rows.dropna().groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = scratch.keep(rows.withColumn("is_query", F.col("vec_id") % every == 0), "rows")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("vector").collect()
    tree = grow(padded([np.array(r[0]) for r in sample], width))
    stats = measure(rows, tree, width)
    data = scratch.keep(cut(rows, tree, width, stats, False, DATA_BLOCK), "data")
    queries = scratch.keep(cut(rows, tree, width, stats, True, QUERY_BLOCK), "queries")
    q_named, d_named = (blocks_of(tree, stats, q, most) for q, most in ((True, QUERY_BLOCK), (False, DATA_BLOCK)))

    def paired(pairs: DataFrame, query_side: DataFrame) -> DataFrame:
        """Query blocks go to the data blocks, whose keys spread evenly."""
        sent = query_side.select(
            F.col("node").alias("q_node"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "q_least"
        ).join(F.broadcast(pairs), "q_node")
        return data.join(sent, "node").select("q_ids", "q_vectors", "q_least", "ids", "vectors", "centre", "radius")

    # The first block for each query block: the data block that its centre lies nearest to, of those with enough rows.
    data_nodes = sorted(set(d_named.values()))
    enough = [n for n in data_nodes if stats.get((n, False), (0, 0))[0] > k] or data_nodes
    seeds = []
    for q in sorted(set(q_named.values())):
        if (q, True) in stats:
            seeds.append((q, min(enough, key=lambda n: float(((tree.centres[n] - tree.centres[q]) ** 2).sum()))))
    pair_schema = "q_node int, node int"
    no_least = queries.withColumn("q_least", F.lit(None).cast("binary"))
    first = scratch.keep(multiply(paired(spark.createDataFrame(seeds, pair_schema), no_least), k), "first")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    reached = first.withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select("query_id", "score")

    def with_least(docs: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
        known = dict(zip(scores["query_id"], scores["score"].astype(float)))
        rows = [np.array([known.get(i, -np.inf) for i in np.frombuffer(ids, np.int64)]) for ids in docs["ids"]]
        return docs[["node", "part", "ids", "vectors"]].assign(q_least=[r.tobytes() for r in rows], worst=[float(r.min()) for r in rows])

    members = queries.select("node", "part", F.col("ids")).mapInPandas(
        lambda batches: (
            pd.DataFrame([(n, p, i) for n, p, ids in b.itertuples(index=False) for i in np.frombuffer(ids, np.int64)], columns=["node", "part", "query_id"])
            for b in batches
        ),
        "node int, part long, query_id long",
    )
    scored = members.join(reached, "query_id")
    bounded = scratch.keep(
        queries.groupBy("node", "part").cogroup(scored.groupBy("node", "part"))
        .applyInPandas(with_least, "node int, part long, ids binary, vectors binary, q_least binary, worst double"),
        "bounded",
    )
    worst = {r[0]: r[1] for r in bounded.groupBy("node").agg(F.min("worst")).collect()}  # a row for each query node
    rest = [pair for pair in surviving(tree, stats, q_named, d_named, worst) if pair not in set(seeds)]
    second = multiply(paired(spark.createDataFrame(rest, pair_schema), bounded), k)
    return (
        first.union(second)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
