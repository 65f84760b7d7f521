"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree splits space by hyperplanes through pairs of sample vectors' midpoints (unit vectors, normal to the pair's
difference); its leaves are buckets of vectors.  A query walks all trees at once with one priority queue: the queue holds
subtrees of any tree by the least margin by which the query would have to be moved to get there, the best one is opened
next, and leaves are taken until their different vectors number ``share`` of all and at least ``least`` (a tree; copies
count once).  All candidates are
then ranked exactly, by cosine in double precision of the original vectors.

Scale: the trees are fitted on at most ``SAMPLE`` vectors, have a fixed number of leaves, and are broadcast; every row is
put into a leaf of every tree by one scan.  Leaves meet their queries in blocks: a leaf with many vectors, or with many
queries, is split by a hash into parts of bounded size, so copies of one vector, which share all leaves, do not land in
one task.  A vector is ranked with a query once, in the first of the query's leaves (by tree) that holds it.

On vectors without clusters distances are nearly equal and hyperplanes exclude little, so a high recall needs a great
share of the rows; ``share`` is the parameter that trades the two.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those whose
length differs from the most frequent one; a null id takes no part; repeated rows are separate candidates with equal ids
(a query's own id is never one) and one query; ties go to the smaller id; with fewer candidates than ``k`` all are returned; an empty
table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlab.llm.tables import written

TREES = 8
DEPTH = 7
SAMPLE = 10_000
SHARE = 0.15
LEAST = 500
BLOCK_VECTORS = 20_000
BLOCK_QUERIES = 4_000


@dataclass
class Forest:
    """Complete binary trees: inner node i of a tree has children 2i + 1 and 2i + 2."""

    normals: np.ndarray  # trees x inner nodes x dims
    offsets: np.ndarray  # trees x inner nodes

    @property
    def depth(self) -> int:
        return (self.normals.shape[1] + 1).bit_length() - 1

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree (n x trees)."""
        out = np.zeros((len(unit), len(self.normals)), dtype=np.int32)
        for t, (normal, offset) in enumerate(zip(self.normals, self.offsets)):
            side = unit @ normal.T > offset  # all inner nodes at once
            node = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + side[np.arange(len(unit)), node]
            out[:, t] = node - len(offset)
        return out

    def search(self, unit: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order in which the shared queue gives them, until ``wanted`` rows are reached."""
        margin = np.einsum("tnd,d->tn", self.normals, unit) - self.offsets
        inner = margin.shape[1]
        queue = [(0.0, t, 0) for t in range(len(margin))]
        found, rows = [], 0
        while queue and rows < wanted:
            cost, tree, node = heapq.heappop(queue)
            while node < inner:
                m = margin[tree, node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(cost, abs(m)), tree, 4 * node + 3 - near))
                node = near
            found.append((tree, node - inner))
            rows += int(sizes[tree, node - inner])
        return found


def fit_forest(unit: np.ndarray, trees: int, depth: int, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    dims = unit.shape[1]
    normals, offsets = np.zeros((trees, inner, dims)), np.zeros((trees, inner))
    for t in range(trees):
        members = {0: np.arange(len(unit))}
        for node in range(inner):
            own = members.pop(node)
            if len(own) >= 2:
                a, b = unit[rng.choice(own, 2, replace=False)]
                normal = a - b
            else:
                normal = np.zeros(dims)
            length = np.linalg.norm(normal)
            normal = normal / length if length > 1e-9 else rng.normal(size=dims) / np.sqrt(dims)
            projected = unit[own] @ normal
            # The split is the median, so a tree is balanced over the sample.
            offsets[t, node] = np.median(projected) if len(own) else 0.0
            normals[t, node] = normal
            right = projected > offsets[t, node]
            members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
    return Forest(normals, offsets)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the vectors that take part."""
    v = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.cast("array<double>").alias("vector")).where("id is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (length["n"] if length else 0)).select("id", "vector")


def _units(matrix: np.ndarray) -> np.ndarray:
    big = np.abs(matrix).max(axis=1, keepdims=True)
    scaled = matrix / np.where(big > 0, big, 1)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of every pair, in double precision; sums run over components in order, whatever the block's shape."""
    dot = np.zeros((len(queries), len(vectors)))
    q2, v2 = np.zeros(len(queries)), np.zeros(len(vectors))
    for d in range(queries.shape[1]):
        dot += queries[:, d, None] * vectors[None, :, d]
        q2 += queries[:, d] ** 2
        v2 += vectors[:, d] ** 2
    return dot / (np.sqrt(q2)[:, None] * np.sqrt(v2)[None, :])


def nearest(vectors: DataFrame, is_query, k: int = 5, trees: int = TREES, depth: int = DEPTH, share: float = SHARE, least: int = LEAST,
            id_col: str = "vec_id", vector_col: str = "embedding", block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``is_query`` (a condition on column ``id``) the ``k`` most similar
    other rows among the forest's candidates."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).collect()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if len(sample) < 2:
        return spark.createDataFrame([], result)
    forest = spark.sparkContext.broadcast(fit_forest(_units(_matrix([r["vector"] for r in sample])), trees, depth))

    @F.pandas_udf("array<int>")
    def leaves_of(vector: pd.Series) -> pd.Series:
        return pd.Series(list(forest.value.leaves(_units(_matrix(vector)))))

    placed, _ = written(rows.withColumn("leaves", leaves_of("vector")), "leaves")
    # At most trees * 2^depth rows: how many vectors a leaf holds, and about how many different ones.
    counts = (placed.select(F.posexplode("leaves").alias("tree", "leaf"), F.xxhash64("vector").alias("value")).groupBy("tree", "leaf")
              .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("value", 0.02).alias("different")).collect())
    rows_in, sizes = (np.zeros((trees, 1 << depth), dtype=np.int64) for _ in range(2))
    for r in counts:
        rows_in[r["tree"], r["leaf"]], sizes[r["tree"], r["leaf"]] = r["n"], r["different"]
    wanted = trees * max(least, int(np.ceil(share * sizes[0].sum())))
    shared_sizes = spark.sparkContext.broadcast(sizes)

    @F.pandas_udf("array<int>")
    def visits_of(vector: pd.Series) -> pd.Series:
        """Leaves to look into, as tree * 2^depth + leaf."""
        out = []
        for unit in _units(_matrix(vector)):
            out.append(np.array([t << depth | leaf for t, leaf in forest.value.search(unit, shared_sizes.value, wanted)], dtype=np.int32))
        return pd.Series(out)

    queries, _ = written(placed.where(is_query).dropDuplicates(["id"]).withColumn("visits", visits_of("vector")).drop("leaves"), "queries")
    asked = queries.select(F.explode("visits").alias("leaf")).groupBy("leaf").count().collect()
    parts = {r["leaf"]: (-(-int(rows_in[r["leaf"] >> depth, r["leaf"] & ((1 << depth) - 1)]) // block_vectors), -(-r["count"] // block_queries)) for r in asked}
    return _ranked(placed, queries, parts, depth, k).select("query_id", "rank", "vec_id", "score")


def _ranked(placed: DataFrame, queries: DataFrame, parts: dict[int, tuple[int, int]], depth: int, k: int) -> DataFrame:
    """Exact ranks of the candidates, block by block.

    ``parts``: into how many parts each visited leaf's vectors and queries are dealt; a block is a pair of parts.
    """
    spark = placed.sparkSession
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    table = F.broadcast(spark.createDataFrame([(leaf, v, q) for leaf, (v, q) in sorted(parts.items())], "leaf int, v_parts int, q_parts int"))
    vectors = placed.select("id", "vector", "leaves", F.posexplode("leaves").alias("_tree", "_leaf"))
    vectors = vectors.withColumn("leaf", F.col("_tree") * (1 << depth) + F.col("_leaf")).join(table, "leaf")
    vectors = vectors.select("id", "vector", "leaves", "leaf", F.pmod(F.xxhash64("id"), "v_parts").cast("int").alias("v"), F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q"))
    visiting = queries.select("id", "vector", "visits", F.explode("visits").alias("leaf")).join(table, "leaf")
    visiting = visiting.select("id", "vector", "visits", "leaf", F.pmod(F.xxhash64("id"), "q_parts").cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.col("v_parts") - 1)).alias("v"))

    def rank(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = int(found["leaf"].iloc[0]) >> depth
        ids, homes, matrix = found["id"].to_numpy(), np.stack(found["leaves"].to_list()), _matrix(found["vector"])
        earlier = homes[:, :tree] + (np.arange(tree) << depth)
        out: tuple[list, list, list] = ([], [], [])
        for at in range(0, len(asked), 64):
            some = asked.iloc[at:at + 64]
            score = cosines(_matrix(some["vector"]), matrix)
            for (query_id, visits), line in zip(zip(some["id"], some["visits"]), score):
                line = np.where(ids == query_id, -np.inf, line)
                if tree:  # ranked already where an earlier tree holds it
                    visited = np.zeros(len(homes[0]) << depth, dtype=bool)
                    visited[visits] = True
                    line[visited[earlier].any(axis=1)] = -np.inf
                live = np.flatnonzero(line > -np.inf)
                if len(live) > k:
                    bound = -np.partition(-line[live], k - 1)[k - 1]
                    live = live[line[live] >= bound]
                    live = live[np.lexsort((ids[live], -line[live]))[:k]]
                out[0].extend([query_id] * len(live))
                out[1].extend(ids[live].tolist())
                out[2].extend(line[live].tolist())
        return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    key = ["leaf", "v", "q"]
    scored = vectors.groupBy(*key).cogroup(visiting.groupBy(*key)).applyInPandas(rank, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def op4_ann_forest(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of every row of embeddings whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)
