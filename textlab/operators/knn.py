"""Exact k-nearest neighbours (Q1), and what uses it: KNN-Shapley data valuation (Q2) and SMOTE over-sampling (V6).

Method (euclidean distance, a metric):
1. Copies are collapsed: identical vectors become one representative with its k + 1 smallest member ids (a group of copies
   can be a third of all rows; it is then one representative, not n^2 pairs).
2. ``n_pivots`` representatives (md5 order) are pivots, a bounded array shipped to every task.  Representatives with the same
   nearest pivot are packed into blocks of at most about ``BLOCK_ROWS`` rows, with the block's centre and radius.
3. A row's k + 1 nearest of its own block bound its neighbours' distances from above.  Two blocks whose centres are farther
   apart than their radii and that bound are not compared (triangle inequality).
4. The other pairs of blocks are compared where they lie (``operators.blocks``): one matrix product in single precision finds
   what can be near enough, with a margin for its rounding; these distances are then computed in double precision.

Nothing is capped, so the result equals brute force.  On clustered vectors most pairs of blocks are skipped; on unstructured
vectors of many dimensions no exact method skips much: all pairs are compared, and the time grows with their number.

A null id, and a vector that is null or holds a null or NaN, take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.hashing import h60, hash_key
from textlab.operators.blocks import Nearest, block_rows, pair_blocks
from textlab.operators.splits import exact_rank
from textlab.session import checkpoint_dir

# Rows of a block at most, about.
BLOCK_ROWS = 4096
MAX_PIVOTS = 1024


def _as_double(vec: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def _nearest_pivot(pivots: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half = (pivots * pivots).sum(axis=1) / 2
        for pdf in batches:
            cell = np.zeros(len(pdf), dtype=np.int32)
            for at in range(0, len(pdf), 1024):
                cell[at:at + 1024] = np.argmax(np.stack(pdf["_v"].iloc[at:at + 1024].to_list()) @ pivots.T - half, axis=1)
            yield pdf.assign(cell=cell)
    return run


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of paired rows of two transposed arrays; component order fixes the sums."""
    total = np.zeros(q.shape[1])
    for a, b in zip(q, x):
        total += (a - b) ** 2
    return np.sqrt(total)


def _near(best: Nearest, q: np.ndarray, x: np.ndarray, sizes: np.ndarray, members: np.ndarray) -> None:
    """Adds the members of the rows of ``x`` that can be among the best of the rows of ``q``."""
    starts = np.cumsum(sizes) - sizes
    centre = q.mean(axis=0)
    a, b = q - centre, x - centre
    half = (b * b).sum(axis=1) / 2
    far = np.abs(b).max(initial=0.0)
    if not np.isfinite(half).all() or far > 1e15:  # beyond single precision
        a, b, kind = q, x, np.float64
        half = (b * b).sum(axis=1) / 2
    else:
        kind = np.float32
    norms = (a * a).sum(axis=1)
    margin = 64 * np.finfo(kind).eps * (np.sqrt(norms.max(initial=0.0)) + np.sqrt(2 * half.max(initial=0.0))) ** 2
    left = np.concatenate([a, np.ones((len(a), 1))], axis=1).astype(kind)
    right = np.concatenate([b, -half[:, None]], axis=1).astype(kind).T.copy()
    qt, xt = q.T.copy(), x.T.copy()
    found: list[tuple] = []
    for at in range(0, len(q), 256):
        scores = left[at:at + 256] @ right
        cut = -best.cut[at:at + 256]
        if np.isinf(cut).any() and len(x) > best.keep:
            # no bound yet: that of the products themselves
            kth = np.partition(scores, len(x) - best.keep, axis=1)[:, len(x) - best.keep]
            reach = kth.astype(np.float64) - 2 * margin
        else:
            reach = np.full(len(scores), -np.inf)
        bound = (norms[at:at + 256] - (cut + 1e-8) ** 2) / 2 - margin
        least = np.maximum(reach, np.where(np.isinf(cut), -np.inf, bound))
        i, j = np.divmod(np.flatnonzero(scores >= np.nextafter(least.astype(kind), kind(-np.inf))[:, None]), len(x))
        if len(i):
            distance, times = _exact(qt[:, at + i], xt[:, j]), sizes[j]
            member = np.arange(times.sum()) + np.repeat(starts[j] - (np.cumsum(times) - times), times)
            found.append((np.repeat(at + i, times), -np.repeat(distance, times), members[member]))
    if found:
        best.add(*(np.concatenate(c) for c in zip(*found)))


def _array(row, side: str) -> np.ndarray:
    return np.frombuffer(getattr(row, f"{side}_data")).reshape(getattr(row, f"{side}_n"), -1)


def _pack(k: int, digits: int):
    """One block: its vectors, members, centre, radius and the greatest distance that its rows need to look."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(pdf["_v"].to_list()).astype(np.float64)
        sizes, members = pdf["members"].map(len).to_numpy(dtype=np.int64), np.concatenate(pdf["members"].to_list())
        best = Nearest(len(v), k + 1, digits)
        _near(best, v, v, sizes, members)
        centre = v.mean(axis=0)
        return pd.DataFrame({
            "block": [f"{pdf['cell'].iloc[0]}:{pdf['part'].iloc[0]}"], "n": [len(v)], "data": [v.tobytes()], "cut": [best.cut.tobytes()],
            "ids": [pdf["rep"].to_numpy()], "sizes": [sizes], "members": [members], "centre": [centre],
            "radius": [np.sqrt(((v - centre) ** 2).sum(axis=1).max())], "reach": [-best.cut.min()]})
    return run


def _vectors(row, side: str) -> np.ndarray:
    return np.frombuffer(getattr(row, f"{side}_data")).reshape(getattr(row, f"{side}_n"), -1)


def _start(k: int, digits: int):
    def start(row):
        best = Nearest(row.q_n, k + 1, digits)
        best.cut = np.frombuffer(row.q_cut).copy()
        return best, _vectors(row, "q"), np.asarray(row.q_ids)
    return start


def _visit(state, row) -> None:
    _near(state[0], state[1], _vectors(row, "x"), np.asarray(row.x_sizes), np.asarray(row.x_members))


def _finish(state) -> pd.DataFrame:
    i, score, members = state[0].rows
    return pd.DataFrame({"q": state[2][i], "distance": -score, "neighbor_id": members})


def knn(points: DataFrame, id_col: str, vec_col: str, k: int = 10, n_pivots: int | None = None, seed: int = 42,
        digits: int = 9) -> DataFrame:
    """(id, neighbor_id, distance, rank) for the k nearest other points;
    ties by neighbour id; distance rounded to ``digits`` before ranking."""
    base = points.select(F.col(id_col).alias("_id"), _as_double(F.col(vec_col)).alias("_v"))
    base = base.where(F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    base = base.withColumn("_vh", F.xxhash64("_v"))
    # 1. representatives of identical vectors: the k+1 smallest ids of each
    # group of copies (row_number <= k+1 gets a partial per-group limit before
    # the shuffle, so a huge group of copies stays bounded).
    w_copy = Window.partitionBy("_vh", "_v").orderBy("_id")
    top_ids = base.withColumn("_mr", F.row_number().over(w_copy)).filter(F.col("_mr") <= k + 1)
    reps = top_ids.groupBy("_vh", "_v").agg(F.min("_id").alias("rep"), F.array_sort(F.collect_list("_id")).alias("members"))
    checkpoint_dir(points.sparkSession)
    reps = reps.where("rep is not null").select("rep", "members", "_v").checkpoint(eager=True)
    # 2. pivots (bounded), cells and blocks
    n = reps.count()
    rows = block_rows(n, points.sparkSession.sparkContext.defaultParallelism, BLOCK_ROWS)
    n_pivots = n_pivots or min(MAX_PIVOTS, max(16, n // rows))
    piv = reps.select("_v", h60(hash_key(F.lit(seed), "rep")).alias("_h"), "rep").orderBy("_h", "rep").limit(n_pivots)
    pivots = np.array([r["_v"] for r in piv.collect()])
    id_type, vec_type = points.schema[id_col].dataType.simpleString(), "array<double>"
    cells = reps.mapInPandas(_nearest_pivot(pivots), f"rep {id_type}, members array<{id_type}>, _v {vec_type}, cell int")
    cells = cells.checkpoint(eager=True)
    parts = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias("_parts"))  # one row a pivot
    dealt = cells.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("_parts"))).drop("_parts")
    blocks = dealt.groupBy("cell", "part").applyInPandas(_pack(k, digits), f"""block string, n int, data binary, cut binary,
        ids array<{id_type}>, sizes array<bigint>, members array<{id_type}>, centre {vec_type}, radius double, reach double""")
    blocks = blocks.checkpoint(eager=True)
    # 3. and 4. the pairs of blocks that can hold neighbours
    apart = F.sqrt(F.aggregate(F.zip_with("q_centre", "x_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    near = apart <= (F.col("q_radius") + F.col("x_radius") + F.col("q_reach")) * (1 + 1e-9) + 1e-8
    found = pair_blocks(blocks, near, _start(k, digits), _visit, _finish, f"q {id_type}, distance double, neighbor_id {id_type}")
    pairs = found.select("q", F.round("distance", digits).alias("distance"), "neighbor_id")
    # every original point: its representative's list minus itself
    members = base.select(F.col("_id").alias(id_col), "_vh", "_v").join(
        reps.select(F.xxhash64("_v").alias("_vh"), "_v", F.col("rep").alias("q")), ["_vh", "_v"]).drop("_vh", "_v")
    top_q = pairs.withColumn("_k", F.row_number().over(
        Window.partitionBy("q").orderBy("distance", "neighbor_id"))).filter(F.col("_k") <= k + 1)
    lists = top_q.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("L"))
    out = members.join(lists, "q").select(id_col, F.slice(F.filter("L", lambda s: s["neighbor_id"] != F.col(id_col)),
                                                          1, k).alias("L"))
    out = out.select(id_col, F.posexplode("L").alias("_p", "s"))
    return out.select(id_col, F.col("s.neighbor_id").alias("neighbor_id"), F.col("s.distance").alias("distance"),
                      (F.col("_p") + 1).cast("int").alias("rank"))


def valuation_ranks(k: int, eps: float) -> int:
    """Neighbours that the truncated KNN-Shapley recursion looks at: max(k, 1 / eps)."""
    return max(k, int(math.ceil(1.0 / eps)))


def knn_shapley(points: DataFrame, neighbors: DataFrame, id_col: str, label_col: str, k: int = 10,
                ranks: int | None = None, digits: int = 9) -> DataFrame:
    """Q2: KNN-Shapley values (Jia et al., 2019), truncated.

    Each point t is a test point for its nearest other points ranked
    j = 1, 2, ... with m_j = [label(j) == label(t)].  Beyond rank
    ``ranks`` = max(k, 1 / eps) every value is within eps of 0 and set to 0;
    before it  s_j = s_(j+1) + (m_j - m_(j+1)) / k * min(k, j) / j.
    The ranks beyond k carry the negative terms: a point that stands before
    better neighbours loses.  ``neighbors`` must hold ``ranks`` neighbours.

    ``value_sum`` is a point's sum of s over all N test points;
    ``data_valuation_score`` = 0.5 * (value_sum / N + 1), below 0.5 = harmful.
    """
    ranks = ranks or k
    lab = points.select(F.col(id_col).alias("_t"), F.col(label_col).alias("_yt"))
    nb = neighbors.select(F.col(id_col).alias("_t"), "neighbor_id", "rank").join(lab, "_t")
    nb = nb.join(points.select(F.col(id_col).alias("neighbor_id"), F.col(label_col).alias("_yn")), "neighbor_id")
    nb = nb.withColumn("m", (F.col("_yt") == F.col("_yn")).cast("double"))
    w = Window.partitionBy("_t").orderBy("rank")
    nb = nb.withColumn("_mnext", F.lead("m").over(w))
    # The last neighbour: s = 0 at the cut; if all other points are ranked (few points), it starts the recursion.
    last = F.when(F.col("rank") >= ranks, F.lit(0.0)).otherwise(F.col("m") / k * F.least(F.lit(k), F.col("rank")) / F.col("rank"))
    step = F.when(F.col("_mnext").isNull(), last).otherwise(
        (F.col("m") - F.col("_mnext")) / k * F.least(F.lit(k), F.col("rank")) / F.col("rank"))
    nb = nb.withColumn("_step", step)
    # suffix sum over the (at most ``ranks``) neighbours of one test point
    nb = nb.withColumn("s", F.sum("_step").over(w.rowsBetween(0, Window.unboundedFollowing)))
    n = points.select(F.count(F.lit(1))).scalar()
    tot = nb.groupBy("neighbor_id").agg(F.sum("s").alias("_s"))
    out = points.select(id_col, label_col).join(tot.withColumnRenamed("neighbor_id", id_col), id_col, "left")
    total = F.coalesce("_s", F.lit(0.0))
    # + 0.0: a sum of -1e-17 is 0, not -0
    return out.select(id_col, label_col, (F.round(total, digits) + F.lit(0.0)).alias("value_sum"),
                      F.round(F.lit(0.5) * (total / n + F.lit(1.0)), digits).alias("data_valuation_score"))


def smote(points: DataFrame, id_col: str, vec_col: str, label_col: str, minority: int = 1, k: int = 5,
          seed: int = 42, digits: int = 6, **knn_kw) -> DataFrame:
    """V6: synthetic minority rows until both classes are equal (Chawla et
    al., 2002).  Synthetic j (0-based) starts from the minority row of rank
    (j mod m) + 1 in md5(seed:id) order, takes its neighbour of rank
    (h(seed:j) mod min(k, m - 1)) + 1 among minority rows and moves u(seed:j)
    of the way.  A minority of one row has no neighbour: an error is raised.
    Returns only the synthetic rows: (synthetic_id, base_id, neighbor_id, vector)."""
    mino = points.filter(F.col(label_col) == minority).select(id_col, vec_col)
    n_minority = mino.count()
    if n_minority == 1:
        raise ValueError("SMOTE needs at least two minority rows")
    m = F.lit(n_minority)
    reach = max(1, min(k, n_minority - 1))
    other = points.filter(F.col(label_col) != minority).select(F.count(F.lit(1))).scalar()
    needed = F.greatest(other - m, F.lit(0))
    nbrs = knn(mino, id_col, vec_col, k=k, seed=seed, **knn_kw)
    r = exact_rank(mino.withColumn("_h", h60(hash_key(F.lit(seed), id_col))), [], ["_h", id_col], "_rk")
    cnt = F.floor((needed - (F.col("_rk") - 1) + m - 1) / m).cast("int")
    gen = r.withColumn("_i", F.explode(F.sequence(F.lit(0), cnt - 1))).filter(cnt > 0)
    gen = gen.withColumn("synthetic_id", ((F.col("_rk") - 1) + F.col("_i") * m).cast("bigint"))
    gen = gen.withColumn("_nr", (F.pmod(h60(hash_key(F.lit(seed), "synthetic_id", F.lit("nn"))), F.lit(reach)) + 1)
                         .cast("int"))
    gen = gen.withColumn("_u", h60(hash_key(F.lit(seed), "synthetic_id", F.lit("u"))) / F.lit(float(1 << 60)))
    nb = nbrs.select(F.col(id_col).alias("_b"), "neighbor_id", F.col("rank").alias("_nr2"))
    j = gen.join(nb, (gen[id_col] == nb["_b"]) & (gen["_nr"] == nb["_nr2"]))
    j = j.drop("_b", "_nr2").join(mino.select(F.col(id_col).alias("neighbor_id"), F.col(vec_col).alias("_nv")), "neighbor_id")
    vec = F.zip_with(_as_double(F.col(vec_col)), _as_double(F.col("_nv")),
                     lambda a, b: F.round(a + F.col("_u") * (b - a), digits))
    return j.select("synthetic_id", F.col(id_col).alias("base_id"), "neighbor_id", vec.alias("vector"))
