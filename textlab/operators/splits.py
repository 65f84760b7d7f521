"""Splits and resampling with exact quotas and no single-task groups.

The core primitive is ``exact_rank``: the 1-based position of each row
within its group under a total order.  A window ``row_number()`` would sort a
whole group inside one task (a class can hold a third of all rows); instead
rows are range-partitioned on (group, order), sorted inside each partition,
and numbered by ``monotonically_increasing_id`` plus per-(partition, group)
offsets taken from a small aggregate (partitions x groups rows, broadcast).
Callers that hand in narrow frames (ids and keys) shuffle only these.  The numbered rows are
checkpointed (``spark.checkpoint.dir``) before the offsets are taken, so the
offsets and the rows come from one fixed materialisation: partition ids
cannot differ between the two reads, and a lost executor does not renumber.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.hashing import h60, hash_key
from textlab.session import checkpoint_dir


def exact_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
               out_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based rank within ``group_cols`` by ``order_cols``
    (the order must be total: include a unique key)."""
    spark = df.sparkSession
    g, o = list(group_cols), list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *g, *o).sortWithinPartitions(*g, *o)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    checkpoint_dir(spark)
    s = s.checkpoint(eager=True)
    blocks = s.groupBy("_pid", *g).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # A group spanning several partitions: rows before it in earlier partitions.
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    # The offset table has partitions x groups rows; AQE broadcasts it while it is small.
    ranked = s.join(offsets, ["_pid", *g])
    return ranked.withColumn(out_col, (F.col("_mid") - F.col("_first") + F.col("_off") + 1).cast("bigint")) \
        .drop("_pid", "_mid", "_first", "_off")


def _largest_remainder(counts: DataFrame, group_cols: Sequence[str], class_col: str,
                       total_expr, out_col: str = "quota") -> DataFrame:
    """Per class quota: floor of the exact share, leftovers by largest
    remainder (ties: smaller class value first).  ``counts`` has
    (group..., class, n_c); the table is small (groups x classes)."""
    g = list(group_cols)
    wg = Window.partitionBy(*g) if g else Window.partitionBy()
    c = counts.withColumn("_n", F.sum("n_c").over(wg))
    c = c.withColumn("_t", total_expr(F.col("_n")))
    c = c.withColumn("_share", F.col("_t") * F.col("n_c") / F.col("_n"))
    c = c.withColumn("_fl", F.floor("_share")).withColumn("_rem", F.col("_share") - F.col("_fl"))
    c = c.withColumn("_left", F.col("_t") - F.sum("_fl").over(wg))
    c = c.withColumn("_rr", F.row_number().over(
        (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(F.col("_rem").desc(), F.col(class_col).asc())))
    return c.select(*g, class_col, "n_c",
                    (F.col("_fl") + F.when(F.col("_rr") <= F.col("_left"), 1).otherwise(0)).cast("bigint").alias(out_col))


def smallest_cuts(base: DataFrame, group_cols: Sequence[str], quotas: DataFrame, id_col: str, h_col: str = "_h") -> DataFrame:
    """(group..., _cut_h, _cut_id): the ``quota``-th row of each group in the order of (60-bit hash, id), found by counting.

    Two histograms, of the hash's first 16 bits and of the next 16 bits inside the one part that holds the quota-th row, leave
    about one row in 2^32 of a group, which are numbered.  No sort and no checkpoint of the rows; ``quotas`` (group..., quota)
    is small (groups).  A group with quota 0 has no cut.
    """
    g = list(group_cols)
    picked = quotas.where("quota > 0").select(*g, F.col("quota").alias("_left"), F.lit(0).cast("bigint").alias("_part"))
    rows = base
    for shift in (44, 28):
        rows = base.join(F.broadcast(picked), g) if shift == 44 else base.join(F.broadcast(picked), g).where(
            F.shiftright(h_col, 44) == F.col("_part"))
        counted = rows.groupBy(*g, "_left", F.shiftright(h_col, shift).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        picked = counted.where("_before < _left and _left <= _before + _n").select(
            *g, (F.col("_left") - F.col("_before")).alias("_left"), F.col("_p").alias("_part"))
    rest = base.join(F.broadcast(picked), g).where(F.shiftright(h_col, 28) == F.col("_part"))
    at = F.row_number().over(Window.partitionBy(*g).orderBy(h_col, id_col))
    return rest.withColumn("_at", at).where("_at = _left").select(*g, F.col(h_col).alias("_cut_h"), F.col(id_col).alias("_cut_id"))


def _within_cut(id_col: str, h_col: str = "_h") -> Column:
    h, row = F.col(h_col), F.col(id_col)
    return F.coalesce((h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (row <= F.col("_cut_id"))), F.lit(False))


def stratified_splits(df: DataFrame, id_col: str, label_col: str, n_splits: int = 10,
                      test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """Long fold table (fold, id, label, role) of a stratified shuffle split.

    Per fold: ``ceil(test_size * n)`` test rows split over classes by largest
    remainder; within a class the rows with the smallest md5(seed:fold:id)
    go to test.
    """
    base = df.select(id_col, label_col).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    base = base.withColumn("_h", h60(hash_key(F.lit(seed), "fold", id_col)))
    counts = base.groupBy("fold", label_col).agg(F.count(F.lit(1)).alias("n_c"))
    quotas = _largest_remainder(counts, ["fold"], label_col, lambda n: F.ceil(F.lit(test_size) * n))
    cuts = smallest_cuts(base, ["fold", label_col], quotas.select("fold", label_col, "quota"), id_col)
    out = base.join(F.broadcast(cuts), ["fold", label_col], "left")
    return out.select("fold", id_col, label_col, F.when(_within_cut(id_col), "test").otherwise("train").alias("role"))


def stratified_kfold(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(id, label, fold): within each class, rows in md5(seed:id) order are
    dealt round-robin to folds 0..k-1."""
    base = df.select(id_col, label_col).withColumn("_h", h60(hash_key(F.lit(seed), id_col)))
    ranked = exact_rank(base, [label_col], ["_h", id_col])
    return ranked.select(id_col, label_col, ((F.col("rank") - 1) % k).cast("int").alias("fold"))


def shuffle_order(df: DataFrame, id_col: str, seed: int = 42, out_col: str = "position") -> DataFrame:
    """Seeded shuffle: ``position`` = rank of md5(seed:id)."""
    base = df.withColumn("_h", h60(hash_key(F.lit(seed), id_col)))
    return exact_rank(base, [], ["_h", id_col], out_col).drop("_h")


def holdout_split(df: DataFrame, id_col: str, test_fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """Shuffle, then the first ``floor(test_fraction * n)`` rows are test, the
    rest train (the reference's ICL split: 70 % test)."""
    ranked = shuffle_order(df, id_col, seed)
    n = df.select(F.count(F.lit(1))).scalar()
    cut = F.floor(F.lit(test_fraction) * n)
    return ranked.withColumn("role", F.when(F.col("position") <= cut, "test").otherwise("train"))


def undersample(df: DataFrame, id_col: str, label_col: str, seed: int = 42) -> DataFrame:
    """Keep every class down to the minority count (smallest md5 first)."""
    base = df.withColumn("_h", h60(hash_key(F.lit(seed), id_col)))
    counts = base.groupBy(label_col).agg(F.count(F.lit(1)).alias("_c"))
    quotas = counts.select(label_col, counts.select(F.min("_c")).scalar().alias("quota"))
    cuts = smallest_cuts(base, [label_col], quotas, id_col)
    return base.join(F.broadcast(cuts), label_col).where(_within_cut(id_col)).select(*df.columns)


def oversample(df: DataFrame, id_col: str, label_col: str, seed: int = 42) -> DataFrame:
    """Replicate rows of every class up to the majority count: each row
    ``floor(M / n_c)`` times, plus one more copy for the first ``M mod n_c``
    rows in md5 order.  Adds ``replica`` (1 = original)."""
    base = df.withColumn("_h", h60(hash_key(F.lit(seed), id_col)))
    counts = base.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    big = counts.select(F.max("_nc")).scalar()
    ranked = exact_rank(base, [label_col], ["_h", id_col]).join(F.broadcast(counts), label_col)
    copies = F.floor(big / F.col("_nc")) + F.when(F.col("rank") <= big % F.col("_nc"), 1).otherwise(0)
    out = ranked.withColumn("replica", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return out.drop("rank", "_h", "_nc")


def dataset_fingerprint(df: DataFrame, cols) -> Column:
    """Row count and order-free sum of xxhash64 over ``cols`` (scalar subquery)."""
    h = F.xxhash64(*cols).cast("decimal(38,0)")
    return df.select(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(h).cast("string"))).scalar()


def cached_folds(docs: DataFrame, id_col: str, label_col: str, text_col: str, cache_root: str,
                 n_splits: int = 10, test_size: float = 0.3, seed: int = 42, augment_factor: int = 1) -> DataFrame:
    """V5: fold table cached as Parquet under a key of the settings *and* a
    fingerprint of the data (the reference's key omits the data, so stale
    folds were possible).  A hit reads the stored folds; a miss builds and
    writes them.  With ``augment_factor`` > 1 the stored folds are those of
    ``augment_folds``: every fold's training rows and their rewritten copies."""
    import hashlib

    from textlab.operators.augment import augment_folds
    from textlab.sources.io import path_exists
    spark = docs.sparkSession
    fp = docs.select(dataset_fingerprint(docs, [id_col, label_col, text_col]).alias("f")).first()["f"]
    key = hashlib.sha256(f"{text_col}|{label_col}|{augment_factor}|{n_splits}|{test_size}|{seed}|{fp}"
                         .encode()).hexdigest()
    path = f"{cache_root.rstrip('/')}/folds-{key}"
    # A write that broke off leaves no _SUCCESS file and is written again; any other failure is raised.
    if not path_exists(spark, f"{path}/_SUCCESS"):
        folds = stratified_splits(docs, id_col, label_col, n_splits, test_size, seed)
        if augment_factor > 1:
            folds = augment_folds(docs, folds, id_col, text_col, label_col, factor=augment_factor)
        folds.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
