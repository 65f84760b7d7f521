"""Balanced shards by histogram sort, in DataFrame operations only.

Documents are ordered by (hash of the text, id), so equal texts lie together, and cut into shards of nearly equal bytes.
The cuts are found before anything is exchanged: each round counts the exact bytes below many candidate boundaries at
once (an aggregation with partial sums over all partitions), keeps for every cut the interval between two candidates
that holds its target, and puts the next candidates inside it, until an interval holds no more bytes than the
tolerance.  An interval of one hash value (a text with many copies) is split by id, one of one hash and id (a repeated
row) by a number that each row got when the keys were written, so a hot group of equal texts or rows is cut like any
other.  Then rows move once, range-partitioned by (shard, hash, id, number).

Law: ``bytes``.  A document's size is the UTF-8 bytes of its text plus 1.

Scale: texts are read once; rounds work on rows of four numbers.  A round returns at most ``2 ** PROBE_BITS`` counts a
cut to the driver, whatever the input.  The tolerance is a share of a shard, so the number of rounds does not grow with
the input beyond the key's width.

Defined cases: a null text has no bytes and hashes as the empty text; a null id is ordered before all others; repeated
rows are spread like others by ``assign_shards`` (which of them goes where depends on their input files), while in
``write_shards`` they have equal keys and stay on one side of a cut; a very long text is one row of its size, and a shard
cannot be more equal than that; an empty table gives an empty result; other columns do not enter
(``write_shards`` writes them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlab.llm.tables import discard, written

PROBE_BITS = 10
TOLERANCE = 0.0005
_LEAST = -(1 << 63)


@dataclass(frozen=True)
class Cut:
    """Rows before (hash, id, tie) lie below the cut; hash None: below all keys' end."""

    hash: int | None
    id: int = _LEAST
    tie: int = _LEAST


@dataclass(frozen=True)
class _Open:
    """An interval that holds a cut's target: keys whose high bits are ``prefix``, ``below`` bytes before it."""

    target: float
    below: int
    shift: int  # candidates are ``1 << shift`` apart
    prefix: int | None  # key >> (shift + PROBE_BITS); None: all keys
    hash: int | None = None  # set: the keys are ids of this hash
    id: int | None = None  # set too: the keys are ties of this hash and id


def _keys(text: Column, doc_id: Column) -> tuple[Column, Column, Column]:
    text = F.coalesce(text, F.lit(""))
    return (F.xxhash64(text).alias("_hash"), F.coalesce(doc_id.cast("bigint"), F.lit(_LEAST)).alias("_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"))


def _shift(low: int, high: int) -> int:
    """Candidate distance that splits low..high into at most 2^PROBE_BITS aligned parts."""
    return max(0, (low ^ high).bit_length() - PROBE_BITS) if (low < 0) == (high < 0) else 64 - PROBE_BITS


def _round(rows: DataFrame, open_: list[_Open]) -> dict[int, list]:
    """For each open interval its candidates in order, with bytes and least and greatest keys between them."""
    number, bucket = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for k, o in reversed(list(enumerate(open_))):
        key = F.col("_hash" if o.hash is None else "_id" if o.id is None else "_tie")
        inside = F.lit(True) if o.hash is None else F.col("_hash") == o.hash
        if o.id is not None:
            inside = inside & (F.col("_id") == o.id)
        if o.prefix is not None:
            inside = inside & (F.shiftright(key, o.shift + PROBE_BITS) == o.prefix)
        number = F.when(inside, F.lit(k)).otherwise(number)
        bucket = F.when(inside, F.shiftright(key, o.shift)).otherwise(bucket)
    counted = (rows.select(number.alias("k"), bucket.alias("b"), "size", "_hash", "_id", "_tie").where("k is not null")
               .groupBy("k", "b").agg(F.sum("size").alias("bytes"), F.min("_hash").alias("h0"), F.max("_hash").alias("h1"),
                                      F.min("_id").alias("i0"), F.max("_id").alias("i1"),
                                      F.min("_tie").alias("t0"), F.max("_tie").alias("t1")).orderBy("k", "b").collect())
    out: dict[int, list] = {}
    for r in counted:
        out.setdefault(r["k"], []).append(r)
    return out


def _inside(target: float, below: int, low: int, high: int, hash_: int | None = None, id_: int | None = None) -> _Open:
    """The interval of the keys low..high."""
    s = _shift(low, high)
    return _Open(target, below, s, low >> (s + PROBE_BITS) if s + PROBE_BITS < 64 else None, hash_, id_)


def find_cuts(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Cut]:
    """The ``shards - 1`` cuts of ``rows`` (_hash, _id, _tie, size)."""
    whole = rows.agg(F.sum("size").alias("bytes"), F.min("_hash").alias("h0"), F.max("_hash").alias("h1")).first()
    total = whole["bytes"] or 0
    if not total:
        return [Cut(None)] * (shards - 1)
    most = total / shards * tolerance
    cuts: dict[float, Cut] = {}
    targets = [total * i / shards for i in range(1, shards)]
    open_ = {t: _inside(t, 0, whole["h0"], whole["h1"]) for t in targets}
    while open_:
        asked = list(dict.fromkeys((o.below, o.shift, o.prefix, o.hash, o.id) for o in open_.values()))
        counts = _round(rows, [_Open(0, *a) for a in asked])
        for target, o in list(open_.items()):
            below = o.below
            for r in counts[asked.index((o.below, o.shift, o.prefix, o.hash, o.id))]:
                if below + r["bytes"] >= target:
                    break
                below += r["bytes"]
            above = below + r["bytes"]
            one_text, one_key = r["h0"] == r["h1"], r["h0"] == r["h1"] and r["i0"] == r["i1"]
            if above - below <= most or (one_key and r["t0"] == r["t1"]) or above == target:
                cuts[target] = _after(r, o) if above - target <= target - below else _before(r, o)
                del open_[target]
            elif one_key:
                open_[target] = _inside(target, below, r["t0"], r["t1"], r["h0"], r["i0"])
            elif one_text:
                open_[target] = _inside(target, below, r["i0"], r["i1"], r["h0"])
            else:
                open_[target] = _inside(target, below, r["h0"], r["h1"])
    return [cuts[t] for t in targets]


def _before(r, o: _Open) -> Cut:
    return Cut(r["h0"]) if o.hash is None else Cut(o.hash, r["i0"]) if o.id is None else Cut(o.hash, o.id, r["t0"])


def _after(r, o: _Open) -> Cut:
    most = (1 << 63) - 1
    if o.id is not None and r["t1"] < most:
        return Cut(o.hash, o.id, r["t1"] + 1)
    if o.hash is not None and r["i1"] < most:
        return Cut(o.hash, r["i1"] + 1)
    return Cut(r["h1"] + 1) if r["h1"] < most else Cut(None)


def shard_of(cuts: list[Cut]) -> Column:
    """The shard of a row with columns _hash, _id and _tie: how many cuts lie at or before it."""
    h, i, t = F.col("_hash"), F.col("_id"), F.col("_tie")
    at = F.lit(0)
    for c in cuts:
        if c.hash is not None:
            beyond = (h > c.hash) | ((h == c.hash) & ((i > c.id) | ((i == c.id) & (t >= c.tie))))
            at = at + F.when(beyond, 1).otherwise(0)
    return at.cast("int")


def assign_shards(docs: DataFrame, shards: int, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, and slot (its place in the shard, from 0)."""
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    # The numbers are written with the keys, so every later reading sees the same ones.
    rows, rows_path = written(docs.select(doc_id.cast("bigint").alias("doc_id"), *_keys(text, doc_id), F.monotonically_increasing_id().alias("_tie"),
                                          F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")), "sizes")
    cuts = find_cuts(rows, shards, tolerance)
    ordered = (rows.withColumn("shard", shard_of(cuts)).repartitionByRange("shard", "_hash", "_id", "_tie")
               .sortWithinPartitions("shard", "_hash", "_id", "_tie")
               .withColumn("_at", F.monotonically_increasing_id()).drop("_hash", "_id", "_tie"))
    placed, _ = written(ordered, "shards")
    discard(rows, rows_path)
    # The place inside a task's part of a shard, plus what the tasks before it hold of that shard.
    part = F.shiftright("_at", 33).alias("_part")
    parts = placed.groupBy(part, "shard").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (placed.withColumn("_part", part).join(parts, ["_part", "shard"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_at") - F.col("_first") + F.col("_before")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole rows as Parquet files under ``path``/shard=k, in shard order, after one exchange.

    Columns named shard, _hash, _id or _tie are left out of the files.
    """
    hash_, id_, size = _keys(F.col(f"`{text_col}`"), F.col(f"`{id_col}`"))
    tie = F.lit(0).cast("bigint").alias("_tie")
    rows, rows_path = written(docs.select(hash_, id_, size, tie), "sizes")
    cuts = find_cuts(rows, shards, tolerance)
    discard(rows, rows_path)
    (docs.drop("_hash", "_id", "_tie", "shard").select("*", hash_, id_, tie).withColumn("shard", shard_of(cuts))
     .repartitionByRange("shard", "_hash", "_id").sortWithinPartitions("shard", "_hash", "_id").drop("_hash", "_id", "_tie")
     .write.partitionBy("shard").parquet(path))


def op6_shards_histogram(spark, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs, 8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                         F.lit(None).cast("int").alias("grown_shard"))
