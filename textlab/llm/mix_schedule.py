"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

A mix is a row of slots, each of which takes one block of ``BLOCK_WORDS`` words of one source.  Slot i belongs to the source
whose share of the unit interval holds the van der Corput point of i, so every stretch of the mix has close to the target
shares.  The point of slot i, in units of 1 / 2 ** bits, is the bit reversal of i, which is its own inverse: a source whose share
covers the points a..b owns the slots reverse(a)..reverse(b), and no slot has to be looked up.  There are at least as many
points as blocks, so each source owns at least as many slots as it needs blocks; it uses its first ones.

A source's documents are put in a random order (md5 of a seed and the id), laid out one after the other, twice over, and
cut into equal blocks.  The source's k-th slot takes its k-th block: slots are ranked per source and joined to the blocks.  The
last block of a source ends where its target does.

Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and share ``SHARE`` of all words by weight.  A source's
target stops at ``MOST`` times its words; the excess goes to the others by weight, round by round until none is above.

Scale: texts are read once, to count their words; the rest works on rows of a few numbers.  Ranks and running sums come from a
range partitioning (``ordered.running``) and points are made in chunks, so a source with most of the words is
spread like any other.  A round of the targets returns two numbers to the driver.

Defined cases: a null text has no words and neither has an empty one: such documents take part with size 0 and nothing is taken
of them; a null source is a source of its own, the last; rows with the same id and size lie next to each other, each taking its
part; an empty table gives an empty mix; a very long text is cut into as many blocks as it fills; other columns do not enter, and
clashing names are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.hashing import h60, h60_sql
from textlab.llm.ordered import running
from textlab.llm.tables import discard, written

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # all words times 3 / 2
MOST = 2
BLOCK_WORDS = 1024
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
_CHUNK_BITS = 16
_SOURCE = ["_null", "_source"]


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size in words, a hash of the text, the source as two columns that are not null (_null, _source), and the
    document's random place."""
    doc_id, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string")
    text = F.col(f"`{text_col}`")
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(doc_id.alias("doc_id"), words.alias("size"), F.xxhash64(text).alias("_text"), source.isNull().alias("_null"), F.coalesce(source, F.lit("")).alias("_source"),
                       F.coalesce(h60(F.concat(F.lit(SEED + ":"), doc_id.cast("string"))), F.lit(-1)).alias("_place"))


def _big(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def targets(rows: DataFrame) -> DataFrame:
    """One row per source of ``rows`` (``sizes``): source_size, target, words (the target's whole words), in source order."""
    found = rows.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int")).cast("bigint")
    sources, _ = written(running(found, [], _SOURCE, name="mix-sources").select(*_SOURCE, "_rank", "source_size", weight.alias("weight")),
                         "mix-weights")
    # In units of 1 / SHARE[1] words: what is left to share out, and the weight of the sources that are not full.
    cap = F.col("source_size") * MOST * SHARE[1]
    all_ = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    total, weights = (all_["words"] or 0) * SHARE[0], all_["weight"] or 0
    left, open_ = total, weights
    full = F.lit(False)
    while open_:
        full = _big(cap) * F.lit(open_) < _big(F.col("weight")) * F.lit(left)
        r = sources.where(full).agg(F.sum(cap).alias("words"), F.sum("weight").alias("weight")).first()
        before, left, open_ = open_, total - (r["words"] or 0), weights - (r["weight"] or 0)
        if open_ == before:
            break
    share = _big(F.col("weight")) * F.lit(left)
    per = F.lit(max(open_, 1) * SHARE[1])
    return sources.select(
        *_SOURCE, "_rank", "source_size",
        F.when(full, (F.col("source_size") * MOST).cast("double")).otherwise(share.cast("double") / per.cast("double")).alias("target"),
        F.when(full, F.col("source_size") * MOST).otherwise((share - share % per) / per).cast("bigint").alias("words"))


def slots(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(_null, _source, slot, block): the slots that each source uses, and its block that goes there."""
    need = sources.withColumn("_need", F.ceil(F.col("words") / F.lit(block)).cast("bigint"))
    placed = running(need, [], ["_rank"], ("_need",), name="mix-shares").drop("_rank", "_rows", "_at")
    n = placed.agg(F.sum("_need")).first()[0] or 0
    bits = max((max(n, 1) - 1).bit_length(), 1)

    def edge(upto: str) -> Column:
        """First point at or above the share ``upto / n``."""
        return F.expr(f"(cast({upto} AS decimal(30,0)) * {1 << bits}L + {max(n, 1) - 1}L) div {max(n, 1)}L")
    spans = placed.where("_need > 0").select(*_SOURCE, "_need", edge("_before__need").alias("_from"),
                                             (edge("(_before__need + _need)") - 1).alias("_to"))
    chunk = F.sequence(F.shiftright("_from", _CHUNK_BITS), F.shiftright("_to", _CHUNK_BITS))
    chunks = spans.select("*", F.explode(chunk).alias("_chunk")).repartition(*_SOURCE, "_chunk")
    first = F.shiftleft("_chunk", _CHUNK_BITS)
    points = F.sequence(F.greatest("_from", first), F.least("_to", first + ((1 << _CHUNK_BITS) - 1)))
    owned = chunks.select(*_SOURCE, "_need", F.explode(points).alias("_point")).select(
        *_SOURCE, "_need", F.conv(F.reverse(F.lpad(F.bin("_point"), bits, "0")), 2, 10).cast("bigint").alias("slot"))
    return (running(owned, _SOURCE, ["slot"], name="mix-slots").where("_rank < _need")
            .select(*_SOURCE, "slot", F.col("_rank").alias("block")))


def blocks(laid: DataFrame, sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The pieces of documents in each source's blocks: (_null, _source, block, at, _at, doc_id, _text, start, length).

    ``laid`` are the documents in their order (``running`` with sums of size); ``start`` counts words of the document, ``at``
    words of the source's stream.
    """
    size, from_, to = F.col("size"), F.col("_from"), F.col("_to")
    turn = F.explode(F.sequence(F.lit(0), F.lit(MOST - 1)))
    turns = (laid.where("size > 0").join(sources.select(*_SOURCE, "source_size", "words"), _SOURCE)
             .select(*_SOURCE, "_at", "doc_id", "_text", "size", "words", "_before_size", "source_size", turn.alias("_turn"))
             .withColumn("_from", F.col("_before_size") + F.col("_turn") * F.col("source_size"))
             .withColumn("_to", F.least(from_ + size, "words")).where("_from < _to"))
    last = F.expr(f"(_to - 1) div {block}")
    cut = turns.withColumn("block", F.explode(F.sequence(F.expr(f"_from div {block}"), last)))
    begin, end = F.greatest(from_, F.col("block") * block), F.least(to, (F.col("block") + 1) * block)
    return cut.select(*_SOURCE, "block", begin.alias("at"), "_at", "doc_id", "_text", (begin - from_).alias("start"), (end - begin).alias("length"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The schedule and the documents.

    Schedule: slot, at (order within a slot), doc_id, start, length (words of the document), source, ``_text`` and ``_at``; a
    piece a row.
    Documents: one row each, doc_id, size, source_size, target and ``_at``, the number that names the row in the schedule.
    """
    counted, path = written(sizes(docs, id_col, text_col, source_col), "mix-sizes")  # words are counted once
    laid = running(counted, _SOURCE, ["_place", "doc_id", "size", "_text"], ("size",), name="mix-documents")
    discard(counted, path)
    sources, _ = written(targets(laid), "mix-targets")
    source = F.when(~F.col("_null"), F.col("_source")).alias("source")
    schedule = (blocks(laid, sources, block).join(slots(sources, block), _SOURCE + ["block"])
                .select("slot", "at", "doc_id", "start", "length", source, "_text", "_at"))
    return schedule, laid.join(sources, _SOURCE).select("doc_id", "size", "source_size", "target", source, "_at")


def write_mix(docs: DataFrame, path: str, block: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> None:
    """Write the mixed texts as Parquet files in slot order: slot, at, doc_id, source, text (words joined by a blank)."""
    schedule, _ = mix(docs, block, id_col, text_col, source_col)
    text = F.col(f"`{text_col}`")
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_t")).dropDuplicates(["_id", "_hash"])
    piece = F.expr("slice(_w, int(start) + 1, int(length))")
    (schedule.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
     .withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
     .select("slot", "at", "doc_id", "source", F.array_join(piece, " ").alias("text"))
     .repartitionByRange("slot", "at").sortWithinPartitions("slot", "at").write.parquet(path))


def op12_mix_schedule(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    schedule, rows = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    taken = schedule.groupBy("_at").agg(F.sum("length").alias("taken"))
    return rows.join(taken, "_at", "left").select("doc_id", "size", "source_size", "target",
                                                  F.coalesce("taken", F.lit(0)).alias("taken"))


_WEIGHT_SQL = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))

#: The targets by one pass over the sources in order of fullness, the taken words of a document in closed form.
SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
        coalesce({h60_sql(f"'{SEED}:' || doc_id::VARCHAR")}, -1) AS place FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS z, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {_WEIGHT_SQL} END AS w
    FROM d GROUP BY source),
o AS (SELECT *, sum(z) OVER () * {SHARE[0]} AS total, sum(w) OVER () AS weights,
        coalesce(sum(z * {MOST * SHARE[1]}) OVER f, 0) AS z0, coalesce(sum(w) OVER f, 0) AS w0
    FROM s WINDOW f AS (ORDER BY z * 6 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, z * {MOST * SHARE[1]} * (weights - w0) < w * (total - z0) AS is_full FROM o),
l AS (SELECT *, total - coalesce(sum(z * {MOST * SHARE[1]}) FILTER (is_full) OVER (), 0) AS left_,
        weights - coalesce(sum(w) FILTER (is_full) OVER (), 0) AS open FROM f),
t AS (SELECT source, z::BIGINT AS z, CASE WHEN is_full THEN (z * {MOST})::DOUBLE ELSE (w * left_)::DOUBLE / (open * {SHARE[1]})::DOUBLE END AS target,
        CASE WHEN is_full THEN z * {MOST} ELSE w * left_ // (open * {SHARE[1]}) END AS words FROM l),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM d)
SELECT doc_id, size, z AS source_size, target, (greatest(least(a + size, words) - a, 0)
    + greatest(least(z + a + size, words) - z - a, 0))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source"""
