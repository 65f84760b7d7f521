"""Corpus preparation for language-model work.

Token streams are packed into fixed blocks within batches of documents.
Batches are bounded (``batch_docs`` documents) and blocks are bounded
(``block`` tokens), so every window and every collect below works on a
bounded group; batch membership comes from an exact distributed rank.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.hashing import h60, hash_key
from textlab.operators.splits import exact_rank

# The metadata pattern of the reference's compact text form.
METADATA_PATTERN = r"(?s)^(.*?)\s*(\([^)]*\)):\s*(.*)\z"
# Label names of the labelling project.
LABEL_NAMES = {0: "dfn", 1: "dfy"}
MASK, PAD = "[MASK]", "[PAD]"


def split_metadata(text) -> dict[str, Column]:
    """``title (meta): desc`` -> title, meta, desc and the text to rewrite
    (``title: desc``); without a metadata block the whole text is rewritten."""
    t = F.col(text) if isinstance(text, str) else text
    has = t.rlike(METADATA_PATTERN)
    title = F.regexp_extract(t, METADATA_PATTERN, 1)
    meta = F.regexp_extract(t, METADATA_PATTERN, 2)
    desc = F.regexp_extract(t, METADATA_PATTERN, 3)
    return {"has_meta": has, "title": title, "meta": meta, "desc": desc,
            "to_rewrite": F.when(has, F.concat(title, F.lit(": "), desc)).otherwise(t)}


def restore_metadata(rewritten, meta) -> Column:
    """Put the metadata back after the first ':' of a rewritten text."""
    r = F.col(rewritten) if isinstance(rewritten, str) else rewritten
    m = F.col(meta) if isinstance(meta, str) else meta
    head = F.trim(F.substring_index(r, ":", 1))
    pos = F.instr(r, ":")
    tail = F.trim(F.substring(r, pos + 1, 1 << 30))
    return F.when((m == "") | m.isNull() | (pos == 0), r).otherwise(F.concat(head, F.lit(" "), m, F.lit(": "), tail))


def label_name(label) -> Column:
    """0 -> 'dfn', 1 -> 'dfy'."""
    c = F.col(label) if isinstance(label, str) else label
    e = None
    for k, v in LABEL_NAMES.items():
        e = F.when(c == k, F.lit(v)) if e is None else e.when(c == k, F.lit(v))
    return e


def label_from_name(name) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    e = None
    for k, v in LABEL_NAMES.items():
        e = F.when(c == v, F.lit(k)) if e is None else e.when(c == v, F.lit(k))
    return e.cast("int")


def mask_tokens(tokens, key, rate: float = 0.15, seed: int = 42) -> Column:
    """Replace a token by [MASK] when u(seed:key:position) < rate."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    k = F.col(key) if isinstance(key, str) else key
    return F.transform(t, lambda x, i: F.when(
        h60(hash_key(F.lit(seed), k, i)) / F.lit(float(1 << 60)) < F.lit(rate), F.lit(MASK)).otherwise(x))


def fit_length(tokens, n: int = 512) -> Column:
    """Truncate to n tokens, pad with [PAD] to n."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    head = F.slice(t, 1, n)
    return F.concat(head, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), F.lit(n) - F.size(head))))


def pack_blocks(docs: DataFrame, id_col: str, tokens_col: str, block: int = 512,
                batch_docs: int = 1000) -> DataFrame:
    """Documents in id order form batches of ``batch_docs``; each batch's
    token streams are concatenated and cut into ``block``-token blocks; the
    incomplete tail of each batch is dropped.  (batch, block, tokens, labels).

    Null ids come first and null tokens are empty; rows with the same id are
    ordered by a hash of their tokens, and repeated rows are packed each."""
    # Only ids, hashes and lengths are ranked; a document's slices then carry its tokens to their blocks in one shuffle.
    content = F.xxhash64(tokens_col).alias("_content")
    ranked = exact_rank(docs.select(id_col, content, F.coalesce(F.size(tokens_col), F.lit(0)).alias("_len")), [],
                        [id_col, "_content"], "_rk").withColumn("batch", F.floor((F.col("_rk") - 1) / batch_docs).cast("bigint"))
    w = Window.partitionBy("batch").orderBy("_rk")  # at most batch_docs rows per group
    ranked = ranked.withColumn("_off", F.coalesce(F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)))
    ranked = ranked.withColumn("_tot", F.sum("_len").over(Window.partitionBy("batch"))).filter(F.col("_len") > 0)
    first = F.floor(F.col("_off") / block)
    last = F.floor((F.col("_off") + F.col("_len") - 1) / block)
    # The first row of each (id, content); the join by the same columns, none of them null, needs no further shuffle of the tokens.
    keys = ["_key", "_none", "_id"]

    def keyed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(content.alias("_key") if "_content" not in columns else F.col("_content").alias("_key"), F.col(id_col).isNull().alias("_none"),
                         F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), *columns)

    texts = keyed(docs, tokens_col).withColumn("_before", F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    found = texts.filter(F.col("_before").isNull()).drop("_before").join(keyed(ranked, "_content", "batch", "_len", "_off", "_tot"), keys)
    cut = found.withColumn("block", F.explode(F.sequence(first, last)))
    cut = cut.filter(F.col("block") < F.floor(F.col("_tot") / block))
    start = F.greatest(F.col("block") * block - F.col("_off"), F.lit(0)).cast("int")
    stop = F.least((F.col("block") + 1) * block - F.col("_off"), F.col("_len")).cast("int")
    cut = cut.select("batch", "block", (F.col("_off") + start).alias("_g"),
                     F.slice(F.col(tokens_col), start + 1, stop - start).alias("_part"))
    blocks = cut.groupBy("batch", "block").agg(F.array_sort(F.collect_list(F.struct("_g", "_part"))).alias("_s"))
    toks = F.flatten(F.transform("_s", lambda s: s["_part"]))
    return blocks.select("batch", "block", toks.alias("tokens"), toks.alias("labels"))


def few_shot_demos(examples: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int = 2,
                   seed: int = 42) -> Column:
    """A demo block (scalar subquery) of ``per_class`` examples per class,
    picked in md5(seed:id) order; classes in label order."""
    h = examples.select(id_col, text_col, label_col, h60(hash_key(F.lit(seed), id_col)).alias("_h"))
    # Each task keeps its own first ``per_class`` rows of a class before the shuffle (a window group limit).
    w = Window.partitionBy(label_col).orderBy("_h", id_col)
    r = h.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= per_class)
    line = F.concat(F.lit("Text: "), F.col(text_col), F.lit("\nLabel: "), F.col(label_col).cast("string"))
    demos = r.select(F.struct(label_col, "_rk", line.alias("_l")).alias("s")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["_l"]), "\n\n").alias("d"))
    return demos.scalar()


# Instruction text of the prompted classifier (ours).
INSTRUCTIONS = ("Decide whether the text belongs to the positive class. "
                "Answer with 1 for yes and 0 for no.")


def prompt_rows(docs: DataFrame, text_col: str, demos: Column | None = None,
                instructions: str = INSTRUCTIONS) -> Column:
    """Instructions, optional demos, then the text to classify."""
    parts = [F.lit(instructions + "\n\n")]
    if demos is not None:
        parts += [demos, F.lit("\n\n")]
    parts += [F.lit("Text: "), F.col(text_col), F.lit("\nLabel:")]
    return F.concat(*parts)
