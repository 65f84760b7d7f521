"""Merkle manifest of a table of documents, with nested-interval labels.

Every row is a leaf: the sha256 of its five fields.  The leaves of a language, in the order of their ids, are hashed in
runs of eight, and the results again, until one node remains; the nodes of the languages are hashed likewise into one root.

A node is labelled with the interval of leaf ranks it covers, ``lo``..``hi``, and its level.  All nodes of a level that
share a parent lie in one bucket ``lo // 8 ** level of the parent``, so a node meets its parent in an equi-join on (tree,
bucket) under the condition that the parent's interval contains its own.  The siblings are what is left of the parent's
interval without the node's: children that end before it, and children that begin after it.  Joins run from the top level
down, and every node takes its parent's path along, so no ancestor is joined to more than its eight children however
many leaves lie below it.  A path holds, from the leaf up, what is hashed before and after the node at each level.

Scale: texts are read once, in the pass that hashes them; everything after it works on rows of a few digests.  Ranks
come from a range partitioning (``ordered.running``), so a language with most of the rows is spread like any other.  The
levels shrink by eight, and each is written once.  Nothing but the root's digest and the number of levels is sent to the
driver.

Defined cases: a null field is hashed as ``-`` and the empty text as ``0:``; a null id comes first in its language and is
not tampered with; a null language is a tree of its own, the first one; rows with the same id are ordered by their digest,
and repeated rows are leaves each; a language with one row has that leaf as its subroot; an empty table has no rows and
no root; very long texts are hashed whole, as one value of the JVM; other columns do not enter, and clashing names are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.ordered import running
from textlab.llm.tables import discard, written

FANOUT = 8
_BITS = 3  # of a rank that one level takes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<before:string,after:string>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    return hashed(*[field(columns[f]) for f in FIELDS])


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text as the tampering leaves it: A-Z in lower case where 3 divides the crc32 of the id's decimal text."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def _fold(path: Column, start: Column) -> Column:
    """The digest at the top of ``path`` (steps from the leaf up) when ``start`` is at its foot."""
    return F.aggregate(path, start, lambda acc, s: hashed(s["before"], acc, s["after"]))


def _bucket(rank: Column, level: int) -> Column:
    """The run of ``level`` that a rank lies in: rank // 8 ** level."""
    return F.shiftright(rank, _BITS * level)


def _runs(nodes: DataFrame, level: int, members: list[str]) -> DataFrame:
    """Parents at ``level`` of ``nodes`` (_tree, _size, lo, hi, digest): (_tree, _size, lo, hi, digest, children).

    A tree of one leaf has no step from it: its parent at level 1 only carries it on, with the leaf's own digest.
    """
    child = F.struct("lo", "hi", "digest", *members)
    rows = (nodes.groupBy("_tree", _bucket(F.col("lo"), level).alias("_bucket"))
            .agg(F.sort_array(F.collect_list(child)).alias("children"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                 F.first("_size").alias("_size")))
    text = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    return rows.select("_tree", "_size", "lo", "hi",
                       F.when(F.col("_size") == 1, F.col("children")[0]["digest"]).otherwise(F.sha2(text, 256)).alias("digest"),
                       "children")


def _steps(siblings: Column, lo: Column, hi: Column, size: Column) -> Column:
    """The step of the node ``lo``..``hi`` in its parent: digests of the siblings before and after it, none in a tree of one."""
    def digests(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda s: s["digest"]), "")
    step = F.struct(digests(F.filter(siblings, lambda s: s["hi"] < lo)).alias("before"),
                    digests(F.filter(siblings, lambda s: s["lo"] > hi)).alias("after"))
    return F.when(size == 1, F.array().cast(f"array<{_STEP}>")).otherwise(F.array(step))


class Tree:
    """Levels of the trees over ranked leaves, each written once.

    ``leaves`` has ``_tree`` (not null), ``_size`` (leaves of the tree), ``lo`` = ``hi`` = rank, ``digest`` and the columns
    ``members``, which the lowest level keeps.
    """

    def __init__(self, leaves: DataFrame, members: list[str], name: str):
        self.members = members
        first, _ = written(_runs(leaves, 1, members), f"{name}-1")
        self.levels = [first]
        most = first.agg(F.max("_size")).first()[0] or 0
        while FANOUT ** len(self.levels) < most:
            at = len(self.levels)
            below = self.levels[-1].where(F.col("_size") > FANOUT ** at).select("_tree", "_size", "lo", "hi", "digest")
            self.levels.append(written(_runs(below, at + 1, []), f"{name}-{at + 1}")[0])

    def tops(self) -> DataFrame:
        """(_tree, digest): the last node of every tree."""
        out = None
        for at, nodes in enumerate(self.levels, 1):
            top = nodes.where((F.col("_size") <= FANOUT ** at)).select("_tree", "digest")
            out = top if out is None else out.unionByName(top)
        return out

    def paths(self, above: DataFrame, carried: list[str]) -> DataFrame:
        """The runs of the lowest level with ``path``, the steps from them to the top and on along ``above.path``.

        ``above`` (_tree, path, *carried) has one row a tree.
        """
        down = None
        for at in range(len(self.levels), 0, -1):
            nodes = self.levels[at - 1]
            tops = nodes.where(F.col("_size") <= FANOUT ** at).join(above, "_tree")
            if down is not None:
                parent = down.select(F.col("_tree").alias("_t"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                     _bucket(F.col("lo"), at + 1).alias("_b"),
                                     F.col("children").alias("_family"), F.col("path").alias("_path"), *carried)
                inner = nodes.where(F.col("_size") > FANOUT ** at).join(
                    parent, (F.col("_tree") == F.col("_t")) & (_bucket(F.col("lo"), at + 1) == F.col("_b"))
                    & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
                inner = inner.withColumn("path", F.concat(_steps(F.col("_family"), F.col("lo"), F.col("hi"), F.col("_size")), "_path"))
                tops = tops.unionByName(inner.select(*tops.columns))
            down = tops if at == 1 else written(tops, "merkle-paths")[0]
        return down


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, lo (its rank in the language), leaf, subroot, root, path (steps of sibling
    digests before and after, from the leaf to the root) and tampered, the leaf after the tampering."""
    columns = {f: F.col(f"`{f}`") for f in FIELDS}
    other = dict(columns, text=tampered_text(columns["doc_id"], columns["text"]))
    same = other["text"].eqNullSafe(columns["text"])
    leaf = leaf_of(columns)
    rows = docs.select(columns["doc_id"].alias("doc_id"), columns["lang"].alias("lang"), leaf.alias("digest"),
                       F.when(~same, leaf_of(other)).alias("tampered"),
                       F.coalesce(F.concat(F.lit("1"), columns["lang"]), F.lit("0")).alias("_tree"))
    rows, rows_path = written(rows, "merkle-hashed")  # the range partitioning samples its input: texts are hashed once
    ranked = running(rows, ["_tree"], ["doc_id", "digest"], name="merkle-leaves").select(
        "_tree", F.col("_rows").alias("_size"), F.col("_rank").alias("lo"), F.col("_rank").alias("hi"),
        "digest", "doc_id", "lang", F.coalesce("tampered", "digest").alias("tampered"))
    discard(rows, rows_path)
    trees = Tree(ranked, ["doc_id", "lang", "tampered"], "merkle-language")
    subroots = running(trees.tops().withColumnRenamed("_tree", "_lang_tree").withColumn("_tree", F.lit("")), ["_tree"], ["_lang_tree"],
                       name="merkle-subroots")
    upper = Tree(subroots.select("_tree", F.col("_rows").alias("_size"), F.col("_rank").alias("lo"), F.col("_rank").alias("hi"),
                                 "digest", "_lang_tree"), ["_lang_tree"], "merkle-root")
    root = upper.tops().first()
    root = F.lit(root["digest"] if root else None).cast("string")
    none = docs.sparkSession.createDataFrame([("",)], "_tree string").withColumn("path", F.array().cast(f"array<{_STEP}>"))
    by_language = _members(upper.paths(none, []), ["_lang_tree"], []).select(
        F.col("_lang_tree").alias("_tree"), F.col("digest").alias("subroot"), "path")
    return _members(trees.paths(by_language, ["subroot"]), trees.members, ["subroot"]).select(
        "doc_id", "lang", "lo", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path", "tampered")


def _members(runs: DataFrame, members: list[str], carried: list[str]) -> DataFrame:
    """The leaves of ``runs`` with their whole path."""
    one = runs.select("_size", "children", "path", *carried, F.explode("children").alias("_c"))
    step = _steps(F.col("children"), F.col("_c.lo"), F.col("_c.hi"), F.col("_size"))
    return one.select(F.col("_c.lo").alias("lo"), F.col("_c.digest").alias("digest"), *[F.col(f"_c.{m}").alias(m) for m in members],
                      *carried, F.concat(step, "path").alias("path"))


def proofs(made: DataFrame) -> DataFrame:
    """``manifest``'s rows as digests: proof_sha256 of all siblings, folded_root from the tampered leaf, verified."""
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    return (made.withColumn("proof_sha256", proof).withColumn("folded_root", _fold(F.col("path"), F.col("tampered")))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def op11_merkle_intervals(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with each one's proof checked after the tampering."""
    return proofs(manifest(spark.read.parquet(f"{sf_dir}/documents.parquet")))


#: crc32 of the decimal text of doc_id, bit by bit.
_CRC_SQL = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
        lambda d, i: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295), 4294967295)"""


def _level_sql(tree: str, level: int, last: int) -> str:
    """Level ``level`` (and its steps) of the trees whose leaves are the table ``{tree}0`` (g, i, n, digest)."""
    below, this = f"{tree}{level - 1}", f"{tree}{level}"
    text = f"""{this} AS (SELECT g, i // 8 AS i, any_value(n) AS n,
        CASE WHEN any_value(n) > {8 ** (level - 1)} THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest
        FROM {below} GROUP BY g, i // 8),
    {tree}step{level} AS (SELECT a.g, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after, any_value(a.n) > {8 ** (level - 1)} AS real
        FROM {below} a JOIN {below} b ON a.g = b.g AND a.i // 8 = b.i // 8 GROUP BY a.g, a.i)"""
    return text if level == last else text + ",\n" + _level_sql(tree, level + 1, last)


def _climb_sql(tree: str, source: str, last: int) -> tuple[str, str, str]:
    """Joins, siblings and folded digest of ``last`` levels above ``source`` (g, i, start)."""
    joins, proof, fold = "", [], f"{source}.start"
    for k in range(1, last + 1):
        t = f"{tree}s{k}"
        joins += f" JOIN {tree}step{k} {t} ON {t}.g = {source}.g AND {t}.i = {source}.i // {8 ** (k - 1)}"
        proof.append(f"CASE WHEN {t}.real THEN {t}.before || {t}.after ELSE '' END")
        fold = f"CASE WHEN {t}.real THEN sha256({t}.before || {fold} || {t}.after) ELSE {fold} END"
    return joins, " || ".join(proof), fold


def _oracle(leaf_levels: int = 7, root_levels: int = 2) -> str:
    """DuckDB SQL of ``op11_merkle_intervals`` for languages of at most 8 ** leaf_levels rows."""
    def one(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"
    joins, proof, fold = _climb_sql("t", "d", leaf_levels)
    ujoins, uproof, ufold = _climb_sql("u", "s", root_levels)
    return f"""
WITH docs AS (SELECT *, CASE WHEN {_CRC_SQL} % 3 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END AS other
    FROM documents),
d AS (SELECT doc_id, {one('text')} AS digest, {one('other')} AS start, coalesce('1' || lang, '0') AS g FROM docs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n FROM d),
t0 AS (SELECT g, i, n, digest FROM leaves),
{_level_sql('t', 1, leaf_levels)},
sub AS (SELECT g AS lang_tree, digest, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t{leaf_levels}),
u0 AS (SELECT g, i, n, digest FROM sub),
{_level_sql('u', 1, root_levels)},
low AS (SELECT d.doc_id, d.digest AS leaf, d.g AS lang_tree, {proof} AS proof, {fold} AS folded FROM leaves d{joins}),
top AS (SELECT low.*, sub.digest AS subroot, sub.g, sub.i, low.folded AS start FROM low JOIN sub ON low.lang_tree = sub.lang_tree)
SELECT s.doc_id, s.leaf, s.subroot, r.digest AS root, sha256(s.proof || {uproof}) AS proof_sha256,
    {ufold} AS folded_root, ({ufold}) = r.digest AS verified
FROM top s{ujoins} CROSS JOIN u{root_levels} r"""


SQL = _oracle()
