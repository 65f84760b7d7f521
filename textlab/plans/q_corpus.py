"""Augmentation and corpus-preparation queries (P1-P9), stemming."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions import text as T
from textlab.functions.hashing import h60_sql
from textlab.functions.stem import stem_tokens, stem_vocabulary
from textlab.functions.tokens import tokens
from textlab.operators import corpus as C
from textlab.operators import rules as R
from textlab.operators.augment import augment_folds, augment_rounds
from textlab.operators.splits import stratified_splits
from textlab.plans import sqltext as S
from textlab.plans.registry import register
from textlab.plans.views import CATEGORIES_SQL, categories_col, labelled_docs, title_col, title_sql
from textlab.sources.tables import read_table

_TOK = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
_COMPACT_SQL = S.title_cats_compact(title_sql(), S.list_join(CATEGORIES_SQL), "coalesce(source, '')", "text")


def _compact(df):
    return T.title_cats_compact(title_col(), T.list_join(categories_col()), F.coalesce("source", F.lit("")), "text")


@register("split_metadata", f"""
WITH c AS (SELECT doc_id, {_COMPACT_SQL} AS t FROM documents)
SELECT doc_id, regexp_matches(t, '{C.METADATA_PATTERN}') AS has_meta,
       regexp_extract(t, '{C.METADATA_PATTERN}', 1) AS title,
       regexp_extract(t, '{C.METADATA_PATTERN}', 2) AS meta,
       CASE WHEN regexp_matches(t, '{C.METADATA_PATTERN}')
            THEN regexp_extract(t, '{C.METADATA_PATTERN}', 1) || ': ' || regexp_extract(t, '{C.METADATA_PATTERN}', 3)
            ELSE t END AS to_rewrite
FROM c""")
def q_split_metadata(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    p = C.split_metadata(_compact(d))
    return d.select("doc_id", p["has_meta"].alias("has_meta"), p["title"].alias("title"), p["meta"].alias("meta"),
                    p["to_rewrite"].alias("to_rewrite"))


@register("label_names", """
SELECT doc_id, CASE quality WHEN 0 THEN 'dfn' WHEN 1 THEN 'dfy' END AS label_name,
       CAST(CASE CASE quality WHEN 0 THEN 'dfn' WHEN 1 THEN 'dfy' END WHEN 'dfn' THEN 0 WHEN 'dfy' THEN 1 END AS INTEGER)
         AS label_back
FROM labels""")
def q_label_names(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    n = C.label_name("quality")
    return lab.select("doc_id", n.alias("label_name"), C.label_from_name(n).alias("label_back"))


@register("mask_tokens", f"""
SELECT doc_id, list_transform(tok, lambda x, i: CASE WHEN
   {h60_sql("'42:' || CAST(doc_id AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR)")} / {float(1 << 60)} < 0.15
   THEN '[MASK]' ELSE x END) AS masked
FROM (SELECT doc_id, {_TOK} AS tok FROM documents)""")
def q_mask_tokens(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", tokens("text").alias("tok"))
    return d.select("doc_id", C.mask_tokens("tok", "doc_id", 0.15, 42).alias("masked"))


@register("fit_length", f"""
SELECT doc_id, list_resize(tok[1:512], 512, '[PAD]') AS input_tokens
FROM (SELECT doc_id, {_TOK} AS tok FROM documents)""")
def q_fit_length(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", tokens("text").alias("tok"))
    return d.select("doc_id", C.fit_length("tok", 512).alias("input_tokens"))


@register("pack_blocks", f"""
WITH d AS (SELECT doc_id, {_TOK} AS tok FROM documents),
r AS (SELECT doc_id, tok, len(tok) AS n, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 1000) AS BIGINT) AS batch
      FROM d),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY batch ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
             sum(n) OVER (PARTITION BY batch) AS tot FROM r),
e AS (SELECT batch, off + p - 1 AS g, tot, tok[p] AS t FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM o)),
b AS (SELECT batch, CAST(floor(g / 512) AS BIGINT) AS block, g, t FROM e WHERE floor(g / 512) < floor(tot / 512))
SELECT batch, block, list(t ORDER BY g) AS tokens, list(t ORDER BY g) AS labels FROM b GROUP BY batch, block""")
def q_pack_blocks(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", tokens("text").alias("tok"))
    return C.pack_blocks(d, "doc_id", "tok", 512, 1000)


@register("prompt_table", """
WITH lab AS (SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY """ + h60_sql("'42:' || CAST(doc_id AS VARCHAR)")
          + """, doc_id) AS rk FROM lab),
demos AS (SELECT string_agg('Text: ' || text || chr(10) || 'Label: ' || CAST(label AS VARCHAR), chr(10) || chr(10)
                            ORDER BY label, rk) AS d FROM r WHERE rk <= 2)
SELECT doc_id, '""" + C.INSTRUCTIONS + """' || chr(10) || chr(10) || demos.d || chr(10) || chr(10) || 'Text: ' || text
       || chr(10) || 'Label:' AS prompt
FROM documents, demos""")
def q_prompt_table(spark, sf_dir):
    lab = labelled_docs(spark, sf_dir).select("doc_id", "text", "label")
    demos = C.few_shot_demos(lab, "doc_id", "text", "label", 2, 42)
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", C.prompt_rows(d, "text", demos).alias("prompt"))


@register("stem_vocab")
def q_stem_vocab(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select(tokens("text").alias("tokens"))
    return stem_vocabulary(d, "tokens")


@register("mine_rules_stemmed")
def q_mine_rules_stemmed(spark, sf_dir):
    # The reference's default: German stems, unigrams + bigrams, min_df 3, 1000 terms, score > 0.94.
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text", strict=True).alias("tokens"))
    docs = stem_tokens(docs, "tokens", id_col="doc_id")
    return R.mine_rules(docs, "label", "tokens", min_df=3, max_features=1000, threshold=0.94, ngram_range=(1, 2))


def _compact_labelled(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id").select("doc_id", "label", _compact(d).alias("text"))


@register("augment_rounds")
def q_augment_rounds(spark, sf_dir):
    return augment_rounds(_compact_labelled(spark, sf_dir), "doc_id", "text", "label", rounds=2)


@register("augment_folds")
def q_augment_folds(spark, sf_dir):
    docs = _compact_labelled(spark, sf_dir)
    folds = stratified_splits(docs, "doc_id", "label", 10, 0.3, 42)
    return augment_folds(docs, folds, "doc_id", "text", "label", factor=2)
