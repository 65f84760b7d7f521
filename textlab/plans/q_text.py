"""Text preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions import text as T
from textlab.functions.tokens import EDGE_PUNCTUATION, ngrams, tokens
from textlab.operators.explore import text_quality_report
from textlab.plans import sqltext as S
from textlab.plans.registry import register
from textlab.plans.views import CATEGORIES_SQL, categories_col, title_col, title_sql
from textlab.sources.tables import read_table

_TOK = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
_TOK_STRICT = (r"list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '\s+'), "
               f"lambda w: {S.rr('w', EDGE_PUNCTUATION, '')}), "
               r"lambda w: regexp_matches(w, '^[\p{L}\p{N}]+$'))")

# Section words that occur in the driver's documents (the default German
# headings occur in none of them).
_SECTIONS = ["License", "the", "token", "der"]


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages")


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


@register("html_to_text", f"SELECT page_id, {S.html_to_text('html')} AS text FROM pages")
def q_html_to_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.html_to_text("html").alias("text"))


@register("html_to_md", f"SELECT page_id, {S.html_to_md('html')} AS md FROM pages")
def q_html_to_md(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.html_to_md("html").alias("md"))


@register("html_clean", f"SELECT page_id, {S.html_clean('html')} AS html_clean FROM pages")
def q_html_clean(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", T.html_clean("html").alias("html_clean"))


@register("list_join", f"SELECT doc_id, {S.list_join(CATEGORIES_SQL)} AS categories FROM documents")
def q_list_join(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.list_join(categories_col()).alias("categories"))


@register("list_split", f"""SELECT doc_id, regexp_split_to_array({S.list_join(CATEGORIES_SQL)}, ',\\s*') AS parts
FROM documents""")
def q_list_split(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.list_split(T.list_join(categories_col())).alias("parts"))


@register("strip_title", f"SELECT doc_id, {S.strip_title('text', title_sql())} AS body FROM documents")
def q_strip_title(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.strip_title("text", title_col()).alias("body"))


@register("strip_section_words", f"SELECT doc_id, {S.strip_section_words('text', _SECTIONS)} AS body FROM documents")
def q_strip_section_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.strip_section_words("text", _SECTIONS).alias("body"))


_AREA_SQL = S.list_join(CATEGORIES_SQL)
_APP_SQL = "coalesce(source, '')"

_VARIANTS_SQL = f"""variants AS (
  SELECT doc_id,
         {S.cats_md('text', _AREA_SQL, _APP_SQL)} AS description_cats_md,
         {S.title_cats_compact(title_sql(), _AREA_SQL, _APP_SQL, 'text')} AS description_title_cats_compact,
         {S.title_cats_compact_wo_sections(title_sql(), _AREA_SQL, _APP_SQL, 'text', _SECTIONS)}
           AS description_title_cats_compact_wo_section_stopwords
  FROM documents)"""


def _variants(spark, sf_dir, *more):
    d = _docs(spark, sf_dir)
    area, app, title = T.list_join(categories_col()), F.coalesce("source", F.lit("")), title_col()
    return d.select(
        "doc_id", *more,
        T.cats_md("text", area, app).alias("description_cats_md"),
        T.title_cats_compact(title, area, app, "text").alias("description_title_cats_compact"),
        T.title_cats_compact_wo_sections(title, area, app, "text", _SECTIONS).alias(
            "description_title_cats_compact_wo_section_stopwords"))


@register("text_variants", "WITH " + _VARIANTS_SQL + " SELECT * FROM variants")
def q_text_variants(spark, sf_dir):
    return _variants(spark, sf_dir)


_VARIANT_COLS = ["description_cats_md", "description_title_cats_compact",
                 "description_title_cats_compact_wo_section_stopwords"]


@register("text_quality_report", "WITH " + _VARIANTS_SQL + ",\nraw AS (SELECT doc_id, text AS description_raw, "
          + f"{S.strip_title('text', title_sql())} AS description_text_only FROM documents)\n"
          + "\nUNION ALL\n".join(
              f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
              f"CAST(sum(CASE WHEN {c} = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty FROM "
              f"{'raw' if c.startswith('description_raw') or c == 'description_text_only' else 'variants'}"
              for c in ["description_raw", "description_text_only"] + _VARIANT_COLS))
def q_text_quality_report(spark, sf_dir):
    # One scan: raw text, title-free text and the variants are columns of one projection.
    d = _variants(spark, sf_dir, F.col("text").alias("description_raw"),
                  T.strip_title("text", title_col()).alias("description_text_only"))
    return text_quality_report(d, ["description_raw", "description_text_only"] + _VARIANT_COLS)


@register("tokens", f"SELECT doc_id, {_TOK} AS tokens FROM documents")
def q_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tokens("text").alias("tokens"))


@register("tokens_strict", f"SELECT doc_id, {_TOK_STRICT} AS tokens FROM documents")
def q_tokens_strict(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tokens("text", strict=True).alias("tokens"))


@register("ngrams", f"""SELECT doc_id, tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]) AS grams
FROM (SELECT doc_id, {_TOK} AS tok FROM documents)""")
def q_ngrams(spark, sf_dir):
    # Tokens are projected first so the n-gram lambda reads a column instead
    # of re-tokenising the text for every position.
    toks = _docs(spark, sf_dir).select("doc_id", tokens("text").alias("tok"))
    return toks.select("doc_id", ngrams("tok", 1, 2).alias("grams"))


@register("labeling_export", f"""SELECT page_id AS id, url,
       regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
       {S.html_to_md('html')} AS text, {S.html_clean('html')} AS text_html
FROM pages""")
def q_labeling_export(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select(F.col("page_id").alias("id"), "url",
                    F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
                    T.html_to_md("html").alias("text"), T.html_clean("html").alias("text_html"))


@register("delivery_positive", f"""SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, CAST(d.lang AS VARCHAR) AS lang,
       CAST(d.source AS VARCHAR) AS source, CAST(d.n_chars AS VARCHAR) AS n_chars,
       CAST(l.quality AS VARCHAR) AS label, {S.html_to_text('d.text')} AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1""")
def q_delivery_positive(spark, sf_dir):
    d = _docs(spark, sf_dir)
    lab = read_table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    return j.select(*[F.col(c).cast("string").alias(c) for c in ["doc_id", "lang", "source", "n_chars"]],
                    F.col("quality").cast("string").alias("label"), T.html_to_text("text").alias("text"))
