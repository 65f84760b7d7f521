"""Text preparation as native column expressions.

The reference runs per-row Python parsers (HTML -> Markdown -> HTML -> text).
Here each step is an ordered chain of ``regexp_replace``/``replace`` calls
that stays inside whole-stage codegen.  The chains cover the tag set listed
below, not full HTML: they are tag-aware text cleaners, not parsers.

All regular expressions stay in the subset shared by Java regex and RE2 (no
look-around, no back-references) so that the DuckDB oracle runs the very
same patterns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section headings removed from descriptions, in this order.
SECTION_WORDS = ["Kurztext", "Volltext", "Ziel und Gegenstand"]

# Labels of the category block in the text templates.
AREA_LABEL = "Förderbereich"
APPLICANTS_LABEL = "Förderberechtigte"

# Blocks removed with their content, then tags kept by html_clean.
DROP_BLOCKS = [r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"]
KEEP_TAGS = "p|br|h1|h2|h3|h4|h5|h6|ul|ol|li|strong|em|b|i|blockquote"
# HTML entities decoded (``&amp;`` last).
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
WHITESPACE = r"[ \t\n\r\f]+"
STRIP = r"^[ \t\n\r\f]+|[ \t\n\r\f]+$"
# Tags inside running text; removing one joins what stands on its sides.
INLINE_TAGS = r"(?i)</?(a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|u)(\s[^>]*)?/?>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def list_join(c, sep: str = ", ") -> Column:
    """List -> string; null list -> ''; null elements are skipped."""
    return F.array_join(F.coalesce(_c(c), F.array().cast("array<string>")), sep)


def list_split(c) -> Column:
    """String -> list on commas, dropping the blanks after each comma."""
    return F.split(_c(c), r",\s*")


def strip_title(text, title) -> Column:
    """Remove every literal occurrence of the title (empty title: no-op)."""
    t, ti = _c(text), _c(title)
    return F.when(F.coalesce(F.length(ti), F.lit(0)) == 0, t).otherwise(F.replace(t, ti, F.lit("")))


def strip_section_words(text, words: Sequence[str] = SECTION_WORDS) -> Column:
    """For each word in order, strip white space at both ends, then remove every occurrence."""
    out = _c(text)
    for w in words:
        out = F.replace(F.regexp_replace(out, STRIP, ""), F.lit(w), F.lit(""))
    return out


def _drop_blocks(c: Column) -> Column:
    for p in DROP_BLOCKS:
        c = F.regexp_replace(c, p, "")
    return c


def _decode_entities(c: Column) -> Column:
    for k, v in ENTITIES:
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def html_to_text(html) -> Column:
    """Drop script/style/comments, remove inline tags, replace other tags
    by a blank, decode the common entities, collapse white space, trim."""
    c = _drop_blocks(_c(html))
    c = F.regexp_replace(c, INLINE_TAGS, "")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    c = _decode_entities(c)
    return F.trim(F.regexp_replace(c, WHITESPACE, " "))


# (pattern, spark replacement) pairs of the HTML -> Markdown chain.  The
# DuckDB oracle uses the same patterns with \\1-style group references.
MD_RULES = (
    [(rf"(?is)<h{n}[^>]*>(.*?)</h{n}>", "\n" + "#" * n + " $1\n") for n in range(1, 7)]
    + [
        (r"(?is)<(strong|b)(\s[^>]*)?>(.*?)</(strong|b)>", "**$3**"),
        (r"(?is)<(em|i)(\s[^>]*)?>(.*?)</(em|i)>", "*$3*"),
        (r"(?is)<a\s[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>", "[$2]($1)"),
        (r"(?i)<li[^>]*>", "\n- "),
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)</?p[^>]*>", "\n\n"),
        (r"<[^>]*>", ""),
    ]
)


def html_to_md(html) -> Column:
    """Light Markdown for headings, bold/italic, links, list items,
    breaks and paragraphs; other tags dropped; entities decoded; runs of
    blank lines collapsed; trimmed."""
    c = _drop_blocks(_c(html))
    for pat, rep in MD_RULES:
        c = F.regexp_replace(c, pat, rep)
    c = _decode_entities(c)
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, r"\n[ \n]*\n", "\n\n")
    return F.trim(F.regexp_replace(c, r"^\n+|\n+$", ""))


def html_clean(html) -> Column:
    """Keep only allow-listed tags, without attributes; drop script,
    style and comments with their content; drop every other tag."""
    c = _drop_blocks(_c(html))
    c = F.regexp_replace(c, rf"(?i)<(/?)({KEEP_TAGS})(\s[^>]*)?/?>", "\u0001$1$2\u0002")
    c = F.regexp_replace(c, r"<[^>]*>", "")
    return F.replace(F.replace(c, F.lit("\u0001"), F.lit("<")), F.lit("\u0002"), F.lit(">"))


def cats_md(md, area, applicants) -> Column:
    """T5: Markdown + category block."""
    return F.format_string(f"%s\n\n---\n\n{AREA_LABEL}: %s\n\n{APPLICANTS_LABEL}: %s",
                           _c(md), _c(area), _c(applicants))


def title_cats_compact(title, area, applicants, text) -> Column:
    """``title (area label: a; applicants label: b): text-without-title``."""
    return F.format_string(f"%s ({AREA_LABEL}: %s; {APPLICANTS_LABEL}: %s): %s",
                           _c(title), _c(area), _c(applicants), strip_title(text, title))


def title_cats_compact_wo_sections(title, area, applicants, text,
                                   words: Sequence[str] = SECTION_WORDS) -> Column:
    """T6 with section headings removed (no leading newline or trailing
    blanks, unlike the reference's template)."""
    return F.format_string(f"%s ({AREA_LABEL}: %s; {APPLICANTS_LABEL}: %s): %s",
                           _c(title), _c(area), _c(applicants),
                           strip_section_words(strip_title(text, title), words))
