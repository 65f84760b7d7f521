"""DuckDB twins of the text expressions in ``textlab.functions.text``.

Generated from the same constants, so the oracle SQL and the Spark chain use
identical patterns; only the replacement syntax (``$1`` vs ``\\1``) and the
string-literal escaping differ.
"""

from __future__ import annotations

import re

from textlab.functions import text as T


def lit(s: str) -> str:
    """A DuckDB string expression for ``s`` (control characters via chr())."""
    parts, buf = [], []
    for ch in s:
        if ord(ch) < 32 and ch not in "\n\t":
            if buf:
                parts.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not parts:
        parts.append("'" + "".join(buf).replace("'", "''") + "'")
    return " || ".join(parts) if len(parts) > 1 else parts[0]


def _rep(spark_rep: str) -> str:
    return lit(re.sub(r"\$(\d)", r"\\\1", spark_rep))


def rr(expr: str, pattern: str, spark_rep: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {_rep(spark_rep)}, 'g')"


def drop_blocks(e: str) -> str:
    for p in T.DROP_BLOCKS:
        e = rr(e, p, "")
    return e


def decode_entities(e: str) -> str:
    for k, v in T.ENTITIES:
        e = f"replace({e}, {lit(k)}, {lit(v)})"
    return e


def html_to_text(e: str) -> str:
    e = rr(rr(drop_blocks(e), T.INLINE_TAGS, ""), r"<[^>]*>", " ")
    e = decode_entities(e)
    return f"trim({rr(e, T.WHITESPACE, ' ')})"


def html_to_md(e: str) -> str:
    e = drop_blocks(e)
    for pat, rep in T.MD_RULES:
        e = rr(e, pat, rep)
    e = decode_entities(e)
    e = rr(e, r"[ \t]+", " ")
    e = rr(e, r"\n[ \n]*\n", "\n\n")
    return f"trim({rr(e, '^' + chr(10) + '+|' + chr(10) + '+$', '')})"


def html_clean(e: str) -> str:
    e = drop_blocks(e)
    e = rr(e, rf"(?i)<(/?)({T.KEEP_TAGS})(\s[^>]*)?/?>", "\u0001$1$2\u0002")
    e = rr(e, r"<[^>]*>", "")
    return f"replace(replace({e}, chr(1), '<'), chr(2), '>')"


def list_join(e: str, sep: str = ", ") -> str:
    return f"array_to_string(coalesce({e}, []::VARCHAR[]), {lit(sep)})"


def strip_title(text: str, title: str) -> str:
    return f"CASE WHEN coalesce(length({title}), 0) = 0 THEN {text} ELSE replace({text}, {title}, '') END"


def strip_section_words(e: str, words=T.SECTION_WORDS) -> str:
    for w in words:
        e = f"replace({rr(e, T.STRIP, '')}, {lit(w)}, '')"
    return e


def cats_md(md: str, area: str, app: str) -> str:
    return (f"({md} || {lit(chr(10) * 2 + '---' + chr(10) * 2 + T.AREA_LABEL + ': ')} || {area} || "
            f"{lit(chr(10) * 2 + T.APPLICANTS_LABEL + ': ')} || {app})")


def title_cats_compact(title: str, area: str, app: str, text: str) -> str:
    return (f"({title} || {lit(' (' + T.AREA_LABEL + ': ')} || {area} || {lit('; ' + T.APPLICANTS_LABEL + ': ')}"
            f" || {app} || '): ' || {strip_title(text, title)})")


def title_cats_compact_wo_sections(title: str, area: str, app: str, text: str, words=T.SECTION_WORDS) -> str:
    return (f"({title} || {lit(' (' + T.AREA_LABEL + ': ')} || {area} || {lit('; ' + T.APPLICANTS_LABEL + ': ')}"
            f" || {app} || '): ' || {strip_section_words(strip_title(text, title), words)})")
