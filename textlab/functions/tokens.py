"""Tokenisation and n-grams as native array expressions (no UDF).

Fixed values: a token is a maximal run of Unicode letters or digits
(``[\\p{L}\\p{N}]+``) of the lower-cased text.  The strict mode splits on white
space, detaches punctuation from both ends of a token and keeps only tokens
that are then entirely letters/digits, so ``Bildung,`` gives ``bildung`` while
``ESF+``, ``z.B.`` or ``aus-`` are dropped as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (shared with the DuckDB oracle SQL).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
STRICT_TOKEN_PATTERN = r"^[\p{L}\p{N}]+$"
EDGE_PUNCTUATION = r"""^[.,;:!?()\[\]"'„“”‚‘’«»]+|[.,;:!?()\[\]"'„“”‚‘’«»]+$"""


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, strict: bool = False) -> Column:
    """array<string> of lower-cased word tokens; null/non-text gives []."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    if strict:
        parts = F.transform(F.split(t, r"\s+"), lambda w: F.regexp_replace(w, EDGE_PUNCTUATION, ""))
        return F.filter(parts, lambda w: w.rlike(STRICT_TOKEN_PATTERN))
    return F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)


def ngrams(toks, n_min: int = 1, n_max: int = 1) -> Column:
    """Word n-grams for every n in [n_min, n_max], joined by one blank.

    Order: all 1-grams in position order, then all 2-grams, ...  Arrays
    shorter than n contribute nothing for that n.  Pass a column (not an
    unevaluated expression): the lambda reads it once per position.
    """
    t = _col(toks)
    empty = F.array().cast("array<string>")
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        # n shifted views of the array zipped together: no per-position slice.
        m = F.size(t) - (n - 1)
        grams = F.slice(t, 1, m)
        for j in range(1, n):
            grams = F.zip_with(grams, F.slice(t, j + 1, m), _join_pair)
        parts.append(F.when(F.size(t) >= n, grams).otherwise(empty))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _join_pair(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit(" "), b)


def normalized_text(toks) -> Column:
    """Tokens joined by one blank: the text rules are matched against."""
    return F.array_join(_col(toks), " ")
