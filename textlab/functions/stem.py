"""German Snowball stemmer (the published algorithm) and its Spark use.

The stemmer is a small per-word helper.  Two ways to apply it:
* ``method="udf"`` (default): an Arrow UDF over the token arrays; each Python
  worker memoises stems, so every distinct word is stemmed about once per
  worker and no rows are shuffled.
* ``method="join"``: stem the distinct vocabulary once (pandas UDF on the
  vocabulary table), then join it back to (doc, position, token) rows and
  re-collect per document (two shuffles, no per-token Python).
(A map literal is not used: Spark looks keys up in a map by linear scan.)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the algorithm: vowels and valid s / st endings.
VOWELS = set("aeiouyäöü")
S_ENDING = set("bdfghklmnrt")
ST_ENDING = set("bdfghklmnt")

STEP1 = ["ern", "em", "er", "en", "es", "e", "s"]
STEP2 = ["est", "en", "er", "st"]
STEP3 = ["isch", "lich", "heit", "keit", "end", "ung", "ig", "ik"]

_MEMO: dict[str, str] = {}
_MEMO_MAX = 200_000


def _region(w: str, start: int) -> int:
    for i in range(start + 1, len(w)):
        if w[i] not in VOWELS and w[i - 1] in VOWELS:
            return i + 1
    return len(w)


def _longest(w: str, suffixes) -> str | None:
    best = None
    for s in suffixes:
        if w.endswith(s) and (best is None or len(s) > len(best)):
            best = s
    return best


def german_stem(word: str) -> str:
    w = word.lower().replace("ß", "ss")
    chars = list(w)
    for i in range(1, len(chars) - 1):
        if chars[i - 1] in VOWELS and chars[i + 1] in VOWELS:
            if chars[i] == "u":
                chars[i] = "U"
            elif chars[i] == "y":
                chars[i] = "Y"
    w = "".join(chars)
    r1_raw = _region(w, 0)
    r2 = _region(w, r1_raw)
    r1 = max(r1_raw, 3)

    # Step 1
    s = _longest(w, STEP1)
    if s is not None and len(w) - len(s) >= r1:
        if s in ("em", "ern", "er"):
            w = w[: -len(s)]
        elif s in ("e", "en", "es"):
            w = w[: -len(s)]
            if w.endswith("niss"):
                w = w[:-1]
        elif s == "s" and len(w) >= 2 and w[-2] in S_ENDING:
            w = w[:-1]
    # Step 2
    s = _longest(w, STEP2)
    if s is not None and len(w) - len(s) >= r1:
        if s in ("en", "er", "est"):
            w = w[: -len(s)]
        else:  # st: valid st-ending, itself preceded by at least 3 letters
            i = len(w) - 2
            if i - 1 >= 3 and w[i - 1] in ST_ENDING:
                w = w[:-2]
    # Step 3 (region tests inside each case)
    s = _longest(w, STEP3)
    if s is not None:
        start = len(w) - len(s)
        if s in ("end", "ung"):
            if start >= r2:
                w = w[:start]
                if w.endswith("ig") and not w[:-2].endswith("e") and len(w) - 2 >= r2:
                    w = w[:-2]
        elif s in ("ig", "ik", "isch"):
            if not w[:start].endswith("e") and start >= r2:
                w = w[:start]
        elif s in ("lich", "heit"):
            if start >= r2:
                w = w[:start]
                for e in ("er", "en"):
                    if w.endswith(e) and len(w) - 2 >= r1:
                        w = w[:-2]
                        break
        elif s == "keit":
            if start >= r2:
                w = w[:start]
                t = _longest(w, ["lich", "ig"])
                if t is not None and len(w) - len(t) >= r2:
                    w = w[: -len(t)]
    return (w.replace("U", "u").replace("Y", "y").replace("ä", "a").replace("ö", "o").replace("ü", "u"))


def _stem_series(words: pd.Series) -> pd.Series:
    return words.map(lambda x: None if x is None else german_stem(x))


def stem_udf(c) -> Column:
    """Pandas UDF (Arrow batches) stemming a string column."""
    return F.pandas_udf(_stem_series, "string")(c)


def stem_vocabulary(token_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(term, stem) for every distinct token (one shuffle, partial distinct)."""
    vocab = token_df.select(F.explode(tokens_col).alias("term")).distinct()
    return vocab.select("term", stem_udf("term").alias("stem"))


def _stem_cached(w: str) -> str:
    v = _MEMO.get(w)
    if v is None:
        v = german_stem(w)
        if len(_MEMO) < _MEMO_MAX:
            _MEMO[w] = v
    return v


def _stem_lists(lists: pa.Array) -> pa.Array:
    """Stems of lists of tokens: only a batch's distinct words become Python strings, its tokens stay numbers."""
    coded = lists.flatten().dictionary_encode()
    stems = pa.array([None if w is None else _stem_cached(w) for w in coded.dictionary.to_pylist()], pa.string())
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, stems.take(coded.indices), mask=lists.is_null())


def stem_tokens(token_df: DataFrame, tokens_col: str = "tokens", out_col: str | None = None,
                id_col: str | None = None, method: str = "udf") -> DataFrame:
    """Replace every token by its stem (see the module note for the methods)."""
    out_col = out_col or tokens_col
    if method == "udf":
        f = F.arrow_udf(_stem_lists, "array<string>")
        return token_df.withColumn(out_col, f(F.col(tokens_col)))
    if id_col is None:
        raise ValueError("method='join' needs id_col to collect stems back per document")
    vocab = stem_vocabulary(token_df, tokens_col)
    ex = token_df.select(id_col, F.posexplode(tokens_col).alias("_pos", "term"))
    j = ex.join(vocab, "term")
    back = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_pos", "stem"))).alias("_s"))
    back = back.select(id_col, F.transform("_s", lambda s: s["stem"]).alias(out_col))
    rest = token_df.drop(out_col) if out_col in token_df.columns else token_df
    return rest.join(back, id_col, "left").withColumn(
        out_col, F.coalesce(F.col(out_col), F.array().cast("array<string>")))
