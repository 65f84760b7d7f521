"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, address schemes and identifier cues.
Each anchor is handed to a small deterministic parser that looks only at the characters around it, expands to the
item's boundaries and validates it:

==========  =====================  ================================================================================
kind        anchor                 item
==========  =====================  ================================================================================
email       ``@``                  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
ip          digit                  four numbers joined by dots, each at most 255
card        digit                  14 to 19 digits, single blanks or hyphens between, Luhn checksum right
phone       ``+``                  ``+``, digit, then digits, blanks, brackets, dots, hyphens, 10 to 15 digits in all
address     ``://``, ``mailto:``   an address that names a user: ``scheme://user[:password]@host...`` or ``mailto:``
account     cue word               an IBAN with right checksum, or a number of 6 to 20 digits, after the cue
==========  =====================  ================================================================================

Items of one kind never overlap and are the leftmost ones; an item that fails its check is dropped whole, without a
second try inside it.  Items of different kinds may overlap.  Positions are code points, ends exclusive.

Scale: one scan, no shuffle, nothing gathered; work is linear in a text's length.

Defined cases: null texts count as empty and have no spans; repeated rows each get their row; equal starts are ordered
by kind as listed; an empty table gives an empty result; other columns pass through (or are left out) untouched, one
named like an added column is replaced by it.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.textkit import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
ORDER = {k: i for i, k in enumerate(KINDS)}

#: Words that announce an account or identity number, in any case (fixed values).
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport", "customer id", "member id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USER_URL = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s<>\"']*)?")
_CUE_NUMBER = re.compile(r"[\x20:#=.]{0,3}(?:(?i:no|nr|num|number|nummer|id)\b[\x20:#=.]{0,3})?"
                         r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}|[0-9](?:[\x20-]?[0-9]){5,19})(?![A-Za-z0-9])")
_STATE: dict[str, ahocorasick.Automaton] = {}


_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


def _anchors() -> ahocorasick.Automaton:
    """The automaton, in lower case; one per Python worker."""
    if not _STATE:
        found = ahocorasick.Automaton()
        found.add_word("@", ("at", 1))
        found.add_word("+", ("plus", 1))
        for c in "0123456789":
            found.add_word(c, ("digit", 1))
        found.add_word("://", ("url", 3))
        found.add_word("mailto:", ("mail", 7))
        for cue in CUES:
            found.add_word(cue, ("cue", len(cue)))
        found.make_automaton()
        _STATE["anchors"] = found
    return _STATE["anchors"]


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _ip_items(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Valid quadruples of the chain of dotted numbers that starts at ``at``, and the chain's end."""
    chain = _IP_CHAIN.match(text, at)
    end = chain.end()
    if "." not in chain.group():
        return [], end
    parts, starts, pos = chain.group().split("."), [], at
    for p in parts:
        starts.append(pos)
        pos += len(p) + 1
    items = []
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        if all(len(v := p.lstrip("0")) <= 3 and int(v or "0") <= 255 for p in four):
            items.append((starts[k], starts[k + 3] + len(four[3])))
    return items, end


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All items as (kind, start, end), by start, then kind."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    email_end = ip_end = card_end = account_end = address_end = 0
    # Only A-Z are lowered, so places stay the same.
    for last, (kind, size) in _anchors().iter(text.lower() if text.isascii() else text.translate(_LOWER)):
        if kind == "digit":
            if last >= ip_end:
                items, ip_end = _ip_items(text, last)
                out += [("ip", a, b) for a, b in items]
            if last >= card_end:
                card_end = _CARD_CHAIN.match(text, last).end()
                if card_end - last >= 14:
                    digits = text[last:card_end].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn_ok(digits):
                        out.append(("card", last, card_end))
        elif kind == "at":
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, last + 1)):
                email_end = m.end()
                out.append(("email", start, email_end))
        elif kind == "plus":
            if (m := _PHONE.match(text, last)) and 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", last, m.end()))
        elif kind == "cue":
            begin = last + 1 - size
            if last + 1 >= account_end and not text[begin - 1:begin].isalnum() and (m := _CUE_NUMBER.match(text, last + 1)):
                found = m.group(1)
                if found[0].isdigit() or iban_ok(found):
                    account_end = m.end(1)
                    out.append(("account", m.start(1), account_end))
        elif last >= address_end:
            begin = last + 1 - size
            if kind == "url":
                while begin > address_end and text[begin - 1].isascii() and text[begin - 1].isalpha():
                    begin -= 1
            if (m := _USER_URL.match(text, last + 1)) and (kind == "mail" or begin < last - 2):
                address_end = m.end()
                out.append(("address", begin, address_end))
    out.sort(key=lambda s: (s[1], ORDER[s[0]], s[2]))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col``: array of struct(kind, start, end) of every whole text."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in batch.column(text_col).to_pylist()]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return [pa.array(found, type=pa.list_(kind))]

    return map_batches(docs, run, f"{spans_col} array<struct<kind:string,start:bigint,end:bigint>>", keep=keep)


def mask_text(text: str | None) -> str | None:
    """The text with each item (overlapping ones merged, named by the first) replaced by its kind in angle brackets."""
    spans = find_spans(text) if text else []
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data masked in ``text_col``; all columns in their order, other columns untouched."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([mask_text(t) for t in batch.column(text_col).to_pylist()], type=pa.string())]

    return map_batches(docs, run, f"`{text_col}` string").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_pii_anchors(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base kinds, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [find_spans(t) for t in batch.column("text").to_pylist()]
        base = [[s for s in r if s[0] in BASE_KINDS] for r in rows]
        counts = [pa.array([sum(s[0] == k for s in r) for r in base], type=pa.int64()) for k in BASE_KINDS]
        digest = [hashlib.sha256(joined(r).encode()).hexdigest() for r in base]
        return [*counts, pa.array(digest, type=pa.string()), pa.array([joined(r) for r in rows], type=pa.string())]

    return map_batches(docs, run, "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
                       keep=["doc_id"])
