"""Anchor expansion equals plain regular expressions on fixtures and random strings."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from textlab.llm.pii_anchors import BASE_KINDS, ORDER, find_spans, luhn_ok, mask_text, detect

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn_ok(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def base_of(text):
    return [s for s in find_spans(text) if s[0] in BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="aZ.%+-@ 0123459()_é:/", max_size=60))
def test_equals_regex_on_random_text(text):
    assert base_of(text) == brute(text)


def test_fixtures():
    t = "x a.b@c.d, a@b@c.de 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111-1111 1111 +1 (873) 555-4517 é 4396177793418310"
    assert base_of(t) == brute(t)
    assert {s[0] for s in base_of(t)} == set(BASE_KINDS)
    assert find_spans("") == [] and find_spans(None) == []
    extra = find_spans("IBAN: DE89 3704 0044 0532 0130 00; https://joe:pw@example.com/x; account no 12345678")
    assert [s[0] for s in extra if s[0] not in BASE_KINDS] == ["account", "address", "account"]


def test_longer_random_mix():
    rng = random.Random(5)
    bits = ["user@mail.example.com", "+49 30 1234567", "192.168.0.1", "999.1.1.1", "4111111111111111", "1234-5678",
            "Ünï", "@", "+", "..", "http://a@b.c/d", "9" * 40, "\n", " "]
    for _ in range(300):
        t = "".join(rng.choice(bits) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(0, 40)))
        assert base_of(t) == brute(t)


def test_mask_and_frame(spark):
    assert mask_text("hi joe@x.org!") == "hi <EMAIL>!" and mask_text("clean") == "clean" and mask_text(None) is None
    rows = [(1, "mail joe@x.org", "a"), (1, "mail joe@x.org", "a"), (None, None, None), (2, "", "s"), (3, "ab " * 50000 + "1.2.3.4", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = detect(df).collect()
    assert len(got) == 5 and sum(len(r["spans"]) for r in got) == 3
    assert detect(df.limit(0)).count() == 0


def test_cues_in_any_case():
    for cue in ("Customer ID", "customer Id", "Account No", "ACCOUNT", "aCCt", "Konto", "SSN"):
        text = f"é İ {cue}: 1234567890"
        at = text.index("1234567890")
        assert ("account", at, at + 10) in find_spans(text), cue
    text = "iBAN DE89 3704 0044 0532 0130 00 and MailTo:jo@ex.org"
    assert ("account", 5, 32) in find_spans(text)
    assert any(k == "address" for k, _, _ in find_spans(text))
