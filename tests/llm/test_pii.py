import random
import re

from hypothesis import given, settings, strategies as st

from netaudit.llm.pii import BASE, KINDS, iban_valid, joined, luhn, mask, masked, pii_digests, spans
from tests.llm.support import documents, edge_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["1", "2", "9", "0", "25", "255", "256", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "%", "²", "4111 1111 1111 1111", "+1 (499) 555-6503", "ab@cd.ef", "10.0.0.1"]


def by_pattern(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }
            if fits[kind]():
                found.append((m.start(), KINDS.index(kind), m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in spans(text) if s[0] in BASE] == by_pattern(text)


def test_added_kinds():
    text = 'see https://a.example/x?y=1, key: token = "04dbebab91ab85687d33" IBAN DE89 3704 0044 0532 0130 00. password: hunter'
    got = {k: text[a:b] for k, a, b in spans(text) if k not in BASE}
    assert got == {"url": "https://a.example/x?y=1", "secret": "04dbebab91ab85687d33", "iban": "DE89 3704 0044 0532 0130 00"}
    assert iban_valid("GB82WEST12345698765432") and not iban_valid("GB83WEST12345698765432")


def test_long_runs_of_anchors_take_linear_time():
    for part in ("://", "a://", "@", "a@b", "+", "+1", "1.", "1 ", "token=", "AB12", "1-"):
        assert isinstance(spans(part * 200_000), list)


def test_mask_joins_overlapping_spans():
    assert mask("a x@y.zz b 10.0.0.1") == "a [EMAIL] b [IP]"
    assert mask("http://u@h.example/p q") == "[URL] q"
    assert mask("") == ""


def test_edge_documents(spark):
    rows = edge_rows(random.Random(3)) + [(20, "mail a.b@c.de, +1 (499) 555-6503"), (20, "mail a.b@c.de, +1 (499) 555-6503")]
    got = sorted((r.doc_id or -1, r.n_email, r.n_phone, r.spans) for r in pii_digests(documents(spark, rows)).collect())
    assert got == sorted((i or -1, *(sum(s[0] == k for s in spans(t or "")) for k in ("email", "phone")), joined(spans(t or ""))) for i, t in rows)
    assert pii_digests(documents(spark, [])).count() == 0
    out = masked(documents(spark, rows))
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(i, t and mask(t), None if t is None else len(mask(t))) for i, t in rows}
