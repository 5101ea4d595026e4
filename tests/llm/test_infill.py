import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from netaudit.llm import infill
from tests.llm.support import documents, edge_rows, prose

DIGESTS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def by_hand(doc_id, text):
    """Row and output by slices of a list of units."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, name = len(units), "" if doc_id is None else str(doc_id)
    h = [int(hashlib.sha256(f"1:{name}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None), text
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(prefix), len(middle)), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (doc_id, n, "psm", len(prefix), len(middle)), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def rows():
    rng = random.Random(3)
    odd = [
        "a<P>b", "<S>", "<M", "<<P", "x<", "<P<S<M", "P>x", "\x00\n\r\t", "naïve café — 日本語 🙂 é", "🙂", "Aa1Bb", "퟿\U0010ffff", " ", "z" * 70_000,
    ]
    texts = ["".join(rng.choice("ab <>PSMé🙂\n.7Z") for _ in range(rng.randrange(60))) for _ in range(300)]
    return [*edge_rows(rng), *((100 + i, t) for i, t in enumerate([*odd, *texts])), (0, prose(rng, 50)), (-5, "minus five"), (2**62, "a large id")]


def test_against_slices(spark):
    given_rows = rows()
    docs = documents(spark, given_rows)
    got = Counter(tuple(r) for r in infill.infill_digests(docs).select(*DIGESTS).collect())
    assert got == Counter((*row, sha(out), sha(text)) for (row, out), text in ((by_hand(*r), r[1]) for r in given_rows))
    forms = Counter(row[2] for row in got)
    assert forms["psm"] > forms["spm"] > 10 and forms["plain"] > 10


def test_outputs_and_round_trip(spark):
    given_rows = rows()
    made = infill.transformed(documents(spark, given_rows))
    assert Counter((r.doc_id, r.output) for r in made.collect()) == Counter((r[0], by_hand(*r)[1]) for r in given_rows)
    back = infill.restored(made.select("doc_id", "form", "output"))
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in given_rows)


def test_descriptors_name_the_output(spark):
    for r in infill.transformed(documents(spark, [(i, f"text {i} with some words, é and 🙂") for i in range(40)])).collect():
        buffers = f"text {r.doc_id} with some words, é and 🙂".encode(), infill.SENTINELS
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in r.pieces) == r.output.encode()
        assert len(r.pieces) == (1 if r.form == "plain" else 6)


def test_no_documents(spark):
    assert infill.infill_digests(documents(spark, [])).columns == DIGESTS
    assert infill.infill_digests(documents(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_cuts_keep_bytes_and_inverse_restores(whole, data):
    first, second = sorted(data.draw(st.lists(st.integers(0, len(whole)), min_size=2, max_size=2)))
    table = infill.PieceTable.of(whole).cut(first).cut(second)
    assert table.text() == whole and [p[2] for p in table.pieces] == [first, second - first, len(whole) - second]
    for order in infill.ORDERS.values():
        arranged = table.arranged(order)
        assert arranged.restored(order).text() == whole
        assert arranged.sha256() == hashlib.sha256(arranged.text()).hexdigest()
        if not any(mark in whole for mark in infill.MARKS):
            form = next(f for f, o in infill.ORDERS.items() if o == order)
            assert infill.parsed(arranged.text(), form).restored(order).text() == whole


def test_cut_outside_is_an_error():
    with pytest.raises(IndexError):
        infill.PieceTable.of(b"abc").cut(4)
