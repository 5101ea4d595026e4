import random
from collections import Counter

import numpy as np
import pytest

from netaudit.llm import jaccard
from tests.llm.support import Union, documents, edge_rows, fold, prose, split
from tests.llm.test_words import thue_morse


def shingles(text):
    words = split(fold(text))
    return {tuple(words[j : j + 5]) for j in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def by_hand(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    union = Union()
    for i, a in enumerate(sets):
        for j in range(i):
            alone = rows[i][0] is None or rows[j][0] is None
            if a and sets[j] and (not alone or a == sets[j]) and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                union.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[union.find(i)] = min(least.get(union.find(i), doc_id), doc_id)
    return Counter((d, len(s), least.get(union.find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    """Small sets on both sides of the boundary, large sets, a large group of near copies, a common passage."""
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 30)
    for _ in range(25):
        base = prose(rng, rng.choice([5, 6, 8, 10, 12, 14, 18, 25, 60, 150]), 3000)
        rows += [edited(rng, base, rng.randrange(0, 4)) for _ in range(rng.randrange(1, 6))]
        rows += [" ".join(base.split()[: -rng.randrange(1, 3)]), f"{passage} {prose(rng, 15, 3000)}"]
    hot = prose(rng, 200, 3000)
    rows += [edited(rng, hot, rng.randrange(1, 9)) for _ in range(60)] + [passage, passage.upper()]
    rows = [(None if i % 17 == 0 else i, text) for i, text in enumerate(rows)]
    rng.shuffle(rows)
    got = Counter(map(tuple, jaccard.shingle_components(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == by_hand(rows)


def test_edge_documents(spark):
    rows = edge_rows(random.Random(5))
    docs = documents(spark, rows)
    assert Counter(map(tuple, jaccard.shingle_components(docs).select("doc_id", "n_shingles", "component_id").collect())) == by_hand(rows)
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs).collect()) == [1, 2, 3, 4, 5, 7, 8, 10]
    nameless = [(None, "a text of its own with some more words"), (None, "a text of its own with some more words"), (None, None)]
    assert sorted(r.text or "" for r in jaccard.one_of_each(documents(spark, [*rows, *nameless])).filter("doc_id is null").collect()) == ["", nameless[0][1]]
    assert jaccard.shingle_components(documents(spark, [])).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    """Different texts under one id, one of them in a group with another id, repeated rows; columns named as the helpers'."""
    rng = random.Random(12)
    a, b, c, d = (prose(rng, 40, 3000) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b + " more"), (3, c), (3, c), (4, c), (5, None), (5, d), (None, d), (None, None), (None, "one two"), (6, "one two")]
    docs = documents(spark, rows).selectExpr("*", "1L as _id", "2L as _word", "3L as _BITS", "4L as _mixed")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert Counter(t for _, t in got.elements()) == Counter([a, b + " more", c, d, None, None, "one two"])
    assert {(1, a), (2, b + " more"), (3, c), (5, d), (5, None), (None, None), (6, "one two")} == set(got)


def test_structured_words_do_not_link(spark):
    """Long words that are complements of each other, and texts of two words arranged so."""
    one, other = ("".join(x) for x in thue_morse("a", "b", 10))
    rows = [(1, one), (2, other), (3, f"{one} b c d e f"), (4, f"{other} b c d e f")]
    rows += [(5 + i, " ".join(x)) for i, x in enumerate(thue_morse("red", "blue", 7))]
    got = Counter(map(tuple, jaccard.shingle_components(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == by_hand(rows)


def test_boundary_follows_cost():
    assert jaccard.light_boundary({}, 80) == 0
    assert jaccard.light_boundary({5: 1000, 6: 1000}, 80) >= 6
    assert jaccard.light_boundary({n: 1000 for n in range(1, 21)}, 80) < jaccard.LARGEST_LIGHT
    assert jaccard.least_overlap(10, 10, 80) == 9 and jaccard.least_overlap(10, 8, 80) == 8


def test_signatures_never_differ_more_than_sets():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, 300)], rng.integers(0, 2**63, 40, dtype=np.uint64)]))
        x, y = (jaccard.signature(s, jaccard.MARK_BITS).view(np.uint64) for s in (a, b))
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))
