import random

import numpy as np
import pyarrow as pa
from hypothesis import given, strategies as st

from netaudit.llm.common import components, only_ids, without_ids
from netaudit.llm.words import row_windows, shingle_sets, window_hashes, words_of
from tests.llm.support import Union, fold, split

TEXTS = st.lists(st.none() | st.text(alphabet="aB É\t\n\x1f|", max_size=30), max_size=12)


@given(TEXTS)
def test_words_are_what_ascii_white_space_separates(texts):
    found, seen = [], {}
    for w in words_of(pa.array(texts, pa.string()), fold=True, limit=20):
        for r in range(w.last - w.first):
            spans = [w.data[a:b].tobytes() for a, b in zip(w.starts[w.offsets[r] : w.offsets[r + 1]], w.ends[w.offsets[r] : w.offsets[r + 1]], strict=True)]
            found.append(spans)
            for word, value in zip(spans, w.hashes[w.offsets[r] : w.offsets[r + 1]].tolist(), strict=True):
                assert seen.setdefault(fold(word.decode()), value) == value
    assert found == [split(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_windows_are_equal_where_words_are():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)]
    for k in (5, 25):
        by_words = {}
        for w in words_of(pa.array(texts), fold=False):
            every, (begins, rows) = window_hashes(w.hashes, k), row_windows(w, k)
            for b, r in zip(begins.tolist(), rows.tolist(), strict=True):
                words = tuple(split(texts[w.first + r])[b - w.offsets[r] : b - w.offsets[r] + k])
                assert len(words) == k
                assert by_words.setdefault(words, every[b]) == every[b]
        assert len(set(by_words.values())) == len(by_words)


def thue_morse(a, b, doublings):
    """A sequence of two letters and its complement, whose weighted sums agree for any powers of an odd number."""
    letters = [0]
    for _ in range(doublings):
        letters += [1 - x for x in letters]
    return [(a, b)[x] for x in letters], [(b, a)[x] for x in letters]


def test_structured_words_and_runs_are_told_apart():
    one, other = ("".join(x) for x in thue_morse("a", "b", 12))
    words = [one, other, one[:1024], other[:1024], one[:250], other[:250], one[:256] + "x", other[:256] + "x", "a" * 300, "a" * 301, "a" * 8, "a" * 9, "a" * 16]
    w = next(words_of(pa.array([" ".join(words)]), fold=True))
    assert len(set(w.hashes.tolist())) == len(words)
    for k in (17, 25, 50, 64, 100, 1024, 2048):
        one, other = thue_morse("aa", "b", 11)
        w = next(words_of(pa.array([" ".join(one[:k] + other[:k])]), fold=False))
        assert window_hashes(w.hashes, k)[0] != window_hashes(w.hashes, k)[k]


def test_short_texts_have_one_shingle():
    sets = [s for w in words_of(pa.array(["", None, "a", "a b", "b a", "a b c d e", "a b c d e f"]), fold=True) for s in shingle_sets(w, 5)]
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 1, 2]
    assert len(set(np.concatenate(sets).tolist())) == 5  # the first five words of the last two agree


def test_components_of_random_edges(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: union.find(x) for a, b in edges for x in (a, b) if a != b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_ids_keeps_all_rows_of_the_ids(spark):
    rows = spark.range(5000).selectExpr("id % 1000 as doc_id", "id")
    wanted = spark.createDataFrame([(3,), (3,), (999,), (5000,)], "x long")
    assert sorted(r.doc_id for r in only_ids(rows, "doc_id", wanted).collect()) == [3] * 5 + [999] * 5
    left = without_ids(rows.unionByName(spark.sql("select cast(null as long) doc_id, 1L id")), "doc_id", wanted)
    assert left.count() == 4991 and left.filter("doc_id in (3, 999)").count() == 0 and left.filter("doc_id is null").count() == 1
