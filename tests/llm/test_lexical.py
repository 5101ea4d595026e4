import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from netaudit.llm import lexical
from tests.llm.support import documents, edge_rows, fold, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(fold(text))


def by_hand(rows, items):
    """All scores of all documents, the best ten of each item."""
    docs = [(i, Counter(t)) for i, text in rows if (t := terms(text))]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in docs:
            m = 100 - 75 + 75 * sum(counts.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms(text) if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, nameless, doc_id) in enumerate(sorted(scored)[:10], 1):
            out.append((item_id, rank, None if nameless else doc_id, -score))
    return Counter(out)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, name string, rank int").repartition(2)


def rows_and_items(rng):
    rows = [*edge_rows(rng), (20, "!?!"), (21, "One, TWO; one_two 3.5 ÄÖ äö 日本"), (21, "another text of the id"), (22, "\x80\x7fĀ")]
    vocabulary = [f"t{min(int(rng.paretovariate(0.6)), 5000)}" for _ in range(4000)]
    for i in range(250):
        rows.append((100 + i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30, 200, 900]))).title()))
    rows += [(500 + i, "copy of one text with t1 t2 t77") for i in range(30)] + [(None, "copy of one text with t1 t2 t77")]
    rows.append((600, " ".join(f"x{i}" for i in range(60_000)) + " t5 t5 t5"))
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 40])))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "..."), (53, "unknownword"), (54, "one TWO äö ÄÖ 日本"), (55, "copy one text t1 t1 t1"), (55, "w1 w2 w3"), (None, "x59999 t5"), (56, "w17 " * 50)]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_scores(spark, seed):
    rows, items = rows_and_items(random.Random(seed))
    got = lexical.ranked(documents(spark, rows), items_of(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == by_hand(rows, items)


def test_items_in_many_blocks_and_a_kept_index(spark, monkeypatch):
    rows, items = rows_and_items(random.Random(3))
    docs = documents(spark, rows)
    index = lexical.checkpointed(lexical.signatures(docs))
    monkeypatch.setattr(lexical, "TABLE_CELLS", 1500)
    assert len(list(lexical._item_blocks(items_of(spark, items)))) > 2
    assert Counter(map(tuple, lexical.ranked(docs, items_of(spark, items), index).collect())) == by_hand(rows, items)


def test_no_rows(spark):
    docs, items = documents(spark, [(1, "a b"), (2, None)]), items_of(spark, [(1, "a")])
    assert lexical.ranked(documents(spark, []), items).collect() == []
    assert lexical.ranked(documents(spark, [(1, None), (2, "?!")]), items).collect() == []
    assert lexical.ranked(docs, items.limit(0)).collect() == []
    # In one document of one the weight of a term is 287, and nothing of the item is elsewhere.
    assert Counter(map(tuple, lexical.ranked(docs, items).collect())) == by_hand([(1, "a b")], [(1, "a")])


def blocks_of(rows, n_docs, n_terms):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["name", "text"])
    for out in lexical._sign(iter([batch])):
        yield from out.to_pylist()


def test_bounds_are_never_below_scores_and_seldom_far_above():
    rows, items = rows_and_items(random.Random(4))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = {i: Counter(x.encode() for x in terms(t)) for i, t in rows if terms(t)}
    n_docs, n_terms = len(docs), sum(sum(c.values()) for c in docs.values())
    block_items = lexical.Items([Counter(own) for _, t in items if (own := lexical.terms_of(t))])
    df = Counter(block_items.number[t] for c in docs.values() for t in c if t in block_items.number)
    block_items.weigh(df, n_docs)
    seen, exact, near = 0, 0, 0
    for block in blocks_of(rows, n_docs, n_terms):
        bounds = lexical.upper_bounds(block_items, block, n_docs, n_terms)
        for d, name in enumerate(block["names"]):
            seen += 1
            counts = docs[name]
            assert block["counts"][d] == sum(counts.values())
            m = lexical.length_factor([sum(counts.values())], n_docs, n_terms)
            tf = np.array([counts[t] for t in block_items.terms], dtype=np.int64)
            scores = block_items.weighted @ np.where(tf > 0, lexical.gain(tf, m), 0)
            assert (bounds[:, d] >= scores).all()
            exact += int((bounds[:, d] == scores).sum())
            near += int((bounds[:, d] <= 1.3 * scores + 1e6).sum())
    assert seen == n_docs and near > 0.9 * n_docs * len(block_items.table) and exact > 0.5 * n_docs * len(block_items.table)


def test_terms_with_one_hash_are_told_apart(monkeypatch):
    """With a hash of two values nearly all terms share one; bytes decide."""
    monkeypatch.setattr(lexical, "hash_spans", lambda data, starts, ends, fold: ((ends - starts) % 2).astype(np.uint64))
    text = "plain Plane PLAIN plan plains a be plain1"
    items = lexical.Items([Counter([b"plain", b"plan", b"plane", b"a", b"other"])])
    assert items.same_hash == 4
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    span, term = items.found(lexical.term_spans(data, np.array([0, len(data)])))
    assert sorted((s, items.terms[t]) for s, t in zip(span.tolist(), term.tolist(), strict=True)) == [(0, b"plain"), (1, b"plane"), (2, b"plain"), (3, b"plan"), (5, b"a")]


def test_few_documents_are_scored(spark):
    """The bounds leave out nearly all documents that hold some term of an item."""
    rng = random.Random(6)
    vocabulary = [f"t{min(int(rng.paretovariate(0.5)), 20000)}" for _ in range(20_000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=120))) for i in range(1500)]
    items = lexical.Items([Counter(lexical.terms_of(" ".join(rng.choices(vocabulary, k=15)))) for _ in range(5)])
    docs = {i: Counter(lexical.terms_of(t)) for i, t in rows}
    n_terms = 120 * len(rows)
    items.weigh(Counter(items.number[t] for c in docs.values() for t in c if t in items.number), len(rows))
    bounds = np.concatenate([lexical.upper_bounds(items, b, len(rows), n_terms) for b in blocks_of(rows, len(rows), n_terms)], axis=1)
    m = lexical.length_factor([120], len(rows), n_terms)
    scores = np.array([items.weighted @ np.where((tf := np.array([c[t] for t in items.terms])) > 0, lexical.gain(tf, m), 0) for c in docs.values()])
    least = np.sort(scores, axis=0)[-10]
    assert ((bounds >= least[:, None]).sum(axis=1) < 100).all()
