import hashlib
import random
from collections import Counter

import pytest

from netaudit.llm import passages
from tests.llm.support import documents, edge_rows, prose, split
from tests.llm.test_words import thue_morse


def by_hand(rows, window):
    first = {}
    for doc_id, text in rows:
        words = split(text)
        for j in range(len(words) - window + 1 if doc_id is not None else 0):
            key = tuple(words[j : j + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = Counter()
    for doc_id, text in rows:
        words = split(text)
        gone = [False] * len(words)
        for j in range(len(words) - window + 1 if doc_id is not None else 0):
            if first[tuple(words[j : j + window])] < doc_id:
                gone[j : j + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def random_rows(rng, n):
    """Texts that share passages, some of them with most others."""
    passages_ = [prose(rng, rng.randrange(4, 30), 12) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(0, 25)) if rng.random() < 0.5 else rng.choice(passages_[: 1 + rng.randrange(8)]) for _ in range(rng.randrange(1, 8))]
        rows.append((i, " ".join(parts)))
    return rows + [(n + i, rng.choice(rows)[1]) for i in range(n // 5)]


@pytest.mark.parametrize("phrases_of_a_task", [5, 100_000])
def test_against_all_windows(spark, monkeypatch, phrases_of_a_task):
    # Small shards and tasks, so that shards are divided and documents visit several.
    monkeypatch.setattr(passages, "SHARD_PHRASES", 10)
    monkeypatch.setattr(passages, "TASK_PHRASES", phrases_of_a_task)
    rows = random_rows(random.Random(phrases_of_a_task), 150)
    got = Counter(map(tuple, passages.passage_digests(documents(spark, rows), window=10, phrase=5).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert got == by_hand(rows, 10)


def test_edge_documents(spark):
    rows = edge_rows(random.Random(4))
    got = Counter(map(tuple, passages.passage_digests(documents(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert got == by_hand(rows, 50)
    assert passages.passage_digests(documents(spark, [])).count() == 0


def test_a_word_like_no_other_stays(spark):
    """Long words whose letters are arranged so that weighted sums agree, in the same passage of 118 words."""
    one, other = ("".join(x) for x in thue_morse("a", "b", 10))
    rng = random.Random(3)
    before, behind = prose(rng, 59), prose(rng, 59)
    rows = [(1, f"{before} {one} {behind}"), (2, f"{before} {other} {behind}"), (3, f"{before} {one} {behind}")]
    rows += [(10 + i, " ".join(x)) for i, x in enumerate(thue_morse("red", "blue", 7))]
    docs = documents(spark, rows)
    assert Counter(map(tuple, passages.passage_digests(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == by_hand(rows, 50)
