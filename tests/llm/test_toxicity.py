import random

import pytest

from netaudit.llm.toxicity import Lexicon, LexiconTrie, Scorer, held_out, learn, scored, toxicity
from pyspark.sql import functions as F
from tests.llm.support import documents, edge_rows, prose

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize(("edits", "low", "high"), [(1, 5, 9), (2, 10, 14)])
def test_automaton_finds_what_distances_say(edits, low, high):
    rng = random.Random(edits)
    for _ in range(100):
        terms = ["".join(rng.choice("abc") for _ in range(rng.randint(low, high))) for _ in range(8)]
        trie = LexiconTrie(terms, edits)
        for _ in range(40):
            word = list(rng.choice(terms))
            for _ in range(rng.randint(0, edits + 1)):
                at = rng.randrange(len(word))
                word[at : at + 1] = rng.choice([[], [rng.choice("abc")], [rng.choice("abc"), word[at]]])
                word = word or ["a"]
            word = "".join(word)
            near = min(((distance(word, t), t) for t in terms if distance(word, t) <= edits), default=(0, None))[1]
            assert trie.nearest(word) == near


def test_misspelt_and_quoted_terms():
    scorer = Scorer(Lexicon({"moron": 5.0, "disgusting": 6.0}, {}))
    names = dict(zip(scorer.names, range(len(scorer.names)), strict=True))
    plain, quoted = scorer.count("you are a moron indeed")[0], scorer.count('he was called a "moron" there')[0]
    assert plain[names["plain"]] > 0 and plain[names["quoted"]] == 0
    assert quoted[names["plain"]] == 0 and quoted[names["quoted"]] > 0 and quoted[names["odds"]] == 0
    for text in ("m0ron", "morron", "mor*n", "disgostng"):
        assert scorer.count(f"such a {text} thing")[0][names["fuzzy"]] > 0
    assert scorer.count("a moon on the morning")[0][names["fuzzy"]] == 0 or distance("moon", "moron") == 1


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()
    assert len(rows) > 600 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.98
    assert sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows) >= 0.9


def test_labels_of_held_out_rows_change_nothing(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 40) + (" villain fiend" if i % 4 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    wrong = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(tuple, scored(documents(spark, rows), learn(documents(spark, rows), own)).collect())) for own in (labels, wrong)]
    assert scores[0] == scores[1]


def test_edge_documents(spark):
    rows = edge_rows(random.Random(9))
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity(documents(spark, rows), labels).collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _ in rows)
    assert all(r.score is not None and r.predicted == (r.score >= 0.5) and r.held_out is not None for r in got)
    assert toxicity(documents(spark, []), labels.limit(0)).count() == 0
    assert {r.score for r in toxicity(documents(spark, rows), labels.limit(0)).collect()} == {0.5}


def test_rare_toxic_terms_among_many_frequent_words(spark):
    """Over 20,000 innocent words and stems have more contexts than the toxic term."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(6000)]
    rows = []
    for i in range(60):
        rng.shuffle(words)
        rows.append((i, " ".join([*words, "vilefiend"] if i % 2 and i < 24 else words)))
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    assert len({w[:n] for w in words for n in (5, 6, 7, 8)}) > 20_000
    assert "vilefiend" in learn(documents(spark, rows), labels).terms
