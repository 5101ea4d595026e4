import random
import re

import pytest
from pyspark.sql import functions as F

from netaudit.llm.decontaminate import _key, clean_rows, contamination
from tests.llm.support import documents, edge_rows, prose

TRAIN = "A train travels 60 miles in 2 hours from Boston to Denver; how far does the train go in 5 hours leaving from Boston at last?"
APPLES = "If Anna has 3 apples and Bob has 3 apples then how many apples do Anna and Bob have in total here"


def judged(spark, rows, items):
    docs, asked = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: (r.n_items, r.item_id, r.kind, r.contaminated) for r in contamination(docs, asked).collect()}


def test_templates(spark):
    rows = [
        (1, f"Before. {TRAIN} After."), (2, TRAIN.replace("60 miles", "80km").replace("Boston", "Paris").replace("Denver", "Lyon").replace("2 hours", "3 hours")),
        (3, TRAIN.replace("from Boston at", "from Rome at").replace("60", "61")), (4, APPLES.replace("Anna", "Carl").replace("Bob", "Dora Lee").replace("3", "1,400")),
        (5, APPLES.replace("Anna has 3", "Anna has 4")), (6, "If Carl has 4 apples and Dora has 4 apples then how many pears"), (7, APPLES.upper()), (8, prose(random.Random(1), 200)),
    ]
    got = judged(spark, rows, [(1, TRAIN), (2, APPLES)])
    assert got[1] == (1, 1, "verbatim", True)
    assert got[2] == (1, 1, "re-parameterised", True)
    assert got[4] == (1, 2, "re-parameterised", True)
    # One value of the item against two of the text: not the same question.
    assert got[3] == got[5] == got[6] == got[8] == (0, None, None, False)


def test_against_substrings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    found = {r.doc_id for r in contamination(docs, items).filter("contaminated").collect()}
    asked = [" ".join(r.text.lower().split()) for r in items.collect()]
    held = {r.doc_id for r in docs.select("doc_id", "text").collect() if any(a in " ".join(r.text.lower().split()) for a in asked)}
    assert found == held and len(held) > 100


@pytest.mark.parametrize("share", [0.5, 0.9])
def test_share_of_windows(spark, share):
    rng = random.Random(3)
    item = prose(rng, 44, 5000)
    words = item.split()
    kept = round(40 * share) + 4
    docs = documents(spark, [(1, prose(rng, 30, 5000) + " " + " ".join(words[:kept]) + " end")])
    row = contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), least_share=0.1).first()
    assert row.share == pytest.approx(share)


def test_edge_documents(spark):
    rows = edge_rows(random.Random(11))
    items = spark.createDataFrame([(1, rows[4][1]), (1, rows[4][1]), (2, rows[4][1]), (3, None), (4, ""), (5, "too short"), (None, rows[3][1])], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.n_items, r.item_id, r.contaminated) for r in contamination(documents(spark, rows), items).collect())
    same = {5, 6, 9, None}
    assert got == sorted((i or -1, 2 if i in same else 0, 1 if i in same else None, i in same) for i, _ in rows)
    assert sorted(r.doc_id or -1 for r in clean_rows(documents(spark, rows), items).collect()) == [1, 2, 3, 4, 7, 8, 10]
    assert contamination(documents(spark, []), items).count() == 0
    assert contamination(documents(spark, rows), items.limit(0)).filter("contaminated").count() == 0


def test_capitals_and_one_changed_value(spark):
    rng = random.Random(5)
    words = prose(rng, 80, 5000).lower().split()
    words[10], words[70] = "41", "41"
    item, changed = " ".join(words), " ".join(["42" if i == 70 else w for i, w in enumerate(words)])
    rows = [(1, APPLES.upper()), (2, APPLES.lower()), (3, f"So. {changed} end"), (4, prose(rng, 200))]
    got = judged(spark, rows, [(1, APPLES), (2, item)])
    assert got == {1: (1, 1, "verbatim", True), 2: (1, 1, "verbatim", True), 3: (1, 2, "re-parameterised", True), 4: (0, None, None, False)}


SHORT = ["Solve 3x + 5 = 20", "What is 45 + 12 - 3 * 7?", "Ann Bell, Carla Dorn, Emil Funk, Gerd Hahn", "Capital of Peru?", "8 15 16 23 42 108"]


def test_items_without_usable_windows(spark):
    rows = [(i, f"We ask here. {text} Then we go on.") for i, text in enumerate(SHORT)]
    rows += [(10, "We ask. Solve 7x + 2 = 16 now"), (11, "So what is 1 + 2 - 9 * 4 then"), (12, "numbers 9 15 16 23 42 108 here"), (13, "the capital of Chile"), (14, "Ann Bell, Carla Dorn, Emil Funk"), (15, "what is 45")]
    got = judged(spark, rows, list(enumerate(SHORT)))
    assert {i: got[i] for i in range(len(SHORT))} == {i: (1, i, "verbatim", True) for i in range(len(SHORT))}
    assert got[10] == (1, 0, "re-parameterised", True) and got[11] == (1, 1, "re-parameterised", True)
    assert all(got[i] == (0, None, None, False) for i in (12, 13, 14, 15))


def test_windows_out_of_order_are_no_copy(spark):
    """All windows of an item, dealt over a text with other words between them, in any order and number of times."""
    rng = random.Random(9)
    item = prose(rng, 40, 5000)
    words = item.split()
    windows = [" ".join(words[i : i + 5]) for i in range(36)]
    rows = []
    for i in range(6):
        dealt = windows * (1 + i % 2)
        rng.shuffle(dealt)
        rows.append((i, " filler ".join(dealt)))
    for i, inserted in enumerate((0, 1, 3)):
        copy = list(words)
        for _ in range(inserted):
            copy.insert(20, "extra")
        rows.append((10 + i, f"{prose(rng, 100, 5000)} {' '.join(copy)} {prose(rng, 30, 5000)}"))
    got = judged(spark, rows, [(1, item)])
    assert {i: g[3] for i, g in got.items()} == {i: i >= 10 for i, _ in rows}


def test_slots_and_templates_against_all_pairs(spark):
    """Questions with values put in by chance: held are those whose values stand for the item's one to one."""
    rng = random.Random(14)
    stem = "a worker paints {} walls on day one and {} walls on day two while a friend paints {} walls so how many walls are painted when both work {} days"
    patterns = [("1", "2", "3", "4"), ("1", "1", "2", "3"), ("1", "2", "1", "2"), ("1", "1", "1", "1")]

    def filled(pattern):
        values = {}
        return tuple(values.setdefault(p, str(rng.randrange(100, 999))) for p in pattern)

    items = [(i, stem.format(*filled(p)) + f" under plan number {i} of this shop") for i, p in enumerate(patterns) if i]
    rows = [(doc, stem.format(*filled(p)) + f" under plan number {i} of this shop") for doc, (i, p) in enumerate((i, p) for i in range(4) for p in patterns)]

    def stands_for(item, text):
        """Each value of the item stands against one value of the text."""
        values = {}
        for own, other in zip(re.findall("[0-9]+", item), re.findall("[0-9]+", text), strict=True):
            values.setdefault(own, set()).add(other)
        return all(len(v) == 1 for v in values.values())

    want = {doc: [i for i, item in items if stands_for(item, text)] for doc, text in rows}
    got = judged(spark, rows, items)
    assert {doc: g[3] for doc, g in got.items()} == {doc: bool(held) for doc, held in want.items()}
    assert {doc: g[0] for doc, g in got.items()} == {doc: len(held) for doc, held in want.items()} and 0 < sum(map(bool, want.values())) < len(want)


def test_keys_of_a_text_are_independent(spark):
    row = spark.sql("select 'a text' as t").select(_key(F.col("t")).alias("k"), F.xxhash64(F.xxhash64("t"), F.lit("second")).alias("chained")).first()
    assert len({row.k.h, row.k.g, row.chained}) == 3
