import random

import numpy as np

from netaudit.llm.quality import co_train, good_rows, quality
from tests.llm.support import documents, edge_rows

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality(docs, labels.filter("doc_id % 5 <> 3")).join(labels.select("doc_id", "quality"), "doc_id").filter("doc_id % 5 = 3").collect()
    assert len(rows) > 600
    assert sum(r.keep == (r.quality == 1) for r in rows) / len(rows) >= 0.97
    assert sum(r.keep for r in rows if r.quality == 1) / sum(r.quality for r in rows) >= 0.99


def test_a_useless_view_does_no_harm():
    rng = np.random.default_rng(1)
    y = (rng.random(1500) < 0.85).astype(float)
    text = np.column_stack([y + rng.normal(0, 0.2, 1500), rng.normal(size=1500)])
    noise, pool = rng.normal(size=(1500, 3)), (rng.random(2000) < 0.85).astype(float)
    model = co_train(text, noise, y, np.arange(1500) % 5 == 0, np.column_stack([pool + rng.normal(0, 0.2, 2000), rng.normal(size=2000)]), rng.normal(size=(2000, 3)))
    assert ((model.score(text, noise) >= 0.5) == (y == 1)).mean() > 0.97


def test_a_good_view_teaches_the_other():
    """The metadata view has few labels of its own; the pool that the text view labels makes up for it."""
    rng = np.random.default_rng(2)
    y, pool = (rng.random(400) < 0.5).astype(float), (rng.random(3000) < 0.5).astype(float)

    def views(label):
        return np.column_stack([label * 4 + rng.normal(0, 0.5, len(label))]), np.column_stack([label[:, None] + rng.normal(0, 2.0, (len(label), 20))])

    (text, meta), (pool_text, pool_meta) = views(y), views(pool)
    apart = np.arange(400) % 5 == 0
    alone = co_train(text, meta, y, apart, pool_text[:0], pool_meta[:0]).meta
    taught = co_train(text, meta, y, apart, pool_text, pool_meta).meta
    _, test_meta = views(pool)
    right = [((view.logit(test_meta) >= 0) == (pool == 1)).mean() for view in (alone, taught)]
    assert right[1] > right[0]


def test_edge_documents(spark):
    rows = edge_rows(random.Random(10))
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = quality(documents(spark, rows), labels).collect()
    assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _ in rows) and all(0 <= r.score <= 1 for r in got)
    assert {(r.score, r.keep) for r in quality(documents(spark, rows), labels.limit(0)).collect()} == {(0.5, True)}
    assert good_rows(documents(spark, rows), labels.limit(0)).count() == len(rows)
    assert quality(documents(spark, []), labels).count() == 0


def test_null_metadata(spark):
    docs = documents(spark, [(1, "a b"), (2, "c")]).selectExpr("doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source", "cast(null as long) as n_chars")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality(docs, labels).filter("score is null").count() == 0


def test_rows_are_dropped_one_by_one(spark):
    """Rows without id and rows that share one are judged by their own texts; columns named as the helpers'."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"word{rng.randrange(500)}" for _ in range(60))) if i % 2 else (i, "!!! ||| $$$ " * 30) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    good, bad = rows[1][1], rows[0][1]
    odd = [(1000, good), (1000, bad), (None, good), (None, bad)]
    docs = documents(spark, rows + odd).selectExpr("*", "1 as _row", "2 as _word", "3 as _id", "4 as _bits")
    kept = good_rows(docs, labels)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(t == good for i, t in got if i == 1000 or i is None) == [True, True]
    assert {i for i, _ in got if i is not None and i < 300} == {i for i in range(300) if i % 2}
