"""Each stage of the pipeline against a brute-force version of it, on what the stage before kept."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from netaudit.llm.common import checkpointed, table
from netaudit.llm.pii import mask
from tests.llm.support import Union
from tests.llm.test_jaccard import shingles

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    kept = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(checkpointed(stage(spark, kept[-1], SF)))
    return kept


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "tokens"]
    assert all(df.columns == COLUMNS for df in stages[:-1])
    counts = [df.count() for df in stages]
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5]


def test_quality_drops_what_labels_call_bad(spark, stages):
    kept = texts(stages[1])
    labels = table(spark, SF, "labels").collect()
    assert sum(r.doc_id in kept for r in labels if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in labels)
    assert sum(r.doc_id in kept for r in labels if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in labels)


def test_one_document_of_each_group(stages):
    before = texts(stages[1])
    sets, union, holders = {i: shingles(t) for i, t in before.items()}, Union(), {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    met = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in met:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            union.join(a, b)
    assert set(texts(stages[2])) == {i for i in before if union.find(i) == i}


def test_no_benchmark_item_is_left(spark, stages):
    before = texts(stages[2])
    items = [" ".join(r.text.lower().split()) for r in table(spark, SF, "benchmark").collect()]
    assert set(texts(stages[3])) == {i for i, t in before.items() if not any(x in " ".join(t.lower().split()) for x in items)}


def test_personal_data_is_masked(stages):
    before = texts(stages[3])
    assert {(r.doc_id, r.text, r.n_chars) for r in stages[4].collect()} == {(i, mask(t), len(mask(t))) for i, t in before.items()}


def test_tokens_are_those_of_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts(stages[4]).items()}
    assert {r.doc_id: list(r.ids) for r in stages[5].collect()} == want


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, SF))
        assert docs.count() == 0, name


def test_clashing_columns_and_odd_rows_in_every_stage(spark):
    extra = {"_id": "1L", "_h": "'h'", "_g": "2", "_word": "'w'", "_BITS": "3", "_row": "4", "key": "5", "name": "'n'", "h": "6", "g": "7"}
    odd = spark.createDataFrame([(None, "a text without id"), (3, None), (7, "another text under an id that is taken"), (7, "another text under an id that is taken")], "doc_id long, text string")
    docs = table(spark, SF, "documents").unionByName(odd, allowMissingColumns=True).selectExpr("*", *[f"{value} as {name}" for name, value in extra.items()])
    for name, stage in corpus_pipeline.STAGES:
        made = checkpointed(stage(spark, docs, SF))
        assert made.count() > 100, name
        if name != "tokens":
            assert made.columns == docs.columns and made.select(*extra).distinct().count() == 1, name
        docs = made
