import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from netaudit.llm import tokenstore, wavelet
from netaudit.session import job_folder
from tests.llm.support import documents, edge_rows, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts(rng, n):
    alphabet = [
        "a", "B", "\xe9", " ", "  ", "\n", "\r\n", "\t", "'s", "'ll", "'", "1", "23", ",", "...", "<|endoftext|>", "<|endoftext", "\x0b", "\x0c", "\x1c", "\x1f",
        "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u200b", "\u2028", "\u202f", "\u205f", "\u3000", "\ufeff", "\u65e5\u672c", "\U0001f642", "\u0663", "\u0301",
        "word", " the", "\u017f", "\x00",
    ]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def encoded(own, texts):
    return [np.frombuffer(own.encode(t), own.dtype).tolist() for t in texts]


def test_encoder_equals_library(library, monkeypatch):
    texts = [*odd_texts(random.Random(2), 4000), "x" * 5000, " " * 5000, prose(random.Random(1), 3000, 10**6), "ends with a blank ", " \u00e9t\u00e9 \u65e5\u672c"]
    want = [[*library.encode(text, add_special_tokens=False).ids, 0] for text in texts]
    own = tokenstore.Encoder(VOCABULARY)
    assert encoded(own, texts) == want and encoded(own, texts[::-1]) == want[::-1]
    monkeypatch.setattr(tokenstore, "TOGETHER", 7)
    monkeypatch.setattr(tokenstore, "REMEMBERED", 50)
    own = tokenstore.Encoder(VOCABULARY)
    assert [encoded(own, [t])[0] for t in texts[:500]] == want[:500] and len(own.known) < 200
    assert encoded(own, [None, "", "a"]) == [[0], [0], [64, 0]]


def test_white_space_that_cuts_a_text_is_white_space_for_the_library(library):
    """Every code point in front of a blank and behind one: the pieces give what the whole gives."""
    own = tokenstore.Encoder(VOCABULARY)
    points = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    for at in range(0, len(points), 2000):
        text = "".join(f"!{c} a {c}" for c in points[at : at + 2000])
        assert encoded(own, [text])[0][:-1] == library.encode(text, add_special_tokens=False).ids
        # Pieces of one character too, which are learnt together.
        text = " ".join(c for c in points[at : at + 2000] if not tokenstore._DOUBTFUL.match(c))
        assert encoded(own, [text])[0][:-1] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("group_bytes", [1, 3000, 1 << 23])
def test_columns_equal_library(library, monkeypatch, group_bytes):
    """Texts of a column, which are cut together, give what each gives."""
    monkeypatch.setattr(tokenstore, "GROUP_BYTES", group_bytes)
    rng = random.Random(5)
    alphabet = ["a", "B", "\xe9", "\xd7", " ", " ", "\n", "\n", "\r", "\t", "'", "'s", "12", "\xb2", ",", "...", "\u2026", "<|endoftext|", "|>", "\x00", "\u65e5"]
    texts = ["", " ", "\n", "\n\n", "\n", "", None, *("".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(3000)), None, *odd_texts(rng, 500), "x" * 5000, prose(rng, 300, 10**6), ""]
    want = [[*library.encode(text or "", add_special_tokens=False).ids, 0] for text in texts]
    own = tokenstore.Encoder(VOCABULARY)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["left out", *texts], kind).slice(1)
        for _ in range(2):
            assert [np.frombuffer(ids, own.dtype).tolist() for ids in own.encode_all(column)] == want
    monkeypatch.setattr(tokenstore, "REMEMBERED", 50)
    own = tokenstore.Encoder(VOCABULARY)
    assert [np.frombuffer(ids, own.dtype).tolist() for ids in own.encode_all(pa.array(texts))] == want
    assert list(own.encode_all(pa.array([], pa.string()))) == []


def test_every_code_point_in_a_column(library):
    """Beside blanks, marks, line ends, letters and digits."""
    own = tokenstore.Encoder(VOCABULARY)
    points = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and not tokenstore._DOUBTFUL.match(c)]
    texts = ["".join(f"!{c} a{c},{c}\n{c}1{c}'" for c in points[at : at + 2000]) for at in range(0, len(points), 2000)]
    for text, ids in zip(texts, own.encode_all(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, own.dtype).tolist()[:-1] == library.encode(text, add_special_tokens=False).ids


def test_a_piece_is_looked_up_once_in_a_group():
    """Time grows with the different words of a group, not with all words."""
    class Counted(dict):
        looks = 0

        def get(self, key, default=None):
            Counted.looks += 1
            return super().get(key, default)

    own = tokenstore.Encoder(VOCABULARY)
    own.known = Counted()
    texts = ["some words, and the same words\nagain " * 100] * 50
    assert len(set(own.encode_all(pa.array(texts)))) == 1 and Counted.looks < 50


def rows():
    rng = random.Random(9)
    return [*edge_rows(rng), *((50 + i, t) for i, t in enumerate(odd_texts(rng, 100))), (None, "nameless too"), (-3, "first")]


def by_hand(library, given):
    """Documents in ascending order; places of rows that share an id may be exchanged."""
    found = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in given]
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("sizes", [(1 << 23, 1 << 25), (300, 1 << 25), (300, 2000), (1, 500)])
def test_files_against_library(spark, library, sizes):
    given = rows()
    path = job_folder(spark)
    tokenstore.write_tokens(documents(spark, given), path, VOCABULARY, *sizes)
    want = by_hand(library, given)
    got = sorted(tokenstore.token_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(ids)) for i, ids in want)
    sequence = [t for r in got for t in r.ids]
    starts = np.cumsum([0, *(len(r.ids) for r in got)]).tolist()
    assert [r.start for r in got] == starts[:-1]
    digests = sorted(tokenstore.token_digests(spark, path).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in digests] == [(r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got]

    tokens = [0, 50256, sequence[5], 50257, 49_000]
    counts = {r.token: r.n for r in tokenstore.token_counts(spark, path, tokens).collect()}
    assert counts == {t: sequence.count(t) for t in tokens}
    places = Counter(tuple(r) for r in tokenstore.token_places(spark, path, tokens[:3]).collect())
    assert places == Counter((t, r.doc_id, r.start + i, i) for r in got for i, t in enumerate(r.ids) if t in tokens[:3])
    at = [0, 3, len(sequence) - 1, len(sequence), 1000]
    assert dict(map(tuple, tokenstore.tokens_at(spark, path, at).collect())) == {p: sequence[p] for p in at if p < len(sequence)}


def test_a_shard_is_one_file_of_bounded_size(spark):
    path = job_folder(spark)
    tokenstore.write_tokens(documents(spark, [(i, prose(random.Random(i), 200)) for i in range(60)]), path, VOCABULARY, 1000, 1 << 25)
    files = [p for p in Path(path).rglob("part-*") if not p.name.endswith(".crc")]
    assert len(files) == len({p.parent for p in files}) > 10
    for p in files:
        shard = wavelet.Shard(p.read_bytes())
        assert f"n_tokens={shard.n}" in str(p) and shard.n < 1000 + 1000


def test_many_rows_of_one_id_are_spread(spark):
    """A third of the rows share an id and half of these the text too; no range holds them all."""
    docs = documents(spark, [(7 if i % 3 == 0 else i, "the same words" if i % 2 else prose(random.Random(i), 20)) for i in range(600)])
    path = job_folder(spark)
    tokenstore.write_tokens(docs, path, VOCABULARY, range_bytes=2000)
    shards = [wavelet.Shard(r.content).documents()[0] for r in tokenstore.token_files(spark, path).collect()]
    counts = [names.count(7) for names in shards]
    assert sum(counts) == 201 and max(counts) < 120 and len(shards) > 5


def test_no_documents(spark):
    path = job_folder(spark)
    tokenstore.write_tokens(documents(spark, []), path, VOCABULARY)
    assert tokenstore.token_digests(spark, path).collect() == [] and tokenstore.token_places(spark, path, [0]).collect() == []
