import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from netaudit.llm.bpe import MergeAutomaton, decoded, encoded, encoder, token_digests
from tests.llm.support import documents, edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got, n = encoder(PATH).encode(text)
    return got == " ".join(map(str, ids)) and n == len(ids) and encoder(PATH).decode(got) == library.decode(ids, skip_special_tokens=False)


PARTS = ["a", "th", "the", "ing", "E", "'s", "'", "re", ".", "1", "!!", "é", "é", "́", "漢", " ", "\n", "\x1c", "\x00", "\xa0", "😀", "İ", "Σ", "haha", "—", "<|endoftext|>", "<|x"]


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_ids_and_text_are_the_library_s(library, text):
    assert same(library, text)


def test_words_of_vocabulary_parts(library):
    rng, words = random.Random(6), sorted(library.get_vocab())
    for _ in range(3000):
        assert same(library, "".join(rng.choice(words).replace("</w>", "") for _ in range(3)))
    assert same(library, "ha" * 3000)


def test_edge_documents(spark, library):
    rows = edge_rows(random.Random(7))
    tokens = encoded(documents(spark, rows), PATH)
    assert sorted((r.doc_id or -1, r.n_tokens, list(r.ids)) for r in tokens.collect()) == sorted(
        (i or -1, len(x := library.encode(t or "", add_special_tokens=False).ids), x) for i, t in rows
    )
    back = sorted((r.doc_id or -1, r.text) for r in decoded(tokens, PATH).collect())
    assert back == sorted((i or -1, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows)
    assert token_digests(documents(spark, []), PATH).count() == 0


def test_gadgets_of_a_repeated_letter():
    letters = {**{c: i for i, c in enumerate(__import__("netaudit.llm.bpe", fromlist=["byte_symbols"]).byte_symbols())}}
    vocab = letters | {c + "$": 256 + i for c, i in letters.items()} | {"aa": 512, "aaa$": 513}
    machine = MergeAutomaton(vocab, [["a", "a"], ["aa", "a$"]], "$")
    assert [machine.labels[t] for t in machine.encode("aaaa")] == ["aa", "a", "a$"]
    assert [machine.labels[t] for t in machine.encode("aaaaa")] == ["aa", "aa", "a$"][:1] + ["aaa$"]


def test_every_code_point(library):
    """Each alone, in words and among numbers and marks, also those that Python's tables do not have yet."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        assert same(library, "\n".join(f"a{c}a {c} 1{c}1 .{c}. {c}{c}" for c in points[at : at + 4096]))
