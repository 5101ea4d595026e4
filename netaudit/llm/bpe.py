"""Byte-pair encoding by a deterministic automaton made from merge gadgets, and decoding.

The automaton reads tokens; its state is the token last read. It starts with one arc per base
symbol from every state. The gadget of merge ``u v -> w`` forbids the arc ``v`` where ``u`` was
read last, adds the arc ``w`` wherever ``u`` could be read, and lets ``w`` lead on as ``v`` did
until then. After all gadgets the automaton accepts exactly one sequence of tokens for a word,
that of its merges. Encoding walks a word symbol by symbol through a table of arcs; decoding
emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

#: White space as the vocabulary's normaliser takes it. Fixed value: the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that are neither letters, numbers, white space nor an apostrophe, so that a run of them is one word.
MARKS = ".,;:!?#$%&*\"()[]"
#: Encoded words, and chunks of text, that a task process remembers; only spares repeated work.
REMEMBERED = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: its own if it has one, else the next from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return out


class MergeAutomaton:
    """Arcs allowed between tokens, from the merges in order.

    Written out, every state would have an arc for nearly every token. A gadget is therefore kept
    as its record: the parts of ``w``, its rank, and the forbidden pair; the arcs they imply are
    derived when a table entry is first used, and then stay in the table.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.letters = byte_symbols()
        self.labels = {token: text for text, token in vocab.items()}
        #: Tokens by spelling, inside a word and at its end.
        self.inner = {letter: vocab[letter] for letter in self.letters}
        self.final = {letter: vocab[letter + suffix] for letter in self.letters}
        self.rank, self.first, self.last, self.forbidden = {}, {}, {}, {}
        spelt = {token: text for text, token in [*self.inner.items(), *self.final.items()]}
        ends = set(self.final.values())
        for rank, (left, right) in enumerate(merges):  # the gadgets, one after the other
            u, v, w = vocab[left], vocab[right], vocab[left + right]
            self.forbidden.setdefault((u, v), rank)
            if w in self.rank:
                continue
            self.rank[w], self.first[w], self.last[w] = rank, u, v
            spelt[w] = spelt[u] + spelt[v]
            if v in ends:
                ends.add(w)
                self.final[spelt[w]] = w
            else:
                self.inner[spelt[w]] = w
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.arcs: dict[tuple[int, int], bool] = {}

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state``: no gadget forbids it to the parts at their border.

        A part's arcs pass to the whole when the whole is made, so a pair counts against wholes
        made later: on the right side also for the whole that the same merge makes.
        """
        known = self.arcs.get((state, token))
        if known is None:
            known, left, bound_left = True, state, float("inf")
            while known and left is not None:
                right, bound_right = token, float("inf")
                while right is not None:
                    rank = self.forbidden.get((left, right))
                    if rank is not None and rank < bound_left and rank <= bound_right:
                        known = False
                        break
                    bound_right = self.rank.get(right, -1)
                    right = self.first.get(right)
                bound_left = self.rank.get(left, -1)
                left = self.last.get(left)
            self.arcs[state, token] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Tokens of one word, which is not empty; its last symbol carries the suffix."""
        if not (word.isascii() and word.isprintable()):
            word = "".join([self.letters[byte] for byte in word.encode()])
        n, arcs, longest = len(word), self.arcs, self.longest
        # Token that ends after so many symbols, once it is known, and the place where it begins or is tried next.
        last, begins = [-1] * (n + 1), [0] * (n + 1)
        open_ends, end, begin = [], n, max(0, n - longest)
        find = self.final.get
        while True:
            token = find(word[begin:end])
            if token is not None and begin:
                state = last[begin]
                if state < 0:  # where the word's beginning leads comes first
                    open_ends.append(end)
                    begins[end] = begin
                    end, find = begin, self.inner.get
                    begin = end - longest if end > longest else 0
                    continue
                allowed = arcs.get((state, token))
                if not (self.arc(state, token) if allowed is None else allowed):
                    token = None
            if token is None:
                begin += 1
                continue
            last[end], begins[end] = token, begin
            if not open_ends:
                break
            end = open_ends.pop()
            begin = begins[end]
            if end == n:
                find = self.final.get
        out, at = [], n
        while at:
            out.append(last[at])
            at = begins[at]
        return out[::-1]


class Encoder:
    """Texts to tokens and back, for a word vocabulary file: normalise, split, walk the automaton."""

    def __init__(self, path: str):
        # The file is the tokenizer's public description; an unknown form of it is refused.
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError(f"{path} is no vocabulary of lower-cased words with ends")
        model = spec["model"]
        self.automaton = MergeAutomaton(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]], model["end_of_word_suffix"])
        self.path, self.library = path, None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {str(i): text for i, text in self.automaton.labels.items()} | {str(i): text for text, i in self.special.items()}
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.white = regex.compile(f"[{WHITE}]+")
        self.piece = regex.compile(steps[0]["pattern"]["Regex"].replace(r"\s", WHITE))
        #: Ids of chunks between white space as they stand in texts, and of words; labels of chunks.
        self.chunk_ids: dict[str, str] = {}
        self.chunk_labels: dict[str, str] = {}
        self.words: dict[str, tuple[str, str]] = {}

    def forget(self) -> None:
        """Drop the words that a task has learnt, and the automaton with them, as other tasks need the memory."""
        for held in (self.chunk_ids, self.chunk_labels, self.words):
            held.clear()
        encoder.cache_clear()

    def word(self, piece: str) -> tuple[str, str]:
        """Ids and labels of a word."""
        known = self.words.get(piece)
        if known is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
                self.automaton.arcs.clear()
            ids = " ".join(map(str, self.automaton.encode(piece)))
            known = self.words[piece] = (ids, self.decode(ids))
        return known

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks, which hold no white space, and decode them."""
        if len(self.chunk_ids) + len(chunks) > REMEMBERED:
            self.chunk_ids.clear()
            self.chunk_labels.clear()
        for chunk in chunks:
            if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
                self.remember(chunk, self.newer(chunk))
                continue
            # One letter at a time, so that a sigma at a word's end is like any other.
            plain = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ")).lower()
            if plain.isalpha():
                self.chunk_ids[chunk], self.chunk_labels[chunk] = self.word(plain)
                continue
            letters = plain.rstrip(MARKS)
            pieces = [letters, plain[len(letters) :]] if letters.isalpha() else self.piece.findall(plain)
            self.remember(chunk, pieces)

    def remember(self, chunk: str, pieces: list[str]) -> None:
        found = list(map(self.word, pieces))
        self.chunk_ids[chunk] = " ".join([ids for ids, _ in found])
        self.chunk_labels[chunk] = " ".join([labels for _, labels in found])

    def newer(self, chunk: str) -> list[str]:
        """Words of a chunk with characters that Python's tables do not know; the library's tables tell their case and kind."""
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        plain = self.library.normalizer.normalize_str(chunk)
        return [plain[begin:end] for _, (begin, end) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def chunks(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Special tokens as they stand, and between them what white space separates."""
        for i, part in enumerate(self.apart.split(text)):
            if i % 2:
                yield True, [part]
            else:
                # Python also splits at four control characters, which are no white space here.
                plain = not any(c in part for c in "\x1c\x1d\x1e\x1f")
                yield False, part.split() if plain else [c for c in self.white.split(part) if c]

    def both(self, text: str | None) -> tuple[str, str]:
        """Ids and labels of a whole text, each joined by spaces."""
        ids, labels = [], []
        for special, chunks in self.chunks(text or ""):
            if special:
                ids.append(str(self.special[chunks[0]]))
                labels.append(chunks[0])
                continue
            known = self.chunk_ids
            if fresh := {c for c in chunks if c not in known}:
                if len(self.chunk_ids) + len(fresh) > REMEMBERED:
                    fresh = set(chunks)
                self.learn(fresh)
            ids += map(self.chunk_ids.__getitem__, chunks)
            labels += map(self.chunk_labels.__getitem__, chunks)
        return " ".join(ids), " ".join(labels)

    def encode(self, text: str | None) -> tuple[str, int]:
        """Ids joined by spaces, and their number."""
        ids, _ = self.both(text)
        return ids, ids.count(" ") + 1 if ids else 0

    def decode(self, ids: str) -> str:
        """Labels of the arcs, joined by spaces, as this vocabulary has no decoder of its own."""
        labels = self.labels
        return " ".join([labels[i] for i in ids.split(" ")]) if ids else ""


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per task."""
    return Encoder(path)


def _each(path: str, column: str, names: list[str], schema: pa.Schema, make: Callable[[Encoder, str | None], tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            where = batch.schema.get_field_index(column)
            rows = [make(own, value.as_py()) for value in batch.column(where)]
            made = [pa.array([r[i] for r in rows], schema.field(n).type) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns) if i != where] + made, schema=schema)
        own.forget()

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text; ``ids`` is an array of int.

    Null and empty texts have no tokens; ids may be null or repeated, rows are kept as they are.
    ``path`` names the vocabulary file, which every executor can open.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            made = [own.encode(value.as_py()) for value in batch.column(1)]
            counts = [n for _, n in made]
            ids = np.fromstring(" ".join(text for text, _ in made if text), dtype=np.int32, sep=" ")
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts, dtype=np.int64)].astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), lists], ["doc_id", "n_tokens", "ids"])
        own.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` for rows of ``doc_id, ids``; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    rows = tokens.select(F.col("doc_id").cast("long"), F.array_join(F.coalesce("ids", F.array().cast("array<int>")), " ").alias("ids"))
    return rows.mapInArrow(_each(path, "ids", ["text"], schema, lambda own, ids: (own.decode(ids),)), "doc_id long, text string")


def _digests(own: Encoder, text: str | None) -> tuple[int, str, str]:
    ids, labels = own.both(text)
    return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(labels.encode()).hexdigest()


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, in one pass; cases as in ``encoded``."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _each(path, "text", names, schema, _digests), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
