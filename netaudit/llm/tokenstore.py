"""Token ids of whole texts in files of wavelet matrices, one per shard.

Documents are put in the order of their ids by a range shuffle; each task encodes its range and
closes a shard after ``SHARD_TOKENS`` ids, behind a whole document. A shard is one file (see
``wavelet.py``) that Spark's writer commits with its task, so a lost executor leaves no part of
one. Folders name a shard's number and its ids; where a shard begins in the whole sequence is a
sum over these names, and no file is opened for it.

Cases: a null text is empty and has the end id only; null ids come first; rows that share an id
follow by a hash of their text, repeated rows each for itself; other columns are not read, whatever
their names; no documents give no files and no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from netaudit.llm.common import checkpointed
from netaudit.llm.wavelet import Shard, image
from netaudit.operators.scan import ordered_scan

#: Id behind each document.
END = 0
#: A shard is closed behind the document that brings it to so many ids.
SHARD_TOKENS = 1 << 23
#: Bytes of text in a range of documents, on average; there is a range for each core at least.
RANGE_BYTES = 1 << 25
#: Most shards of a range, which number the shards of the next from there.
SHARDS_OF_RANGE = 1_000_000
#: Pieces of text whose ids a task remembers, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 1 << 20, 64
#: Pieces that go to the library as one text.
TOGETHER = 256
#: Bytes of texts that are cut at once.
GROUP_BYTES = 1 << 23

# No token spans a character that is surely no white space and a space after it, a letter and a mark
# after it that is no apostrophe, or a single line end and a letter after it, so texts are cut there.
# White space that the library and Python may see differently keeps a text from being cut elsewhere
# than before a blank behind a visible ASCII character.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_PIECE = re.compile(f"\n(?=[{_LETTERS}])|[ \n\r\t]*[{_LETTERS}]+(?=[ \n\r\t!-&(-/:-@\\[-`{{-~]|\\Z)|[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
# One word of the library's own pattern.
_WORD = re.compile(f" ?[{_LETTERS}]+")
_MARKED = re.compile("[^A-Za-z\\s][^\\s]*")
# The characters that stand for bytes in vocabularies of bytes: printable ones for themselves, the others from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_LINE_END = chr(_BYTE_NAMES[0x0A])
_DOUBTFUL = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_SURE_CUT = re.compile("(?<=[!-~])(?= )")
# One word of the library's own pattern, whatever stands around it in a text without added tokens.
_ALONE = f" ?([{_LETTERS}]+|[0-9]+|[!-&(-/:-@\\[-`{{-~]+)"
# Kinds of bytes: white space, letters and digits of ASCII, marks of ASCII without the apostrophe, all others.
_SPACE, _PLAIN, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[*b" \n\r\t"]] = _SPACE
_KIND[[b for b in range(0x21, 0x7F) if b != 0x27]] = _MARK
_KIND[[b for b in range(128) if chr(b).isalnum()]] = _PLAIN
# Pairs of kinds that no token spans.
_APART = np.zeros(16, dtype=bool)
_APART[[4 * a + b for a, b in ((_PLAIN, _SPACE), (_MARK, _SPACE), (_OTHER, _SPACE), (_PLAIN, _MARK), (_MARK, _PLAIN))]] = True


def _starts_of_pieces(content: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of texts that begin at ``starts``; the texts have no added tokens and no doubtful white space."""
    kinds = _KIND[content]
    begins = np.ones(len(content), dtype=bool)
    begins[1:] = _APART[4 * kinds[:-1] + kinds[1:]]
    begins[starts] = True
    # A line end alone before a visible character is a token, so what follows it begins a piece too.
    lines = np.flatnonzero(content[:-1] == 0x0A)
    lines = lines[begins[lines] & (kinds[lines + 1] != _SPACE)]
    begins[lines + 1] = True
    return np.flatnonzero(begins)


class Encoder:
    """Ids of texts as the library gives them; pieces between blanks are encoded once and remembered.

    For vocabularies of bytes with the library's own pattern of words, and added tokens that are not words.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        steps = json.loads(self.library.to_str())
        kind = steps["pre_tokenizer"] or {}
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if steps["normalizer"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"] or any(not _MARKED.fullmatch(t) for t in added):
            raise ValueError(f"not a vocabulary of bytes: {path}")
        self.model = self.library.model
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        # The machine's order of bytes is little-endian, as Spark's workers are.
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.end = np.array([END], dtype=self.dtype).tobytes()
        # A character of a token stands for a byte; added tokens stand for themselves.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        for i, token in self.library.get_added_tokens_decoder().items():
            self.bytes[i] = len(token.content.encode())
        self.known: dict[str, bytes] = {}
        self.odd = "|".join([_DOUBTFUL.pattern, *map(re.escape, added)])
        # The name of each byte.
        self.names = np.array([_BYTE_NAMES.get(b, b) for b in range(256)], dtype="<u2")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def _learn_words(self, words: list[str]) -> None:
        """Encode pieces that are one word each of the library's own pattern."""
        if words:
            # Names of the bytes of all words at once; no word has a line end.
            names = self.names[np.frombuffer("\n".join(words).encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")
            kind, tokenize = self.dtype.char, self.model.tokenize
            for piece, name in zip(words, names.split(_LINE_END), strict=True):
                self.known[piece] = array(kind, [t.id for t in tokenize(name)]).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces; those that no token can leave go to the library as one text."""
        apart, rest, words = [], [], []
        for piece in pieces:
            (words if _WORD.fullmatch(piece) else rest).append(piece)
        self._learn_words(words)
        for at in range(0, len(rest), TOGETHER):
            some = []
            for piece in rest[at : at + TOGETHER]:
                closed = piece[0] in " \n\r\t" and ("!" <= piece[-1] <= "~" or piece[-1].isalnum())
                (some if closed else apart).append(piece)
            ids = self._ids("".join(some))
            ends = np.cumsum([len(p.encode()) for p in some])
            reached = np.cumsum(self.bytes[ids])
            cuts = np.searchsorted(reached, ends) + 1
            if not np.array_equal(reached[cuts - 1], ends):
                raise ValueError("the vocabulary has tokens that span words")
            content, size = ids.tobytes(), self.dtype.itemsize
            first = 0
            for piece, last in zip(some, (cuts * size).tolist(), strict=True):
                self.known[piece] = content[first:last]
                first = last
        for piece in apart:
            self.known[piece] = self._ids(piece).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text and the end id, as unsigned little-endian numbers."""
        if not text:
            return self.end
        known = self.known
        pieces = (_SURE_CUT.split if _DOUBTFUL.search(text) else _PIECE.findall)(text)
        found = list(map(known.get, pieces))
        if None in found:
            if len(known) > REMEMBERED:
                known.clear()
            places = [i for i, ids in enumerate(found) if ids is None]
            missing = {pieces[i] for i in places}
            self._learn(list(missing))
            for i in places:
                found[i] = known[pieces[i]]
            for piece in missing:
                if len(piece) > LONGEST_REMEMBERED:
                    del known[piece]
        found.append(self.end)
        return b"".join(found)

    def _known(self, pieces: pa.Array) -> list[bytes]:
        """Ids of different pieces; those that hold several words and are new are cut further."""
        keys = pieces.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, keys))
        if None in found:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known, places = self.known, [i for i, ids in enumerate(found) if ids is None]
            alone = pc.match_substring_regex(pieces.take(pa.array(places)), f"^{_ALONE}$").to_pylist()
            self._learn_words([keys[i] for i, one in zip(places, alone, strict=True) if one])
            mixed = {keys[i]: _PIECE.findall(keys[i]) for i, one in zip(places, alone, strict=True) if not one}
            self._learn([part for part in set(chain.from_iterable(mixed.values())) if part not in known])
            for piece, parts in mixed.items():
                known[piece] = b"".join([known[part] for part in parts])
            for i in places:
                found[i] = known[keys[i]]
            for piece in chain([keys[i] for i in places], *mixed.values()):
                if len(piece) > LONGEST_REMEMBERED:
                    known.pop(piece, None)
        return found

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text of a column; a piece is looked up once in a group of texts."""
        groups = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)) // GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if begin < end:
                yield from self._encode_group(texts.slice(begin, end - begin).fill_null("").cast(pa.large_string()))

    def _encode_group(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, self.odd)
        alone = odd.to_pylist()
        plain = pc.if_else(odd, "", texts).cast(pa.large_string()) if any(alone) else texts
        _, offsets, content = plain.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
        content = np.frombuffer(content or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
        starts = bounds - bounds[0]
        if len(content):
            begins = _starts_of_pieces(content, starts[:-1][np.diff(starts) > 0])
            ends = np.r_[begins, len(content)]
            pieces = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(content)]).dictionary_encode()
            ids = pa.array(self._known(pieces.dictionary), pa.large_binary()).take(pieces.indices)
            _, places, found = ids.buffers()
            starts = np.frombuffer(places, dtype=np.int64)[ids.offset + np.searchsorted(ends, starts)]
        else:
            found = b""
        found, starts = memoryview(found), starts.tolist()
        for i, own in enumerate(alone):
            yield self.encode(texts[i].as_py()) if own else b"".join([found[starts[i] : starts[i + 1]], self.end])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


_FILE_SQL = "shard long, n_tokens long, image binary"
_FILE = pa.schema([("shard", pa.int64()), ("n_tokens", pa.int64()), ("image", pa.large_binary())])


def _sharder(vocabulary: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        # The number of the range; the shuffle keeps it, as the number of ranges is set.
        shard = TaskContext.get().partitionId() * SHARDS_OF_RANGE
        ids, names, lengths = bytearray(), [], []

        def closed() -> pa.RecordBatch:
            content = image(np.frombuffer(ids, dtype=own.dtype), names, lengths)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, sum(lengths), content), _FILE, strict=True)], schema=_FILE)

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), own.encode_all(batch.column(1)), strict=True):
                ids += found
                names.append(doc_id)
                lengths.append(len(found) // own.dtype.itemsize)
                if len(ids) >= shard_tokens * own.dtype.itemsize:
                    yield closed()
                    shard += 1
                    ids, names, lengths = bytearray(), [], []
        if names:
            yield closed()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, shard_tokens: int = SHARD_TOKENS, range_bytes: int = RANGE_BYTES) -> None:
    """Encode every whole text and write the shards below ``path``, which must not exist.

    ``vocabulary`` names a file of the tokenizers library that every executor can open.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Rows that share an id are spread by their text, equal ones by where they stand in the input.
    spread = texts.select("*", F.xxhash64("text").alias("same_id"), F.monotonically_increasing_id().alias("same_text"))
    keys = ["doc_id", "same_id", "same_text"]
    ranges = spread.repartitionByRange(max(1 + size // range_bytes, docs.sparkSession.sparkContext.defaultParallelism), *keys).sortWithinPartitions(*keys)
    shards = ranges.select("doc_id", "text").mapInArrow(_sharder(vocabulary, shard_tokens), _FILE_SQL)
    # The text writer puts the bytes of a string down as they are, and a line end that the image does not count.
    shards.select("shard", "n_tokens", F.col("image").cast("string")).write.partitionBy("shard", "n_tokens").text(path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """``shard, n_tokens, content`` of each file; the first two are read from names."""
    def named(name):
        return F.regexp_extract("path", f"/{name}=([0-9]+)/", 1).cast("long").alias(name)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(named("shard"), named("n_tokens"), "content")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``shard, start``: ids in all shards before it."""
    shards = token_files(spark, path).select("shard", "n_tokens", F.floor(F.col("shard") / (1000 * SHARDS_OF_RANGE)).alias("ranges"))
    shards = checkpointed(shards)
    return checkpointed(ordered_scan(shards, [], ["ranges"], "shard", total_before={"start": F.col("n_tokens")}).select("shard", F.col("start").cast("long")))


def _documents(shard: Shard) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    names, starts = shard.documents()
    return names, starts, shard.tokens()


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document, read back from the files; the end id comes last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names, starts, ids = _documents(Shard(content.as_buffer()))
                # Lists of one batch must not outgrow their offsets.
                for at in range(0, len(names), 4096):
                    last = min(at + 4096, len(names))
                    offsets = (starts[at : last + 1] - starts[at]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[starts[at] : starts[last]].astype(np.int32)))
                    columns = [pa.array([number] * (last - at), pa.int64()), pa.array(names[at:last], pa.int64()), pa.array(starts[at:last]), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "inside", "ids"])

    rows = token_files(spark, path).select("shard", "content").mapInArrow(run, "shard long, doc_id long, inside long, ids array<int>")
    return rows.join(shard_starts(spark, path), "shard").select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "ids")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names, starts, ids = _documents(Shard(content.as_buffer()))
                ends = starts.tolist()
                sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                columns = [pa.array([number] * len(names), pa.int64()), pa.array(names, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = token_files(spark, path).select("shard", "content").mapInArrow(run, "shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(shard_starts(spark, path), "shard").select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_counts(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """``token, n`` for each of ``tokens`` (ids of the vocabulary), by two ranks per plane and shard."""
    wanted = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([shard.count(t) for t in wanted], pa.int64())], ["token", "n"])

    found = token_files(spark, path).select("content").mapInArrow(run, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def token_places(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """``token, doc_id, place, inside`` of every occurrence of each of ``tokens``: its place in the whole sequence and in its document."""
    wanted = sorted(set(tokens))
    names = ["shard", "token", "doc_id", "at", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(content.as_buffer())
                docs, starts = shard.documents()
                for token in wanted:
                    at = shard.places(token)
                    row = np.searchsorted(starts, at, side="right") - 1
                    doc_ids = pa.array(docs, pa.int64()).take(pa.array(row))
                    fixed = [pa.array(np.full(len(at), v, dtype=np.int64)) for v in (number, token)]
                    yield pa.RecordBatch.from_arrays([*fixed, doc_ids, pa.array(at), pa.array(at - starts[row])], names)

    rows = token_files(spark, path).select("shard", "content").mapInArrow(run, "shard long, token long, doc_id long, at long, inside long")
    return rows.join(shard_starts(spark, path), "shard").select("token", "doc_id", (F.col("start") + F.col("at")).alias("place"), "inside")


def tokens_at(spark: SparkSession, path: str, places: Sequence[int]) -> DataFrame:
    """``place, token`` for each of ``places`` in the whole sequence, those of the request that exist; each reads one block per plane."""
    wanted = np.unique(np.array(places, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(content.as_buffer())
                mine = wanted[(wanted >= start) & (wanted < start + shard.n)]
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(shard.access(mine - start))], ["place", "token"])

    files = token_files(spark, path).join(shard_starts(spark, path), "shard")
    return files.select("start", "content").mapInArrow(run, "place long, token long")
