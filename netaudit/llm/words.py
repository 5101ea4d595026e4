"""Words and word shingles of whole columns of text, hashed with numpy inside Arrow tasks.

A column arrives as one buffer of UTF-8 bytes. Words are runs without ASCII white space; each is
hashed to 64 bits eight bytes at a time, so no Python string is made. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Rows whose texts are brought into one buffer at a time.
PIECE_ROWS = 512
# Freed buffers go back to the system, as the tasks of an executor share its memory.
pa.set_memory_pool(pa.system_memory_pool())
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes of a word that are hashed eight at a time; longer words are hashed one by one.
LONG_WORD = 256
_KEYS = mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of the rows ``first`` to ``last`` (excluded) of a batch.

    ``hashes``, ``starts`` and ``ends`` have one entry per word; the words of row ``first + r``
    are ``offsets[r]`` to ``offsets[r + 1]``. ``data`` holds the bytes that starts and ends count.
    """

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.offsets))


def text_pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, to, their bytes and where each row's bytes begin and end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for begin in range(0, len(texts), PIECE_ROWS):
        yield from _buffer_pieces(texts.slice(begin, PIECE_ROWS).cast(pa.large_string()).fill_null(""), begin, limit)


def _buffer_pieces(texts: pa.Array, row: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    n = len(texts)
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        begin = offsets[first]
        yield row + first, row + last, data[begin : offsets[last]], offsets[first : last + 1] - begin
        first = last


def split_words(data: np.ndarray, bounds: np.ndarray, extra_starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the first word of each row. ``extra_starts`` marks bytes that begin a word anyway."""
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    if extra_starts is not None:
        cut[:-1] |= extra_starts
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | cut[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """64 bits of each span's bytes and length; with ``fold`` A-Z count as a-z.

    Eight bytes at a time go through a one-to-one mix, so that no structure of a word, such as
    sums that cancel out, makes two alike. Words of one length up to eight bytes never collide.
    """
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = _FOLD[data] if fold else data
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) * _KEYS[0] + _KEYS[1])
    active, done = np.flatnonzero(lengths <= LONG_WORD), 0
    while len(active):
        rest = lengths[active] - done
        value = eights[starts[active] + done]
        last = rest < 8
        value[last] &= (np.uint64(1) << (8 * rest[last]).astype(np.uint64)) - np.uint64(1)
        out[active] = mix((out[active] ^ value) * _KEYS[2])
        done += 8
        active = active[rest > 8]
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        digest = hashlib.blake2b(padded[starts[i] : ends[i]], digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def words_of(texts: pa.Array, fold: bool, limit: int = PIECE_BYTES) -> Iterator[Words]:
    for first, last, data, bounds in text_pieces(texts, limit):
        starts, ends, offsets = split_words(data, bounds)
        yield Words(first, last, data, starts, ends, hash_spans(data, starts, ends, fold), offsets)


@lru_cache(maxsize=8)
def _places(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, across row ends too; the caller leaves those out.

    Long runs are put together from runs of one, two, four and so on words, each mixed, so that
    no arrangement of few different words makes two runs alike.
    """
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    n = len(hashes) - k + 1
    if k <= 16:
        out = np.zeros(n, dtype=np.uint64)
        for j, place in enumerate(_places(k)):
            out += hashes[j : j + n] * place
        return mix(out)
    runs, size, out, done = hashes, 1, None, 0
    steps = _places(2 * k.bit_length())
    for level in range(k.bit_length()):
        left, right = steps[2 * level], steps[2 * level + 1]
        if k >> level & 1:
            out = runs if out is None else mix(out[: len(runs) - done] * left + runs[done:] * right)
            done += size
        if done < k:
            runs = mix(runs[:-size] * right + runs[size:] * left)
            size *= 2
    return out[:n]


def row_windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each window of ``k`` words inside a row, and the row of each."""
    counts = np.maximum(np.diff(w.offsets) - k + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - before[rows] + w.offsets[:-1][rows], rows


def shingle_sets(w: Words, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row: ``k`` words, or the whole row if it has fewer."""
    every = window_hashes(w.hashes, k)
    places = _places(k)
    for begin, end in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
        if end - begin >= k:
            yield np.unique(every[begin : end - k + 1])
        elif end > begin:
            own = w.hashes[begin:end] * places[: end - begin]
            yield mix(np.array([own.sum(dtype=np.uint64) + np.uint64(end - begin)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)
