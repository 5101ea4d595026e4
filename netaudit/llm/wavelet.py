"""Wavelet matrix of a sequence of ids, and its file image.

Plane ``p`` holds bit ``p`` (from the highest) of every id; below it stand the ids whose bit is 0,
then those whose bit is 1, each in their order. One rank per plane follows a position down, one
select per plane leads back up. So an id at a position, the number of an id before a position and
the places of an id need a few looks into each plane, not the sequence.

An image is one string of bytes: a header, a directory, the table of documents, and each plane in
blocks of ``BLOCK_BITS`` bits that are compressed apart, with the ones before each block. A reader
decompresses the blocks it looks into.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

MAGIC = b"WVMX"
VERSION = 1
#: Bits of a plane that are compressed together.
BLOCK_BITS = 1 << 18
_BLOCK_BYTES = BLOCK_BITS >> 3
_BLOCK_WORDS = BLOCK_BITS >> 6
#: Magic, version, planes, ids, documents, bytes of the image.
_HEADER = struct.Struct("<4sHHQQQ")


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def _bits_needed(ids: np.ndarray) -> int:
    return max(1, int(ids.max()).bit_length()) if len(ids) else 1


def planes_of(ids: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Packed bits of each plane (the first bit is the lowest of its byte) and the zeros in each."""
    planes, zeros, now = [], [], ids
    for shift in range(_bits_needed(ids) - 1, -1, -1):
        one = now & now.dtype.type(1 << shift) != 0
        planes.append(np.packbits(one, bitorder="little"))
        below = np.compress(~one, now)
        zeros.append(len(below))
        now = np.concatenate([below, np.compress(one, now)])
    return planes, zeros


def image(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """File image of the ids of consecutive documents; ``lengths`` add up to the ids."""
    if sum(lengths) != len(ids) or len(lengths) != len(doc_ids):
        raise ValueError("lengths of documents differ from the ids")
    codec = _codec()
    planes, zeros = planes_of(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    frames = [codec.compress(known.tobytes() + numbers.tobytes() + np.array(lengths, dtype="<i8").tobytes(), asbytes=True)]
    ranks = []
    for plane in planes:
        seen = 0
        for at in range(0, len(plane), _BLOCK_BYTES):
            block = plane[at : at + _BLOCK_BYTES]
            frames.append(codec.compress(block.tobytes(), asbytes=True))
            ranks.append(seen)
            seen += int(np.bitwise_count(block).sum())
    # Per frame its end; per plane its zeros; per block the ones of its plane before it.
    directory = np.concatenate([np.cumsum([len(f) for f in frames]), zeros, ranks]).astype("<i8").tobytes()
    size = _HEADER.size + len(directory) + sum(map(len, frames))
    return b"".join([_HEADER.pack(MAGIC, VERSION, len(planes), len(ids), len(doc_ids), size), directory, *frames])


class Shard:
    """Reads an image; bytes after its end are left alone."""

    def __init__(self, content: bytes | memoryview | pa.Buffer):
        view = memoryview(content)
        magic, version, self.planes, self.n, self.n_docs, size = _HEADER.unpack_from(view)
        if magic != MAGIC or version != VERSION or size > len(view):
            raise ValueError("not a whole image of a wavelet matrix")
        self.codec = _codec()
        self.plane_bytes = (self.n + 7) >> 3
        self.blocks = -(-self.plane_bytes // _BLOCK_BYTES)
        n_frames = 1 + self.planes * self.blocks
        directory = np.frombuffer(view, dtype="<i8", count=n_frames + self.planes + self.planes * self.blocks, offset=_HEADER.size)
        self.frame_ends = directory[:n_frames]
        self.zeros = directory[n_frames : n_frames + self.planes]
        self.ranks = directory[n_frames + self.planes :].reshape(self.planes, self.blocks)
        self.frames = view[_HEADER.size + directory.nbytes : size]
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _frame(self, i: int, size: int) -> bytes:
        begin = int(self.frame_ends[i - 1]) if i else 0
        return self.codec.decompress(self.frames[begin : int(self.frame_ends[i])], decompressed_size=size, asbytes=True)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents and the place of each one's first token, with the end of the last."""
        raw = self._frame(0, 17 * self.n_docs) if self.n_docs else b""
        known = np.frombuffer(raw, dtype=np.uint8, count=self.n_docs)
        numbers = np.frombuffer(raw, dtype="<i8", count=self.n_docs, offset=self.n_docs)
        lengths = np.frombuffer(raw, dtype="<i8", count=self.n_docs, offset=9 * self.n_docs)
        names = [d if k else None for d, k in zip(numbers.tolist(), known.tolist(), strict=True)]
        return names, np.r_[0, np.cumsum(lengths)].astype(np.int64)

    def _block_bytes(self, plane: int, block: int) -> bytes:
        size = min(_BLOCK_BYTES, self.plane_bytes - block * _BLOCK_BYTES)
        return self._frame(1 + plane * self.blocks + block, size)

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of a block, and the ones of the plane before each of them and after the last."""
        found = self.held.get((plane, block))
        if found is None:
            words = np.zeros(_BLOCK_WORDS, dtype="<u8")
            raw = np.frombuffer(self._block_bytes(plane, block), dtype=np.uint8)
            words.view(np.uint8)[: len(raw)] = raw
            ones = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)] + self.ranks[plane, block]
            self.held[plane, block] = found = words, ones
        return found

    def _bits(self, plane: int) -> np.ndarray:
        raw = b"".join(self._block_bytes(plane, b) for b in range(self.blocks))
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=self.n, bitorder="little").view(bool)

    def tokens(self) -> np.ndarray:
        """The whole sequence, from the last plane up; each step merges two runs."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for plane in range(self.planes - 1, -1, -1):
            one, zeros = self._bits(plane), int(self.zeros[plane])
            above = np.empty(self.n, dtype=kind)
            # Places of the bits, as numpy assigns by places faster than by a mask.
            above[np.flatnonzero(~one)] = now[:zeros]
            above[np.flatnonzero(one)] = now[zeros:] | kind(1 << (self.planes - 1 - plane))
            now = above
        return now

    def _look(self, plane: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bit at each place and ones of the plane before it; the bit at the end is 0."""
        bits, ranks = np.zeros(len(places), dtype=bool), np.zeros(len(places), dtype=np.int64)
        blocks = np.minimum(places // BLOCK_BITS, max(self.blocks - 1, 0))
        for block in np.unique(blocks).tolist():
            mine = blocks == block
            words, ones = self._block(plane, block)
            inside = places[mine] - block * BLOCK_BITS
            word, bit = inside >> 6, (inside & 63).astype(np.uint64)
            # The end of a full block has no word of its own.
            held = np.where(word < _BLOCK_WORDS, words[np.minimum(word, _BLOCK_WORDS - 1)], np.uint64(0))
            below = held & ((np.uint64(1) << bit) - np.uint64(1))
            ranks[mine] = ones[word] + np.bitwise_count(below)
            bits[mine] = (held >> bit) & np.uint64(1) == 1
        return bits, ranks

    def access(self, places: np.ndarray) -> np.ndarray:
        """Ids at ``places``."""
        now = np.asarray(places, dtype=np.int64)
        if len(now) and not (0 <= now.min() and now.max() < self.n):
            raise IndexError("place outside the sequence")
        ids = np.zeros(len(now), dtype=np.int64)
        for plane in range(self.planes):
            one, rank = self._look(plane, now)
            now = np.where(one, self.zeros[plane] + rank, now - rank)
            ids = 2 * ids + one
        return ids

    def _path(self, token: int) -> list[bool] | None:
        """Bits of an id from the highest; None if it has more than there are planes."""
        if token < 0 or token >> self.planes:
            return None
        return [bool(token >> (self.planes - 1 - p) & 1) for p in range(self.planes)]

    def _span(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where those of ``begin`` to ``end`` that are ``token`` stand below the last plane."""
        now = np.array([begin, end], dtype=np.int64)
        path = self._path(token)
        if path is None or not self.n:
            return 0, 0
        for plane, one in enumerate(path):
            _, rank = self._look(plane, now)
            now = self.zeros[plane] + rank if one else now - rank
        return int(now[0]), int(now[1])

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often ``token`` stands in ``begin`` to ``end`` (excluded)."""
        first, last = self._span(token, begin, self.n if end is None else end)
        return last - first

    def _select(self, plane: int, one: bool, k: np.ndarray) -> np.ndarray:
        """Places of the ``k``-th (from 0) ones, or zeros, of a plane; ``k`` ascends."""
        at = np.arange(self.blocks, dtype=np.int64) * BLOCK_BITS
        before = self.ranks[plane] if one else at - self.ranks[plane]
        blocks = np.searchsorted(before, k, side="right") - 1
        places = np.zeros(len(k), dtype=np.int64)
        for block in np.unique(blocks).tolist():
            mine = blocks == block
            words, ones = self._block(plane, block)
            own = words if one else ~words
            starts = np.arange(_BLOCK_WORDS + 1, dtype=np.int64) * 64 + block * BLOCK_BITS
            below = ones if one else starts - ones
            word = np.searchsorted(below, k[mine], side="right") - 1
            left = (k[mine] - below[word]).astype(np.int64)
            bits = np.unpackbits(own[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            nth = np.cumsum(bits, axis=1, dtype=np.uint8) == (left + 1)[:, None]
            places[mine] = starts[word] + np.argmax(nth, axis=1)
        return places

    def places(self, token: int) -> np.ndarray:
        """All places of ``token``, ascending."""
        first, last = self._span(token, 0, self.n)
        now = np.arange(first, last, dtype=np.int64)
        if first == last:
            return now
        for plane, one in reversed(list(enumerate(self._path(token)))):
            now = self._select(plane, one, now - self.zeros[plane] if one else now)
        return now
