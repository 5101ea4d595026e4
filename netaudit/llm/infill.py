"""Fill-in-the-middle transformation of whole texts by piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable buffers: its UTF-8
text and the three sentinels. Cutting splits a descriptor, an arrangement permutes descriptors and
puts a sentinel's before each, the inverse permutation restores the order, and hashes read the
bytes that the descriptors name without putting a new text together. Where to cut and how to
arrange follows from a hash of ``doc_id`` alone, so a repeated or recovered task does the same.

Cases: a null text is empty; an empty text, and one that holds a sentinel, stays as it is
(``plain``); a null ``doc_id`` is hashed as no digits; repeated rows are transformed alike, each for
itself; other columns are not read, whatever their names; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from netaudit.llm.words import text_pieces

PREFIX, MIDDLE, SUFFIX = range(3)
#: The sentinel in front of each part, as one buffer.
SENTINELS = b"<P><M><S>"
MARKS = tuple(SENTINELS[i : i + 3] for i in range(0, len(SENTINELS), 3))
#: Order of the parts in each form that is not plain.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Documents of 100 that are transformed, and of these the ones of 100 whose suffix comes first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
TEXT_BUFFER, SENTINEL_BUFFER = 0, 1
#: Bytes of a buffer that a hash reads at a time.
STREAM_BYTES = 1 << 16

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class PieceTable:
    """Descriptors ``(buffer, start, length)`` in the order in which their bytes are read."""

    buffers: tuple[memoryview, memoryview]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: bytes | memoryview) -> PieceTable:
        view = memoryview(text)
        return cls((view, memoryview(SENTINELS)), ((TEXT_BUFFER, 0, len(view)),))

    def cut(self, at: int) -> PieceTable:
        """Split the descriptor that holds the byte ``at``; at either end of one, a part is empty."""
        before = 0
        for i, (buffer, start, length) in enumerate(self.pieces):
            if at <= before + length:
                parts = (buffer, start, at - before), (buffer, start + at - before, before + length - at)
                return PieceTable(self.buffers, self.pieces[:i] + parts + self.pieces[i + 1 :])
            before += length
        raise IndexError(f"cut at {at} of {before} bytes")

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The descriptors in ``order``, each behind its sentinel."""
        marked = [((SENTINEL_BUFFER, len(MARKS[p]) * p, len(MARKS[p])), self.pieces[p]) for p in order]
        return PieceTable(self.buffers, tuple(piece for pair in marked for piece in pair))

    def restored(self, order: Sequence[int]) -> PieceTable:
        """Sentinels out, descriptors back by the inverse of ``order``."""
        parts = [p for p in self.pieces if p[0] == TEXT_BUFFER]
        inverse = sorted(range(len(order)), key=order.__getitem__)
        return PieceTable(self.buffers, tuple(parts[i] for i in inverse))

    def chunks(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            for at in range(start, start + length, STREAM_BYTES):
                yield self.buffers[buffer][at : min(at + STREAM_BYTES, start + length)]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()

    def text(self) -> bytes:
        return b"".join(self.buffers[buffer][start : start + length] for buffer, start, length in self.pieces)


def parsed(output: bytes | memoryview, form: str) -> PieceTable:
    """The table of an output over its own bytes. No sentinel can begin inside another or inside a part of a text without any."""
    table, whole = PieceTable.of(output), bytes(output)
    if form == "plain":
        return table
    order = ORDERS[form]
    marks = [whole.index(MARKS[order[0]])]
    for part in order[1:]:
        marks.append(whole.index(MARKS[part], marks[-1] + 3))
    ends = [*marks[1:], len(whole)]
    pieces = []
    for part, at, end in zip(order, marks, ends, strict=True):
        pieces += [(SENTINEL_BUFFER, 3 * part, 3), (TEXT_BUFFER, at + 3, end - at - 3)]
    return PieceTable(table.buffers, tuple(pieces))


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four unsigned integers of 32 bits that belong to an id."""
    name = b"" if doc_id is None else b"%d" % doc_id
    return struct.unpack(">4I", hashlib.sha256(b"1:" + name).digest()[:16])


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which units begin (runs of ASCII letters, other code points alone) and the first unit of each row."""
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, bounds)


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _transform(doc_id: int | None, data: np.ndarray, starts: np.ndarray) -> tuple[str, int | None, int | None, PieceTable]:
    """Form, code points of prefix and middle, and the table of a text with units at ``starts``."""
    view = memoryview(np.ascontiguousarray(data))
    table, whole, n = PieceTable.of(view), view.tobytes(), len(starts)
    h1, h2, h3, h4 = draws(doc_id)
    if not whole or h3 % 100 >= TRANSFORMED or any(mark in whole for mark in MARKS):
        return "plain", None, None, table
    first, second = (int(starts[u]) if u < n else len(whole) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    return form, code_points(data[:first]), code_points(data[first:second]), table.cut(first).cut(second).arranged(ORDERS[form])


_MADE = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("output_sha256", pa.string()),
    ("pieces", pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))), ("output", pa.string()),
])
_MADE_SQL = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
    "pieces array<struct<buffer: int, start: long, length: long>>, output string"
)


def _make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, last, data, bounds in text_pieces(batch.column(1)):
            starts, offsets = unit_starts(data, bounds)
            rows = []
            for r, doc_id in enumerate(ids[first:last]):
                begin, end = int(bounds[r]), int(bounds[r + 1])
                own = starts[offsets[r] : offsets[r + 1]] - begin
                form, prefix, middle, table = _transform(doc_id, data[begin:end], own)
                pieces = [{"buffer": b, "start": s, "length": n} for b, s, n in table.pieces]
                rows.append((doc_id, len(own), form, prefix, middle, table.sha256(), pieces, table.text()))
            columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(_MADE)]
            yield pa.RecordBatch.from_arrays(columns, schema=_MADE)


def transformed(docs: DataFrame) -> DataFrame:
    """Every whole text cut and arranged.

    ``n`` counts units, ``prefix_chars`` and ``middle_chars`` code points (null if plain),
    ``pieces`` are the descriptors (buffer 0 is the text, 1 the sentinels, in bytes) and ``output``
    the text that they name.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_make, _MADE_SQL)


def _each_restored(names: list[str], types: list[pa.DataType], make: Callable[[PieceTable], str | bytes]):
    """A map of the columns ``names``, ``form``, ``output`` to ``names`` and what ``make`` reads from the restored table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(i) for i in range(len(names))]
            forms, outputs = batch.column(len(names)), batch.column(len(names) + 1).cast(pa.large_binary())
            made = []
            for form, output in zip(forms.to_pylist(), outputs, strict=True):
                whole = output.as_buffer() if output.is_valid else b""
                table = parsed(whole, form)
                made.append(make(table if form == "plain" else table.restored(ORDERS[form])))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, types[-1])], [*names, "made"])

    return run


def restored(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` rebuilt from nothing but ``form`` and ``output``; a null output is empty."""
    run = _each_restored(["doc_id"], [pa.string()], PieceTable.text)
    found = rows.select(F.col("doc_id").cast("long"), "form", "output").mapInArrow(run, "doc_id long, made string")
    return found.withColumnRenamed("made", "text")


def infill_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every whole text."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    run = _each_restored(names, [pa.string()], PieceTable.sha256)
    rows = transformed(docs).select(*names, F.col("form").alias("how"), "output")
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, made string"
    return rows.mapInArrow(run, schema).withColumnRenamed("made", "restored_sha256")
