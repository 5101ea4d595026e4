"""Ranked lexical search by bit-sliced Bloom signatures.

Documents with about as many distinct terms share a block. A block has one bitmap of its documents
per signature bit, its slices. A term sets three bits of a document, and three more for each power
of two that its count reaches. The slices of a term and a level, put together by AND, name every
document that holds the term so often, and a few others; weighted by the gain of each level they
add up to an upper bound of each document's score. Documents whose bound reaches the score of the
tenth best document known so far are read again and scored exactly.

Passes over the documents: signatures, document counts of the items' terms, the texts that may be
among the best ones by bound, and all that are not excluded by the tenth best score of those. Items
are taken in blocks whose tables of terms have a fixed size. Texts are named by their hash: two
texts of one hash are both read, so a name that is shared costs time and no document.

Cases: null and empty texts, and those without a term, are in no result; an item without terms, or
with a null text, gives no rows; null ids come last among equal scores; rows that share an id are
ranked each for itself, and so are items; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from netaudit.llm.common import checkpointed, split_by_ids
from netaudit.llm.words import hash_spans, mix, text_pieces

#: Documents of an item's result.
BEST = 10
#: Bits that a key sets, and bits of a signature for each key, before rounding up to a power of two.
HASHES, BITS_PER_KEY = 3, 10
#: Documents of a block, and bits of its slices where documents are long; 8 documents at least.
BLOCK_DOCS, BLOCK_BITS = 512, 1 << 24
#: Cells of the table of items by terms that a pass takes; an item with more terms is taken alone.
TABLE_CELLS = 1 << 21
#: Share by which a sum of doubles may be off.
SLACK = 1e-9

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD_BYTES = _FOLD.tobytes()
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_LEVEL_STEP = 0xD6E8FEB86659FD93

def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, A-Z lower-cased."""
    return _TERM.findall((text or "").encode().translate(_FOLD_BYTES))


@dataclass
class Spans:
    """Terms of the rows of a piece: bytes, where terms begin and end, their hashes and the row of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def term_spans(data: np.ndarray, bounds: np.ndarray) -> Spans:
    inside = _IN_TERM[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    rows = np.searchsorted(bounds, starts, side="right") - 1
    return Spans(data, starts, ends, hash_spans(data, starts, ends, fold=True), rows)


def slots(keys: np.ndarray, width: int) -> np.ndarray:
    """The bits of each key, one row per key."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return ((keys[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def level_keys(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix(hashes + np.uint64((level + 1) * _LEVEL_STEP % (1 << 64)))


def _signature_keys(spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each term of a row and each level that its count reaches, ordered by row."""
    order = np.lexsort((spans.hashes, spans.rows))
    rows, hashes = spans.rows[order], spans.hashes[order]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.r_[at, len(rows)])
    rows, hashes = rows[at], hashes[at]
    out_rows, out_keys, level = [], [], 0
    while len(rows):
        out_rows.append(rows)
        out_keys.append(level_keys(hashes, level))
        level += 1
        more = counts >= 1 << level
        rows, hashes, counts = rows[more], hashes[more], counts[more]
    if not out_rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    rows, keys = np.concatenate(out_rows), np.concatenate(out_keys)
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order]


def width_for(keys: int) -> int:
    return 1 << max(6, (BITS_PER_KEY * keys - 1).bit_length())


class _Block:
    """Slices of the documents of one width, filled document by document."""

    def __init__(self, width: int):
        self.width = width
        self.room = min(BLOCK_DOCS, max(8, BLOCK_BITS // width))
        self.slices = np.zeros((width, self.room >> 3), dtype=np.uint8)
        self.counts: list[int] = []
        self.names: list[int] = []

    def add(self, keys: np.ndarray, count: int, name: int) -> None:
        doc = len(self.names)
        self.slices[slots(keys, self.width).ravel(), doc >> 3] |= np.uint8(1 << (doc & 7))
        self.counts.append(count)
        self.names.append(name)

    def row(self) -> pa.RecordBatch:
        used = np.ascontiguousarray(self.slices[:, : (len(self.names) + 7) >> 3])
        values = (self.width, len(self.names), sum(self.counts), self.counts, self.names, used.tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _INDEX, strict=True)], schema=_INDEX)


_INDEX = pa.schema([
    ("width", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("counts", pa.list_(pa.int64())), ("names", pa.list_(pa.int64())), ("slices", pa.binary()),
])
_INDEX_SQL = "width long, n_docs long, n_terms long, counts array<long>, names array<long>, slices binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Block] = {}
    for batch in batches:
        names = batch.column(0).to_pylist()
        for first, last, data, bounds in text_pieces(batch.column(1)):
            spans = term_spans(data, bounds)
            rows, keys = _signature_keys(spans)
            counts = np.bincount(spans.rows, minlength=last - first).tolist()
            ends = np.searchsorted(rows, np.arange(last - first + 1)).tolist()
            for r, (begin, end) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if begin == end:
                    continue
                width = width_for(end - begin)
                block = blocks.setdefault(width, None) or _Block(width)
                blocks[width] = block
                block.add(keys[begin:end], counts[r], names[first + r])
                if len(block.names) == block.room:
                    yield blocks.pop(width).row()
    for block in blocks.values():
        yield block.row()


def _named(docs: DataFrame) -> DataFrame:
    """``name, text, doc_id``; the name is a hash of the text."""
    text = F.col("text").cast("string")
    return docs.select(F.xxhash64(text).alias("name"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"))


def signatures(docs: DataFrame) -> DataFrame:
    """Blocks of bit-sliced signatures of every whole text with a term, to be kept as a table.

    ``width`` slices of ``n_docs`` documents; ``counts`` are the documents' terms with repeats,
    ``n_terms`` their sum, ``names`` the hashes of their texts.
    """
    return _named(docs).select("name", "text").mapInArrow(_sign, _INDEX_SQL)


class Items:
    """Terms of some items, their weights and how often each item has them."""

    def __init__(self, terms: list[Counter]):
        self.terms = sorted(set().union(*terms))
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.table = np.zeros((len(terms), len(self.terms)), dtype=np.int64)
        for i, own in enumerate(terms):
            for term, n in own.items():
                self.table[i, self.number[term]] = n
        lengths = np.array([len(t) for t in self.terms])
        self.bytes = np.frombuffer(b"".join(self.terms), dtype=np.uint8)
        self.begins = np.cumsum(lengths) - lengths
        self.lengths = lengths
        self.hashes = hash_spans(self.bytes, self.begins, self.begins + lengths, fold=True)
        self.by_hash = np.argsort(self.hashes, kind="stable")
        self.sorted_hashes = self.hashes[self.by_hash]
        self.same_hash = int(np.unique(self.hashes, return_counts=True)[1].max())

    def found(self, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
        """Spans that are one of the terms, and which; found by hash, compared byte by byte."""
        left = np.searchsorted(self.sorted_hashes, spans.hashes)
        out_spans, out_terms = [], []
        for step in range(self.same_hash):
            at = np.minimum(left + step, len(self.terms) - 1)
            span = np.flatnonzero(self.sorted_hashes[at] == spans.hashes)
            term = self.by_hash[at[span]]
            same = spans.ends[span] - spans.starts[span] == self.lengths[term]
            span, term = span[same], term[same]
            alike = np.ones(len(span), dtype=bool)
            rest, byte = np.arange(len(span)), 0
            while len(rest):
                alike[rest] &= _FOLD[spans.data[spans.starts[span[rest]] + byte]] == self.bytes[self.begins[term[rest]] + byte]
                byte += 1
                rest = rest[self.lengths[term[rest]] > byte]
            out_spans.append(span[alike])
            out_terms.append(term[alike])
        return np.concatenate(out_spans), np.concatenate(out_terms)

    def weigh(self, frequencies: dict[int, int], n_docs: int) -> None:
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequencies.get(i, 0) + 1))) for i in range(len(self.terms))]
        self.weighted = self.table * np.array(weights, dtype=np.int64)


def length_factor(counts: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """The divisor's part that grows with a document's length; Python's integers, as the product may have over 64 bits."""
    return np.array([100 - 75 + 75 * n * n_docs // n_terms for n in counts], dtype=np.int64)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def upper_bounds(items: Items, block: dict, n_docs: int, n_terms: int) -> np.ndarray:
    """An upper bound of each item's score of each document of a block, one row per item."""
    docs, width = block["n_docs"], block["width"]
    slices = np.frombuffer(block["slices"], dtype=np.uint8).reshape(width, -1)
    counts = np.array(block["counts"], dtype=np.int64)
    m = length_factor(block["counts"], n_docs, n_terms)
    sums = np.zeros((len(items.terms), docs))
    rows, present = np.arange(len(items.terms)), None
    before = np.zeros(docs)
    level = 0
    while len(rows):
        bits = np.bitwise_and.reduce(slices[slots(level_keys(items.hashes[rows], level), width)], axis=1)
        present = bits if present is None else present & bits
        some = present.any(axis=1)
        rows, present = rows[some], present[some]
        # A document that reaches this level but not the next has fewer than the next one's count.
        now = gain(np.minimum((2 << level) - 1, counts), m).astype(float)
        sums[rows] += np.unpackbits(present, axis=1, count=docs, bitorder="little") * (now - before)
        before = now
        level += 1
        if (1 << level) > counts.max():
            break
    return items.weighted.astype(float) @ sums


def _best_bounds(items: Items, n_docs: int, n_terms: int):
    """For each task and item the documents with the highest bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, names = np.zeros((len(items.table), 0)), np.zeros((len(items.table), 0), dtype=np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                found = upper_bounds(items, block, n_docs, n_terms)
                bounds = np.concatenate([bounds, found], axis=1)
                names = np.concatenate([names, np.broadcast_to(np.array(block["names"], dtype=np.int64), found.shape)], axis=1)
                if bounds.shape[1] > BEST:
                    best = np.argpartition(-bounds, BEST - 1, axis=1)[:, :BEST]
                    bounds, names = np.take_along_axis(bounds, best, 1), np.take_along_axis(names, best, 1)
        item, place = np.nonzero(bounds > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(names[item, place]), pa.array(bounds[item, place])], ["item", "name", "bound"])

    return run


def _not_excluded(items: Items, n_docs: int, n_terms: int, least: np.ndarray):
    """Names of the documents whose bound for some item reaches that item's ``least`` score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                found = upper_bounds(items, block, n_docs, n_terms)
                open_ = ((found > 0) & (found * (1 + SLACK) >= least[:, None] - 0.5)).any(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.array(block["names"], dtype=np.int64)[open_]), pa.int64())], ["name"])

    return run


def _frequencies(items: Items):
    """Number of a task's documents that hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(items.terms), dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in text_pieces(batch.column(0)):
                spans = term_spans(data, bounds)
                span, term = items.found(spans)
                pairs = np.unique(spans.rows[span] * len(items.terms) + term)
                counts += np.bincount(pairs % len(items.terms), minlength=len(items.terms))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], ["term", "n"])

    return run


def _scores(items: Items, n_docs: int, n_terms: int):
    """For each task and item the documents with the highest exact scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in items.table]
        for batch in batches:
            for text, doc_id in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                terms = terms_of(text.as_py())
                counts = Counter(map(items.number.get, terms))
                counts.pop(None, None)
                if not counts:
                    continue
                term, tf = np.array(list(counts)), np.array(list(counts.values()), dtype=np.int64)
                scores = items.weighted[:, term] @ gain(tf, length_factor([len(terms)], n_docs, n_terms))
                for item in np.flatnonzero(scores > 0).tolist():
                    # Highest score first, then ids, null last.
                    own = best[item]
                    row = (-int(scores[item]), doc_id is None, doc_id or 0)
                    if len(own) < BEST or row < own[-1]:
                        own.append(row)
                        own.sort()
                        del own[BEST:]
        rows = [(item, None if nameless else doc_id, -score) for item, own in enumerate(best) for score, nameless, doc_id in own]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return run


def _ranks(rows: DataFrame, *order) -> DataFrame:
    """Rows with a place among the ``BEST`` of their item; each task's rows are cut to so many before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= BEST)


def _best(docs: DataFrame, names: DataFrame, items: Items, n_docs: int, n_terms: int) -> DataFrame:
    """``item, doc_id, score, rank`` by exact scores of the documents with one of ``names``.

    Names are met by a table of bits of fixed size; a document that passes by chance is scored too.
    """
    _, near = split_by_ids(_named(docs), "name", names)
    found = near.select("text", "doc_id").mapInArrow(_scores(items, n_docs, n_terms), "item int, doc_id long, score long")
    return _ranks(found, F.desc("score"), F.asc_nulls_last("doc_id"))


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list[Counter]]]:
    """Ids and terms of the items with terms, in blocks of bounded tables; items come to the driver one by one."""
    ids, terms, distinct = [], [], set()
    for row in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        own = Counter(terms_of(row[1]))
        if not own:
            continue
        if ids and (len(ids) + 1) * len(distinct | own.keys()) > TABLE_CELLS:
            yield ids, terms
            ids, terms, distinct = [], [], set()
        ids.append(row[0])
        terms.append(own)
        distinct |= own.keys()
    if ids:
        yield ids, terms


def ranked(docs: DataFrame, items: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's best documents.

    ``index`` is what ``signatures`` gives for the same documents, made here if it is not given.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    index = checkpointed(signatures(docs)) if index is None else index
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    results = []
    for ids, terms in _item_blocks(items) if sums[0] else ():
        block = Items(terms)
        counts = _named(docs).select("text").mapInArrow(_frequencies(block), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
        block.weigh({r.term: r.n for r in counts.collect()}, sums[0])  # bounded by the block's terms
        likely = index.mapInArrow(_best_bounds(block, *sums), "item int, name long, bound double")
        seeds = checkpointed(_ranks(likely, F.desc("bound"), "name").select("name"))
        least = np.ones(len(ids))
        for row in _best(docs, seeds, block, *sums).filter(F.col("rank") == BEST).select("item", "score").collect():  # one per item
            least[row.item] = row.score
        names = checkpointed(index.mapInArrow(_not_excluded(block, *sums, least), "name long").distinct())
        found = checkpointed(_best(docs, names, block, *sums))
        item_ids = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind.simpleString()}")
        results.append(found.join(item_ids, "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)
