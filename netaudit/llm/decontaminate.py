"""Benchmark decontamination by templates: typed placeholders, joined windows, consistent slots.

A text becomes a template: punctuation goes, letters are folded, numbers, names and units after
numbers become placeholders that keep what they stand for as a slot. Windows of five template
tokens of documents and items meet in a hash join. An item is in a text when the text has enough
of its windows in occurrences whose slots agree: an item's value always stands against the same
value of the text. Equal slots make a verbatim copy, others a re-parameterised one. Windows also
meet as literals, letters folded and nothing replaced, so a copy in other capitals is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from netaudit.llm.common import bit_table, checkpointed, in_bit_table, spare, split_by_ids
from netaudit.llm.words import SPACE, hash_spans, mix, split_words, text_pieces, window_hashes

WINDOW, LEAST_LITERALS, LEAST_SHARE = 5, 3, 0.8
#: Shifts between text and item, in tokens, that may belong to one occurrence.
BAND = 16
#: Literals that a template without a window needs to be one window as a whole.
LEAST_WHOLE = 2
#: Forms of windows: of a template, a whole template, literals.
TEMPLATE, WHOLE, LITERAL = 0, 1, 2
LITERAL_SALT = 0x8EBC6AF09C88C6E3
#: Bits of the table that documents' windows are first looked up in, whatever the benchmark's size: 1 MB.
TABLE_BITS = 23
# Units, singular and plural, and their signs.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons second seconds s sec minute minutes min hour hours h day days week weeks month months year years "
    "dollar dollars euro euros cent cents usd eur gbp percent degree degrees celsius fahrenheit kmh mph volt volts watt watts joule joules "
    "meter meters metre metres kilometer kilometers kilometre kilometres"
).split()
PLACEHOLDERS = {"number": 1, "name": 2, "unit": 3}
_ALNUM = np.zeros(256, dtype=bool)
for _from, _to in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _ALNUM[_from:_to] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_LETTER = _ALNUM & ~_DIGIT
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:|\n\"")] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends, _ = split_words(data, np.array([0, len(data)]))
    return hash_spans(data, starts, ends, fold=True)


UNIT_HASHES = np.sort(_word_hashes(UNITS))
_KIND_HASH = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def templates(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: first row, token hashes, kinds (0 literal, else placeholder), values, and offsets of the rows; then all as literals, and offsets of these."""
    for first, last, raw, bounds in text_pieces(texts):
        # Sentence starts are read off the text as it stands, tokens off its letters and digits.
        keep = _ALNUM[raw] | SPACE[raw]
        place = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(keep, out=place[1:])
        data, limits = raw[keep], place[bounds]
        # Capitals of two bytes, those of the Latin alphabets of western Europe, are folded as well.
        wide = np.zeros(len(data) + 1, dtype=bool)
        wide[1:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data = data + 0x20 * wide[:-1].astype(np.uint8)
        digit, letter = _DIGIT[data], _LETTER[data]
        apart = np.zeros(len(data), dtype=bool)
        apart[1:] = letter[1:] & digit[:-1]  # "5kg" is a number and a unit
        starts, ends, offsets = split_words(data, limits, apart)
        n = len(starts)
        hashes = hash_spans(data, starts, ends, fold=True)
        literals, literal_offsets = hashes, offsets
        kinds = np.zeros(n, dtype=np.int64)
        if n:
            rows = np.repeat(np.arange(last - first), np.diff(offsets))
            digits = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(digit, out=digits[1:])
            kinds[digits[ends] - digits[starts] == ends - starts] = 1
            after_number = np.r_[False, (kinds[:-1] == 1) & (rows[1:] == rows[:-1])]
            at = np.minimum(np.searchsorted(UNIT_HASHES, hashes), len(UNIT_HASHES) - 1)
            kinds[(UNIT_HASHES[at] == hashes) & after_number & (kinds == 0)] = 3
            # A name begins with a capital, goes on in small letters and does not begin a sentence.
            size = 1 + wide[starts + 1]
            second = np.minimum(starts + size, len(data) - 1)
            capital = (_UPPER[data[starts]] | wide[starts + 1]) & (ends - starts > size) & _LETTER[data[second]] & ~_UPPER[data[second]] & ~wide[second + 1]
            where = np.flatnonzero(keep)
            stops = np.zeros(len(raw) + 1, dtype=np.int64)
            np.cumsum(_STOP[raw], out=stops[1:])
            before = np.r_[0, ends[:-1] - 1]
            inner = np.r_[False, (rows[1:] == rows[:-1]) & (stops[where[starts[1:]]] == stops[where[before[1:]]])]
            kinds[capital & inner & (kinds == 0)] = 2
            # Names in a row are one name.
            name = kinds == 2
            joined = name & np.r_[False, name[:-1] & (rows[1:] == rows[:-1])]
            group = np.cumsum(~joined) - 1
            values = np.zeros(group[-1] + 1, dtype=np.uint64)
            np.add.at(values, group, hashes)
            offsets = np.r_[0, np.cumsum(np.bincount(rows[~joined], minlength=last - first))]
            kinds, hashes = kinds[~joined], np.where(name[~joined], mix(values), hashes[~joined])
        tokens = np.where(kinds > 0, _KIND_HASH[kinds], hashes)
        yield first, tokens, kinds, hashes, offsets, literals, literal_offsets


def _named(tokens: np.ndarray, k: int, literal: bool) -> np.ndarray:
    """Names of the windows of ``k`` tokens, apart from those of templates if ``literal``."""
    names = window_hashes(tokens, k)
    return mix(names ^ np.uint64(LITERAL_SALT)) if literal else names


def _spans(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and first token of each window of ``k`` tokens inside a row."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(counts.sum()) - (np.cumsum(counts) - counts)[rows] + offsets[:-1][rows]


def _windows(k: int, table, sizes=None):
    """Windows as ``name`` with place and slots, by form; of texts, with ``table``, only those it may have.

    Windows of templates need enough literals. Items without such a window, but with ``k`` tokens
    and LEAST_WHOLE literals, are one window each; items of fewer than ``k`` literals are one as
    literals. Texts have windows of the ``sizes`` that occur, as ``(form, size)``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else table.value
        for batch in batches:
            owners, places, names, slots, forms, lengths = [], [], [], [], [], []

            def add(first, offsets, rows, at, every, form, size, kinds=None, values=None):
                if bits is not None:
                    held = in_bit_table(bits, every[at])
                    rows, at = rows[held], at[held]
                owners.append(rows + first)
                places.append(at - offsets[:-1][rows])
                names.append(every[at])
                slots.extend([] if kinds is None else values[a : a + size][kinds[a : a + size] > 0].view(np.int64).tolist() for a in at.tolist())
                forms.append(np.full(len(at), form))
                lengths.append(np.full(len(at), size))

            for first, tokens, kinds, values, offsets, literals, literal_offsets in templates(batch.column(batch.num_columns - 1)):
                filled = np.zeros(len(tokens) + 1, dtype=np.int64)
                np.cumsum(kinds > 0, out=filled[1:])
                rows, at = _spans(offsets, k)
                good = filled[at + k] - filled[at] <= k - LEAST_LITERALS
                add(first, offsets, rows[good], at[good], _named(tokens, k, False), TEMPLATE, k, kinds, values)
                if sizes is None:
                    count, usable = np.diff(offsets), np.bincount(rows[good], minlength=len(offsets) - 1)
                    whole = np.flatnonzero((count >= k) & (usable == 0) & (count - np.diff(filled[offsets]) >= LEAST_WHOLE))
                    wanted = [(WHOLE, size, whole[count[whole] == size]) for size in np.unique(count[whole]).tolist()]
                    count = np.diff(literal_offsets)
                    wanted += [(LITERAL, size, np.flatnonzero(count == size)) for size in np.unique(count[(count > 0) & (count < k)]).tolist()]
                    wanted.append((LITERAL, k, np.flatnonzero(count >= k)))
                else:
                    wanted = [(form, size, None) for form, size in sizes]
                for form, size, chosen in wanted:
                    source, limits = (tokens, offsets) if form == WHOLE else (literals, literal_offsets)
                    rows, at = _spans(limits, size)
                    if chosen is not None:
                        own = np.isin(rows, chosen)
                        rows, at = rows[own], at[own]
                    add(first, limits, rows, at, _named(source, size, form == LITERAL), form, size, *((kinds, values) if form == WHOLE else ()))
            if not names:
                continue
            owner = pa.array(np.concatenate(owners))
            made = [np.concatenate(places).astype(np.int32), np.concatenate(names).view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).take(owner) for i in range(batch.num_columns - 1)), *map(pa.array, made), pa.array(slots, pa.list_(pa.int64())),
                    *(pa.array(np.concatenate(c).astype(np.int32)) for c in (forms, lengths)),
                ],
                [*batch.schema.names[:-1], "place", "name", "slots", "form", "length"],
            )

    return run


def _key(text: Column) -> Column:
    """128 bits that stand for a whole text; what stands before the text makes the halves differ in all states."""
    return F.struct(F.xxhash64(F.lit("first"), text).alias("h"), F.xxhash64(F.lit("second"), text).alias("g"))


def item_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE) -> DataFrame:
    """``key, item_id, share, kind`` for each text (by its key) and item that it holds.

    ``share`` is the part of the item's different windows that the text has, in the form that it
    has most of. ``kind`` is ``verbatim`` or ``re-parameterised``, the first where only literals
    reach the share. Items without id or without any token match nothing; items of one id are one item.
    """
    spark = docs.sparkSession
    made = "place int, name long, slots array<long>, form int, length int"
    own = items.filter("item_id is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    asked = checkpointed(own.mapInArrow(_windows(window, None), f"item_id long, {made}"))
    sizes = asked.groupBy("item_id", "form").agg(F.countDistinct("name", "length").alias("size"))
    table = spark.sparkContext.broadcast(bit_table(asked.select("name"), TABLE_BITS))
    lengths = sorted((r.form, r.length) for r in asked.filter(F.col("form") != TEMPLATE).select("form", "length").distinct().collect())  # lengths of items

    texts = docs.select(F.col("text").cast("string")).filter("text is not null").select(_key(F.col("text")).alias("key"), "text")
    texts = texts.select("key.h", "key.g", "text")
    seen = texts.mapInArrow(_windows(window, table, lengths), f"h long, g long, {made}")
    met = seen.join(asked.select("item_id", "name", "form", "length", F.col("place").alias("item_place"), F.col("slots").alias("item_slots")), ["name", "form", "length"])
    # Inside one occurrence the shift between text and item changes by no more than the words put in or left out. Bands
    # of shifts overlap by half, so an occurrence lies in one whole; windows of different bands do not add up.
    shift = F.col("place") - F.col("item_place")
    bands = F.array(2 * F.floor(shift / BAND), 2 * F.floor((shift + BAND // 2) / BAND) + 1)
    met = met.select("h", "g", "item_id", "form", "length", "name", F.explode(bands).alias("band"), "slots", "item_slots")
    met = checkpointed(met.distinct())
    occurrence = ["h", "g", "item_id", "form", "band"]
    own_pairs = met.withColumn("p", F.explode(F.arrays_zip("item_slots", "slots")))
    values = own_pairs.groupBy(*occurrence, F.col("p.item_slots").alias("value")).agg(
        F.min("p.slots").alias("least"), F.max("p.slots").alias("most"), F.min((F.col("p.slots") == F.col("p.item_slots")).cast("int")).alias("same")
    )
    states = values.groupBy(*occurrence).agg(F.collect_list(F.when(F.col("least") != F.col("most"), F.col("value"))).alias("torn"), F.min("same").alias("same"))
    # Only windows with a value that stands against several are left out.
    steady = met.join(states, occurrence, "left").filter(~F.coalesce(F.arrays_overlap("item_slots", "torn"), F.lit(False)))
    shares = steady.groupBy(*occurrence).agg(F.countDistinct("name", "length").alias("hits"), F.min(F.coalesce("same", F.lit(1))).alias("same"))
    held = shares.join(sizes, ["item_id", "form"]).withColumn("share", F.col("hits") / F.col("size")).filter(F.col("share") >= least_share)
    best = held.groupBy("h", "g", "item_id").agg(F.max("share").alias("share"), F.min("same").alias("same"))
    return best.select("h", "g", "item_id", "share", F.when(F.col("same") == 1, "verbatim").otherwise("re-parameterised").alias("kind"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id, n_items, item_id, share, kind, contaminated`` for each row of ``docs``.

    ``item_id`` is the item held to the largest share, the smallest id among equals; ``share`` and
    ``kind`` are its. A clean text has 0 items and nulls; null and empty texts are clean. Rows are
    judged by their texts alone, so ids may be null or repeated. Other columns are not read.
    """
    found = item_matches(docs, items, window, least_share).groupBy("h", "g").agg(
        F.count("*").alias("n_items"), F.min_by(F.struct("item_id", "share", "kind"), F.struct(-F.col("share"), "item_id")).alias("best")
    )
    rows = docs.select(F.col("doc_id").cast("long"), _key(F.col("text").cast("string")).alias("key")).select("doc_id", "key.h", "key.g")
    return rows.join(found, ["h", "g"], "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "best.item_id", "best.share", "best.kind", F.col("n_items").isNotNull().alias("contaminated")
    )


def clean_rows(docs: DataFrame, items: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    found = checkpointed(item_matches(docs, items, window, least_share).select("h", "g").distinct())
    key, own = _key(F.col("text").cast("string")), [spare(docs, name) for name in ("_h", "_g")]
    marked = docs.withColumns({own[0]: key["h"], own[1]: key["g"]})
    there = [spare(marked, name) for name in ("_h_found", "_g_found")]
    gone = found.toDF(*there)
    sure, near = split_by_ids(marked, own[0], gone.select(there[0]))
    return sure.unionByName(near.join(gone, (F.col(own[0]) == F.col(there[0])) & (F.col(own[1]) == F.col(there[1])), "left_anti")).select(*docs.columns)
