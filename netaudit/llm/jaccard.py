"""Jaccard join of word shingles: size-aware, with subsets for light sets and lists for heavy ones.

Equal sets meet first, as one class. A light class (few shingles) is put under every subset it
must share with a partner of each size; classes under one subset are linked with certainty. A
heavy class is put into the inverted lists of its rarest shingles, as many as a partner cannot
miss; classes of one list are candidates, and their whole texts are compared. Where light ends
is chosen by cost from the sizes present.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from netaudit.llm.common import bit_table, checkpointed, components, in_bit_table, only_ids, small_batches, spare, split_by_ids
from netaudit.llm.words import mix, shingle_sets, words_of

#: Cells that shingle counts are added up in to order shingles, whatever the data: 1 MB.
CELL_BITS = 17
#: Bits of the table of lists with more than one class, by which other entries are left out before the shuffle: 4 MB.
LIST_BITS = 25
#: Sets above this size are always heavy; bounds the subsets of one set.
LARGEST_LIGHT = 16
#: Bits of the signatures that pairs are compared by before their texts are: in the lists, and pair by pair.
MARK_BITS, SIGNATURE_BITS = 1024, 4096
#: Cost of one entry of an inverted list against one subset: it is shuffled twice, and hits are compared as texts.
LIST_COST = 8


def least_overlap(n: int, m: int, percent: int) -> int:
    """Shingles that sets of ``n`` and ``m`` share at least when they link."""
    return -(-percent * (n + m) // (100 + percent))


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets_of(n: int, light: int, percent: int) -> int:
    return sum(comb(n, least_overlap(n, m, percent)) for m in partner_sizes(n, percent) if m <= light)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def light_boundary(sizes: dict[int, int], percent: int) -> int:
    """Size up to which subsets are cheaper, for counts by size (sizes to ``LARGEST_LIGHT / percent``)."""
    def cost(light: int) -> int:
        few = sum(c * subsets_of(n, light, percent) for n, c in sizes.items() if n <= light)
        lowest = -(-percent * (light + 1) // 100)
        return few + LIST_COST * sum(c * prefix_length(n, percent) for n, c in sizes.items() if n >= lowest)

    return min(range(LARGEST_LIGHT + 1), key=cost)


def set_key(shingles: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    digest = mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([digest], dtype=np.uint64)).view(np.int64)[0])


def signature(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the shingles per bit: two signatures differ in no more bits than their sets in shingles."""
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for w in words_of(batch.column(1), fold=True) for s in shingle_sets(w, k)]
            made = [pa.array([signature(s, bits) for s in sets], pa.list_(pa.int64())) for bits in (MARK_BITS, SIGNATURE_BITS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int32()), *made], ["key", "n", "mark", "signature"])

    return run


def _of_class(k: int):
    """Rows whose text has the key they are joined with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [set_key(s) for w in words_of(batch.column(1), fold=True) for s in shingle_sets(w, k)]
            yield batch.filter(pa.array(np.array(own, dtype=np.int64) == np.array(batch.column(0))))

    return run


def _may_link(a: Column, b: Column, n: Column, m: Column, bits: int, percent: int) -> Column:
    """Sizes and signatures allow the link; exact, as it never refuses one."""
    apart = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(bits // 64)), F.lit(0))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))


def _classes(k: int):
    """Size and key of each document, and at the task's end its counts of shingles by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, dtype=np.int64)

        def rows(ids, sizes, keys, cells, amounts):
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), pa.array(cells, pa.int32()), pa.array(amounts, pa.int64())],
                ["doc_id", "n", "key", "cell", "amount"],
            )

        for batch in batches:
            sizes, keys = [], []
            for w in words_of(batch.column(1), fold=True):
                sets = list(shingle_sets(w, k))
                sizes += [len(s) for s in sets]
                keys += [set_key(s) for s in sets]
                cells = (np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                counts += np.bincount(cells, minlength=len(counts))
            yield rows(batch.column(0), sizes, keys, [None] * len(sizes), [None] * len(sizes))
        used = np.flatnonzero(counts)
        yield rows(pa.nulls(len(used), pa.int64()), [None] * len(used), [None] * len(used), used, counts[used])

    return run


def _entries(k: int, percent: int, light: int, cells, shared=None):
    """Subsets of light sets and list entries of heavy sets; equal sets of one task give theirs once.

    With a bit table ``shared`` of names, entries under other names are left out.
    """
    lowest = -(-percent * (light + 1) // 100)

    def subsets(s: np.ndarray, key: int, out: list) -> None:
        n, mixed = len(s), mix(s)
        for m in partner_sizes(n, percent):
            if m > light:
                break
            c = least_overlap(n, m, percent)
            if c > n:
                continue
            low, high = min(n, m), max(n, m)
            chosen = np.array([[i for i in range(n) if i not in left] for left in map(set, combinations(range(n), n - c))])
            named = mix(mixed[chosen].sum(axis=1, dtype=np.uint64) + np.uint64((low << 40) | (high << 20) | c))
            out.append((named, key, n, n == low, n == high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, table = cells.value, None if shared is None else shared.value
        seen = set()
        for batch in batches:
            names, keys, sizes, lows, highs, is_list = [], [], [], [], [], []

            def put(named, key, n, low, high, listed):
                if table is not None:
                    named = named[in_bit_table(table, named)]
                names.append(named)
                for column, value in ((keys, key), (sizes, n), (lows, low), (highs, high), (is_list, listed)):
                    column.append(np.full(len(named), value))

            for w in words_of(batch.column(0), fold=True):
                for s in shingle_sets(w, k):
                    n = len(s)
                    if not n:
                        continue
                    key = set_key(s)
                    if key in seen:
                        continue
                    seen.add(key)
                    if n <= light:
                        found = []
                        subsets(s, key, found)
                        for named, key, n, low, high in found:
                            put(named, key, n, low, high, False)
                    if n >= lowest:
                        rank = (counts[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(32)) | (s >> np.uint64(32))
                        put(s[np.argsort(rank, kind="stable")[: prefix_length(n, percent)]], key, n, True, True, True)
            if len(seen) > 1_000_000:  # only spares repeated work
                seen.clear()
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(names).view(np.int64))]
                    + [pa.array(np.concatenate(x).astype(t)) for x, t in ((keys, np.int64), (sizes, np.int32), (lows, bool), (highs, bool), (is_list, bool))],
                    ["name", "key", "n", "low", "high", "listed"],
                )

    return run


def _links(k: int, percent: int):
    """Pairs whose whole texts link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [(s for w in words_of(batch.column(c), fold=True) for s in shingle_sets(w, k)) for c in ("text_a", "text_b")]
            linked = []
            for a, b in zip(*sides, strict=True):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(bool(len(a)) and 100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _compared(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` of keys that link; ``texts``: key, doc_id, text of one document of each class in ``pairs``."""
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_links(k, percent), "a long, b long")


def shingle_links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Classes of equal shingle sets, and links between them.

    ``docs`` needs ``doc_id`` and ``text``. Returns ``doc_id, n, key`` per row, and ``a, b`` of
    class keys whose links connect what all links of at least ``percent`` would: between members
    of one component some links are left out, none between different components.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    both = checkpointed(docs.mapInArrow(_classes(k), "doc_id long, n int, key long, cell int, amount long"))
    classes = both.filter("cell is null").select("doc_id", "n", "key")
    counts = np.zeros(1 << CELL_BITS, dtype=np.int64)
    found = both.filter("cell is not null").groupBy("cell").agg(F.sum("amount").alias("amount")).toArrow()  # bounded by the cells
    counts[np.array(found["cell"])] = np.array(found["amount"])
    cells = spark.sparkContext.broadcast(np.minimum(counts, 2**32 - 1))
    keys = both.filter("n > 0").groupBy("key").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"))
    bound = 100 * LARGEST_LIGHT // percent + 1
    sizes = {r.n: r["count"] for r in keys.filter(F.col("n") <= bound).groupBy("n").count().collect()}  # bounded by the sizes
    light = light_boundary(sizes, percent)

    kinds = "name long, key long, n int, low boolean, high boolean, listed boolean"
    named = docs.filter("doc_id is not null").select("text")
    entries = named.mapInArrow(_entries(k, percent, light, cells), kinds)
    lists = entries.groupBy("name", "listed").agg(
        F.min("key").alias("lead"), F.min_by("n", "key").alias("lead_n"), F.max("key").alias("last"),
        F.min(F.when(F.col("low"), F.col("key"))).alias("least_low"), F.min(F.when(F.col("high"), F.col("key"))).alias("least_high"),
    ).filter("lead != last").drop("last")
    lists = checkpointed(lists)
    shared = spark.sparkContext.broadcast(bit_table(lists.select("name"), LIST_BITS))
    entries = named.mapInArrow(_entries(k, percent, light, cells, shared), kinds)
    met = checkpointed(entries.join(lists, ["name", "listed"]))

    # All pairs of a low and a high class under one subset link; one partner for each connects them.
    sure = met.filter("not listed").select("key", F.explode(F.array(F.when(F.col("low"), F.col("least_high")), F.when(F.col("high"), F.col("least_low")))).alias("partner"))
    sure = sure.filter("key != partner").select(F.greatest("key", "partner").alias("a"), F.least("key", "partner").alias("b")).distinct()

    listed = met.filter("listed").select("name", "key", "n", "lead", "lead_n")
    needed = checkpointed(listed.select("key").distinct().join(keys.select("key", F.col("doc_id").alias("rep")), "key"))
    # Rows that only share the id of a class have another key.
    texts = only_ids(docs, "doc_id", needed.select("rep")).join(needed, F.col("doc_id") == F.col("rep"))
    texts = checkpointed(texts.select("doc_id", "key", "text").distinct().select("key", "text").mapInArrow(_of_class(k), "key long, text string"))
    signatures = checkpointed(texts.mapInArrow(_signatures(k), "key long, n int, mark array<long>, signature array<long>"))

    def likely(pairs: DataFrame) -> DataFrame:
        a = signatures.select(F.col("key").alias("a"), "n", F.col("signature").alias("sign_a"))
        b = signatures.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("signature").alias("sign_b"))
        return pairs.join(a, "a").join(b, "b").filter(_may_link(F.col("sign_a"), F.col("sign_b"), F.col("n"), F.col("m"), SIGNATURE_BITS, percent)).select("a", "b")

    # Sets whose sizes are too far apart cannot link, whatever they hold.
    alike = 100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n")
    to_lead = checkpointed(likely(listed.filter("key != lead").filter(alike).select(F.col("key").alias("a"), F.col("lead").alias("b")).distinct()))
    near = checkpointed(_compared(to_lead, texts, k, percent).unionByName(sure))

    # What is connected by now needs no more comparisons; the rest of each list is compared whole.
    known = components(near)
    placed = checkpointed(
        listed.join(known, listed.key == known.node, "left").select("name", "key", F.coalesce("component", "key").alias("part")).distinct()
    )
    parts = placed.groupBy("name", "part").agg(F.count("*").alias("members")).groupBy("name").agg(
        F.max_by("part", F.struct("members", "part")).alias("top"), F.count("*").alias("parts")
    ).filter("parts > 1").drop("parts")
    mixed = placed.join(parts, "name").join(signatures.select("key", "n", "mark"), "key")
    left = mixed.filter("part != top").select("name", F.col("key").alias("a"), "n", F.col("mark").alias("mark_a"), F.col("part").alias("part_a"))
    right = mixed.select(F.col("name").alias("other"), F.col("key").alias("b"), F.col("n").alias("m"), F.col("mark").alias("mark_b"), F.col("part").alias("part_b"), "top")
    fits = _may_link(F.col("mark_a"), F.col("mark_b"), F.col("n"), F.col("m"), MARK_BITS, percent)
    rest = (
        left.join(right, (F.col("name") == F.col("other")) & F.expr("part_a != part_b and (part_b = top or a < b)") & fits)
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        .join(to_lead, ["a", "b"], "left_anti")
    )
    far = checkpointed(_compared(likely(rest), texts, k, percent))
    return classes, near.unionByName(far)


def shingle_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    Null and empty texts have no shingles and link with nothing. Repeated rows and equal texts
    link. A row without id only joins the component of an equal set; without one its component
    is null. An empty table gives an empty one; other columns of ``docs`` are not read.
    """
    with small_batches(docs.sparkSession):
        classes, links = shingle_links(docs, k, percent)
    linked = components(links)
    whole = classes.join(linked, classes.key == linked.node, "left").select("doc_id", "n", F.coalesce("component", "key").alias("part"))
    whole = checkpointed(whole)
    least = whole.filter("n > 0").groupBy("part").agg(F.min("doc_id").alias("least"))
    found = whole.filter("n > 0").join(least, "part").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("least").alias("component_id"))
    return found.unionByName(whole.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` with the smallest id of their component, once each; rows without words stay.

    Rows without id, and rows that share an id but not their text, are told apart by an id made of
    the text, which stands behind all others. Rows alike in id and text count as one.
    """
    text, name = F.col("text").cast("string"), spare(docs, "_id")
    made = F.lit(1 << 62) + F.pmod(F.xxhash64(text, F.col("doc_id").cast("long")), F.lit(1 << 61))
    ids = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("of")).filter("id is not null")
    mixed = checkpointed(ids.groupBy("id").agg(F.min("of").alias("least"), F.max("of").alias("most")).filter("least <> most").select("id"))
    own = docs.withColumn(name, F.col("doc_id").cast("long"))
    plain, near = split_by_ids(own, name, mixed)
    flag = spare(own, "_mixed")
    marked = near.join(mixed.select(F.col("id").alias(flag)), F.col(name) == F.col(flag), "left").withColumn(name, F.when(F.col(flag).isNull(), F.col(name))).drop(flag)
    named = plain.unionByName(marked).withColumn(name, F.coalesce(name, made))

    found = checkpointed(shingle_components(named.select(F.col(name).alias("doc_id"), text.alias("text")), k, percent))
    dropped = checkpointed(found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("kept")).filter("rows > 1 or not kept"))
    # Most rows have an id of their own and stay where they are.
    sure, near = split_by_ids(named, name, dropped.select("doc_id"))
    gone = dropped.filter("not kept").select(F.col("doc_id").alias(flag))
    rest = near.join(gone, F.col(name) == F.col(flag), "left_anti").dropDuplicates([name])
    return sure.unionByName(rest).select(*docs.columns)
