"""Removal of repeated passages with sharded Aho-Corasick automata over words.

1. Every window of 50 words has one phrase of 25 words with the smallest hash; a passage that two
   documents share has the same phrase in both. Phrases of more than one document recur.
2. The recurring phrases, as sequences of word numbers, are compiled to Aho-Corasick automata.
   A shard holds the phrases whose first owner falls into it, and the documents that have one of
   them are streamed through it, so that each document visits few shards. A shard with many
   documents is dealt to several tasks, each with the whole automaton.
3. Windows around the occurrences are compared: those that a document with a smaller id has as
   well are removed. Tasks settle what they see and only what is left of divided shards meets again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from netaudit.llm.common import checkpointed, only_ids
from netaudit.llm.words import row_windows, window_hashes, words_of

#: Words of a window, and of a phrase.
WINDOW, PHRASE = 50, 25
#: Phrases of a shard, and phrases that the documents of a task have, about; both set the size of a task, not what is found.
SHARD_PHRASES, TASK_PHRASES = 4000, 50_000
NOTHING = hashlib.sha256(b"").hexdigest()


def plain_digest(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _profiles(window: int, phrase: int):
    """Words, digest and phrases of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, anchors, ends = [], [], [], [0]
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            for w in words_of(batch.column(1), fold=False):
                counts.append(np.diff(w.offsets))
                digests += [plain_digest(texts[r].as_py()) for r in range(w.first, w.last)]
                if len(w.hashes) < window:
                    ends += [ends[-1]] * (w.last - w.first)
                    continue
                least = sliding_least(window_hashes(w.hashes, phrase), window - phrase + 1)
                begins, rows = row_windows(w, window)
                least = least[begins]
                limits = np.searchsorted(rows, np.arange(w.last - w.first + 1))
                for r in range(w.last - w.first):
                    own = np.unique(least[limits[r] : limits[r + 1]])
                    anchors.append(own)
                    ends.append(ends[-1] + len(own))
            values = np.concatenate(anchors) if anchors else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))],
                ["doc_id", "n_words", "digest", "phrases"],
            )

    return run


def _letters(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _phrase_words(phrase: int):
    """The words of an owner's recurring phrases, as letters one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            wanted = batch.column(2)
            for w in words_of(batch.column(1), fold=False):
                grams, letters = window_hashes(w.hashes, phrase), _letters(w.hashes)
                for r in range(w.last - w.first):
                    begin, end = w.offsets[r], w.offsets[r + 1]
                    own = grams[begin : max(begin, end - phrase + 1)]
                    values, places = np.unique(own, return_index=True)
                    hit = np.isin(values, np.array(wanted[w.first + r].as_py(), dtype=np.int64).view(np.uint64))
                    at = places[hit] + begin
                    out.append(letters[at[:, None] + np.arange(phrase)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["owner", "payload"])

    return run


def _located(window: int, phrase: int):
    """Stream the documents of each shard, which follow its phrases, through its automaton."""
    def settle(docs: list, divided: bool) -> Iterator[pa.RecordBatch]:
        """Windows that a smaller id of this task has are removed; of divided shards the others stay open."""
        sizes = [len(d[2]) for d in docs]
        hashes = np.concatenate([d[2] for d in docs])
        owners = np.repeat(np.array([d[0] for d in docs], dtype=np.int64), sizes)
        rows = np.repeat(np.arange(len(docs)), sizes)
        order = np.lexsort((owners, hashes))
        begins = np.r_[True, hashes[order][1:] != hashes[order][:-1]] if len(order) else np.zeros(0, bool)
        least = owners[order][np.flatnonzero(begins)][np.cumsum(begins) - 1] if len(order) else owners
        gone = np.zeros(len(hashes), dtype=bool)
        gone[order] = owners[order] > least
        limits = np.searchsorted(rows, np.arange(len(docs) + 1))
        out = {"doc_id": [], "digest": [], "removed": [], "open_hash": [], "open_at": []}
        for r, (doc_id, digest, own, places) in enumerate(docs):
            lost = gone[limits[r] : limits[r + 1]]
            kept = ~lost if divided else np.zeros(len(own), dtype=bool)
            if lost.any() or kept.any():
                for name, value in zip(out, (doc_id, digest, places[lost], own[kept].view(np.int64), places[kept]), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("doc_id", pa.int64()), ("digest", pa.string()), ("removed", pa.list_(pa.int32())), ("open_hash", pa.list_(pa.int64())), ("open_at", pa.list_(pa.int32()))
        ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, machine, docs, divided = None, None, [], False
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for r in range(batch.num_rows):
                here = (columns[0][r].as_py(), columns[1][r].as_py())
                if here != shard:
                    if docs:
                        yield from settle(docs, divided)
                    shard, docs, divided = here, [], columns[2][r].as_py() > 1
                    machine, ready = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE), False
                payload = columns[5][r].as_buffer()
                if columns[3][r].as_py() == 0:
                    for words in np.frombuffer(payload, dtype=np.uint32).reshape(-1, phrase).tolist():
                        machine.add_word(tuple(words), 1)
                    continue
                if not ready:
                    machine.make_automaton()
                    ready = True
                text = pa.array([payload.to_pybytes()], pa.binary()).cast(pa.string())
                for w in words_of(text, fold=False):
                    n = len(w.hashes)
                    if n < window:
                        continue
                    ends = np.fromiter((e for e, _ in machine.iter(tuple(_letters(w.hashes).tolist()))), dtype=np.int64)
                    marks = np.zeros(n + 1, dtype=np.int64)
                    last = n - window
                    np.add.at(marks, np.clip(ends - window + 1, 0, last + 1), 1)
                    np.add.at(marks, np.minimum(ends - phrase + 1, last) + 1, -1)
                    places = np.flatnonzero(np.cumsum(marks)[: last + 1] > 0)
                    if len(places):
                        docs.append((columns[4][r].as_py(), plain_digest(payload.to_pybytes()), window_hashes(w.hashes, window)[places], places.astype(np.int32)))
        if docs:
            yield from settle(docs, divided)

    return run


def passage_starts(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> tuple[DataFrame, DataFrame]:
    """Profiles of all documents, and where the windows to remove begin.

    Returns ``doc_id, n_words, digest, copy`` for each row (``copy``: the whole text is that of a
    smaller id and at least one window long) and ``doc_id, digest, starts`` (lists of word
    numbers) for the documents that lose a part.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    profiles = checkpointed(docs.mapInArrow(_profiles(window, phrase), "doc_id long, n_words long, digest string, phrases array<long>"))
    firsts = profiles.filter(F.col("n_words") >= window).groupBy("digest").agg(F.min("doc_id").alias("first"))
    known = profiles.join(firsts, "digest", "left")
    whole = known.select("doc_id", "n_words", "digest", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy"))
    anchors = checkpointed(known.filter("doc_id = first").select("doc_id", "phrases").distinct())
    occurs = anchors.select("doc_id", F.explode("phrases").alias("phrase"))
    recurring = checkpointed(
        occurs.groupBy("phrase").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last").drop("last")
    )
    shards = max(1, -(-recurring.count() // SHARD_PHRASES))

    def shard(owner):
        return F.pmod(F.xxhash64(owner), F.lit(shards)).cast("int")

    routes = checkpointed(occurs.join(recurring, "phrase").groupBy("doc_id", shard("owner").alias("shard")).agg(F.count("*").alias("phrases")))
    load = routes.groupBy("shard").agg(F.ceil(F.sum("phrases") / TASK_PHRASES).cast("int").alias("parts"))
    load = checkpointed(load)

    texts = checkpointed(only_ids(docs, "doc_id", routes.select("doc_id")).distinct())
    owned = recurring.groupBy("owner").agg(F.collect_list("phrase").alias("phrases"))  # at most one document's
    phrases = texts.join(owned, F.col("doc_id") == F.col("owner")).select("owner", "text", "phrases").mapInArrow(_phrase_words(phrase), "owner long, payload binary")
    compiled = phrases.withColumn("shard", shard("owner")).join(load, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts", F.lit(0).alias("kind"), F.col("owner").alias("doc_id"), "payload"
    )
    streamed = texts.join(routes.select("doc_id", "shard"), "doc_id").join(load, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"), "parts", F.lit(1).alias("kind"), "doc_id", F.encode("text", "UTF-8").alias("payload")
    )
    dealt = compiled.unionByName(streamed).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind", "doc_id")
    found = checkpointed(dealt.mapInArrow(
        _located(window, phrase), "doc_id long, digest string, removed array<int>, open_hash array<long>, open_at array<int>"
    ))

    opened = found.select("doc_id", "digest", F.explode(F.arrays_zip("open_hash", "open_at")).alias("w")).select("doc_id", "digest", "w.open_hash", "w.open_at")
    settled = opened.groupBy("open_hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).filter("least < last")
    later = opened.join(settled, "open_hash").filter("doc_id > least").groupBy("doc_id", "digest").agg(F.collect_list("open_at").alias("removed"))
    starts = found.select("doc_id", "digest", "removed").filter(F.size("removed") > 0).unionByName(later)
    return whole, starts.groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("removed")).alias("starts"))  # at most one document's


def _kept(window: int):
    """What is left of each text, as words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, counts, texts = [], [], [], []
            for doc_id, text, digest, starts in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = text.as_buffer().to_pybytes().split()
                if hashlib.sha256(b" ".join(words)).hexdigest() != digest.as_py():
                    continue  # another text under the same id
                marks = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.array(starts.values)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                gone = np.cumsum(marks)[:-1] > 0
                ids.append(doc_id.as_py())
                digests.append(digest.as_py())
                counts.append(int(gone.sum()))
                texts.append(b" ".join(w for w, lost in zip(words, gone.tolist(), strict=True) if not lost).decode())
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "digest": digests, "n_removed": counts, "kept": texts}, schema=pa.schema(
                [("doc_id", pa.int64()), ("digest", pa.string()), ("n_removed", pa.int64()), ("kept", pa.string())]
            ))

    return run


def shortened(docs: DataFrame, starts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, digest, n_removed, kept`` of the documents that lose a part."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = only_ids(docs, "doc_id", starts.select("doc_id")).distinct()
    return texts.join(starts, "doc_id").select("doc_id", "text", "digest", "starts").mapInArrow(_kept(window), "doc_id long, digest string, n_removed long, kept string")


def passage_digests(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs``.

    A null text has no words. Rows with one id never remove each other's words, and each row is
    judged by its own text. A row without id keeps all words and removes none elsewhere. An empty
    table gives an empty one; other columns of ``docs`` are not read.
    """
    whole, starts = passage_starts(docs, window, phrase)
    cut = shortened(docs, checkpointed(starts), window).select("doc_id", "digest", F.col("n_removed").alias("cut"), F.sha2("kept", 256).alias("rest"))
    return whole.join(cut, ["doc_id", "digest"], "left").select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(NOTHING)).otherwise(F.coalesce("rest", "digest")).alias("kept_sha256"),
    )
