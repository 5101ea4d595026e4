"""Quality by co-training: a text view and a metadata view label rows for each other.

The text view sees counts of a text's characters and words, the metadata view only language,
source and length. In each round the rows of an unlabelled pool that one view is sure of go to
the other with that label. At the end each view is calibrated on rows kept apart, and a small
model weighs the two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from netaudit.llm.common import checkpointed, spare, without_ids
from netaudit.llm.logistic import fit_logistic, sigmoid
from netaudit.llm.words import words_of

#: Labelled rows and rows of the unlabelled pool, those with the smallest hashes of their ids.
SAMPLE_ROWS, POOL_ROWS = 20_000, 20_000
ROUNDS, SURE, PER_ROUND = 4, 0.95, 2_000
#: One in so many labelled rows is kept apart for calibration; so many of these must bear out what a view is sure of.
APART, WITNESSES = 5, 20
#: Columns that languages and sources are hashed to, each.
META_CELLS = 32
KEEP = 0.5
# Characters that prose has few of.
MARKS = b"#$%&*@^~|<>{}[]\\=_+/"


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(chars)] = 1
    return out


CLASSES = {
    "marks": _flags(MARKS), "pipes": _flags(b"|"), "bangs": _flags(b"!?"), "upper": _flags(bytes(range(65, 91))),
    "lower": _flags(bytes(range(97, 123))), "digits": _flags(b"0123456789"), "stops": _flags(b".,;:"), "lines": _flags(b"\n"),
    "wide": _flags(bytes(range(128, 256))),
}
TEXT_VIEW = (*CLASSES, "repeats", "distinct", "word_length", "longest", "log_words")


def text_features(w) -> np.ndarray:
    """One row of features per text of a piece; all 0 for a text without words."""
    rows = w.last - w.first
    first, end = w.offsets[:-1], w.offsets[1:]
    words = np.maximum(end - first, 1)
    lengths = w.ends - w.starts
    row_of = w.row_of_word()
    chars = np.bincount(row_of, weights=lengths, minlength=rows)
    out = np.zeros((rows, len(TEXT_VIEW)))
    # From the first to the last word of each text; white space between counts as nothing but lines.
    filled = end > first
    begin = np.where(filled, w.starts[np.minimum(first, max(len(w.starts) - 1, 0))] if len(w.starts) else 0, 0)
    stop = np.where(filled, w.ends[np.maximum(end - 1, 0)] if len(w.ends) else 0, 0)
    for i, flags in enumerate(CLASSES.values()):
        sums = np.zeros(len(w.data) + 1, dtype=np.int64)
        np.cumsum(flags[w.data], out=sums[1:])
        out[:, i] = np.log1p(50 * (sums[stop] - sums[begin]) / np.maximum(chars, 1))
    n = len(CLASSES)
    if len(w.hashes):
        same = np.r_[False, (w.hashes[1:] == w.hashes[:-1]) & (row_of[1:] == row_of[:-1])]
        out[:, n] = np.log1p(50 * np.bincount(row_of, weights=same, minlength=rows) / words)
        order = np.lexsort((w.hashes, row_of))
        fresh = np.r_[True, (w.hashes[order][1:] != w.hashes[order][:-1]) | (row_of[order][1:] != row_of[order][:-1])]
        out[:, n + 1] = np.bincount(row_of[order], weights=fresh, minlength=rows) / np.sqrt(words)
        out[:, n + 2] = chars / words / 10
        longest = np.zeros(rows)
        np.maximum.at(longest, row_of, lengths)
        out[:, n + 3] = np.log1p(longest) / 5
    out[:, n + 4] = np.log1p(end - first) / 10
    return out


#: Columns that are read; what a row is scored by is all in them.
READ = [("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long")]


def row_name() -> Column:
    """A hash of all that is read of a row, so that rows of one name have one score."""
    return F.xxhash64(*[F.col(name).cast(kind) for name, kind in READ])


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (text view), the metadata ``lang, source, n_chars`` and the name of every row with its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_features(w) for w in words_of(batch.column(1), fold=False)]
            x = np.concatenate(made) if made else np.zeros((0, len(TEXT_VIEW)))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(TEXT_VIEW))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel())), *(batch.column(i) for i in (2, 3, 4, 5))], ["doc_id", "x", "lang", "source", "n_chars", "row"]
            )

    read = [F.col(name).cast(kind).alias(name) for name, kind in READ]
    return docs.select(*read, row_name().alias("row")).mapInArrow(run, "doc_id long, x array<double>, lang string, source string, n_chars long, row long")


def with_meta(rows: DataFrame) -> DataFrame:
    """Cells of language and source, and the length on a log scale; nulls have cells of their own."""
    def cell(c):
        return F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit("\0none"))), F.lit(META_CELLS)).cast("int")

    return rows.withColumns({"lang_cell": cell("lang"), "source_cell": cell("source"), "log_chars": F.log1p(F.greatest(F.coalesce("n_chars", F.lit(0)), F.lit(0)).cast("double")) / 10})


def meta_matrix(lang: np.ndarray, source: np.ndarray, log_chars: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lang), 2 * META_CELLS + 2))
    at = np.arange(len(lang))
    out[at, lang] = 1
    out[at, META_CELLS + source] = 1
    out[:, -2], out[:, -1] = log_chars, log_chars**2
    return out


@dataclass
class View:
    """A logistic model of one view, and the line that calibrates its log-odds."""

    centre: np.ndarray
    spread: np.ndarray
    beta: np.ndarray
    line: tuple[float, float] = (0.0, 1.0)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.beta[0] + ((x - self.centre) / self.spread) @ self.beta[1:]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.line[0] + self.line[1] * np.clip(self.logit(x), -15, 15)


def fit_view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
    centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    spread = x.std(axis=0) if len(x) else np.ones(x.shape[1])
    spread = np.where(spread > 1e-9, spread, 1.0)
    return View(centre, spread, fit_logistic((x - centre) / spread, y, weight, ridge=0.05))


@dataclass
class Model:
    text: View
    meta: View
    mix: np.ndarray

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return sigmoid(self.mix[0] + self.mix[1] * self.text.calibrated(text) + self.mix[2] * self.meta.calibrated(meta))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, apart: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> Model:
    """Train on the rows not kept ``apart``, exchange sure labels of the pool, calibrate on the rows apart."""
    views, pool = [text, meta], [pool_text, pool_meta]
    learn = ~apart
    given = [[(v[learn], y[learn], np.ones(learn.sum()))] for v in views]
    free = np.ones(len(pool_text), dtype=bool)
    fitted = []
    for turn in range(ROUNDS + 1):
        fitted = [fit_view(*(np.concatenate(part) for part in zip(*rows, strict=True))) for rows in given]
        if turn == ROUNDS or not free.any():
            break
        left = np.flatnonzero(free)
        for own in (0, 1):
            p = sigmoid(fitted[own].logit(pool[own][left]))
            borne_out = sigmoid(fitted[own].logit(views[own][apart]))
            sure = np.zeros(len(p), dtype=bool)
            for label in (0, 1):  # a view that is sure without being right teaches nothing
                told = (borne_out if label else 1 - borne_out) >= SURE
                if told.sum() >= WITNESSES and (y[apart][told] == label).mean() >= SURE:
                    sure |= (p if label else 1 - p) >= SURE
            order = np.argsort(-np.abs(p - 0.5), kind="stable")
            chosen = left[order[sure[order]][:PER_ROUND]]
            if len(chosen):
                label = (sigmoid(fitted[own].logit(pool[own][chosen])) >= 0.5).astype(float)
                given[1 - own].append((pool[1 - own][chosen], label, np.full(len(chosen), 0.5)))
                free[chosen] = False
    for view, x in zip(fitted, views, strict=True):
        view.line = tuple(fit_logistic(np.clip(view.logit(x[apart]), -15, 15)[:, None], y[apart], ridge=0.01))
    both = np.column_stack([v.calibrated(x[apart]) for v, x in zip(fitted, views, strict=True)])
    return Model(*fitted, fit_logistic(both, y[apart], ridge=0.01))


def _sample(rows: DataFrame) -> tuple:
    found = rows.select("x", "lang_cell", "source_cell", "log_chars", *[c for c in ("id", "quality") if c in rows.columns]).collect()  # bounded by its caller
    x = np.array([r.x for r in found], dtype=float).reshape(-1, len(TEXT_VIEW))
    meta = meta_matrix(np.array([r.lang_cell for r in found], dtype=int), np.array([r.source_cell for r in found], dtype=int), np.array([r.log_chars for r in found], dtype=float))
    return found, x, meta


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, pool_rows: int = POOL_ROWS) -> DataFrame:
    """``doc_id, score, text_score, meta_score, keep`` for each row of ``docs``.

    ``score`` is the probability of quality 1. Learns from at most ``sample_rows`` labelled and
    ``pool_rows`` other rows; labels without id or value are left out, a repeated id counts once,
    as good only if it always is. Without labels every score is 0.5, and rows are kept. Null and
    empty texts are scored as texts without words; ids may be null or repeated.
    """
    return scored(docs, labels, sample_rows, pool_rows).drop("row")


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int, pool_rows: int) -> DataFrame:
    """The columns of :func:`quality` and the name of each row."""
    spark = docs.sparkSession
    rows = checkpointed(with_meta(features(docs)))
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min((F.col("quality") == 1).cast("int")).alias("quality"))
    chosen = checkpointed(known.orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    labelled, text, meta = _sample(rows.join(chosen, F.col("doc_id") == F.col("id")).orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    others = rows.filter("doc_id is not null").join(known.select("id"), F.col("doc_id") == F.col("id"), "left_anti")
    _, pool_text, pool_meta = _sample(others.orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool_rows))
    y = np.array([r.quality for r in labelled], dtype=float)
    apart = np.arange(len(y)) % APART == 0  # the order is that of a hash
    model = spark.sparkContext.broadcast(co_train(text, meta, y, apart, pool_text, pool_meta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, len(TEXT_VIEW))
            m = meta_matrix(*(np.array(batch.column(i)) for i in (2, 3, 4)))
            scores = [own.score(x, m), sigmoid(own.text.calibrated(x)), sigmoid(own.meta.calibrated(m))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores), batch.column(5)], ["doc_id", "score", "text_score", "meta_score", "row"])

    out = rows.select("doc_id", "x", "lang_cell", "source_cell", "log_chars", "row").mapInArrow(run, "doc_id long, score double, text_score double, meta_score double, row long")
    return out.withColumn("keep", F.col("score") >= KEEP)


def good_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, pool_rows: int = POOL_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, each judged by itself, whatever id it has or shares."""
    bad = scored(docs, labels, sample_rows, pool_rows).filter(~F.col("keep")).select("row").distinct()
    name = spare(docs, "_row")
    return without_ids(docs.withColumn(name, row_name()), name, checkpointed(bad)).drop(name)
