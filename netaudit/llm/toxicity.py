"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and the context of each hit.

Terms and stems are learned from labelled texts: words whose contexts are far more often toxic.
A text's words are looked up; a word that is no term is run, as a Levenshtein automaton, against
the trie of terms, so that misspelt terms are caught. Each hit is scored by the words around it,
quoted or reported hits apart from plain ones, and a logistic model weighs what was counted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from netaudit.llm.common import checkpointed, only_ids
from netaudit.llm.logistic import fit_logistic, sigmoid

#: Labelled rows used, those with the smallest hashes of their ids; size of the fitted lexicon: terms and stems with the highest
#: log-odds, innocent words seen most. Each task holds it; without these bounds an executor needs over 3000 MB for 20,000 rows.
SAMPLE_ROWS, MOST_TERMS, MOST_INNOCENT = 20_000, 4_000, 20_000
#: Different words before a term that are needed in toxic texts, so that copies count once, and the least log-odds.
LEAST_CONTEXTS, LEAST_ODDS = 5, 2.5
STEM_LENGTHS, STEM_NOISE = (4, 5, 6, 7), 0.1
#: Terms from so many letters on are also found misspelt, with one edit, from LONG on with two.
FUZZY, LONG = 5, 10
CONTEXT_WORDS = 5
REMEMBERED = 300_000
WORD = re.compile(r"\w+(?:[*@$]\w+)*")
QUOTES = "\"'“”„«»‘’`"
# Words that report speech, in the four languages of the corpus.
REPORTING = frozenset(
    "said says say quote quoted quotes called calls wrote writes word words term phrase "
    "sagte sagt nannte schrieb wort zitat dit disait écrit mot citation dijo dice escribió palabra cita".split()
)


class LexiconTrie:
    """Terms that allow one number of edits, as a trie, met by the Levenshtein automaton of a word."""

    def __init__(self, terms: list[str], edits: int):
        self.root: dict = {}
        self.edits = edits
        #: Parts of terms by place and length: with ``edits`` edits one of ``edits + 1`` parts stays whole.
        self.parts: dict[tuple[int, int, bool], set[str]] = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            cuts = [len(term) * i // (edits + 1) for i in range(edits + 2)]
            for first, last in zip(cuts, cuts[1:], strict=False):
                at_end = last == len(term)
                self.parts.setdefault((last - first if at_end else first, last - first, at_end), set()).add(term[first:last])
        self.lengths = range(min(map(len, terms), default=1) - edits, max(map(len, terms), default=0) + edits + 1)

    def may(self, word: str) -> bool:
        """Whether some part of a term stands where it could; false only if no term is near."""
        if len(word) not in self.lengths:
            return False
        for (place, size, at_end), parts in self.parts.items():
            if at_end:
                if word[len(word) - size :] in parts:
                    return True
            elif place == 0:
                if word[:size] in parts:
                    return True
            elif any(word[i : i + size] in parts for i in range(max(0, place - self.edits), place + self.edits + 1)):
                return True
        return False

    def nearest(self, word: str) -> str | None:
        """The closest term within the edits, the first in order of letters among equals."""
        if not self.may(word):
            return None
        n, found = len(word), None
        # States of the automaton are (letters of the word read, edits made); each walks the trie.
        stack = [(self.root, 0, 0)]
        while stack:
            node, i, made = stack.pop()
            for letter, child in node.items() if made < self.edits else ():
                if letter:
                    stack.append((child, i, made + 1))
                    if i < n and letter != word[i]:
                        stack.append((child, i + 1, made + 1))
            if i < n:
                if made < self.edits:
                    stack.append((node, i + 1, made + 1))
                if (child := node.get(word[i])) is not None:
                    stack.append((child, i + 1, made))
            elif "" in node and (found is None or (made, node[""]) < found):
                found = (made, node[""])
        return found[1] if found else None


@dataclass
class Lexicon:
    """Log-odds of terms and stems, words that are never misspelt terms, and the model's weights."""

    terms: dict[str, float]
    stems: dict[str, float]
    innocent: set[str] = field(default_factory=set)
    weights: list[float] = field(default_factory=list)


class Scorer:
    """Counts of one text; remembers what it found out about words."""

    names = ("plain", "quoted", "stem", "fuzzy", "odds", "best", "share", "kinds")

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.tries = [LexiconTrie([t for t in lexicon.terms if FUZZY <= len(t) < LONG], 1), LexiconTrie([t for t in lexicon.terms if len(t) >= LONG], 2)]
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[str, float, str]] = {}

    def look(self, word: str) -> tuple[str, float, str] | None:
        odds = self.lexicon.terms.get(word)
        if odds is not None:
            return "plain", odds, word
        for n in STEM_LENGTHS:
            odds = self.lexicon.stems.get(word[:n]) if len(word) >= n else None
            if odds is not None:
                return "stem", odds, word[:n]
        if word not in self.lexicon.innocent:
            for trie in self.tries:
                if (term := trie.nearest(word)) is not None:
                    return "fuzzy", self.lexicon.terms[term], term
        return None

    def count(self, text: str | None) -> tuple[list[float], list[str]]:
        """Features of a text, and its words taken as misspelt."""
        text = (text or "").lower()
        words = WORD.findall(text)
        distinct = set(words)
        for word in distinct - self.seen:
            if (hit := self.look(word)) is not None:
                self.hits[word] = hit
        self.seen |= distinct
        found = {w for w in self.hits if w in distinct} if len(self.hits) < len(distinct) else {w for w in distinct if w in self.hits}
        counts = dict.fromkeys(self.names, 0.0)
        misspelt, kinds = [], set()
        if found:
            matches = list(WORD.finditer(text))
            for i, match in enumerate(matches):
                if match[0] not in found:
                    continue
                kind, odds, term = self.hits[match[0]]
                around = words[max(0, i - CONTEXT_WORDS) : i] + words[i + 1 : i + 1 + CONTEXT_WORDS]
                quoted = text[max(0, match.start() - 1) : match.start()] in QUOTES and match.start() > 0 or not REPORTING.isdisjoint(around)
                counts["quoted" if quoted else kind] += 1
                if kind == "fuzzy":
                    misspelt.append(match[0])
                if not quoted:
                    counts["odds"] += odds
                counts["best"] = max(counts["best"], odds * (0.5 if quoted else 1.0))
                kinds.add(term)
            counts["share"] = 100.0 * sum(counts[k] for k in ("plain", "quoted", "stem", "fuzzy")) / max(1, len(words))
            counts["kinds"] = float(len(kinds))
        if len(self.seen) > REMEMBERED:  # only spares repeated work
            self.seen.clear()
            self.hits.clear()
        return [math.log1p(counts[n]) if n != "best" else counts[n] for n in self.names], misspelt


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id's digits is a multiple of five; such rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and the word before each, per text."""
    for batch in batches:
        pairs: set = set()
        for value in batch.column(0):
            words = WORD.findall((value.as_py() or "").lower())
            pairs.update(zip(words, ["", *words], strict=False))
        yield pa.RecordBatch.from_pydict({"word": [w for w, _ in pairs], "before": [p for _, p in pairs]}, schema=pa.schema([("word", pa.string()), ("before", pa.string())]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts of each batch that have each word and stem."""
    for batch in batches:
        counts: dict = {}
        for value, toxic in zip(batch.column(0), batch.column(1), strict=True):
            own = set(WORD.findall((value.as_py() or "").lower()))
            for key in {(w, False) for w in own} | {(w[:n], True) for w in own for n in STEM_LENGTHS if len(w) >= n}:
                counts.setdefault(key, [0, 0])[toxic.as_py() != 1] += 1
        yield pa.RecordBatch.from_pydict(
            {"term": [t for t, _ in counts], "stem": [x for _, x in counts], "toxic": [n for n, _ in counts.values()], "other": [n for _, n in counts.values()]},
            schema=pa.schema([("term", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("other", pa.int64())]),
        )


def _by_term(pairs: DataFrame) -> DataFrame:
    """``term, stem, contexts``: different words before each word, and before words of each stem."""
    names = [F.struct(F.col("word").alias("term"), F.lit(False).alias("stem"))]
    names += [F.when(F.length("word") >= n, F.struct(F.substring("word", 1, n).alias("term"), F.lit(True).alias("stem"))) for n in STEM_LENGTHS]
    rows = pairs.select("before", F.explode(F.array(*names)).alias("t")).filter("t is not null").select("t.term", "t.stem", "before").distinct()
    return rows.groupBy("term", "stem").agg(F.count("*").alias("contexts"))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """Lexicon and model from at most ``sample_rows`` labelled rows outside the held-out fold.

    Rows without id or label are left out; a repeated id counts once, with its first text and as toxic if it ever is.
    Without both labels every score is 0.5's side of the only label seen.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = checkpointed(known.orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    rows = checkpointed(only_ids(docs, "doc_id", known.select("id")).groupBy("doc_id").agg(F.min("text").alias("text")).join(known, F.col("doc_id") == F.col("id")).select("text", "toxic"))
    pairs = rows.filter("toxic = 1").select("text").mapInArrow(_contexts, "word string, before string")
    contexts = _by_term(pairs).filter(F.col("contexts") >= LEAST_CONTEXTS)
    sizes = {r.toxic: r["count"] for r in rows.groupBy(F.col("toxic") == 1).count().toDF("toxic", "count").collect()}
    counted = rows.select("text", "toxic").mapInArrow(_frequencies, "term string, stem boolean, toxic long, other long")
    found = counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).join(contexts, ["term", "stem"])
    held = F.least("toxic", "contexts")
    odds = F.log((held + 0.5) / (sizes.get(True, 0) + 1)) - F.log((F.col("other") + 0.5) / (sizes.get(False, 0) + 1))
    # A stem stands for many words, so it must hardly ever be innocent.
    passed = found.select("term", "stem", odds.alias("odds"), (F.col("other") / F.greatest(F.lit(1), held)).alias("against"))
    passed = passed.filter((F.col("odds") >= LEAST_ODDS) & (~F.col("stem") | (F.col("against") <= STEM_NOISE)))
    best = [(-r.odds, (r.term, r.stem)) for r in passed.orderBy(F.desc("odds"), "term", "stem").limit(MOST_TERMS).collect()]  # bounded
    lexicon = Lexicon({t: -o for o, (t, stem) in best if not stem}, {t: -o for o, (t, stem) in best if stem})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            made = [scorer.count(v.as_py()) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([m[0] for m in made], pa.list_(pa.float64())), pa.array([m[1] for m in made], pa.list_(pa.string()))], ["toxic", "x", "misspelt"])

    seen = checkpointed(rows.mapInArrow(features, "toxic int, x array<double>, misspelt array<string>"))
    often = seen.filter("toxic <> 1").select(F.explode(F.array_distinct("misspelt")).alias("word")).groupBy("word").count().filter("count >= 2")
    lexicon.innocent = {r.word for r in often.orderBy(F.desc("count"), "word").limit(MOST_INNOCENT).collect()}  # bounded
    if lexicon.innocent:
        seen = checkpointed(rows.mapInArrow(features, "toxic int, x array<double>, misspelt array<string>"))
    sample = seen.select("x", "toxic").collect()  # at most sample_rows
    x = np.array([r.x for r in sample], dtype=float).reshape(-1, len(Scorer.names))
    lexicon.weights = fit_logistic(x, np.array([r.toxic == 1 for r in sample], dtype=float)).tolist()
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score`` of every whole text; null and empty texts are scored as texts without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, weights = Scorer(lexicon), np.array(lexicon.weights)
        for batch in batches:
            x = np.array([scorer.count(v.as_py())[0] for v in batch.column(1)], dtype=float).reshape(-1, len(Scorer.names))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(weights[0] + x @ weights[1:]))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``, which may repeat or lack ids.

    Only the texts make a score; a row without id is not held out. Other columns are not read.
    """
    rows = scored(docs, learn(docs, labels, sample_rows))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
