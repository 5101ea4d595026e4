"""Which of many patterns match which of many texts, without comparing all pairs.

A pattern is read into tokens and checked against the grammar below. Its groups are opened where
that is exact, alternatives become rows of their own, and what is left between tokens that match
more than one text are literals that every match must hold. Of these a piece of up to sixteen
characters is chosen, the one that the fewest texts hold; texts and patterns meet in an equi-join
on hashes of pieces, and the pattern itself decides. Everything is a Spark expression on distinct patterns.

Grammar: characters, ``.``, classes without nested classes, ``^ $ \\b \\B``, groups (capturing,
``?:``, named, atomic, with the flags ``i s m``), lookaheads, alternatives, back references,
``\\d \\w \\s \\h \\v \\x \\u \\p`` escapes, and the quantifiers ``* + ? {n} {n,} {n,m}``, lazy or
possessive too. Keys outside of it are no patterns; callers take them as plain text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Depth of groups that is read; deeper ones are no patterns.
DEPTH = 12
#: Groups of alternatives that become rows, one after the other, and alternatives of such a group. Others are gaps.
OPENED, ALTERNATIVES = 3, 8
#: Lengths of the pieces that texts and patterns meet by. Shorter literals than the third are offered only where a pattern has no longer one.
SIZES = (1, 2, 3, 4, 6, 8, 12, 16)
PIECE = SIZES[2]

# Characters of the private use area that stand for parts of a pattern. A pattern's own are gaps.
GAP, BEGIN, END, LOOK = "\ue000", "\ue001", "\ue002", "\ue003"
META, KEPT = "()|*+?{}^$[]\\.", "".join(chr(0xE010 + i) for i in range(14))
_PRIVATE = "[\ue000-\ue02f]"

_ESCAPED = r"\\(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|[pP]\{(?:L[ultmo]?|M[nce]?|N[dlo]?|P[cdseifo]?|S[mcko]?|Z[slp]?)\}|[dDwWsShHvVtnrf]|[^A-Za-z0-9])"
_IN_CLASS = r"[^\[\]\\&-]"
_CLASS = rf"\[\^?+-?(?:{_IN_CLASS}-{_IN_CLASS}|{_ESCAPED}|{_IN_CLASS}|&(?!&))+-?\]"
_OPEN = r"\((?:\?(?:[:>]|<[A-Za-z][A-Za-z0-9]*>|[ism]+:))?"
_LOOK = r"\(\?[=!]"
_FLAGS = r"\(\?[ism]+\)"
_TIMES = r"(?:[*+?]|\{[0-9]{1,3}(?:,[0-9]{0,3})?\})[?+]?"
_TOKEN = rf"{_ESCAPED}|\\[1-9bB]|{_CLASS}|{_FLAGS}|{_LOOK}|{_OPEN}|{_TIMES}|[\s\S]"


def _is(token: Column, pattern: str) -> Column:
    return token.rlike(f"^(?:{pattern})$")


def _kind(token: Column) -> Column:
    """``a`` atom, ``q`` quantifier, ``o`` and ``c`` group, ``l`` lookahead, ``b`` bar, ``z`` no width, ``x`` no token."""
    low = F.regexp_extract(token, "^\\{([0-9]+)", 1).try_cast("int")
    high = F.regexp_extract(token, ",([0-9]+)\\}", 1).try_cast("int")
    spans = F.regexp_extract_all(F.regexp_replace(token, _ESCAPED, ""), F.lit(f"{_IN_CLASS}-{_IN_CLASS}"), 0)
    ordered = F.forall(spans, lambda s: F.substring(s, 1, 1) <= F.substring(s, 3, 1))
    return (
        F.when(_is(token, _TIMES), F.when(F.coalesce(low > high, F.lit(False)), "x").otherwise("q"))
        .when(_is(token, _FLAGS) | token.isin("^", "$", "\\b", "\\B"), "z")
        .when(_is(token, _LOOK), "l").when(_is(token, _OPEN), "o").when(token == ")", "c").when(token == "|", "b")
        .when(_is(token, _CLASS), F.when(ordered, "a").otherwise("x"))
        .when(token.isin("[", "\\", "{"), "x")
        .otherwise("a")
    )


def _well_formed(tokens: Column) -> Column:
    kinds = F.concat_ws("", F.transform(tokens, _kind))
    loose = kinds.rlike("^q|[qzobl]q|x")
    for _ in range(DEPTH):
        kinds = F.regexp_replace(F.regexp_replace(kinds, "o[azbq]*c", "a"), "l[azbq]*c", "z")
    return ~loose & ~kinds.rlike("[ocl]|zq")


def _sign(token: Column, lines: Column) -> Column:
    """What stands for a token: a character itself, or a part of the pattern."""
    escaped = F.translate(F.substring(token, 2, 1), META, KEPT)
    return (
        F.when(token.rlike(_PRIVATE), GAP)
        .when(token == "^", F.when(lines, GAP).otherwise(BEGIN)).when(token == "$", F.when(lines, GAP).otherwise(END))
        .when(_is(token, _FLAGS), "").when(_is(token, _LOOK), LOOK).when(_is(token, _OPEN), "(")
        .when(_is(token, _TIMES), F.when(token.rlike("^(?:[*?]|\\{0+[,}])"), "*").otherwise("+"))
        .when(_is(token, "\\\\[^A-Za-z0-9]"), escaped)
        .when((F.length(token) > 1) | (token == "."), GAP)
        .otherwise(F.translate(token, "]}", KEPT[META.index("]")] + KEPT[META.index("}")]))
    )


def _replaced(signs: Column, *rules: tuple[str, str]) -> Column:
    return reduce(lambda now, rule: F.regexp_replace(now, *rule), rules, signs)


_INSIDE = f"[^(){LOOK}]"
_PLAIN = f"[^()|{LOOK}]"
#: What groups may become, inside out: nothing that must be held, or their own content.
_GROUPS = [
    (f"{LOOK}{_INSIDE}*\\)", GAP),
    (f"\\({_INSIDE}*\\)\\*", GAP),
    (f"\\(({_PLAIN}*)\\)\\+", f"{GAP}$1{GAP}"),
    (f"\\(({_PLAIN}*)\\)(?![*+])", "$1"),
    # One of the alternatives follows at once on what stands before.
    (f"(\\({_INSIDE}*\\|{_INSIDE}*\\))\\+", f"$1{GAP}"),
]
_CHARACTERS = [(f"[^()|{LOOK}]\\*", GAP), (f"([^()|{LOOK}])\\+", f"$1{GAP}$1")]
_OPENABLE = f"\\(({_INSIDE}*\\|{_INSIDE}*)\\)(?![*+])"


def _opened(signs: Column) -> Column:
    """Versions of a pattern, one for each alternative of its first innermost group."""
    group = F.regexp_extract(signs, _OPENABLE, 1)
    parts = F.split(signs, _OPENABLE, 2)
    ways = F.split(group, "\\|", -1)
    joined = F.transform(ways, lambda way: F.concat(F.get(parts, F.lit(0)), way, F.get(parts, F.lit(1))))
    gap = F.array(F.concat(F.get(parts, F.lit(0)), F.lit(GAP), F.get(parts, F.lit(1))))
    return F.when(group == "", F.array(signs)).when(F.size(ways) <= ALTERNATIVES, joined).otherwise(gap)


def _folded(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text: Column, size: Column) -> Column:
    """Hashes of the pieces of one size. Two pieces of one hash make texts and patterns meet that need not, no more."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.substring(text, i, size))))


def _size_of(literal: Column) -> Column:
    """Largest size of a piece that is not longer than a literal."""
    return F.array_max(F.filter(F.array(*map(F.lit, SIZES)), lambda size: size <= F.length(literal)))


def split_keys(keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Keys that are patterns of the grammar, and the others."""
    tokens = F.regexp_extract_all(F.col(key), F.lit(_TOKEN), 0)
    marked = keys.withColumn("_well_formed", _well_formed(tokens))
    return marked.filter("_well_formed").drop("_well_formed"), marked.filter("not _well_formed").drop("_well_formed")


def literals(patterns: DataFrame, pattern: str) -> DataFrame:
    """``pattern, way, literals``: for each way to match a pattern, texts that every match of this way holds.

    Patterns must be of the grammar. Texts are held in lower case between ``BEGIN`` and ``END``;
    a way without literals may match any text.
    """
    tokens = F.regexp_extract_all(F.col(pattern), F.lit(_TOKEN), 0)
    lines = F.exists(tokens, lambda t: t.rlike("^\\(\\?[is]*m"))
    signs = F.concat_ws("", F.transform(tokens, lambda t: _sign(t, lines)))
    signs = _replaced(signs, *_CHARACTERS, *_GROUPS * DEPTH)
    rows = patterns.select(F.col(pattern).alias("pattern"), signs.alias("signs"))
    for _ in range(OPENED):
        rows = rows.select("pattern", F.explode(_opened(F.col("signs"))).alias("signs"))
        rows = rows.withColumn("signs", _replaced(F.col("signs"), *_GROUPS))
    rows = rows.withColumn("signs", _replaced(F.col("signs"), *[(_OPENABLE, GAP), *_GROUPS] * DEPTH))
    ways = rows.select("pattern", F.explode(F.split("signs", "\\|", -1)).alias("signs"))
    # Nothing is sure of what stands before a begin or, as a line end may follow the match, behind an end.
    ways = ways.withColumn("signs", _replaced(F.col("signs"), (BEGIN, GAP + BEGIN), (END, END + GAP)))
    kept = F.filter(F.split("signs", GAP), lambda run: F.length(F.translate(run, BEGIN + END, "")) > 0)
    texts = F.transform(kept, lambda run: _folded(F.translate(run, KEPT, META)))
    return ways.select("pattern", texts.alias("literals")).distinct().select("pattern", F.xxhash64("literals").alias("way"), "literals")


#: Stands for the piece of a pattern that holds no literal, and is in every text.
ANY = 0


def _text_pieces(texts: DataFrame, text: str, sizes: DataFrame) -> DataFrame:
    """``text, piece``: the pieces of each text of the sizes that occur; that of size 0 is ``ANY``."""
    whole = _folded(F.col(text))
    line_end = "(?:\\r\\n|[\\n\\r\\u0085\\u2028\\u2029])$"
    versions = F.array_distinct(F.array(whole, F.regexp_replace(whole, line_end, "")))
    all_sizes = F.array(F.lit(0), *map(F.lit, SIZES))
    spread = texts.select(text, F.explode(all_sizes).alias("size")).join(F.broadcast(sizes), "size", "left_semi")
    held = F.flatten(F.transform(versions, lambda v: pieces_of(F.concat(F.lit(BEGIN), v, F.lit(END)), F.col("size"))))
    found = F.when(F.col("size") == 0, F.array(F.lit(ANY).cast("bigint"))).otherwise(F.array_distinct(held))
    return spread.select(text, F.explode(found).alias("piece"))


def pattern_pairs(
    texts: DataFrame, text: str, patterns: DataFrame, pattern: str, join: Callable[[DataFrame, DataFrame, str, list[str]], DataFrame]
) -> DataFrame:
    """``text, pattern`` for every distinct text and every pattern of the grammar that is found in it.

    ``join(rows, lookup, key, spread_by)`` is an inner join that may spread the rows of a hot key.
    """
    ways = literals(patterns.select(pattern).distinct(), pattern)
    longest = F.coalesce(F.array_max(F.transform("literals", F.length)), F.lit(0))
    # A mark alone is in every text.
    own = F.filter("literals", lambda l: (F.length(l) >= F.least(longest, F.lit(PIECE))) & ~l.isin(BEGIN, END))
    sized = ways.withColumn("literal", F.explode_outer(own)).withColumn("size", F.coalesce(_size_of(F.col("literal")), F.lit(0)))
    useful = F.when(F.col("size") == 0, F.array(F.lit(ANY).cast("bigint"))).otherwise(pieces_of(F.col("literal"), F.col("size")))
    offered = sized.select("pattern", "way", "size", F.explode(useful).alias("piece"))
    probes = texts.filter(F.col(text).isNotNull()).select(text).distinct()
    counts = _text_pieces(probes, text, offered.select("size").distinct()).groupBy("piece").agg(F.count("*").alias("texts"))
    # A way whose piece no text holds matches none. Spark's size check does not see how many pieces a text has.
    rarest = offered.join(counts.hint("merge"), "piece", "left").groupBy("pattern", "way").agg(
        F.min_by(F.struct("piece", "size"), F.struct(F.coalesce("texts", F.lit(0)), "piece")).alias("rarest")
    ).select("pattern", "rarest.piece", "rarest.size")
    held = _text_pieces(probes, text, rarest.select("size").distinct())
    met = join(held, rarest.select("pattern", "piece").distinct(), "piece", [text])
    return met.filter(F.expr(f"`{text}` rlike `pattern`")).select(text, "pattern").distinct()
