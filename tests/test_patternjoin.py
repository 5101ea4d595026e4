"""Patterns as keys against Python's patterns over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from netaudit.operators import matchjoin, patternjoin

PATTERNS = [
    "abc", "^ab", "bc$", "^abc$", "a.c", "a|bc", "^(a|b)c", "(ab|ba)c$", "(?:ab){2}", "a{2,3}b", "ab*c", "ab+c", "ab?c", "a*", ".*", "[abc]+", "[^a]b", "[a-c]x[0-9]",
    r"a\.c", r"\bab", r"\d+c", r"c\d{2}$", r"\(a\)", r"a\+b", r"\w+\.c$", "(a(b|c))+x", "((a|b)c)*b", "(a|b)(b|c)(c|a)(a|b)x", "(?=ab)a", "(?!a)bc", "a(?=b|c)c?", "(?i)ABC", "(?i:aB)c",
    "(a|b|c|x|1|2|3|4|5)c", "(?<n>ab)c", "a*?b", "a++b", "(a)bc", r"(a)\1", "x|", "|x", "()a", "ab{0}c", "ab{0,2}c", "a{1}b", r"\x61b", r"[\d]c", r"[\]a]b", "[-a]b", "[a-]b",
    "a]b", "a}b", "(((a)))b", "((a|b)|c)x", "^a|b$", "^(?:a|b)$", "c$", "^", "$", "ca\\$", "[&a]b", "(x?a)?bc", "a(?:b(?:c(?:x)))",
]
BROKEN = ["a(b", "a)b", "[ab", "*a", "a**", "a{2}{3}", "^*", "(?<=a)b", "a{3,2}", "[z-a]", "\\", "a\\", "\\Qa\\E", "[[:alpha:]]", "[a&&b]", "(?x)a b", "(?", "a{", "[]", "[^]", "\\p{Foo}", "\\y"]


def texts_of(rng, n):
    alphabet = "aaabbbcccx1.2+()]}$A-"
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 9))) for _ in range(n)} | {"aabc", "ABC", "aBc", "a&b", "]b", "abcx", "a.c", "(a)", "a+b"})


def generated(rng, depth=0):
    """A random pattern of the grammar that Python reads alike."""
    def atom():
        pick = rng.randrange(10)
        if pick < 5 or depth > 2:
            return "".join(rng.choice("abcx1") for _ in range(rng.randrange(1, 4)))
        if pick == 5:
            return rng.choice([".", "[ab]", "[^c]", r"\d", r"\.", "[a-c1]"])
        return rng.choice(["(", "(?:"]) + generated(rng, depth + 1) + ")"

    ways = []
    for _ in range(rng.choice([1, 1, 1, 2, 3])):
        ways.append("".join(atom() + rng.choice(["", "", "", "*", "+", "?", "{1,2}", "{0,1}", "+?"]) for _ in range(rng.randrange(1, 4))))
    return rng.choice(["", "", "^"] if depth == 0 else [""]) + "|".join(ways) + rng.choice(["", "", "$"] if depth == 0 else [""])


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(11)
    patterns = sorted({*PATTERNS, *(generated(rng) for _ in range(250))})
    return texts_of(rng, 250), patterns


def test_pairs_equal_all_pairs(spark, sides):
    texts, patterns = sides
    t = spark.createDataFrame([(x,) for x in [*texts, *texts[:9], None]], "t string")
    p = spark.createDataFrame([(x,) for x in [*patterns, *patterns[:9]]], "p string")
    good, broken = patternjoin.split_keys(p, "p")
    assert broken.count() == 0
    got = {(r.t, r.pattern) for r in patternjoin.pattern_pairs(t, "t", good, "p", matchjoin.salted_join).collect()}
    want = {(x, q) for q in patterns for x in texts if re.search(q.replace("(?<n>", "(?P<n>"), x)}
    assert got == want and len(want) > 5000


def test_every_match_holds_a_literal_of_some_way(spark, sides):
    """The index, apart from the join: literals are held in lower case between two marks."""
    texts, patterns = sides
    rows = patternjoin.literals(spark.createDataFrame([(x,) for x in patterns], "p string"), "p").collect()
    ways = {}
    for r in rows:
        ways.setdefault(r.pattern, []).append(r.literals)
    assert set(ways) == set(patterns)
    for q in patterns:
        for x in texts:
            if re.search(q.replace("(?<n>", "(?P<n>"), x):
                marked = f"{patternjoin.BEGIN}{x.lower()}{patternjoin.END}"
                assert any(all(piece in marked for piece in way) for way in ways[q]), (q, x, ways[q])
    assert ways["(ab|ba)c$"] == [["bac" + patternjoin.END], ["abc" + patternjoin.END]] or ways["(ab|ba)c$"] == [["abc" + patternjoin.END], ["bac" + patternjoin.END]]
    assert ways["ab*c"] == [["a", "c"]] and ways["^ab"] == [[patternjoin.BEGIN + "ab"]] and ways[".*"] == [[]]


def test_what_is_no_pattern(spark):
    p = spark.createDataFrame([(x,) for x in [*BROKEN, *PATTERNS]], "p string")
    good, broken = patternjoin.split_keys(p, "p")
    assert {r.p for r in broken.collect()} == set(BROKEN) and {r.p for r in good.collect()} == set(PATTERNS)
    # Spark compiles all that are patterns.
    assert good.filter(F.expr("'abc' rlike p")).count() > 5


def test_line_ends_before_the_end(spark):
    t = spark.createDataFrame([("ab\n",), ("ab\r\n",), ("ab\nc",), ("ab",)], "t string")
    p = spark.createDataFrame([("ab$",), ("(?m)ab$",), ("a.c$",)], "p string")
    got = {(r.t, r.pattern) for r in patternjoin.pattern_pairs(t, "t", p, "p", matchjoin.salted_join).collect()}
    want = {(r.t, r.p) for r in t.crossJoin(p).filter("t rlike p").collect()}
    assert got == want and ("ab\n", "ab$") in want and ("ab\nc", "(?m)ab$") in want


def test_first_match_with_patterns(spark, sides):
    """Plain keys, patterns and broken ones together, prefixes as a group and suffixes with an end behind the last alternative."""
    texts, patterns = sides
    keys = [*patterns, *BROKEN]
    register = spark.createDataFrame([(x, i, f"u{i}") for i, x in enumerate(texts)], "t string, seq int, u string")
    probes = spark.createDataFrame([(x,) for x in keys], "p string")

    def found(key, text, begin, end):
        if key in BROKEN:
            return text.startswith(key) if begin else text.endswith(key)
        return re.search(begin + key.replace("(?<n>", "(?P<n>") + end, text) if not key.startswith("(?i)") else re.search(begin + key[4:] + end, text, re.I)

    got = {r.p: r.match.u for r in matchjoin.first_prefix_match(probes, "p", register, "t", "seq", ["u"]).collect()}
    want = {k: f"u{i}" for k in keys for i in [next((i for i, x in enumerate(texts) if found(k, x, "^(?:", ")")), None)] if i is not None}
    assert got == want

    ordered = spark.createDataFrame([(k, i, f"k{i}") for i, k in enumerate(keys)], "p string, seq int, k string")
    got = {r.t: r.match.k for r in matchjoin.first_suffix_match(register, "t", ordered, "p", "seq", ["k"]).collect()}
    want = {x: f"k{i}" for x in texts for i in [next((i for i, k in enumerate(keys) if found(k, x, "", "$")), None)] if i is not None}
    assert got == want


def test_no_patterns_and_no_texts(spark):
    t, p = spark.createDataFrame([("a",), (None,), ("",)], "t string"), spark.createDataFrame([("a+",)], "p string")
    assert patternjoin.pattern_pairs(t, "t", p.limit(0), "p", matchjoin.salted_join).collect() == []
    assert patternjoin.pattern_pairs(t.limit(0), "t", p, "p", matchjoin.salted_join).collect() == []
    assert [tuple(r) for r in patternjoin.pattern_pairs(t, "t", p, "p", matchjoin.salted_join).collect()] == [("a", "a+")]


def test_no_pair_of_all_is_made(spark):
    """Each text meets the few patterns whose rarest piece it holds."""
    t = spark.createDataFrame([(f"host{i}.example.com",) for i in range(2000)], "t string")
    p = spark.createDataFrame([(f"^host{i}[.]example[.](com|net)$",) for i in range(2000)], "p string")
    met = []

    def counted(rows, lookup, key, spread_by):
        joined = matchjoin.salted_join(rows, lookup, key, spread_by)
        met.append(joined.count())
        return joined

    assert patternjoin.pattern_pairs(t, "t", p, "p", counted).count() == 2000
    assert met[0] < 2000 * 2000 // 50


def test_a_repeated_group_and_long_numbers_meet_few_texts(spark):
    """Met pairs grow with the texts, not with texts and patterns: alternatives in a repeated group count, and so do all digits."""
    n = 3000
    t = spark.createDataFrame([(f"c{i}.n{i % 25}.example.org",) for i in range(10000, 10000 + n)], "t string")
    kinds = [r"^c(?:{0}|{1}){{1,2}}\..*", r"c{0}[0-9]?\.n[0-9]+\.example\.org"]
    p = spark.createDataFrame([(kinds[i % 2].format(i, i + 1),) for i in range(10000, 10000 + n)], "p string")
    met = []

    def counted(rows, lookup, key, spread_by):
        joined = matchjoin.salted_join(rows, lookup, key, spread_by)
        met.append(joined.count())
        return joined

    assert patternjoin.pattern_pairs(t, "t", p, "p", counted).count() == n // 2 * 3
    assert met[0] < n * 20
    ways = {tuple(r.literals) for r in patternjoin.literals(spark.createDataFrame([("x(a|b)+y",)], "p string"), "p").collect()}
    assert ways == {("xa", "y"), ("xb", "y")}
