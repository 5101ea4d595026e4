"""Small inputs and brute-force versions for the tests of the training-data operators."""

from __future__ import annotations

import random

SPACE = "\t\n\x0b\x0c\r "
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key long, name string, component long, cell int"


def documents(spark, rows):
    """Documents with columns whose names the operators use themselves; rows of id and text."""
    full = [(i, t, "en", "src1", None if t is None else len(t), 7, "n", 3, 1) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows(rng: random.Random):
    """Null, empty and blank texts, a very long one, repeated rows, a null id."""
    text = prose(rng, 120)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, prose(rng, 20_000, 5000)), (5, text), (5, text), (6, text), (None, text), (7, "one"), (8, "One\none two"),
        (9, text + " more"), (10, "É \x1f x"),
    ]


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def split(text) -> list[bytes]:
    return (text or "").encode().split()


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
