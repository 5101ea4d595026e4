"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations, verified.

Vectors are put into buckets by the nearest corners of cross-polytopes after random rotations;
each also probes the buckets it nearly fell into. Vectors of one bucket that are very close form
balls around their mean, so small that all members of a ball surely link. Balls that share a
bucket are candidates. The angle of two centres and the two radii settle most pairs of balls as a
whole, either way; members of the others are compared in blocks. No list of pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from netaudit.llm.common import checkpointed, components
from netaudit.llm.words import mix

LEAST_COSINE = 0.9
#: Probed buckets per table besides the own, corners kept per rotation for that, and tables for up to three rotations each.
PROBES, CORNERS, TABLES = 8, 4, 10
SEED = 20_240_607
#: Vectors of a block when members of two balls are compared.
BLOCK = 1000
#: Angles are compared with so much room for rounding; what is closer to the border is compared by cosine.
ROOM = 1e-6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def padded_width(dim: int) -> int:
    """Power of two that vectors are filled up to with zeros, with room for the corners kept."""
    return max(8, 1 << (dim - 1).bit_length())


def rotations_for(count: int, width: int) -> int:
    """Rotations per table, so that there are at least as many buckets as vectors."""
    return max(2, ceil(log(max(count, 2)) / log(2 * width)))


def bucket_codes(x: np.ndarray, rotations: int, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Own bucket of each row in each table, and its probed buckets; rows have unit length."""
    n, dim = x.shape
    width = padded_width(dim)
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    own, probed = np.zeros((n, tables), dtype=np.uint64), np.zeros((n, tables, probes), dtype=np.uint64)
    for table in range(tables):
        random = np.random.default_rng([SEED, dim, table])
        codes, losses = np.zeros((n, 1), dtype=np.uint64), np.zeros((n, 1))
        for _ in range(rotations):
            y = padded
            for _ in range(3):
                y = hadamard(y * random.choice([-1.0, 1.0], width))
            both = np.concatenate([y, -y], axis=1)
            corners = np.argpartition(-both, CORNERS, axis=1)[:, :CORNERS]
            heights = np.take_along_axis(both, corners, axis=1)
            order = np.argsort(-heights, axis=1, kind="stable")
            corners, heights = np.take_along_axis(corners, order, axis=1), np.take_along_axis(heights, order, axis=1)
            loss = (heights[:, :1] - heights) ** 2
            codes = (codes[:, :, None] * np.uint64(2 * width) + corners[:, None, :].astype(np.uint64)).reshape(n, -1)
            losses = (losses[:, :, None] + loss[:, None, :]).reshape(n, -1)
            # Only the best ways on can be among the probes.
            if codes.shape[1] > 4 * (probes + 1):
                best = np.argsort(losses, axis=1, kind="stable")[:, : probes + 1]
                codes, losses = np.take_along_axis(codes, best, axis=1), np.take_along_axis(losses, best, axis=1)
        best = np.argsort(losses, axis=1, kind="stable")[:, : probes + 1]
        codes = np.take_along_axis(codes, best, axis=1)
        codes = mix(codes + mix(np.array([table * 1_000_003 + dim], dtype=np.uint64)))
        own[:, table] = codes[:, 0]
        probed[:, table, : codes.shape[1] - 1] = codes[:, 1:]
        probed[:, table, codes.shape[1] - 1 :] = codes[:, :1]
    return own.view(np.int64), probed.reshape(n, -1).view(np.int64)


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the rows of each length."""
    lengths = np.diff(np.asarray(column.offsets))
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        yield rows, np.array(column.take(pa.array(rows)).flatten(), dtype=float).reshape(len(rows), width)


def _coded(rotations: int, tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in by_width(batch.column(1)):
                x = x / np.abs(x).max(axis=1, keepdims=True)
                own, probed = bucket_codes(x / np.linalg.norm(x, axis=1, keepdims=True), rotations, tables, probes)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * c.shape[1]), pa.array(c.ravel())) for c in (own, probed)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *lists], ["key", "own", "probed"])

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def _with_cosine(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with ``cosine`` of two vector columns of one length each, which are dropped."""
    rest = [c for c in pairs.columns if c not in (a, b)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for (rows, x), (_, y) in zip(by_width(batch.column(a)), by_width(batch.column(b)), strict=True):
                out[rows] = cosines(x, y)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out)], [*rest, "cosine"])

    kinds = dict(pairs.dtypes)
    return pairs.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "cosine double"]))


def _angle(column: str):
    return F.acos(F.least(F.greatest(F.col(column), F.lit(-1.0)), F.lit(1.0)))


def near_links(rows: DataFrame, least_cosine: float = LEAST_COSINE, probes: int = PROBES, tables: int = TABLES) -> tuple[DataFrame, DataFrame]:
    """Ball of each vector with its links, and links between balls.

    ``rows``: ``key`` (long, unique) and ``v`` (array of double; finite, not all zero). Returns
    ``key, ball, n_links`` and ``a, b`` of balls that hold linked vectors.
    """
    widest, count = rows.agg(F.max(F.size("v")), F.count("*")).first()
    if not count:
        none = rows.select("key", F.col("key").alias("ball"), F.lit(0).cast("long").alias("n_links"))
        return none, rows.select(F.col("key").alias("a"), F.col("key").alias("b"))
    rotations = rotations_for(count, padded_width(widest))
    tables *= 2 ** max(0, rotations - 3)
    border = acos(least_cosine)
    coded = checkpointed(rows.select("key", "v").mapInArrow(_coded(rotations, tables, probes), "key long, own array<long>, probed array<long>"))
    owns = coded.select("key", F.explode("own").alias("bucket"))

    # Balls: vectors within half the border's angle of a bucket's first vector, around their mean.
    leads = owns.groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("last")).filter("lead < last").drop("last")
    close = owns.join(leads, "bucket").filter("key != lead").select("key", "lead").distinct()
    close = close.join(rows.select("key", F.col("v").alias("x")), "key").join(rows.select(F.col("key").alias("lead"), F.col("v").alias("y")), "lead")
    led = _with_cosine(close, "x", "y").filter(_angle("cosine") <= border / 2 - ROOM).groupBy("key").agg(F.min("lead").alias("lead"))
    members = checkpointed(rows.join(led, "key", "left").select("key", "v", F.coalesce("lead", "key").alias("ball")))
    shared = members.groupBy("ball").agg(F.count("*").alias("n")).filter("n > 1").select("ball")
    unit = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    means = (
        members.join(shared, "ball").select("ball", unit.alias("norm"), F.posexplode("v").alias("i", "x"))
        .groupBy("ball", "i").agg(F.sum(F.col("x") / F.col("norm")).alias("x"))
        .groupBy("ball").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("centre"))  # one entry per dimension
    )
    placed = _with_cosine(members.join(means, "ball"), "v", "centre").select("key", "ball", _angle("cosine").alias("angle")).filter(F.col("angle") <= border / 2 - ROOM)
    placed = checkpointed(members.select("key", "v").join(placed, "key", "left").select("key", "v", F.coalesce("ball", "key").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle")))
    balls = placed.groupBy("ball").agg(F.max("angle").alias("radius"), F.count("*").alias("size"), F.min(F.when(F.col("key") == F.col("ball"), F.col("v"))).alias("own"))
    balls = checkpointed(balls.join(means, "ball", "left").select("ball", "radius", "size", F.when(F.col("size") == 1, F.col("own")).otherwise(F.col("centre")).alias("centre")))
    # A ball that only its leader's name is left of, or one member that is not the leader, is that member.
    lone = placed.join(balls.filter("centre is null").select("ball"), "ball").select("ball", "v")
    balls = balls.join(lone.groupBy("ball").agg(F.first("v").alias("only")), "ball", "left").select("ball", "radius", "size", F.coalesce("centre", "only").alias("centre"))
    balls = checkpointed(balls.withColumn("radius", F.when(F.col("size") == 1, F.lit(0.0)).otherwise(F.col("radius"))))

    # Candidates: balls with a vector in a bucket that a vector of the other probes.
    place = placed.select("key", "ball")
    homes = owns.join(place, "key").select("bucket", "ball").distinct()
    probing = coded.select("key", F.explode(F.array_union("own", "probed")).alias("bucket")).join(place, "key").select("bucket", F.col("ball").alias("other")).distinct()
    pairs = probing.join(homes, "bucket").filter("ball != other").select(F.least("ball", "other").alias("a"), F.greatest("ball", "other").alias("b")).distinct()
    a = balls.select(F.col("ball").alias("a"), F.col("radius").alias("ra"), F.col("size").alias("na"), F.col("centre").alias("ca"))
    b = balls.select(F.col("ball").alias("b"), F.col("radius").alias("rb"), F.col("size").alias("nb"), F.col("centre").alias("cb"))
    judged = _with_cosine(pairs.join(a, "a").join(b, "b"), "ca", "cb").withColumn("angle", _angle("cosine"))
    judged = checkpointed(judged.filter(F.col("angle") - F.col("ra") - F.col("rb") <= border + ROOM))
    sure = F.col("angle") + F.col("ra") + F.col("rb") <= border - ROOM
    whole, open_pairs = judged.filter(sure), judged.filter(~sure)

    # Members of the pairs that are not settled, in blocks.
    def side(end: str, other: str, which: int) -> DataFrame:
        parts = {c: F.ceil(F.col(f"n{c}") / BLOCK).cast("int") for c in "ab"}
        own = F.pmod(F.xxhash64("key"), parts[end]).cast("int")
        every = F.explode(F.sequence(F.lit(0), parts[other] - 1))
        joined = open_pairs.join(placed.select("key", "v", F.col("ball").alias(end)), end)
        return joined.select("a", "b", own.alias(f"part_{end}"), every.alias(f"part_{other}"), F.lit(which).alias("side"), "key", "v").select("a", "b", "part_a", "part_b", "side", "key", "v")

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        sides = [block[block.side == s] for s in (0, 1)]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame({"a": [], "b": [], "key": [], "n": []})
        x, y = (np.array(s.v.tolist(), dtype=float) for s in sides)
        x, y = (m / np.abs(m).max(axis=1, keepdims=True) for m in (x, y))
        linked = x @ y.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) >= least_cosine
        found = pd.concat([pd.DataFrame({"key": s.key, "n": linked.sum(axis=axis)}) for s, axis in zip(sides, (1, 0), strict=True)])
        found = found[found.n > 0]
        return found.assign(a=block.a.iloc[0], b=block.b.iloc[0])[["a", "b", "key", "n"]]

    blocks = side("a", "b", 0).unionByName(side("b", "a", 1))
    single = checkpointed(blocks.groupBy("a", "b", "part_a", "part_b").applyInPandas(compare, "a long, b long, key long, n long"))
    extra = whole.select(F.col("a").alias("ball"), F.col("nb").alias("n")).unionByName(whole.select(F.col("b").alias("ball"), F.col("na").alias("n"))).groupBy("ball").agg(F.sum("n").alias("more"))
    own = balls.select("ball", (F.col("size") - 1).alias("inside")).join(extra, "ball", "left").select("ball", (F.col("inside") + F.coalesce("more", F.lit(0))).alias("whole"))
    few = single.groupBy("key").agg(F.sum("n").alias("single"))
    counted = place.join(own, "ball").join(few, "key", "left").select("key", "ball", (F.col("whole") + F.coalesce("single", F.lit(0))).cast("long").alias("n_links"))
    return counted, whole.select("a", "b").unionByName(single.select("a", "b").distinct())


def near_vectors(embeddings: DataFrame, least_cosine: float = LEAST_COSINE, probes: int = PROBES, tables: int = TABLES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``embeddings``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    nor do vectors of different lengths with each other. Equal rows are one vector. A row without
    id takes part in links but names no component and is not counted as kept. Labels and other
    columns are not read.
    """
    given = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    given = given.withColumn("key", F.xxhash64(F.coalesce("vec_id", F.lit(-1)), F.col("vec_id").isNull(), "v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = checkpointed(given.withColumn("usable", usable))
    vectors = rows.filter("usable").select("key", "v").dropDuplicates(["key"])
    counted, links = near_links(checkpointed(vectors), least_cosine, probes, tables)
    parts = components(links)
    found = counted.join(parts, counted.ball == parts.node, "left").select("key", "n_links", F.coalesce("component", "ball").alias("part"))
    whole = checkpointed(rows.select("vec_id", "key").join(found, "key", "left"))
    least = whole.filter("part is not null").groupBy("part").agg(F.min("vec_id").alias("least"))
    out = whole.join(least, "part", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("part").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
