"""Reproducible pseudorandom permutations of 0..n-1 as native columns: Feistel rounds with cycle walking.

A number below a * b >= n is split in two halves modulo a and b, which are mixed by
``ROUNDS`` keyed rounds; a result of n or more is permuted again until it is below n.
A walk only passes numbers from n to a * b - 1, fewer than a (about the square root
of n), so the longest walk is found exactly by following those few (``longest_walk``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 4


def sides(n: int) -> tuple[int, int]:
    """Sides a, b of a near-square domain with a * b >= n and a * b - n < a."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _md5_bits(seed: str, turn: Column, value: Column) -> Column:
    """48 pseudorandom bits that any SQL engine computes alike."""
    bits = F.md5(F.concat(F.lit(f"{seed}:"), turn.cast("string"), F.lit(":"), value.cast("string")))
    return F.conv(F.substring(bits, 1, 12), 16, 10).cast("long")


def _xx_bits(seed: str, turn: Column, value: Column) -> Column:
    """48 pseudorandom bits from Spark's own hash, many times cheaper."""
    return F.xxhash64(F.lit(seed), turn, value).bitwiseAND(F.lit((1 << 48) - 1))


def once(x: Column, a: Column, b: Column, seed: str, portable: bool = True) -> Column:
    """One pass over the whole domain; an even number of rounds keeps the halves' sides.

    ``portable`` rounds use md5, others Spark's xxhash64.
    """
    bits = _md5_bits if portable else _xx_bits
    left, right = (x % a).cast("long"), ((x - x % a) / a).cast("long")

    # The rounds fold over a pair of halves, so no expression repeats another's work.
    def mixed(halves: Column, turn: Column) -> Column:
        side = F.when(turn % 2 == 0, a).otherwise(b)
        return F.struct(halves["right"].alias("left"), ((halves["left"] + bits(seed, turn, halves["right"]) % side) % side).alias("right"))

    start = F.struct(left.alias("left"), right.alias("right"))
    return F.aggregate(F.array(*(F.lit(t) for t in range(ROUNDS))), start, mixed, lambda h: a * h["right"] + h["left"])


def longest_walk(outside: DataFrame, seed: str, portable: bool = True) -> int:
    """How often a result can be out of range: follows the rows (x, n, a, b) with n <= x < a * b, in one job.

    A walk that comes back to its start is a cycle that lies wholly out of range. No number below
    n leads into it, so it does not count.
    """
    x, n, a, b = F.col("x").cast("long"), F.col("n"), F.col("a"), F.col("b")

    def step(s: Column, _: Column) -> Column:
        y = once(s["y"], a, b, seed, portable)
        on = F.struct(y.alias("y"), (s["steps"] + 1).alias("steps"))
        return F.when((s["y"] >= n) & ((s["steps"] == 0) | (s["y"] != x)), on).otherwise(s)

    most = 64
    while True:
        start = F.struct(x.alias("y"), F.lit(0).alias("steps"))
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)
        ended, closed = F.col("w.y") < n, (F.col("w.y") == x) & (F.col("w.steps") > 0)
        row = outside.select("x", "n", walked.alias("w")).agg(F.max(F.when(ended, F.col("w.steps"))), F.max(~ended & ~closed)).first()
        if not row[1]:
            return row[0] or 0
        most *= 4


def permuted(x: Column, n: Column, a: Column, b: Column, seed: str, depth: int, portable: bool = True) -> Column:
    """The permutation's value at ``x``; ``depth`` from ``longest_walk``."""
    y = once(x, a, b, seed, portable)
    if not depth:
        return y
    return F.aggregate(F.array(*(F.lit(t) for t in range(depth))), y, lambda y, _: F.when(y >= n, once(y, a, b, seed, portable)).otherwise(y))


def shuffled(df: DataFrame, x: str, out: str, n: int, seed: str) -> DataFrame:
    """``permuted`` for one n."""
    a, b = sides(n)
    outside = df.sparkSession.range(n, a * b).select(F.col("id").alias("x"), *(F.lit(v).cast("long").alias(c) for c, v in (("n", n), ("a", a), ("b", b))))
    n_, a_, b_ = (F.lit(v).cast("long") for v in (n, a, b))
    return df.withColumn(out, permuted(F.col(x), n_, a_, b_, seed, longest_walk(outside, seed)))


def once_sql(x: str, a: str, b: str, seed: str) -> str:
    """DuckDB expression of ``once``."""
    left, right = f"({x}) % ({a})", f"({x}) // ({a})"
    for turn in range(ROUNDS):
        side = a if turn % 2 == 0 else b
        key = f"('0x' || substr(md5('{seed}:{turn}:' || ({right})::VARCHAR), 1, 12))::BIGINT"
        left, right = right, f"(({left}) + {key} % ({side})) % ({side})"
    return f"({a}) * ({right}) + ({left})"
