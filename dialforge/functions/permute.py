"""Keyed permutations of ``0 .. n-1`` as native expressions.

A Feistel network permutes the numbers of ``m`` bits, the fewest that hold ``n``:
each round swaps two halves and adds a keyed mix of one to the other, so it can be
undone and no two numbers meet. A value of ``n`` or more is sent through again until
it falls below ``n`` (cycle-walking), which takes fewer than two passes on average and
keeps the whole a permutation of ``0 .. n-1``. Nothing is stored or shuffled: each row
computes its own place.

The mix of a round is ``(((a R + b) mod p) ((R + c) mod p) + d) mod p`` with
``p = 2^31 - 1`` and keys drawn from ``(seed, tag, round)``; every product stays below
2^62, so any engine with 64-bit integers computes the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialforge.functions.draw import u_py

PRIME = (1 << 31) - 1
ROUNDS = 6              # even, so that the halves end where they began
WALKS = 80              # more are needed once in 2^80


def bits_for(n: int) -> int:
    return max(2, (n - 1).bit_length())


def round_keys(seed: int, tag: str) -> list[tuple[int, int, int, int]]:
    """``a, b, c, d`` of every round."""
    return [tuple(1 + u_py(seed, [tag, r, name], "round") % (PRIME - 1) for name in "abcd") for r in range(ROUNDS)]


def halves(bits: int, r: int) -> tuple[int, int]:
    """Bits of the left and the right half in round ``r``."""
    right = bits // 2 if r % 2 == 0 else bits - bits // 2
    return bits - right, right


def _pass(x: Column, bits: int, keys: list[tuple[int, int, int, int]]) -> Column:
    """One pass through all rounds. Each round is a fold step, so that its input
    is computed once."""
    steps = F.array(*[F.struct(*[F.lit(k).cast("long").alias(n) for n, k in zip("abcd", key)],
                               *[F.lit(v).alias(n) for n, v in zip(("left", "right"), halves(bits, r))]) for r, key in enumerate(keys)])

    def step(acc, k):
        one, p = F.lit(1).cast("long"), F.lit(PRIME).cast("long")
        low = acc.bitwiseAND(F.call_function("shiftleft", one, k["right"]) - 1)
        high = F.call_function("shiftright", acc, k["right"])
        mixed = (((k["a"] * low + k["b"]) % p) * ((low + k["c"]) % p) + k["d"]) % p
        mixed = mixed.bitwiseAND(F.call_function("shiftleft", one, k["left"]) - 1)
        return F.call_function("shiftleft", low, k["left"]).bitwiseOR(high.bitwiseXOR(mixed))

    return F.aggregate(steps, x, step)


def permuted(place: Column, n: int, seed: int, tag: str) -> Column:
    """Where ``place`` (0 .. n-1) goes in the permutation of ``(seed, tag)``."""
    if not 1 <= n <= 1 << 62:
        raise ValueError("n must be 1 .. 2^62")
    bits, keys = bits_for(n), round_keys(seed, tag)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), _pass(place.cast("long"), bits, keys),
                         lambda acc, _: F.when(acc < n, acc).otherwise(_pass(acc, bits, keys)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("no place after many walks; use another seed")).cast("long"))


def permuted_py(place: int, n: int, seed: int, tag: str) -> int:
    """Python twin of :func:`permuted`."""
    bits, keys = bits_for(n), round_keys(seed, tag)
    x = place
    while True:
        for r, (a, b, c, d) in enumerate(keys):
            left, right = halves(bits, r)
            low, high = x & ((1 << right) - 1), x >> right
            mixed = (((a * low + b) % PRIME) * ((low + c) % PRIME) + d) % PRIME & ((1 << left) - 1)
            x = low << left | high ^ mixed
        if x < n:
            return x
