"""A keyed random permutation of 0..n-1 that is computed place by place.

The swap-or-not shuffle works on any n without cycle walking: in each pass a place x and its mirror
(k - x) mod n are swapped or not, as a bit of a keyed hash of the greater of the two says. A pass
undoes itself, so the whole is a permutation for any keys. Catalyst folds over an array of keys; the
numpy form gives the same numbers, for code that draws while it runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Passes over the keys, several for each doubling of n; n must be below ``PRIME``.
PASSES, PRIME = 48, (1 << 31) - 1


def pass_keys(seed: Column, n: Column) -> Column:
    """``array<struct<k, a, b>>`` of one permutation: the mirror and two multipliers of the hash, a pass each."""

    def one(i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", seed.cast("string"), i.cast("string")).cast("binary"))
        part = lambda at, size: F.conv(F.substring(digest, at, size), 16, 10).cast("long")
        return F.struct((part(1, 15) % n).alias("k"), (part(16, 7) + 1).alias("a"), part(23, 7).alias("b"))

    return F.transform(F.sequence(F.lit(0), F.lit(PASSES - 1)), one)


def permuted(place: Column, n: Column, keys: Column) -> Column:
    """Where ``place`` goes among 0..n-1."""

    def swap(x: Column, key: Column) -> Column:
        mirror = (key["k"] + n - x) % n
        t = (key["a"] * F.greatest(x, mirror) + key["b"]) % PRIME
        return F.when(F.shiftright((t * t) % PRIME, 15) % 2 == 1, mirror).otherwise(x)

    return F.reduce(keys, place.cast("long"), swap)


def pass_numbers(n: int, seed: int | None) -> list[tuple[int, int, int]]:
    """The keys of ``pass_keys`` without Spark."""
    of, out = "" if seed is None else f"{seed}:", []
    for i in range(PASSES):
        digest = hashlib.md5(f"{of}{i}".encode()).hexdigest()
        out.append((int(digest[:15], 16) % n, int(digest[15:22], 16) + 1, int(digest[22:29], 16)))
    return out


def permute(x: np.ndarray, n: np.ndarray | int, passes: Iterable[tuple]) -> np.ndarray:
    """Where places ``x`` go among 0..n-1; ``n`` and the passes' numbers are those of one permutation, or arrays with a value for each place."""
    for k, a, b in passes:
        mirror = k + n - x
        mirror -= n * (mirror >= n)
        t = (a * np.maximum(x, mirror) + b) % PRIME
        x = np.where((t * t % PRIME) >> 15 & 1 == 1, mirror, x)
    return x


def permuted_numbers(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The same for an array of places, without Spark."""
    return permute(np.asarray(places, np.int64), n, pass_numbers(n, seed))
