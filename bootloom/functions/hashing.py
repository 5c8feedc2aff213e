"""The repeatable random numbers behind every resample.

A random number here is ``xxhash64`` of a few integers (seed, draw number, ...),
so it depends on nothing but those integers: not on partitioning, task order or
retries. Spark computes it with its built-in function; tasks that work on NumPy
arrays use the array form below, which returns the same numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# The published XXH64 primes and the seed Spark's xxhash64 starts from.
PRIME_1 = np.uint64(0x9E3779B185EBCA87)
PRIME_2 = np.uint64(0xC2B2AE3D27D4EB4F)
PRIME_3 = np.uint64(0x165667B19E3779F9)
PRIME_4 = np.uint64(0x85EBCA77C2B2AE63)
PRIME_5 = np.uint64(0x27D4EB2F165667C5)
SPARK_SEED = np.uint64(42)
SPARE_BITS = 2047

# Poisson(1) cumulative probabilities P(X <= j), j = 0, 1, 2, ... up to the
# last one below 1 in double precision.
POISSON_1_CDF = [
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
    0.9963401531726563, 0.9994058151824183, 0.999916758850712, 0.9999897508033253,
    0.999998874797402, 0.9999998885745217, 0.9999999899522336, 0.9999999991683892,
    0.9999999999364022, 0.9999999999954802, 0.9999999999997, 0.9999999999999813,
    0.9999999999999989, 0.9999999999999999,
]


def _hash(cols) -> Column:
    return F.xxhash64(*[(F.col(c) if isinstance(c, str) else c).cast("long") for c in cols])


def nonneg_hash(*cols) -> Column:
    """``xxhash64`` of the columns (as longs) without its lowest bit: 0 .. 2**63-1."""
    return F.shiftrightunsigned(_hash(cols), 1)


def uniform(*cols) -> Column:
    """A double in [0, 1) with 53 random bits."""
    return F.shiftrightunsigned(_hash(cols), 11) * F.lit(2.0 ** -53)


def spare(*cols) -> Column:
    """The 11 bits of the same hash that `uniform` does not use: 0 .. 2047."""
    return _hash(cols).bitwiseAND(SPARE_BITS)


def poisson_weight(u: Column) -> Column:
    """Poisson(1) variate from a uniform, by the inverse of the distribution function."""
    out = F.when(u < POISSON_1_CDF[0], 0)
    for j, p in enumerate(POISSON_1_CDF[1:], start=1):
        out = out.when(u < p, j)
    return out.otherwise(len(POISSON_1_CDF))


def hash_array(values, state=SPARK_SEED) -> np.ndarray:
    """Array form of one ``xxhash64`` step over 8-byte integers; chain it for several.

    ``hash_array(b, hash_array(a))`` equals ``xxhash64(a, b)`` read as unsigned.
    """
    x = np.asarray(values).astype(np.uint64)
    with np.errstate(over="ignore"):
        x = x * PRIME_2
        x = (x << np.uint64(31)) | (x >> np.uint64(33))
        x *= PRIME_1
        x = x ^ (np.asarray(state, dtype=np.uint64) + PRIME_5 + np.uint64(8))
        x = (x << np.uint64(27)) | (x >> np.uint64(37))
        x *= PRIME_1
        x += PRIME_4
        x ^= x >> np.uint64(33)
        x *= PRIME_2
        x ^= x >> np.uint64(29)
        x *= PRIME_3
        x ^= x >> np.uint64(32)
    return x


def uniform_array(hashes: np.ndarray) -> np.ndarray:
    """Array form of ``uniform`` for hashes already computed."""
    return (hashes >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def poisson_array(u: np.ndarray) -> np.ndarray:
    """Array form of ``poisson_weight``. Few variates are large, so only those are looked up."""
    w = (u >= POISSON_1_CDF[0]).astype(np.int8)
    for p in POISSON_1_CDF[1:4]:
        w += u >= p
    large = np.nonzero(w == 4)
    w[large] = np.searchsorted(POISSON_1_CDF, u[large], side="right")
    return w
