"""Hash expressions shared by the similarity and itemset operators.

All of them are plain Spark SQL expressions (codegen, no Python), and each has
a DuckDB equivalent so that results can be checked against SQL.
"""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.  Modulus of the linear MinHash family ((a*x + b) mod P):
#: the Mersenne prime 2^31 - 1.
MINHASH_PRIME = 2_147_483_647
#: Fixed values.  Default number of hash buckets for the PCY pair filter.
PCY_BUCKETS = 26_131
#: Width in bits of the portable token hash (7 hex digits of md5).
TOKEN_HASH_BITS = 28


def token_hash(col: str | Column) -> Column:
    """28-bit integer from the first 7 hex digits of ``md5(token)``.

    DuckDB: ``('0x' || substr(md5(w), 1, 7))::BIGINT``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 7), 16, 10).cast("long")


def minhash_params(num_hashes: int, seed: int = 7) -> list[tuple[int, int]]:
    """``num_hashes`` pairs ``(a, b)`` with ``1 <= a < 2^30`` and ``0 <= b < 2^31``.

    With a token hash below 2^28, ``a * x + b`` stays below 2^63, so the
    arithmetic never overflows a long (Spark 4 runs in ANSI mode).
    """
    rng = random.Random(seed)
    return [(rng.randrange(1, 1 << 30), rng.randrange(0, 1 << 31)) for _ in range(num_hashes)]


def linear_hash(x: Column, a: int, b: int, p: int = MINHASH_PRIME) -> Column:
    """``(a * x + b) mod p`` on longs."""
    return F.pmod(F.lit(a).cast("long") * x + F.lit(b).cast("long"), F.lit(p).cast("long"))


def pair_bucket(i: Column, j: Column, buckets: int = PCY_BUCKETS) -> Column:
    """PCY bucket of an ordered pair of dense item ids: ``(j - i) mod buckets``."""
    return F.pmod(j - i, F.lit(buckets))
