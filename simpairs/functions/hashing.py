"""Column-level hash functions (all JVM-side, codegen friendly).

* ``element_bytes``  – the element encoding: UTF-8 bytes of ``str(x)``.
* ``sha1_hash32``    – first four SHA-1 digest bytes read little-endian.
* ``seeded_uniform`` / ``seeded_gaussian`` – reproducible pseudo-random numbers
  derived from an md5 of a text key, so that any number of random values
  (hyperplane coordinates, sampling order) can be generated where the data is,
  without a driver-side table that grows with the data.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the MinHash family (must equal the reference's):
#   Mersenne prime 2**61 - 1, largest 32-bit hash 2**32 - 1, default 128 permutations.
MERSENNE_PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1
NUM_PERM = 128

_TWO_POW_52 = float(1 << 52)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def element_bytes(col) -> Column:
    """UTF-8 bytes of the element's text form (strings pass through)."""
    return _c(col).cast("string").cast("binary")


def sha1_hash32(col) -> Column:
    """32-bit hash of an element: SHA-1 digest bytes 0..3 as little-endian uint32.

    Returned as a non-negative ``long``.
    """
    h = F.sha1(element_bytes(col))
    little_endian_hex = F.concat(
        F.substring(h, 7, 2), F.substring(h, 5, 2),
        F.substring(h, 3, 2), F.substring(h, 1, 2))
    return F.conv(little_endian_hex, 16, 10).cast("long")


def sha1_hash32_py(data: bytes) -> int:
    """Driver/test-side twin of :func:`sha1_hash32`."""
    return int.from_bytes(hashlib.sha1(data).digest()[:4], "little")


def _key_text(seed, *parts) -> Column:
    cols = [F.lit(str(seed))] + [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def seeded_uniform(seed, *parts, offset: int = 0) -> Column:
    """Uniform double in (0, 1) from 52 bits of md5("seed:part1:part2...")."""
    h = F.md5(_key_text(seed, *parts))
    bits = F.conv(F.substring(h, 1 + offset, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(_TWO_POW_52)


def seeded_gaussian(seed, *parts) -> Column:
    """Standard normal value (Box-Muller over two 52-bit uniforms of one md5)."""
    h = F.md5(_key_text(seed, *parts))
    u1 = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_TWO_POW_52)
    u2 = (F.conv(F.substring(h, 14, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_TWO_POW_52)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def seeded_gaussian_py(seed, *parts) -> float:
    """Driver-side twin of :func:`seeded_gaussian` (used for dense planes)."""
    text = ":".join(str(p) for p in (seed,) + parts)
    h = hashlib.md5(text.encode("utf-8")).hexdigest()
    u1 = (int(h[0:13], 16) + 0.5) / _TWO_POW_52
    u2 = (int(h[13:26], 16) + 0.5) / _TWO_POW_52
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(2.0 * math.pi * u2)


def md5_order_key(seed, *parts) -> Column:
    """Deterministic pseudo-random sort key (md5 hex) for seeded sampling."""
    return F.md5(_key_text(seed, *parts))
