"""Deterministic hash expressions (JVM-side, codegen'd) used for random order, seeds and noise.

Each one has a twin in DuckDB SQL so that the oracle can recompute it; the SQL twins live next to the
Spark expressions as ``*_SQL`` format strings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(key: Column | str, seed: int, salt: str | None = None) -> Column:
    """32-bit random order key: first 8 hex digits of ``md5('<key>:<seed>[:<salt>]')`` as a bigint.

    Uniform over [0, 2^32), so its leading bits make balanced, order-preserving buckets.
    """
    key = F.col(key) if isinstance(key, str) else key
    parts = [key.cast("string"), F.lit(str(seed))]
    if salt:
        parts.append(F.lit(salt))
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def order_hash_sql(key_sql: str, seed: int, salt: str | None = None) -> str:
    """DuckDB twin of :func:`order_hash`."""
    tail = f", '{salt}'" if salt else ""
    return f"('0x' || substr(md5(concat_ws(':', CAST({key_sql} AS VARCHAR), '{seed}'{tail})), 1, 8))::BIGINT"


def stable_seed(*parts: Column) -> Column:
    """``sha256('a:b:c')`` first 16 hex digits mod 2^32 == hex digits 9..16 read as a number."""
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(key, 256), 9, 8), 16, 10).cast("bigint")


def _unit_uniform(key: Column, tag: str) -> Column:
    """A uniform number in (0, 1) from 52 bits of ``sha256(key:tag)``; never exactly 0 or 1."""
    digest = F.sha2(F.concat_ws(":", key, F.lit(tag)), 256)
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")  # 13 hex digits = 52 bits
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def gaussian_noise(*parts: Column) -> Column:
    """A standard normal number for the key ``parts`` by Box-Muller over two hash uniforms.

    Deterministic per key, so a client and the aggregator regenerate the same number without
    exchanging it, and every value is computed independently (no sequential random stream).
    """
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    u1 = _unit_uniform(key, "u1")
    u2 = _unit_uniform(key, "u2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def gaussian_noise_sql(*parts_sql: str) -> str:
    """DuckDB twin of :func:`gaussian_noise`."""
    key = "concat_ws(':', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts_sql) + ")"

    def uni(tag: str) -> str:
        return (f"((('0x' || substr(sha256(concat_ws(':', {key}, '{tag}')), 1, 13))::BIGINT)::DOUBLE + 0.5)"
                f" / {float(2**52)!r}")

    return f"(sqrt(-2.0 * ln({uni('u1')})) * cos({2.0 * math.pi!r} * {uni('u2')}))"
