"""Deterministic per-row hashing.

Randomness in this library (splits, folds, samples, forest subsamples) is a
function of ``(seed, key)`` only, so it does not depend on partitioning,
task retries or executor loss.  The hash is the first 32 bits of
``md5(seed | key...)`` which every SQL engine can compute; the DuckDB form is
``('0x' || substr(md5(concat_ws('|', seed, key...)), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key_cols(keys: Sequence[str | Column]) -> list[Column]:
    return [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]


def hash32(seed: int | str, keys: Sequence[str | Column]) -> Column:
    """Unsigned 32-bit hash of (seed, keys) as a BIGINT in [0, 2^32)."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *_key_cols(keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def unit_hash(seed: int | str, keys: Sequence[str | Column]) -> Column:
    """Uniform value in [0, 1) derived from (seed, keys)."""
    return hash32(seed, keys) / F.lit(TWO_32)


def sql_hash32(seed: int | str, keys: Sequence[str]) -> str:
    """The same hash written as DuckDB SQL (used by oracle queries)."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {parts})), 1, 8))::BIGINT"


def sql_unit_hash(seed: int | str, keys: Sequence[str]) -> str:
    return f"({sql_hash32(seed, keys)} / 4294967296.0)"
