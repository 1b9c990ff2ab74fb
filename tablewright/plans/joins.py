"""Join strategies with explicit size checks and hot-key handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 64


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    big_key: Column,
    small_key: str,
    how: str = "left",
    max_broadcast_rows: int = 200_000,
    max_broadcast_bytes: int = 32 << 20,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """Join a large table to a lookup table with one row per key.

    The lookup side is measured first (it is an aggregate, so this is a cheap
    job); it is broadcast only within both bounds, of rows and of bytes.
    Beyond them the join is salted: each big-side row gets a salt in
    ``[0, salt_buckets)`` from its place in its partition, so equal rows
    spread too, and the lookup side is replicated once per salt: a key holding
    a third of all rows is dealt to ``salt_buckets`` tasks instead of one.
    """
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in small.columns), F.lit(0))
    n_small, n_bytes = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if n_small <= max_broadcast_rows and n_bytes <= max_broadcast_bytes:
        return big.join(F.broadcast(small), big_key == F.col(small_key), how)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets))
    big_s = big.withColumn("_tw_salt", salt)
    small_s = small.withColumn("_tw_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    cond = (big_key == F.col(small_key)) & (F.col("_tw_salt") == F.col("_tw_salt_r"))
    return big_s.join(small_s, cond, how).drop("_tw_salt", "_tw_salt_r")
