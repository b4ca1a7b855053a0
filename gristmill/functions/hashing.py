"""Stable hashes: order, buckets and splits that are the same in every run and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 3407


def hash_hex(value: Column, seed: int = DEFAULT_SEED) -> Column:
    """First 64 bits of SHA-256 of ``"{seed}:{value}"`` as 16 hex digits; null stays null.

    Fixed-width lower-case hex sorts like the unsigned number, which Spark has no type for.
    """
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), value.cast("string")), 256), 1, 16)


def hash_number(value: Column, seed: int = DEFAULT_SEED) -> Column:
    """The same 64 bits as an unsigned number, ``decimal(20,0)``."""
    return F.conv(hash_hex(value, seed), 16, 10).cast("decimal(20,0)")


def hash_bucket(value: Column, buckets: int, seed: int = DEFAULT_SEED) -> Column:
    """Unsigned remainder by ``buckets``, from two 32-bit halves that fit a bigint."""
    h = hash_hex(value, seed)
    high, low = (F.conv(F.substring(h, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    return ((high % buckets) * ((1 << 32) % buckets) + low) % buckets


def hash_split(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """``train`` for 90 of 100 buckets, then ``validation`` for 5 and ``test`` for 5."""
    b = hash_bucket(key, 100, seed)
    return F.when(b < 90, "train").when(b < 95, "validation").when(b.isNotNull(), "test")


def messages_hash(messages: Column) -> Column:
    """SHA-256 of the compact JSON of the messages, keys in order (content before role)."""
    return F.sha2(F.to_json(F.transform(messages, lambda m: F.struct(m.content.alias("content"), m.role.alias("role")))), 256)


def bytes_hash(content: Column) -> Column:
    """SHA-256 of binary content in hex."""
    return F.sha2(content, 256)
