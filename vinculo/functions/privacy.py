"""Keyed pseudonyms (HMAC-SHA256) built from Spark's own digest functions.

The padded keys come from a one-row table by a scalar subquery, so that plans and event logs do not show them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_BLOCK_BYTES = 64


def _padded_keys(salt: str) -> tuple[bytes, bytes]:
    key = salt.encode("utf-8")
    if len(key) > _BLOCK_BYTES:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK_BYTES, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def _pads(salt: str) -> tuple[Column, Column]:
    """Both padded keys, each as the value of a one-row table."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    tables = (spark.createDataFrame([(pad,)], "pad binary") for pad in map(bytearray, _padded_keys(salt)))
    inner, outer = (table.scalar() for table in tables)
    return inner, outer


def keyed_hash(value: Column, salt: str) -> Column:
    """Hex HMAC-SHA256 of the trimmed value; blank gives the empty string, null stays null."""
    if not salt:
        raise ValueError("a salt is required to pseudonymise identifiers")
    inner, outer = _pads(salt)
    trimmed = F.trim(value)
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(trimmed, "UTF-8")), 256))
    tag = F.sha2(F.concat(outer, digest), 256)
    return F.when(trimmed == "", "").otherwise(tag)


def salt_fingerprint(salt: str) -> str:
    """SHA-256 of the salt, recorded to tell whether two outputs share it."""
    return hashlib.sha256(salt.encode("utf-8")).hexdigest()
