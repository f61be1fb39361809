"""Hash keys and the stable hash split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def sha256_hex(col) -> Column:
    """SHA-256 of the value's text form, as 64 hex characters."""
    return F.sha2(_c(col).cast("string"), 256)


def sha256_bytes(col) -> Column:
    """SHA-256 digest of the value's text form, 32 bytes."""
    return F.unhex(sha256_hex(col))


def hash_split(key, seed: int = 42, train_share_256: int = 204) -> Column:
    """True for the training part: first byte of sha256(seed:key) below the share.

    A function of the key alone, so stable under any partitioning and portable
    to other engines (unlike ``randomSplit``).
    """
    prefix = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")), 256), 1, 2)
    return prefix < F.lit(format(train_share_256, "02x"))
