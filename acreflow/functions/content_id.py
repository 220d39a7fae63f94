"""Content identifiers: CIDv1, SHA-256, base32.  ``content_id`` is that of a single raw block; ``sources.artifacts`` has files."""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Version 1, raw codec, SHA-256, 32 bytes.
PREFIX = bytes([0x01, 0x55, 0x12, 0x20])


def identifier(prefix: bytes, digest: bytes) -> str:
    return "b" + base64.b32encode(prefix + digest).decode().lower().rstrip("=")


def cid_of_digest(sha256_hex: str | None) -> str | None:
    return None if sha256_hex is None else identifier(PREFIX, bytes.fromhex(sha256_hex))


@F.pandas_udf(StringType())
def _cids(digests: pd.Series) -> pd.Series:
    return digests.map(cid_of_digest)


def content_id(sha256_hex: Column) -> Column:
    """The identifier of the content with this digest; one row for each file, so the Python hop is small."""
    return _cids(sha256_hex)
