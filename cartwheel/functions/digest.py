"""Content digests and content-address keys (A6) as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_fingerprint(columns: Sequence[str], sep: str = "|", doubles: Sequence[str] = ()) -> Column:
    """Text form of a row (columns as text joined by ``sep``) for hashing; ``doubles`` with twelve decimals, so
    that engines which print doubles differently agree."""
    text = lambda c: F.col(c).cast("decimal(38,12)").cast("string") if c in doubles else F.col(c).cast("string")
    return F.concat_ws(sep, *[text(c) for c in columns])


def content_address(md5_hex: Column, prefix: str = "files/md5/") -> Column:
    """``files/md5/<first two hex digits>/<rest>``."""
    return F.concat(F.lit(prefix), F.substring(md5_hex, 1, 2), F.lit("/"), F.substring(md5_hex, 3, 30))
