"""SHA-256 expressions over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.text import canonical_text

# Number of column hashes that are joined before they are hashed again (fixed value).
PARTS_PER_GROUP = 50


def sha256_hex(text: Column) -> Column:
    """64 upper-case hex digits."""
    return F.upper(F.sha2(text, 256))


def col_hash(c: Column, dtype: T.DataType) -> Column:
    """Hash of one value; NULL and the empty text hash alike."""
    return sha256_hex(F.coalesce(canonical_text(c, dtype), F.lit("")))


def fold_hashes(parts: Sequence[Column]) -> Column:
    """One hash out of many: groups of fifty are hashed, then the groups together."""
    if not parts:
        return sha256_hex(F.lit(""))
    groups = [
        sha256_hex(F.concat(*parts[i : i + PARTS_PER_GROUP]))
        for i in range(0, len(parts), PARTS_PER_GROUP)
    ]
    return sha256_hex(F.concat(*groups))


def key_number(parts: Sequence[tuple[Column, T.DataType]]) -> Column:
    """A 32-bit number per key, typed wide enough to be summed over any row count."""
    texts = [F.coalesce(canonical_text(c, t), F.lit("")) for c, t in parts]
    text = texts[0] if len(texts) == 1 else F.concat_ws("_", *texts)
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long").cast("decimal(20,0)")
