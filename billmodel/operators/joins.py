"""Size-checked broadcast for lookup tables derived from the bill.

A dimension derived from the bill (e.g. EMR cluster names) grows with the data,
slowly. It is broadcast only if its measured size in bytes is within a bound;
beyond that the caller takes a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

DEFAULT_BROADCAST_BYTES = 64 << 20
# Session setting that overrides the default bound (no code change needed).
BROADCAST_BYTES_CONF = "spark.billmodel.emrBroadcastBytes"
#: Bytes that a row of a broadcast table takes besides its texts.
ROW_BYTES = 48


def broadcast_bound(df: DataFrame, max_bytes: int | None) -> int:
    """``max_bytes`` if given, else the session setting, else the default."""
    if max_bytes is not None:
        return max_bytes
    value = df.sparkSession.conf.get(BROADCAST_BYTES_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_BYTES


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a table of texts (and arrays of texts) is within the bound (one
    small job)."""
    width = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        text = F.array_join(f.name, "") if isinstance(f.dataType, ArrayType) else F.col(f.name)
        count = F.size(f.name) * ROW_BYTES if isinstance(f.dataType, ArrayType) else F.lit(0)
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + count
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= broadcast_bound(df, max_bytes)
