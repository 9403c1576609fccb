"""Join helpers: a broadcast that is only taken behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# Largest side we ever ship to every executor: at most this many rows and
# at most this many (estimated) bytes.  Beyond either, the shuffle join is
# the safer plan.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

ROW_OVERHEAD = 32     # hash relation entry


def row_bytes(schema: T.StructType) -> F.Column:
    """Measured bytes of a row: the length of every string and binary, 16 for
    any other flat value, the JSON text for nested ones."""
    size = F.lit(ROW_OVERHEAD)
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            part = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            part = F.octet_length(F.to_json(F.struct(c)))
        else:
            part = F.lit(16)
        size = size + F.coalesce(part, F.lit(8))
    return size


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Unlike ``localCheckpoint`` the files outlive any single executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES):
    """Return ``(side, broadcast_taken)``.

    The side is checkpointed once (so it is not recomputed by the join) and
    counted and measured from that stored copy; it gets the broadcast hint
    only within both ``max_rows`` and ``max_bytes``.  Otherwise the caller's
    join stays a shuffle join (AQE may still split skewed partitions).
    """
    side = materialize(small)
    rows, size = side.agg(F.count(F.lit(1)), F.sum(row_bytes(side.schema))).first()
    if rows <= max_rows and (size or 0) <= max_bytes:
        return F.broadcast(side), True
    return side, False
