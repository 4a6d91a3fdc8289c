"""Size-checked broadcast of derived tables.

Per-era coefficient tables and rank offset tables are small by construction (one row per era, or
per partition and group), but their row count still depends on the data. ``bounded_broadcast``
materializes such a table once (persisted, so the count and the join read the same rows), counts
it and returns a broadcast hint only where rows times row width stay under the limit in bytes; above it the plain
frame is returned and the planner picks a shuffled join.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES_CONF = "spark.erascore.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
#: Assumed sizes where the schema does not tell: of a string, and of an array's or map's elements.
STRING_BYTES, ELEMENTS = 40, 4096


def type_bytes(kind: T.DataType) -> int:
    """What a value of this type takes, about; collections count as long ones."""
    if isinstance(kind, T.StructType):
        return sum(type_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return ELEMENTS * type_bytes(kind.elementType)
    if isinstance(kind, T.MapType):
        return ELEMENTS * (type_bytes(kind.keyType) + type_bytes(kind.valueType))
    return STRING_BYTES if isinstance(kind, (T.StringType, T.BinaryType)) else 8


def row_bytes(schema: T.StructType) -> int:
    return 16 + sum(type_bytes(f.dataType) for f in schema.fields)


_PERSISTED: list = []


def keep(df: DataFrame) -> DataFrame:
    """Persist (memory and disk) an intermediate the library reads more than once, and remember it
    so ``release_cached`` can free it when the caller is done with the results."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(kept)
    return kept


def release_cached() -> int:
    """Unpersist every intermediate kept by the library; returns how many were released."""
    n = len(_PERSISTED)
    while _PERSISTED:
        _PERSISTED.pop().unpersist()
    return n


def _limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_BROADCAST_BYTES_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))


def bounded_broadcast(small: DataFrame, width: int | None = None) -> DataFrame:
    """``small`` with a broadcast hint where its rows times ``width`` bytes (by the schema if None) are few enough."""
    kept = keep(small)
    n = kept.count()
    return F.broadcast(kept) if n * (width or row_bytes(small.schema)) <= _limit(small) else kept


def broadcast_if_at_most(small: DataFrame, rows: int, width: int | None = None) -> DataFrame:
    """Broadcast hint for a table whose row count is already known (e.g. one row per era, with the
    era count from ``ranking.group_stats``); no extra job."""
    return F.broadcast(small) if rows * (width or row_bytes(small.schema)) <= _limit(small) else small
