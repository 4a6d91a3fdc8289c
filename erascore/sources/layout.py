"""Co-partitioned era tables: rows bucketed by era and sorted by (era, a column), so that per-era work on them moves nothing.

The files are Parquet at a path of the caller's; a table over them is registered with the session's catalog, which is what tells
the planner of the buckets. A session with a catalog of its own registers them anew by ``open_era_table``. Every era lies in one
bucket, so a metric over an era reads one file set without an exchange; the largest era must fit a task, as with any
window by era (``ranking`` measures that, and takes its skew-safe plan where it does not).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions

_NOTE = "_era_table"  # beside the data; names that begin so are not read as data


def write_era_table(df: DataFrame, path: str, era: str = "era", order: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` (the session's shuffle partitions where None) by era, sorted by era and ``order``,
    one file for each, and open it. An existing table at the path is replaced."""
    spark, path = df.sparkSession, path.rstrip("/")
    buckets = buckets or shuffle_partitions(spark)
    name = f"era_table_{uuid.uuid4().hex[:12]}"
    # the writer's tasks are the buckets, so there is one file in each
    spread = df.repartition(buckets, F.col(era))
    (spread.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, era).sortBy(era, *order).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay: a table with a path is external
    note = json.dumps({"schema": json.loads(df.schema.json()), "era": era, "order": list(order), "buckets": buckets})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_NOTE}")
    return open_era_table(spark, path)


def open_era_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, known to the planner as bucketed and sorted."""
    path = path.rstrip("/")
    note = json.loads(spark.read.text(f"{path}/{_NOTE}").first()["value"])
    schema = T.StructType.fromJson(note["schema"])
    name = f"era_table_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by, order = f"`{note['era']}`", ", ".join(f"`{c}`" for c in (note["era"], *note["order"]))
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) INTO {note['buckets']} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)
