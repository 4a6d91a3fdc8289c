"""A Spark data source for dataset releases (S1, S11): versions, roles, eras.

A release is a folder ``<path>/<version>`` with a table for each role, ``<role>.parquet``: a Parquet file, or a folder of them that
may be partitioned into ``era=<n>`` folders. ::

    register(spark)
    spark.read.format("erascore_release").option("version", "v5").option("roles", "train,live").load(path).where("era >= 100")

Rows have the tables' columns and ``dataset``, their role; NaN in features and targets is NULL. Filters on ``era`` choose what is
read: era folders by name, other files by the least and greatest era of each row group. A task reads one file or row group
in batches. A schema given by the user chooses the columns that are read.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

from .readers import ROLE_FILES

NAME = "erascore_release"
_ERA = re.compile(r"/era=([^/]+)/")
_COMPARE = {EqualTo: operator.eq, EqualNullSafe: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge,
            LessThan: operator.lt, LessThanOrEqual: operator.le}


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it push filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ReleaseSource)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _files(path: str, version: str, role: str) -> list[str]:
    """The data files of a role, in order; FileNotFoundError where there is no such table."""
    from pyarrow import fs

    system, root = _open(f"{path.rstrip('/')}/{version}/{ROLE_FILES.get(role, role)}.parquet")
    kind = system.get_file_info(root).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(f"release {version} has no table {role} under {path}")
    if kind == fs.FileType.File:
        return [root]
    inside = system.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = re.compile(r"/[._]")
    return sorted(x.path for x in inside if x.type == fs.FileType.File and not hidden.search(x.path[len(root):]))


def _era_of(file: str) -> int | str | None:
    found = _ERA.search(file)
    return None if not found else int(found[1]) if found[1].isdigit() else found[1]


def may_hold(filters: Iterable[Filter], low, high) -> bool:
    """Whether a stretch of eras from ``low`` to ``high`` may hold one that passes all filters on the era."""
    for f in filters:
        if isinstance(f, In):
            passes = any(low <= v <= high for v in f.value if v is not None)
        elif isinstance(f, (EqualTo, EqualNullSafe)):
            passes = f.value is not None and low <= f.value <= high
        else:
            passes = _COMPARE[type(f)](high if isinstance(f, (GreaterThan, GreaterThanOrEqual)) else low, f.value)
        if not passes:
            return False
    return True


@dataclass
class Piece(InputPartition):
    role: str
    file: str
    row_group: int | None = None


class ReleaseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _roles(self) -> list[str]:
        return [r.strip() for r in self.options.get("roles", "train,validation,live").split(",") if r.strip()]

    def schema(self) -> T.StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        system, _ = _open(self.options["path"])
        for role in self._roles():
            for file in _files(self.options["path"], self.options["version"], role):
                own = from_arrow_schema(pq.read_schema(file, filesystem=system))
                fields, era = [f for f in own.fields if f.name != "dataset"], _era_of(file)
                if era is not None and "era" not in own.names:
                    fields.append(T.StructField("era", T.IntegerType() if isinstance(era, int) else T.StringType()))
                return T.StructType([*fields, T.StructField("dataset", T.StringType())])
        raise FileNotFoundError(f"release {self.options['version']} is empty")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ReleaseReader(self.options["path"], self.options["version"], self._roles(), schema)


class ReleaseReader(DataSourceReader):
    def __init__(self, path: str, version: str, roles: list[str], schema: T.StructType):
        self.path, self.version, self.roles, self.schema, self.filters = path, version, roles, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Those on the era choose what is read; Spark still applies all of them to the rows."""
        for f in filters:
            if type(f) in (*_COMPARE, In) and f.attribute == ("era",):
                self.filters.append(f)
            yield f

    def partitions(self) -> list[Piece]:
        import pyarrow.parquet as pq

        system, _ = _open(self.path)
        found = []
        for role in self.roles:
            for file in _files(self.path, self.version, role):
                era = _era_of(file)
                if era is not None:
                    if may_hold(self.filters, era, era):
                        found.append(Piece(role, file))
                    continue
                meta = pq.read_metadata(file, filesystem=system)
                column = next((i for i, c in enumerate(meta.schema.to_arrow_schema().names) if c == "era"), None)
                for g in range(meta.num_row_groups):
                    stats = None if column is None else meta.row_group(g).column(column).statistics
                    if stats is None or not stats.has_min_max or may_hold(self.filters, stats.min, stats.max):
                        found.append(Piece(role, file, g))
        return found

    def read(self, partition: Piece) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # nothing to read
            return
        system, _ = _open(self.path)
        wanted, era = to_arrow_schema(self.schema), _era_of(partition.file)
        with system.open_input_file(partition.file) as raw:
            table = pq.ParquetFile(raw)
            own = [n for n in wanted.names if n in table.schema_arrow.names and n != "dataset"]
            groups = None if partition.row_group is None else [partition.row_group]
            for batch in table.iter_batches(columns=own, row_groups=groups):
                columns = []
                for field in wanted:
                    if field.name == "dataset":
                        column = pa.array([partition.role] * batch.num_rows, field.type)
                    elif field.name in own:
                        column = batch.column(own.index(field.name))
                        if pa.types.is_floating(column.type) and field.name.startswith(("feature", "target")):
                            column = pc.if_else(pc.is_nan(column), pa.scalar(None, column.type), column)
                        column = column.cast(field.type)
                    else:
                        column = pa.array([era if field.name == "era" else None] * batch.num_rows, field.type)
                    columns.append(column)
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)
