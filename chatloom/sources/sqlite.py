"""SQLite tables as a Spark data source, read-only, split into parts of about as many rows.

Splits follow the row id, or the first column of the primary key where a table has none. They are
found by seeks alone: the range of numbers is halved again and again, each half narrowed to the
numbers that are there, the widest first, so gaps go; what is left is cut at equal widths. The
first and the last part are open, so no row is outside all parts, whatever its key is.
"""

from __future__ import annotations

import heapq
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

_TYPES = {"INTEGER": "long", "INT": "long", "TEXT": "string", "REAL": "double", "BLOB": "binary"}


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


#: Ranges without large gaps that a part of the table is looked at in.
RANGES = 64


class _Rows(InputPartition):
    """Keys from ``lo`` and under ``hi``; None is open."""

    def __init__(self, key: str | None, lo: int | None, hi: int | None) -> None:
        super().__init__((key, lo, hi))
        self.key, self.lo, self.hi = key, lo, hi


def _key(c: sqlite3.Connection, table: str) -> str | None:
    """What splits a table: its row id, or the first column of its primary key; None for views without either."""
    try:
        c.execute(f'select rowid from "{table}" limit 1')
        return "rowid"
    except sqlite3.OperationalError:
        columns = c.execute(f'pragma table_info("{table}")').fetchall()
        return next((f'"{x[1]}"' for x in columns if x[5] == 1), None)


def _cuts(c: sqlite3.Connection, table: str, key: str, parts: int) -> list[int]:
    """Up to ``parts - 1`` keys that cut the table's whole-number keys into parts of about as many."""

    def inside(lo: int, hi: int) -> tuple[int, int] | None:
        """The least and the greatest key of a range, by two seeks."""
        ends = [c.execute(f'select {key} from "{table}" where {key} between ? and ? order by {key} {way} limit 1', (lo, hi)).fetchone() for way in ("asc", "desc")]
        return (int(ends[0][0]), int(ends[1][0])) if ends[0] else None

    whole = inside(-(2**63), 2**63 - 1)
    if whole is None:
        return []
    heap = [(whole[0] - whole[1], *whole)]
    while len(heap) < RANGES * parts and heap[0][0]:
        _, lo, hi = heapq.heappop(heap)
        middle = (lo + hi) // 2
        for found in (inside(lo, middle), inside(middle + 1, hi)):
            if found:
                heapq.heappush(heap, (found[0] - found[1], *found))
    ranges = sorted((lo, hi) for _, lo, hi in heap)
    total, cuts, before = sum(hi - lo + 1 for lo, hi in ranges), [], 0
    for lo, hi in ranges:
        while len(cuts) < parts - 1 and (at := (len(cuts) + 1) * total // parts) < before + hi - lo + 1:
            cuts.append(lo + at - before)
        before += hi - lo + 1
    return sorted(set(cuts) - {whole[0]})


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.table = options["path"], options["table"]
        self.parts = int(options.get("partitions", "4"))
        self.names = schema.fieldNames()
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a column with numbers or texts go into the SQL; Spark keeps the others."""
        signs = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            values = list(f.value) if isinstance(f, In) else [f.value] if type(f) in signs else []
            if name not in self.names or any(type(v) not in (int, str) for v in values):
                yield f
            elif isinstance(f, IsNotNull):
                self.where.append(f'"{name}" is not null')
            elif isinstance(f, In) and values:
                self.where.append(f'"{name}" in ({", ".join("?" * len(values))})')
                self.values += values
            elif type(f) in signs:
                self.where.append(f'"{name}" {signs[type(f)]} ?')
                self.values += values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        with _connect(self.path) as c:
            key = _key(c, self.table)
            cuts = _cuts(c, self.table, key, self.parts) if key else []
        return [_Rows(key, lo, hi) for lo, hi in zip([None, *cuts], [*cuts, None], strict=True)]

    def read(self, partition: _Rows) -> Iterator[tuple]:
        columns = ", ".join(f'"{n}"' for n in self.names)
        ends = [(f"{partition.key} {sign} ?", end) for sign, end in ((">=", partition.lo), ("<", partition.hi)) if end is not None]
        c = _connect(self.path)
        try:
            where = " and ".join([*(w for w, _ in ends), *self.where]) or "true"
            yield from c.execute(f'select {columns} from "{self.table}" where {where}', (*(end for _, end in ends), *self.values))
        finally:
            c.close()


class SQLiteSource(DataSource):
    """Options: ``path``, ``table``, and ``partitions``."""

    @classmethod
    def name(cls) -> str:
        return "chat_sqlite"

    def schema(self) -> str:
        with _connect(self.options["path"]) as c:
            columns = c.execute(f'pragma table_info("{self.options["table"]}")').fetchall()
        return ", ".join(f"`{c[1]}` {_TYPES.get((c[2] or 'TEXT').upper().split('(')[0], 'string')}" for c in columns)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


def tables(path: str) -> set[str]:
    with _connect(path) as c:
        return {r[0] for r in c.execute("select name from sqlite_master where type = 'table'")}


def read(spark: SparkSession, path: str, table: str, partitions: int = 4) -> DataFrame:
    """A table; simple filters run inside SQLite where the session allows them to be pushed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SQLiteSource)
    return spark.read.format("chat_sqlite").options(path=path, table=table, partitions=str(partitions)).load()


def label_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """User labels with a name, in their order; none where the tables are missing."""
    if "labels" not in tables(path):
        return spark.createDataFrame([], "_id long, label_name string, type long, sort_id long")
    return read(spark, path, "labels").filter("type = 0 and label_name <> ''").orderBy("sort_id", "label_name")
