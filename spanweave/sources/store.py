"""Pool stores as a Spark data source: partitioned reads, pushed filters, writes that can be repeated.

    register(spark)
    spark.read.format("pool_store").option("path", p).option("table", "entity_pools").load()
    df.write.format("pool_store").option("path", p).option("table", "entity_pools").mode("append").save()

A store is an SQLite file in a folder that driver and executors share. A read takes ranges of row numbers, one a
task, in tasks; conditions on columns become conditions of the statement. A write stages the rows of every task in a
file of its own beside the store, which the commit adds in one transaction; rows that are there already stay as they
are, so a job that is run again, or a task that runs twice, changes nothing. Overwriting empties the table in the same
transaction; an aborted job leaves the store as it was.
"""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Iterable, Iterator
from contextlib import closing
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
    LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: The three tables and their columns.
TABLES = {
    "entity_pools": "entity_type string, value string, weight double",
    "decoy_pools": "slot_name string, value string, weight double",
    "templates": "template string, weight double",
}
#: Rows that one task reads, unless the option partitions says otherwise.
ROWS_PER_TASK = 100_000
BATCH = 1_000
_COMPARED = {EqualTo: "=", EqualNullSafe: "IS", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def columns(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].split(", ")]


def create(db: sqlite3.Connection, tables: Iterable[str] = tuple(TABLES)) -> None:
    """Make the tables that are not there; all but the weight is what a row is known by."""
    kinds = {"string": "TEXT", "double": "REAL"}
    for name in tables:
        pairs = [c.split() for c in TABLES[name].split(", ")]
        made = ", ".join(f"{c} {kinds[t]} NOT NULL" + (" DEFAULT 1" if c == "weight" else "") for c, t in pairs)
        db.execute(f"CREATE TABLE IF NOT EXISTS {name} ({made}, UNIQUE ({', '.join(columns(name)[:-1])}))")


def _opened(path: str) -> closing[sqlite3.Connection]:
    """A connection that only reads."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    return closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True))


def condition(f: Filter, known: list[str]) -> tuple[str, list] | None:
    """A filter as a condition with its values, or None if it cannot be one."""
    column = ".".join(f.attribute) if hasattr(f, "attribute") else None
    if column not in known:
        return None
    value = getattr(f, "value", None)
    if type(f) in _COMPARED and isinstance(value, (str, int, float, type(None))):
        return f"{column} {_COMPARED[type(f)]} ?", [value]
    if isinstance(f, In) and all(isinstance(v, (str, int, float)) for v in f.value):
        return f"{column} IN ({', '.join('?' * len(f.value))})", list(f.value)
    if isinstance(f, (IsNull, IsNotNull)):
        return f"{column} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []
    # with upper and lower case apart, unlike LIKE
    if isinstance(f, StringStartsWith):
        return f"substr({column}, 1, length(?)) = ?", [value, value]
    if isinstance(f, StringEndsWith):
        return f"(length(?) = 0 OR substr({column}, -length(?)) = ? AND length({column}) >= length(?))", [value] * 4
    if isinstance(f, StringContains):
        return f"instr({column}, ?) > 0", [value]
    return None


@dataclass
class Rows(InputPartition):
    """Row numbers low to high - 1."""

    low: int
    high: int


class Reader(DataSourceReader):
    def __init__(self, path: str, table: str, partitions: int | None) -> None:
        self.path, self.table, self.wanted = path, table, partitions
        self.conditions: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            made = condition(f, columns(self.table))
            if made is None:
                yield f
            else:
                self.conditions.append(made)

    def partitions(self) -> list[InputPartition]:
        with _opened(self.path) as db:
            low, high, n = db.execute(f"SELECT min(rowid), max(rowid), count(*) FROM {self.table}").fetchone()
        if not n:
            return [Rows(0, 0)]
        parts = min(self.wanted or -(-n // ROWS_PER_TASK), high - low + 1)
        cuts = [low + (high - low + 1) * k // parts for k in range(parts + 1)]
        return [Rows(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]

    def read(self, partition: Rows) -> Iterator[tuple]:
        tests = " AND ".join(["rowid >= ? AND rowid < ?", *(c for c, _ in self.conditions)])
        values = [partition.low, partition.high, *(v for _, vs in self.conditions for v in vs)]
        with _opened(self.path) as db:
            yield from db.execute(f"SELECT {', '.join(columns(self.table))} FROM {self.table} WHERE {tests}", values)


@dataclass
class Staged(WriterCommitMessage):
    path: str


class Writer(DataSourceWriter):
    def __init__(self, path: str, table: str, overwrite: bool) -> None:
        self.path, self.table, self.overwrite, self.job = path, table, overwrite, uuid.uuid4().hex

    def _stage(self) -> Path:
        return Path(f"{self.path}.{self.job}.staged")

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        names = columns(self.table)
        self._stage().mkdir(parents=True, exist_ok=True)
        target = self._stage() / uuid.uuid4().hex
        with closing(sqlite3.connect(target)) as db:
            create(db, [self.table])
            wait: list[tuple] = []
            put = f"INSERT OR IGNORE INTO {self.table} ({', '.join(names)}) VALUES ({', '.join('?' * len(names))})"
            for row in iterator:
                wait.append(tuple(row[c] for c in names))
                if len(wait) == BATCH:
                    db.executemany(put, wait)
                    wait = []
            db.executemany(put, wait)
            db.commit()
        return Staged(str(target))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        Path(self.path).parent.mkdir(parents=True, exist_ok=True)
        names = ", ".join(columns(self.table))
        with closing(sqlite3.connect(self.path, isolation_level=None)) as db:
            create(db)
            for k, m in enumerate(m for m in messages if m):
                # sqlite attaches ten files at most, and none within a transaction: each is copied aside first
                db.execute("ATTACH ? AS staged", (m.path,))
                db.execute(f"CREATE TEMP TABLE new_{k} AS SELECT {names} FROM staged.{self.table}")
                db.execute("DETACH staged")
            db.execute("BEGIN IMMEDIATE")
            if self.overwrite:
                db.execute(f"DELETE FROM {self.table}")
            for k in range(len([m for m in messages if m])):
                db.execute(f"INSERT OR IGNORE INTO {self.table} ({names}) SELECT {names} FROM new_{k}")
            db.execute("COMMIT")
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        if self._stage().exists():
            for f in self._stage().iterdir():
                f.unlink()
            self._stage().rmdir()


class PoolStore(DataSource):
    """Options: path, table, and for reading partitions."""

    @classmethod
    def name(cls) -> str:
        return "pool_store"

    def schema(self) -> str:
        return TABLES[self.options["table"]]

    def reader(self, schema: StructType) -> DataSourceReader:
        n = self.options.get("partitions")
        return Reader(self.options["path"].removeprefix("file://"), self.options["table"], int(n) if n else None)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if missing := set(columns(self.options["table"])) - set(schema.fieldNames()):
            raise ValueError(f"columns are missing: {sorted(missing)}")
        return Writer(self.options["path"].removeprefix("file://"), self.options["table"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PoolStore)
