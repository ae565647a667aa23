"""Value pools and templates: reading, checking, dumping and emitting them."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.operators.templates import template_slots
from spanweave.schema import ENTITY_TYPES
from spanweave.sources.store import TABLES, columns, create, register

ROWS_PER_INSERT = 200


def pool_table(entity_pools: DataFrame, decoy_pools: DataFrame) -> DataFrame:
    """(pool, value, weight) over both kinds, as the template operators take it."""
    decoys = decoy_pools.select(F.concat(F.lit("decoy:"), "slot_name").alias("pool"), "value", "weight")
    return entity_pools.select(F.col("entity_type").alias("pool"), "value", "weight").unionByName(decoys)


def in_memory(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """One of the tables from Python rows; unknown entity types are refused."""
    if name == "entity_pools" and (unknown := {r[0] for r in rows} - set(ENTITY_TYPES)):
        raise ValueError(f"unknown entity types {sorted(unknown)}")
    return spark.createDataFrame(rows, TABLES[name])


def check(entity_pools: DataFrame, templates: DataFrame) -> None:
    """Every entity type and the templates must have rows."""
    have = {r[0] for r in entity_pools.filter(F.col("entity_type").isin(*ENTITY_TYPES)).select("entity_type").distinct().collect()}  # four at most
    if missing := set(ENTITY_TYPES) - have:
        raise ValueError(f"empty pools: {sorted(missing)}")
    if templates.isEmpty():
        raise ValueError("no templates")


def seed_breaches(entity_pools: DataFrame, decoy_pools: DataFrame, templates: DataFrame, decoy_slots: tuple[str, ...]) -> DataFrame:
    """(breach, subject) of every breach of the contract between pools and templates.

    decoy_slots are the declared ones: each needs values, and there are no others. Every slot of a template
    must name an entity type or a decoy with values; a decoy without a name is a breach of its own.
    """
    spark = templates.sparkSession
    named = lambda breach, df: df.select(F.lit(breach).alias("breach"), F.col(df.columns[0]).alias("subject")).distinct()
    types, declared = spark.createDataFrame([(t,) for t in ENTITY_TYPES], "entity_type string"), spark.createDataFrame([(s,) for s in decoy_slots], "slot_name string")
    slots = template_slots(templates.select("template").distinct())
    unknown = slots.filter("sub <> ''").join(decoy_pools.select(F.col("slot_name").alias("sub")).distinct(), "sub", "left_anti")
    parts = (
        named("empty entity pool", types.join(entity_pools.select("entity_type"), "entity_type", "left_anti")),
        named("missing decoy pool", declared.join(decoy_pools.select("slot_name"), "slot_name", "left_anti")),
        named("undeclared decoy pool", decoy_pools.select("slot_name").join(F.broadcast(declared), "slot_name", "left_anti")),
        named("no templates", templates.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("").alias("subject"))),
        named("decoy without a name", slots.filter("sub = ''").select("template")),
        named("unknown decoy", unknown.select(F.concat_ws(": ", "sub", "template").alias("subject"))),
        named("unknown entity type", slots.filter(F.col("sub").isNull() & ~F.col("entity_type").isin(*ENTITY_TYPES)).select(F.concat_ws(": ", "entity_type", "template").alias("subject"))),
    )
    return reduce(DataFrame.unionByName, parts)


def seed_contract(entity_pools: DataFrame, decoy_pools: DataFrame, templates: DataFrame, decoy_slots: tuple[str, ...]) -> dict[str, object]:
    """The counts of values by pool and of templates; ValueError that names every breach.

    What comes back to the driver is one row a pool and the breaches of hand-kept lists.
    """
    errors = sorted(f"{r.breach}: {r.subject}" for r in seed_breaches(entity_pools, decoy_pools, templates, decoy_slots).collect())
    if errors:
        raise ValueError("the seed breaks its contract:\n" + "\n".join(errors))
    count = lambda df, key: {r[0]: r[1] for r in df.groupBy(key).agg(F.count_distinct("value")).collect()}
    return {"entity_pools": count(entity_pools, "entity_type"), "decoy_pools": count(decoy_pools, "slot_name"), "templates": templates.select("template").distinct().count()}


def build_sqlite(path: str, sql_files: list[str]) -> Path:
    """A fresh SQLite file with the three tables, and the statements of SQL files run in their order."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.unlink(missing_ok=True)
    with sqlite3.connect(target) as db:
        create(db)
        for file in sql_files:
            db.executescript(Path(file).read_text())
    return target


def from_sql_files(spark: SparkSession, path: str, sql_files: list[str], folder: str | None = None) -> dict[str, DataFrame]:
    """The tables that SQL files make; with folder, stored there as Parquet and read from it."""
    tables = from_sqlite(spark, str(build_sqlite(path, sql_files)))
    if folder is None:
        return tables
    to_parquet(tables, folder)
    return from_parquet(spark, folder)


def from_jdbc(spark: SparkSession, url: str, partitions: int = 1, **options: str) -> dict[str, DataFrame]:
    """The tables of a database, by JDBC; needed columns only, filters are pushed down.

    partitions: tasks that read a table, each the rows whose first text column has a length of one remainder. The
    expression is of the SQL standard, so that every database takes it.
    """

    def tables() -> Iterator[tuple[str, DataFrame]]:
        for name in TABLES:
            text = columns(name)[-2]
            parts = [f'MOD(LENGTH("{text}"), {partitions}) = {k}' for k in range(partitions)]
            yield name, spark.read.jdbc(url, name, predicates=parts, properties=options).toDF(*columns(name))

    return dict(tables())


def from_sqlite(spark: SparkSession, path: str, partitions: int | None = None) -> dict[str, DataFrame]:
    """The tables of an SQLite file in a shared folder, read in tasks with pushed filters."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    register(spark)
    reader = spark.read.format("pool_store").option("path", path)
    return {k: (reader.option("partitions", partitions) if partitions else reader).option("table", k).load() for k in TABLES}


def to_sqlite(tables: dict[str, DataFrame], path: str, overwrite: bool = False) -> None:
    """Add the rows that an SQLite file in a shared folder does not have yet, or replace its tables."""
    for k, df in tables.items():
        register(df.sparkSession)
        df.select(*columns(k)).write.format("pool_store").option("path", path).option("table", k).mode("overwrite" if overwrite else "append").save()


def from_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {k: spark.read.schema(v).parquet(f"{folder}/{k}") for k, v in TABLES.items()}


def to_parquet(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Replace the stored tables; the row counts."""
    for k, df in tables.items():
        df.select(*columns(k)).write.mode("overwrite").parquet(f"{folder}/{k}")
    return {k: df.count() for k, df in tables.items()}


def dump(entity_pools: DataFrame, decoy_pools: DataFrame, path: str) -> None:
    """{table: {pool: [[value, weight]]}} as one JSON file, written row by row in the order of pools and values."""
    text = lambda x: json.dumps(x, ensure_ascii=False)
    with Path(path).open("w") as out:
        for t, (name, df, key) in enumerate((("entity_pools", entity_pools, "entity_type"), ("decoy_pools", decoy_pools, "slot_name"))):
            out.write(("{" if t == 0 else ", ") + f"{text(name)}: {{")
            before = None
            for pool, value, weight in df.select(key, "value", "weight").orderBy(key, "value").toLocalIterator():
                out.write(", " if pool == before else f"{'' if before is None else '], '}{text(pool)}: [")
                out.write(text([value, weight]))
                before = pool
            out.write("}" if before is None else "]}")
        out.write("}")


def insert_statements(name: str, df: DataFrame, dialect: str = "sqlite") -> Iterator[str]:
    """Multi-row INSERTs that skip rows already there, for SQLite or Postgres."""
    names = columns(name)
    head, tail = ("INSERT OR IGNORE INTO", ";") if dialect == "sqlite" else ("INSERT INTO", " ON CONFLICT DO NOTHING;")
    quoted = lambda v: str(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"
    wait: list[str] = []
    for r in df.select(*names).toLocalIterator():
        wait.append("(" + ", ".join(map(quoted, r)) + ")")
        if len(wait) == ROWS_PER_INSERT:
            yield f"{head} {name} ({', '.join(names)}) VALUES\n" + ",\n".join(wait) + tail
            wait = []
    if wait:
        yield f"{head} {name} ({', '.join(names)}) VALUES\n" + ",\n".join(wait) + tail
