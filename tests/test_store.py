"""The pool store as a data source, and pools over JDBC."""

from __future__ import annotations

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from spanweave.sources import pools, store

ROWS = [("ORG" if k % 3 else "PERSON", f"name {k}" if k % 10 else f"O'Neil {k} é", k / 4 + 0.5) for k in range(500)]


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/shared/pools.db"


def tables(spark):
    return {
        "entity_pools": pools.in_memory(spark, "entity_pools", ROWS).repartition(4),
        "decoy_pools": pools.in_memory(spark, "decoy_pools", [("number", "A-1", 1.0)]),
        "templates": pools.in_memory(spark, "templates", [("{ORG} of {PERSON}", 2.0)]),
    }


def test_round_trip_in_tasks(spark, path):
    pools.to_sqlite(tables(spark), path)
    back = pools.from_sqlite(spark, path, partitions=5)
    rows = back["entity_pools"]
    assert rows.rdd.getNumPartitions() == 5
    by_task = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(by_task) == 5 and all(r["count"] == 100 for r in by_task)
    assert sorted(map(tuple, rows.collect())) == sorted(ROWS)
    assert rows.schema.simpleString() == "struct<entity_type:string,value:string,weight:double>"


def test_writing_again_changes_nothing(spark, path):
    for _ in range(2):
        pools.to_sqlite(tables(spark), path)
    pools.to_sqlite({"entity_pools": pools.in_memory(spark, "entity_pools", [("ORG", "name 1", 99.0), ("ORG", "new", 1.0)])}, path)
    back = pools.from_sqlite(spark, path)["entity_pools"]
    assert back.count() == 501 and back.filter("value = 'name 1'").first().weight == 0.75
    pools.to_sqlite({"entity_pools": pools.in_memory(spark, "entity_pools", ROWS[:7])}, path, overwrite=True)
    assert {k: v.count() for k, v in pools.from_sqlite(spark, path).items()} == {"entity_pools": 7, "decoy_pools": 1, "templates": 1}


def test_a_failed_job_leaves_the_store_as_it_was(spark, path, tmp_path):
    pools.to_sqlite(tables(spark), path)
    bad = tables(spark)["entity_pools"].withColumn("value", F.when(F.col("value") == "name 77", F.raise_error(F.lit("no"))).otherwise(F.concat("value", F.lit("x"))))
    with pytest.raises(Exception, match="no"):
        pools.to_sqlite({"entity_pools": bad}, path, overwrite=True)
    assert pools.from_sqlite(spark, path)["entity_pools"].count() == 500
    assert [p.name for p in (tmp_path / "shared").iterdir()] == ["pools.db"]
    with pytest.raises(ValueError, match="slot_name"):
        store.PoolStore({"path": path, "table": "decoy_pools"}).writer(tables(spark)["templates"].schema, False)



FILTERS = (
    "entity_type = 'ORG'", "value IN ('name 1', 'name 2', 'absent')", "weight > 100 AND weight <= 110.5", "value LIKE 'name 4%'", "value LIKE '%7'", "value LIKE '%ei%'", "value LIKE 'NAME 4%'",
    "weight IS NULL", "value IS NOT NULL AND weight < 1", "entity_type <> 'ORG'", "value = 'O\\'Neil 10 é'", "length(value) = 6", "value LIKE '%'", "entity_type = 'ORG' OR weight = 0.5",
)


def test_filters_are_pushed_and_keep_their_meaning(spark, path):
    pools.to_sqlite(tables(spark), path)
    rows, plain = pools.from_sqlite(spark, path, partitions=2)["entity_pools"], pools.in_memory(spark, "entity_pools", ROWS)
    for f in FILTERS:
        assert sorted(map(tuple, rows.filter(f).collect())) == sorted(map(tuple, plain.filter(f).collect())), f
    reader = store.Reader(path, "entity_pools", 1)
    from pyspark.sql.datasource import EqualTo, In, Not

    left = list(reader.pushFilters([EqualTo(("entity_type",), "PERSON"), In(("value",), ("name 3", "name 4")), Not(EqualTo(("value",), "x")), EqualTo(("other",), 1)]))
    assert len(left) == 2 and [tuple(r) for p in reader.partitions() for r in reader.read(p)] == [("PERSON", "name 3", 1.25)]


def test_an_empty_store_and_none(spark, path, tmp_path):
    pools.build_sqlite(path, [])
    assert all(df.count() == 0 for df in pools.from_sqlite(spark, path).values())
    with pytest.raises(FileNotFoundError):
        pools.from_sqlite(spark, f"{tmp_path}/absent.db")


def test_dump_is_ordered_json(spark, tmp_path):
    t = tables(spark)
    pools.dump(t["entity_pools"], t["decoy_pools"], f"{tmp_path}/d.json")
    told = json.loads((tmp_path / "d.json").read_text())
    assert sorted((k, v, w) for k, rows in told["entity_pools"].items() for v, w in rows) == sorted(ROWS)
    pools.dump(t["entity_pools"].limit(0), t["decoy_pools"], f"{tmp_path}/e.json")
    assert json.loads((tmp_path / "e.json").read_text()) == {"entity_pools": {}, "decoy_pools": {"number": [["A-1", 1.0]]}}


def test_jdbc_reads_in_partitions(spark, tmp_path):
    """Against the database that comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/derby"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    for name, df in tables(spark).items():
        df.write.option("driver", driver).option("createTableColumnTypes", ", ".join(f"{c} VARCHAR(200)" for c in store.columns(name)[:-1])).jdbc(f"{url};create=true", name)
    back = pools.from_jdbc(spark, url, partitions=4, driver=driver)
    assert back["entity_pools"].rdd.getNumPartitions() == 4
    assert sorted(map(tuple, back["entity_pools"].collect())) == sorted(ROWS)
    assert {k: v.count() for k, v in back.items()} == {"entity_pools": 500, "decoy_pools": 1, "templates": 1}
    plan = back["entity_pools"].filter("weight > 100")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan" in plan


def test_store_is_plain_sqlite(spark, path):
    pools.to_sqlite(tables(spark), path)
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*) FROM entity_pools WHERE entity_type = 'ORG'").fetchone()[0] == sum(r[0] == "ORG" for r in ROWS)
