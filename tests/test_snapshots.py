"""Partition-pruned changes: only touched partitions are rewritten, the others keep their files."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import bag
from ambertill.operators import snapshots

ROWS = [(1, 10, "2020-01", "a"), (2, 11, "2020-01", "b"), (3, 10, "2020-02", "c"), (4, 12, "2020-03", "d"),
        (5, None, "2020-03", "e"), (6, 13, None, "f"), (7, 10, None, "g"), (8, 12, "2020-04", "h")]
SCHEMA = "id long, cust long, month string, note string"


def files(folder: str) -> dict:
    root = Path(folder.removeprefix("file:"))
    return {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in root.glob("*.parquet")}


@pytest.fixture
def first(spark):
    return snapshots.partitioned(spark.createDataFrame(ROWS, SCHEMA), "month")


def test_delete_rewrites_only_touched(spark, first):
    before = {v: files(where) for v, where in first.locations.items()}
    doomed = spark.createDataFrame([(10,), (10,), (None,)], "cust long")
    change = snapshots.delete_pruned(first, spark, doomed, {"cust": "cust"})
    assert sorted(change.rewritten, key=repr) == sorted(["2020-01", "2020-02", None], key=repr)
    new = change.snapshot
    assert bag(new.read(spark), "id") == [(2,), (4,), (5,), (6,), (8,)]
    assert bag(change.affected, "id") == [(1,), (3,), (7,)]
    for value in ("2020-03", "2020-04"):
        assert new.locations[value] == first.locations[value]
        assert files(new.locations[value]) == before[value]
    for value in ("2020-01", None):
        assert new.locations[value] != first.locations[value]
    assert "2020-02" not in new.locations  # every row of it went
    assert bag(first.read(spark), "id") == [(i,) for i in range(1, 9)]  # the old snapshot is unchanged


def test_reads_of_a_month_are_pruned(spark, first):
    change = snapshots.delete_pruned(first, spark, spark.createDataFrame([(11,)], "cust long"), {"cust": "cust"})
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = change.snapshot.read(spark).where(F.col("month") == "2020-04")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert first.locations["2020-04"].removeprefix("file:") in plan
    assert first.locations["2020-03"].removeprefix("file:") not in plan
    assert change.rewritten == ["2020-01"]


def test_nothing_touched(spark, first):
    change = snapshots.delete_pruned(first, spark, spark.createDataFrame([(99,)], "cust long"), {"cust": "cust"})
    assert change.rewritten == []
    assert change.snapshot.locations == first.locations
    assert change.snapshot.read(spark).count() == len(ROWS)


def test_update(spark, first):
    chosen = spark.createDataFrame([(12,)], "cust long")
    change = snapshots.update_pruned(first, spark, chosen, {"cust": "cust"}, {"note": F.upper("note")})
    assert sorted(change.rewritten) == ["2020-03", "2020-04"]
    assert bag(change.snapshot.read(spark), "id", "note") == [(1, "a"), (2, "b"), (3, "c"), (4, "D"), (5, "e"), (6, "f"), (7, "g"), (8, "H")]
    assert bag(change.affected, "id", "note") == [(4, "D"), (8, "H")]
    with pytest.raises(ValueError):
        snapshots.update_pruned(first, spark, chosen, {"cust": "cust"}, {"month": F.lit("x")})


@pytest.mark.parametrize("name", ["pruned_customer_delete", "pruned_customer_update"])
def test_registered_against_sql(spark, name):
    from oracle_check import canonical, connection
    from ambertill.registered import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, folder)
    expected = connection(folder).execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert canonical(got.collect(), got.columns) == canonical(expected.fetchall(), names)
    assert got.where("rewritten").count() < got.count()
