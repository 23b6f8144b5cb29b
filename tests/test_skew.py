"""Adaptive execution on, a third of the rows on one key: the final plan must split it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ambertill.operators.matching import Lookup, resolve_keys
from ambertill.plans import films, loads
from ambertill.session import clear_scratch, scratch_dir
from ambertill.sources import sinks

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def adaptive(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def hot(spark, n):
    return spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long"))


def test_history_of_a_frequent_customer(spark, adaptive):
    facts = hot(spark, 30_000).repartition(6)
    people = spark.range(510).withColumnRenamed("id", "customer_id")
    rentals = facts.select(F.col("k").alias("customer_id"), F.col("id").alias("rental_id"), F.lit(dt.date(2020, 1, 1)).alias("rental_date"))
    payments = facts.where("id % 2 = 0").select(F.col("id").alias("rental_id"), F.col("id").alias("payment_id"), F.lit(dt.date(2020, 1, 2)).alias("payment_date"))
    plan, rows = final_plan(films.rental_history(people, rentals, payments))
    assert "skew=true" in plan
    assert len(rows) == 30_000 + 10


def test_history_sorts_neither_side_of_its_joins(spark, adaptive):
    """Payments are streamed past the narrowed rentals; a sort would hold all of a task's payments."""
    people = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "customer_id long")
    rentals = spark.createDataFrame([(1, 10), (1, 11), (2, None), (None, 12), (4, 13), (2, 10)], "customer_id long, rental_id long")
    rentals = rentals.withColumn("rental_date", F.lit(dt.date(2020, 1, 1)))
    payments = spark.createDataFrame([(10, 1), (10, 2), (10, 2), (12, 3), (None, 4)], "rental_id long, payment_id long")
    payments = payments.withColumn("payment_date", F.lit(dt.date(2020, 1, 2)))
    plan, rows = final_plan(films.rental_history(people, rentals, payments))
    assert "SortMergeJoin" not in plan
    wanted = people.join(rentals, "customer_id", "left").join(payments, "rental_id", "left")
    shown = lambda found: sorted((r.customer_id or 0, r.rental_id or 0, r.payment_id or 0) for r in found)
    assert shown(rows) == shown(wanted.collect())


def test_lookup_of_a_frequent_code(spark, adaptive):
    batch = hot(spark, 30_000).select("id", F.col("k").alias("code")).repartition(6)
    table = spark.range(400).select(F.col("id").alias("code"), (F.col("id") * 2).alias("found"))
    resolved, rejected = resolve_keys(batch, {"t": table}, [Lookup("found", "t", "found", {"code": "code"})])
    known = 10_000 + sum(1 for i in range(30_000) if i % 3 and i % 500 < 400)
    assert (resolved.count(), rejected.count()) == (known, 30_000 - known)


def test_partition_columns_keep_their_type(spark, tmp_path):
    rows = spark.createDataFrame([("001", 1), ("010", 2)], "code string, n int")
    back = sinks.write_snapshot(rows, f"{tmp_path}/s", ("code",))
    assert back.schema == rows.schema and sorted(map(tuple, back.collect())) == [("001", 1), ("010", 2)]


def test_namesake_languages_and_stamps(spark):
    now = dt.datetime(2026, 1, 2)
    films_ = spark.createDataFrame([], "film_id long, title string, language_id long, release_year int, rental_duration int, rental_rate decimal(4,2), replacement_cost decimal(5,2), last_update timestamp")
    languages = spark.createDataFrame([(1, "English", None), (2, "english ", None)], "language_id long, name string, last_update timestamp")
    batch = spark.createDataFrame([("One", "ENGLISH", 1), ("Two", "Latin", 2)], "title string, language_name string, seq int")
    done = loads.register_films(films_, languages, batch, 2020, registered_at=now)
    assert sorted((r.title, r.language_id, r.last_update) for r in done.films.collect()) == [("ONE", 1, now), ("TWO", 3, now)]
    assert [(r.language_id, r.last_update) for r in done.languages.where("language_id > 2").collect()] == [(3, now)]


def test_film_with_an_unknown_language_is_refused(spark):
    films_ = spark.createDataFrame([], "film_id long, title string, release_year int, language_id long, last_update timestamp")
    languages = spark.createDataFrame([(1, "English")], "language_id long, name string")
    batch = spark.createDataFrame([("A", 2000, "English"), ("B", 2000, "None")], "title string, release_year int, language_name string")
    done = loads.insert_films(films_, languages, batch, dt.datetime(2026, 1, 1))
    assert done.inserted.count() == 1
    assert [(r.title, r.reject_reason) for r in done.rejected.collect()] == [("B", "language not found for language_name")]


def test_scratch_can_be_cleared(spark):
    import os

    from ambertill.session import stage

    table = stage(spark.range(3), "x")
    assert table.count() == 3
    clear_scratch(spark)
    folder = f"{scratch_dir(spark)}/ambertill-{spark.sparkContext.applicationId}".removeprefix("file:")
    assert not os.path.exists(folder)
