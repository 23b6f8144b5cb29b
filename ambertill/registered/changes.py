"""Data-change jobs on orders and customers: next snapshots and affected rows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ambertill.functions.numbers import as_double
from ambertill.operators import changes, snapshots
from ambertill.operators.ordered import number_rows
from ambertill.operators.ranking import first_per_key
from ambertill.plans import films, loads
from ambertill.registered import registered
from ambertill.session import scratch_dir
from ambertill.sources import sinks
from ambertill.registered.films import _activity
from ambertill.sources.retail import Retail

SPLIT, BATCH_FROM = dt.date(2001, 1, 1), dt.date(2000, 7, 1)


def _orders(t: Retail):
    return t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _target_and_batch(t: Retail):
    """Orders up to 2000; a batch that overlaps them and repeats its own new keys."""
    orders = _orders(t).drop("o_orderdate")
    day = F.col("o_orderdate")
    target = _orders(t).where(day < F.lit(SPLIT)).select(orders.columns)
    batch = _orders(t).where(day >= F.lit(BATCH_FROM)).select(orders.columns)
    repeats = (
        _orders(t).where(day >= F.lit(SPLIT)).select(orders.columns).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    )
    return target, batch.unionByName(repeats)


@registered("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def insert_ignore(t: Retail):
    """The cheaper of two batch rows with one key wins, so the original price does."""
    target, batch = _target_and_batch(t)
    return changes.insert_ignore(target, batch, ["o_orderkey"], ["o_totalprice"]).snapshot


@registered(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
    """
)
def insert_not_exists(t: Retail):
    """Repeats inside the batch are all inserted."""
    target, batch = _target_and_batch(t)
    return changes.insert_missing(target, batch, ["o_orderkey"]).snapshot


@registered("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE 1 = 0")
def insert_ignore_rerun(t: Retail):
    """Loading the result again inserts nothing."""
    target, batch = _target_and_batch(t)
    once = changes.insert_ignore(target, batch, ["o_orderkey"], ["o_totalprice"]).snapshot
    return changes.insert_ignore(once, batch, ["o_orderkey"], ["o_totalprice"]).affected


@registered(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def delete_by_semi(t: Retail):
    doomed = t["customer"].where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    kept = changes.delete_matching(_orders(t), doomed, {"o_custkey": "c_custkey"}).snapshot
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


@registered(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def deleted_by_semi(t: Retail):
    """The rows the delete reports."""
    doomed = t["customer"].where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    gone = changes.delete_matching(_orders(t), doomed, {"o_custkey": "c_custkey"}).affected
    return gone.select("o_orderkey", "o_custkey", "o_totalprice")


@registered(
    """
    SELECT c_custkey, c_name FROM customer WHERE CAST(replace(c_name, 'Customer#', '') AS BIGINT) % 3 <> 0
    """
)
def delete_every_third(t: Retail):
    number = F.replace("c_name", F.lit("Customer#"), F.lit("")).cast("bigint")
    return changes.delete_where(t["customer"].select("c_custkey", "c_name"), number % 3 == 0).snapshot


_CLOSED = "CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END"


@registered(
    f"""
    WITH latest AS (
        SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'O' GROUP BY 1
    )
    SELECT o.o_orderkey, o.o_custkey,
           CASE WHEN latest.o_orderkey IS NOT NULL THEN DATE '2002-01-01' ELSE {_CLOSED} END AS closed_on
    FROM orders o LEFT JOIN latest ON latest.o_orderkey = o.o_orderkey
    """
)
def update_latest(t: Retail):
    closed = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date")).alias("closed_on")
    orders = t["orders"].select("o_orderkey", "o_custkey", closed)
    values = {"closed_on": F.lit(dt.date(2002, 1, 1))}
    return changes.close_latest_open(orders, ["o_custkey"], "o_orderkey", "closed_on", values).snapshot


@registered(
    """
    WITH n AS (SELECT o_custkey AS k, count(*) AS orders_n FROM orders GROUP BY 1),
    m AS (SELECT o_custkey AS k, count(*) AS lines_n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
    top AS (
        SELECT k FROM n JOIN m USING (k) WHERE orders_n >= 15 AND lines_n >= 60
        ORDER BY orders_n DESC, lines_n DESC, k LIMIT 1
    )
    SELECT c_custkey AS customer_id, CASE WHEN k IS NULL THEN c_name ELSE 'RENAMED' END AS customer_name
    FROM customer LEFT JOIN top ON k = c_custkey
    """
)
def update_top_customer(t: Retail):
    customers, orders, lines = _activity(t)
    best = films.active_customers(customers, orders, lines, 15, 60).limit(1).select("customer_id")
    return changes.update_from(customers, best, ["customer_id"], {"customer_name": F.lit("RENAMED")}).snapshot


@registered(
    """
    SELECT c_custkey, c_name, c_mktsegment, DATE '2002-01-01' AS record_ts FROM customer
    """
)
def add_load_date(t: Retail):
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return changes.add_column(customers, "record_ts", F.lit(dt.date(2002, 1, 1)))


@registered(
    """
    WITH patches AS (
        SELECT o_custkey, max(o_orderkey) AS seq FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
    )
    SELECT c_custkey, c_name, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN patches ON patches.o_custkey = c_custkey LEFT JOIN orders ON o_orderkey = seq
    """
)
def patch_segments(t: Retail):
    """Many patches per customer; the last one wins. Half of them name a column that may not change."""
    orders = t["orders"].where(F.col("o_orderstatus").isin("P", "F"))
    column = F.when(F.col("o_orderstatus") == "P", "c_mktsegment").otherwise("c_custkey")
    patches = orders.select(
        F.col("o_custkey").alias("c_custkey"),
        column.alias("column_name"),
        F.col("o_orderpriority").alias("new_value"),
        F.col("o_orderkey").alias("seq"),
    )
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return changes.patch_columns(customers, patches, "c_custkey", ["c_name", "c_mktsegment"], "seq").snapshot


@registered(
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + (SELECT max(o_orderkey) FROM orders)
           AS new_id FROM orders
    """
)
def dense_ids(t: Retail):
    """Ids that go on after the largest in use, in date order, with no gap."""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    existing = t["orders"].select(F.col("o_orderkey").alias("new_id"))
    numbered = changes.assign_ids(orders, existing, "new_id", ["o_orderdate", "o_orderkey"])
    return numbered.select("o_orderkey", "new_id")


@registered(
    """
    SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS row_num, c_custkey, c_mktsegment FROM customer
    """
)
def numbered_output(t: Retail):
    customers = t["customer"].select("c_custkey", "c_mktsegment")
    return number_rows(customers, ["c_mktsegment", "c_custkey"], "row_num")


@registered(
    """
    WITH titles AS (SELECT p_partkey AS seq, p_brand || ' ' || p_name AS title, p_type AS language_name, p_size FROM part),
    taken AS (SELECT DISTINCT upper(title) AS t FROM titles WHERE p_size <= 25),
    fresh AS (
        SELECT DISTINCT ON (upper(title)) seq, upper(title) AS title, language_name FROM titles
        WHERE p_size > 25 AND upper(title) NOT IN (SELECT t FROM taken) ORDER BY upper(title), seq
    )
    SELECT row_number() OVER (ORDER BY seq) + (SELECT max(p_partkey) FROM part WHERE p_size <= 25) AS film_id,
           title, upper(language_name) AS language, 2002 AS release_year,
           3 AS rental_duration, CAST(4.99 AS DOUBLE) AS rental_rate, CAST(19.99 AS DOUBLE) AS replacement_cost
    FROM fresh
    """
)
def register_parts(t: Retail):
    """The smaller parts are the catalogue, the larger ones are registered into it."""
    title = F.concat("p_brand", F.lit(" "), "p_name")
    small = F.col("p_size") <= 25
    catalogue = t["part"].where(small).select(
        F.col("p_partkey").alias("film_id"),
        title.alias("title"),
        F.lit(2000).alias("release_year"),
        F.lit(1).cast("long").alias("language_id"),
        F.lit(3).alias("rental_duration"),
        F.lit("0.99").cast("decimal(4,2)").alias("rental_rate"),
        F.lit("9.99").cast("decimal(5,2)").alias("replacement_cost"),
    )
    languages = t["part"].where(F.col("p_type") == "PROMO").groupBy(F.col("p_type").alias("name")).agg(
        F.min("p_partkey").alias("language_id")
    )
    batch = t["part"].where(~small).select(
        F.concat(F.lit(" "), title).alias("title"), F.lower("p_type").alias("language_name"), F.col("p_partkey").alias("seq")
    )
    done = loads.register_films(catalogue, languages, batch, 2002).inserted
    return done.withColumns(
        {
            "language": F.upper("language"),
            "rental_rate": as_double(F.col("rental_rate")),
            "replacement_cost": as_double(F.col("replacement_cost")),
        }
    )


@registered(
    """
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders
    ORDER BY o_custkey, o_totalprice DESC, o_orderkey
    """
)
def distinct_on_customer(t: Retail):
    orders = _orders(t).select("o_custkey", "o_orderkey", "o_totalprice")
    return first_per_key(orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"])


# ------------------------------------------------------------ changes that rewrite only touched partitions
_MONTH = "strftime(o_orderdate, '%Y-%m')"


def _monthly_orders(t: Retail) -> snapshots.Snapshot:
    orders = t["orders"].select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("o_month")
    )
    return snapshots.partitioned(orders, "o_month")


def _busiest_customer(t: Retail):
    """The customer with the most orders, ties to the smallest key (a top-1, as the reference's ``LIMIT 1``)."""
    counts = t["orders"].where(F.col("o_custkey").isNotNull()).groupBy("o_custkey").count()
    return counts.orderBy(F.desc("count"), "o_custkey").limit(1).select("o_custkey")


def _by_month(df, name: str):
    return df.groupBy("o_month").agg(F.count(F.lit(1)).alias(name))


def _month_report(before, change: snapshots.Rewrite, spark, **counts):
    """One row per month of the old snapshot: counts before, of the change, after, and whether it was rewritten."""
    report = _by_month(before, "rows_before")
    for name, df in counts.items():
        part = _by_month(df, name).withColumnRenamed("o_month", "_m")
        report = report.join(part, report["o_month"].eqNullSafe(part["_m"]), "left").drop("_m").fillna(0, [name])
    rewritten = F.col("o_month").isin([p for p in change.rewritten if p is not None])
    if None in change.rewritten:
        rewritten = rewritten | F.col("o_month").isNull()
    return report.withColumn("rewritten", F.coalesce(rewritten, F.lit(False)))


@registered(
    f"""
    WITH chosen AS (
        SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1
    ), m AS (
        SELECT {_MONTH} AS o_month, coalesce(o_custkey IN (SELECT o_custkey FROM chosen), false) AS hit FROM orders
    )
    SELECT o_month, count(*) AS rows_before, sum(CASE WHEN hit THEN 1 ELSE 0 END) AS deleted,
           sum(CASE WHEN hit THEN 0 ELSE 1 END) AS rows_after, bool_or(hit) AS rewritten
    FROM m GROUP BY o_month
    """
)
def pruned_customer_delete(t: Retail):
    """Delete the busiest customer's orders from a copy partitioned by month; only months holding them are rewritten."""
    old = _monthly_orders(t)
    change = snapshots.delete_pruned(old, t.spark, _busiest_customer(t), {"o_custkey": "o_custkey"})
    report = _month_report(old.read(t.spark), change, t.spark, deleted=change.affected, rows_after=change.snapshot.read(t.spark))
    return report.select("o_month", "rows_before", "deleted", "rows_after", "rewritten")


@registered(
    f"""
    WITH chosen AS (
        SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1
    ), m AS (
        SELECT {_MONTH} AS o_month, coalesce(o_custkey IN (SELECT o_custkey FROM chosen), false) AS hit, o_orderpriority FROM orders
    )
    SELECT o_month, count(*) AS rows_before, sum(CASE WHEN hit THEN 1 ELSE 0 END) AS updated,
           sum(CASE WHEN hit OR o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent_after, bool_or(hit) AS rewritten
    FROM m GROUP BY o_month
    """
)
def pruned_customer_update(t: Retail):
    """Mark the busiest customer's orders urgent in a copy partitioned by month; only months holding them are rewritten."""
    old = _monthly_orders(t)
    change = snapshots.update_pruned(old, t.spark, _busiest_customer(t), {"o_custkey": "o_custkey"}, {"o_orderpriority": F.lit("1-URGENT")})
    urgent = change.snapshot.read(t.spark).where(F.col("o_orderpriority") == "1-URGENT")
    report = _month_report(old.read(t.spark), change, t.spark, updated=change.affected, urgent_after=urgent)
    return report.select("o_month", "rows_before", "updated", "urgent_after", "rewritten")


@registered(
    """
    SELECT c_custkey, c_name, c_mktsegment, DATE '2002-01-01' AS record_ts FROM customer
    UNION ALL
    SELECT -s_suppkey, s_name, 'SUPPLIER', DATE '2002-01-01' FROM supplier
    """
)
def catalogue_load_date(t: Retail):
    """A load date kept as a column default in the catalogue: old files are not rewritten, new rows take it too."""
    name = f"customers_{uuid.uuid4().hex}"
    path = f"{scratch_dir(t.spark)}/tables/{name}"
    t["customer"].select("c_custkey", "c_name", "c_mktsegment").write.option("path", path).format("parquet").saveAsTable(name)
    sinks.add_column_with_default(t.spark, name, "record_ts", "DATE", "DATE'2002-01-01'")
    joining = t["supplier"].select((-F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("SUPPLIER").alias("c_mktsegment"))
    sinks.insert_columns(joining, name)
    return t.spark.table(name)
