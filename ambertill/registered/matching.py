"""Interval and as-of lookups, key resolution, next values, self joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ambertill.functions.numbers import as_double, money
from ambertill.functions.ordering import sort_columns
from ambertill.functions.text import numbered_code
from ambertill.operators.matching import Lookup, resolve_keys, valid_at, with_next
from ambertill.operators.ordered import running
from ambertill.plans.fuel import ingest_sales, latest_quarter_report
from ambertill.registered import registered
from ambertill.session import stage
from ambertill.sources import fuel_network
from ambertill.sources.retail import Retail


def _purchases(t: Retail):
    return t["events"].where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")


def _views(t: Retail):
    """Each view is a price; it stays valid for as many hours as its value says."""
    hours = F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))
    return (
        t["events"]
        .where(F.col("event_type") == "view")
        .select(
            "user_id",
            F.col("ts").alias("valid_from"),
            (F.col("ts") + hours).alias("valid_to"),
            F.col("value").alias("price"),
            F.col("event_id").alias("price_id"),
        )
    )


_OPEN_ENDED = """
    SELECT s.event_id, s.user_id, v.price, v.price_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') s
    ASOF LEFT JOIN (
        SELECT user_id, ts AS valid_from, value AS price, event_id AS price_id
        FROM events WHERE event_type = 'view'
    ) v ON v.user_id = s.user_id AND v.valid_from <= s.ts
"""

_INTERVAL = """
    WITH views AS (
        SELECT user_id, ts AS valid_from, ts + to_hours(CAST(floor(value) AS INTEGER)) AS valid_to,
               value AS price, event_id AS price_id
        FROM events WHERE event_type = 'view'
    )
    SELECT s.event_id, s.user_id, v.price, v.price_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') s
    LEFT JOIN views v ON v.user_id = s.user_id AND v.valid_from <= s.ts AND v.valid_to >= s.ts
    QUALIFY row_number() OVER (PARTITION BY s.event_id ORDER BY v.valid_from DESC NULLS LAST) = 1
"""

_SHOWN = ["event_id", "user_id", "price", "price_id"]


@registered(_OPEN_ENDED)
def asof_price_events(t: Retail):
    views = _views(t).drop("valid_to")
    return valid_at(_purchases(t), views, ["user_id"], "ts", "valid_from", None, ["price", "price_id"]).select(_SHOWN)


@registered(_OPEN_ENDED)
def asof_price_events_sliced(t: Retail):
    """The same with every end given as NULL, which is open."""
    views = _views(t).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    priced = valid_at(_purchases(t), views, ["user_id"], "ts", "valid_from", "valid_to", ["price", "price_id"])
    return priced.select(_SHOWN)


@registered(_INTERVAL)
def interval_price_events(t: Retail):
    priced = valid_at(
        _purchases(t), _views(t), ["user_id"], "ts", "valid_from", "valid_to", ["price", "price_id"]
    )
    return priced.select(_SHOWN)


@registered(
    """
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value
    FROM events
    """
)
def running_value_per_user(t: Retail):
    """Running total per user."""
    events = t["events"].select("event_id", "user_id", "ts", money("value").alias("amount"))
    totals = running(events, ["user_id"], ["ts", "event_id"], {"total": ("sum", "amount")})
    return totals.select("event_id", "user_id", as_double(F.col("total")).alias("running_value"))


#: A code of at least nine digits: longer numbers keep all of theirs.
_DIGITS = "CASE WHEN length({0}) < 9 THEN lpad({0}, 9, '0') ELSE {0} END"
_CODE = f"'Customer#' || {_DIGITS.format('CAST(o_custkey * 2 AS VARCHAR)')}"


@registered(
    f"""
    SELECT o_orderkey, c_custkey AS cust_id, CASE WHEN c_custkey IS NOT NULL THEN n_nationkey END AS nation_id,
           CASE WHEN c_custkey IS NULL THEN 'customer not found for customer_code'
                WHEN n_nationkey IS NULL THEN 'nation not found for nation_code' END AS reject_reason
    FROM (
        SELECT o_orderkey, c_custkey, n_nationkey FROM orders
        LEFT JOIN customer ON c_name = {_CODE}
        LEFT JOIN nation ON n_name = 'NATION_' || CAST(year(o_orderdate) - 1973 AS VARCHAR)
    ) WHERE c_custkey IS NOT NULL AND n_nationkey IS NOT NULL
    UNION ALL
    SELECT o_orderkey, NULL, NULL,
           CASE WHEN c_custkey IS NULL THEN 'customer not found for customer_code'
                ELSE 'nation not found for nation_code' END
    FROM (
        SELECT o_orderkey, c_custkey, n_nationkey FROM orders
        LEFT JOIN customer ON c_name = {_CODE}
        LEFT JOIN nation ON n_name = 'NATION_' || CAST(year(o_orderdate) - 1973 AS VARCHAR)
    ) WHERE c_custkey IS NULL OR n_nationkey IS NULL
    """
)
def key_resolution(t: Retail):
    """Orders whose customer and nation come as codes, many of them unknown."""
    batch = t["orders"].select(
        "o_orderkey",
        numbered_code("Customer#", F.col("o_custkey") * 2, 9).alias("customer_code"),
        F.concat(F.lit("NATION_"), (F.year("o_orderdate") - 1973).cast("string")).alias("nation_code"),
    )
    lookups = (
        Lookup("cust_id", "customer", "c_custkey", {"customer_code": "c_name"}),
        Lookup("nation_id", "nation", "n_nationkey", {"nation_code": "n_name"}),
    )
    resolved, rejected = resolve_keys(batch, t, lookups)
    columns = ["o_orderkey", "cust_id", "nation_id", "reject_reason"]
    good = resolved.withColumn("reject_reason", F.lit(None).cast("string")).select(columns)
    bad = rejected.withColumns({"cust_id": F.lit(None).cast("long"), "nation_id": F.lit(None).cast("int")})
    return good.unionByName(bad.select(columns))


@registered(
    """
    WITH years AS (SELECT DISTINCT o_custkey AS customer_id, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders)
    SELECT *, lead(order_year) OVER (PARTITION BY customer_id ORDER BY order_year) AS next_order_year FROM years
    """
)
def next_order_year(t: Retail):
    years = t["orders"].select(F.col("o_custkey").alias("customer_id"), F.year("o_orderdate").alias("order_year"))
    return with_next(years, ["customer_id"], "order_year", "next_order_year")


@registered(
    """
    WITH parents AS (SELECT o_custkey, min(o_orderkey) AS parent_key FROM orders GROUP BY 1)
    SELECT c.o_orderkey AS child_key, p.o_orderkey AS parent_key,
           CAST(date_diff('day', CAST(p.o_orderdate AS DATE), CAST(c.o_orderdate AS DATE)) AS INTEGER) AS days_after_parent
    FROM orders c JOIN parents f ON f.o_custkey = c.o_custkey JOIN orders p ON p.o_orderkey = f.parent_key
    WHERE c.o_orderkey <> p.o_orderkey
    """
)
def child_to_parent_orders(t: Retail):
    """Self join of one hierarchy level: an order and its customer's first order."""
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    # Stored, so that its size is known and a frequent customer can be split in the join.
    parents = stage(orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderkey", "o_orderdate")).alias("p")), "parents")
    pairs = orders.join(parents, "o_custkey").where(F.col("o_orderkey") != F.col("p.o_orderkey"))
    return pairs.select(
        F.col("o_orderkey").alias("child_key"),
        F.col("p.o_orderkey").alias("parent_key"),
        F.datediff("o_orderdate", F.col("p.o_orderdate")).alias("days_after_parent"),
    )


@registered(
    """
    WITH newest AS (SELECT date_trunc('quarter', max(l_shipdate)) AS q FROM lineitem),
    sums AS (
        SELECT n_name, p_type, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS r,
               sum(CAST(l_tax AS DECIMAL(18,2))) AS d, count(*) AS n
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        JOIN part ON p_partkey = l_partkey
        WHERE date_trunc('quarter', l_shipdate) = (SELECT q FROM newest) GROUP BY ALL
    )
    SELECT CAST((SELECT year(q) FROM newest) AS INTEGER) AS sales_year,
           CAST((SELECT quarter(q) FROM newest) AS INTEGER) AS sales_quarter, n_name AS station_name, p_type AS fuel_name,
           CAST(round(q, 0) AS DOUBLE) AS total_liters_sold, CAST(round(r, 0) AS DOUBLE) AS total_revenue,
           n AS total_check_number, CAST(round(CAST(CAST(r AS DOUBLE) / n AS DECIMAL(38,6)), 0) AS DOUBLE) AS avg_check,
           CAST(round(CAST(CAST(d AS DOUBLE) / n AS DECIMAL(38,6)), 0) AS DOUBLE) AS avg_discount_per_check
    FROM sums
    """
)
def latest_quarter_report_by_nation(t: Retail):
    """A station is a supplier's nation, a fuel a part type, a pair a (supplier, part)."""
    lines = t["lineitem"].select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_partkey").alias("fuel_id"),
        F.col("l_shipdate").alias("sale_datetime"),
        money("l_quantity").alias("quantity_liters"),
        money("l_extendedprice").alias("total_amount"),
        money("l_tax").alias("discount_amount"),
        F.col("l_orderkey").alias("receipt_number"),
    )
    nations = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("station_name"))
    stations = t["supplier"].join(nations, "s_nationkey").select(F.col("s_suppkey").alias("station_id"), "station_name")
    fuels = t["part"].select(F.col("p_partkey").alias("fuel_id"), F.col("p_type").alias("fuel_name"))
    report = latest_quarter_report(lines, None, stations, fuels)
    numbers = ("total_liters_sold", "total_revenue", "avg_check", "avg_discount_per_check")
    return report.withColumns({c: as_double(F.col(c)) for c in numbers}).orderBy(
        *sort_columns(["station_name", "-total_revenue", "fuel_name"])
    )


_INGEST = f"""
    WITH batch AS (
        SELECT event_id, user_id, ts + INTERVAL 2 YEAR AS sold_at, s_suppkey
        FROM events LEFT JOIN supplier ON s_name = 'Supplier#' || {_DIGITS.format("CAST(user_id AS VARCHAR)")}
        WHERE event_type = 'purchase'
    ), prices AS (
        SELECT user_id, ts + INTERVAL 2 YEAR AS valid_from, CAST(value AS DECIMAL(10,2)) AS price,
               ts + INTERVAL 2 YEAR + to_hours(CAST(floor(value) AS INTEGER)) AS valid_to
        FROM events WHERE event_type = 'view'
    ), priced AS (
        SELECT b.*, p.price FROM batch b
        LEFT JOIN prices p ON p.user_id = b.user_id AND p.valid_from <= b.sold_at AND p.valid_to >= b.sold_at
        WHERE s_suppkey IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY b.event_id ORDER BY p.valid_from DESC NULLS LAST) = 1
    ), accepted AS (
        SELECT *, row_number() OVER (ORDER BY sold_at, event_id) AS n FROM priced WHERE price > 0
    )
"""


def _event_network(t: Retail):
    """Every customer is a station selling its nation's fuel; a view sets a price, a supplier serves."""
    people = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    later = F.make_ym_interval(F.lit(2))
    hours = F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))
    start = F.col("ts") + later
    data = {
        "station": people.select(F.col("c_custkey").alias("station_id"), F.col("c_name").alias("station_code")),
        "fuel": t["nation"].select(F.col("n_nationkey").alias("fuel_id"), F.col("n_name").alias("fuel_code")),
        "station_fuel": people.select(
            F.col("c_custkey").alias("station_fuel_id"),
            F.col("c_custkey").alias("station_id"),
            F.col("c_nationkey").alias("fuel_id"),
        ),
        "employee": t["supplier"].select(F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("employee_code")),
        "customer": people.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_code")),
        "price": t["events"].where(F.col("event_type") == "view").select(
            F.col("user_id").alias("station_fuel_id"),
            F.lit("regular").alias("price_type"),
            F.col("value").cast("decimal(10,2)").alias("price_per_liter"),
            start.cast("timestamp").alias("valid_from"),
            (start + hours).cast("timestamp").alias("valid_to"),
        ),
        "fuel_sale": t.spark.createDataFrame([], fuel_network.TABLES["fuel_sale"].schema),
    }
    number = F.col("user_id")
    homes = people.select(F.col("c_custkey").alias("user_id"), F.concat(F.lit("NATION_"), "c_nationkey").alias("fuel_code"))
    batch = (
        t["events"].where(F.col("event_type") == "purchase").join(homes, "user_id").select(
            F.col("event_id").alias("seq"),
            numbered_code("Customer#", number, 9).alias("station_code"),
            "fuel_code",
            numbered_code("Supplier#", number, 9).alias("employee_code"),
            numbered_code("Customer#", number, 9).alias("customer_code"),
            F.lit(2).cast("decimal(10,2)").alias("quantity_liters"),
            F.lit("card").alias("payment_method"),
            start.cast("timestamp").alias("sale_datetime"),
        )
    )
    return data, batch


@registered(
    _INGEST
    + """
    SELECT n AS fuel_sale_id, user_id AS station_fuel_id, s_suppkey AS employee_id, user_id AS customer_id,
           'RCPT' || lpad(CAST(n + 6 AS VARCHAR), 6, '0') AS receipt_number,
           CAST(price AS DOUBLE) AS price_per_liter, CAST(price * 2 AS DOUBLE) AS total_amount
    FROM accepted
    """
)
def ingest_event_sales(t: Retail):
    """Purchases by natural keys become numbered sales at the price valid then."""
    data, batch = _event_network(t)
    sold = ingest_sales(data, batch, dt.datetime(2026, 1, 31), next_receipt=7).inserted
    return sold.select(
        "fuel_sale_id",
        "station_fuel_id",
        "employee_id",
        "customer_id",
        "receipt_number",
        as_double(F.col("price_per_liter")).alias("price_per_liter"),
        as_double(F.col("total_amount")).alias("total_amount"),
    )


@registered(
    _INGEST
    + """
    SELECT event_id AS seq, 'employee not found for employee_code' AS reason FROM batch WHERE s_suppkey IS NULL
    UNION ALL
    SELECT event_id, 'No regular price of NATION_' || c_nationkey || ' at station Customer#'
           || lpad(CAST(priced.user_id AS VARCHAR), 9, '0') || ' is valid at ' || strftime(sold_at, '%Y-%m-%d %H:%M:%S')
    FROM priced JOIN customer ON c_custkey = user_id WHERE price IS NULL
    UNION ALL
    SELECT event_id, 'rule broken: price positive' FROM priced WHERE price <= 0
    """
)
def ingest_event_rejects(t: Retail):
    """The purchases refused, with the first reason."""
    data, batch = _event_network(t)
    refused = ingest_sales(data, batch, dt.datetime(2026, 1, 31), next_receipt=7).rejected
    return refused.select("seq", F.col("reject_reason").alias("reason"))
