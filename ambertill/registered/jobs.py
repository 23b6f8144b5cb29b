"""Whole jobs on the generated tables: loads by natural keys, audits, messages, snapshots, SQL functions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Window, functions as F

from ambertill.functions.numbers import as_double, money
from ambertill.functions.text import numbered_code
from ambertill.operators import changes
from ambertill.operators.changes import union_all
from ambertill.operators.quality import checksum, differences, same_multiset
from ambertill.plans import films, loads
from ambertill.registered import registered
from ambertill.registered.films import _parts
from ambertill.session import scratch_dir, stage
from ambertill.sources import film_rental, fuel_network, sinks, transit
from ambertill.sources.declared import Table, audit_in_one_pass, ref
from ambertill.sources.frames import define_view
from ambertill.sources.retail import SCHEMAS, Retail

NOW = dt.datetime(2026, 1, 31)


def _count(df: DataFrame, name: str, **labels: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name)).select(*(F.lit(v).alias(k) for k, v in labels.items()), name)


def _outcomes(done: dict[str, loads.Loaded], again: dict[str, loads.Loaded]) -> DataFrame:
    """Rows inserted, refused, and inserted by a second run, for each load."""
    rows = []
    for name, first in done.items():
        counted = _count(first.inserted, "inserted", load=name)
        refused, repeated = _count(first.rejected, "rejected"), _count(again[name].inserted, "inserted_again")
        rows.append(
            counted.withColumns({"rejected": refused.scalar(), "inserted_again": repeated.scalar()})
        )
    return union_all(rows)


def _ran(steps, declared, data):
    # Each lookup reads its batch again, and so does the second run: what makes the batch runs once.
    steps = [(load, stage(batch, f"batch-{load.table}")) for load, batch in steps]
    current, reports = loads.run_loads(steps, declared, data)
    _, again = loads.run_loads(steps, declared, current)
    plain = lambda found: {name.split(":")[1]: report for name, report in found.items()}
    return current, plain(reports), plain(again)


# ---------------------------------------------------------------- dependent loads
_PLACES = """
    WITH places AS (
        SELECT 'NATION_' || CAST(c_nationkey + 3 AS VARCHAR) AS station, c_mktsegment AS fuel, c_custkey % 30 AS day
        FROM customer
    ), sold AS (SELECT * FROM places WHERE station IN (SELECT n_name FROM nation))
"""


@registered(
    _PLACES
    + """
    SELECT 'station' AS load, count(DISTINCT n_name) AS inserted, 0 AS rejected, 0 AS inserted_again FROM nation
    UNION ALL SELECT 'fuel', count(DISTINCT c_mktsegment), 0, 0 FROM customer
    UNION ALL SELECT 'station_fuel', (SELECT count(*) FROM (SELECT DISTINCT station, fuel FROM sold)),
                     (SELECT count(*) FROM places) - (SELECT count(*) FROM sold), 0
    UNION ALL SELECT 'price', (SELECT count(*) FROM (SELECT DISTINCT station, fuel, day FROM sold)),
                     (SELECT count(*) FROM places) - (SELECT count(*) FROM sold), 0
    """
)
def fuel_network_loads(t: Retail):
    """Nations are stations, segments are fuels; each customer asks for a pair and a price, some at unknown stations."""
    stations = t["nation"].select(
        F.col("n_name").alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.col("n_regionkey").cast("string").alias("city"),
        F.lit("1 Road").alias("address"),
        F.lit(dt.date(2026, 1, 5)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    fuels = t["customer"].select(F.col("c_mktsegment").alias("fuel_code"), F.col("c_mktsegment").alias("fuel_name"))
    code = F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 3).cast("string"))
    places = t["customer"].select("c_custkey", code.alias("station_code"), F.col("c_mktsegment").alias("fuel_code"))
    amount = lambda n: F.lit(n).cast("decimal(10,2)")
    pairs = places.withColumns({"tank_capacity_liters": amount(1000), "current_quantity_liters": amount(500)})
    start = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp") + F.make_dt_interval((F.col("c_custkey") % 30).cast("int"))
    prices = places.select(
        "station_code",
        "fuel_code",
        F.lit("regular").alias("price_type"),
        amount(2).alias("price_per_liter"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    batches = {"station": stations, "fuel": fuels, "station_fuel": pairs, "price": prices}
    steps = [(loads.FUEL_LOADS[name], batch) for name, batch in batches.items()]
    data = loads.empty_tables(t.spark, fuel_network.TABLES)
    _, done, again = _ran(steps, fuel_network.TABLES, data)
    return _outcomes(done, again)


@registered(
    """
    WITH cust AS (
        SELECT c_custkey, c_name, 'NATION_' || CAST(c_nationkey + 3 AS VARCHAR) AS station, c_mktsegment AS fuel FROM customer
    ), emp AS (
        SELECT s_suppkey, s_name, 'NATION_' || CAST(s_nationkey + 3 AS VARCHAR) AS station FROM supplier
    ), sales AS (
        SELECT o.o_orderkey, c.station, e.s_name
        FROM orders o JOIN cust c ON o.o_custkey = c.c_custkey
        LEFT JOIN supplier e ON e.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)
    ), good AS (
        SELECT * FROM sales
        WHERE station IN (SELECT n_name FROM nation)
          AND s_name IN (SELECT s_name FROM emp WHERE station IN (SELECT n_name FROM nation))
    )
    SELECT 'station' AS load, count(DISTINCT n_name) AS inserted, 0 AS rejected, 0 AS inserted_again FROM nation
    UNION ALL SELECT 'fuel', count(DISTINCT c_mktsegment), 0, 0 FROM customer
    UNION ALL SELECT 'customer', count(DISTINCT c_name), 0, 0 FROM customer
    UNION ALL SELECT 'employee', (SELECT count(*) FROM emp WHERE station IN (SELECT n_name FROM nation)),
                     (SELECT count(*) FROM emp WHERE station NOT IN (SELECT n_name FROM nation)), 0
    UNION ALL SELECT 'station_fuel', (SELECT count(*) FROM (SELECT DISTINCT station, fuel FROM cust WHERE station IN (SELECT n_name FROM nation))),
                     (SELECT count(*) FROM cust WHERE station NOT IN (SELECT n_name FROM nation)), 0
    UNION ALL SELECT 'fuel_sale', (SELECT count(*) FROM good), (SELECT count(*) FROM sales) - (SELECT count(*) FROM good), 0
    """
)
def fuel_sales_loads(t: Retail):
    """Customers, employees and their sales on top of stations, fuels and their pairs; each load is run twice.

    Suppliers are employees at the station of their nation shifted by three, so some stations are unknown and those
    employees are refused. An order is a sale to its customer, at the customer's station and fuel, served by the supplier
    whose key is the order key modulo the number of suppliers; sales at unknown stations or by refused employees are refused.
    """
    nation_station = lambda key: F.concat(F.lit("NATION_"), (F.col(key) + 3).cast("string"))
    amount = lambda n: F.lit(n).cast("decimal(10,2)")
    stations = t["nation"].select(
        F.col("n_name").alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.col("n_regionkey").cast("string").alias("city"),
        F.lit("1 Road").alias("address"),
        F.lit(dt.date(2026, 1, 5)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    fuels = t["customer"].select(F.col("c_mktsegment").alias("fuel_code"), F.col("c_mktsegment").alias("fuel_name"))
    day = lambda key: F.lit(dt.datetime(2026, 1, 1)).cast("timestamp") + F.make_dt_interval((F.col(key) % 30).cast("int"))
    customers = t["customer"].select(
        F.col("c_name").alias("customer_code"),
        F.col("c_name").alias("first_name"),
        F.lit("Buyer").alias("last_name"),
        F.lit("100").alias("phone"),
        F.lit(None).cast("string").alias("email"),
        day("c_custkey").alias("registered_at"),
        F.lit(True).alias("is_active"),
    )
    employees = t["supplier"].select(
        nation_station("s_nationkey").alias("station_code"),
        F.col("s_name").alias("employee_code"),
        F.col("s_name").alias("first_name"),
        F.lit("Clerk").alias("last_name"),
        F.lit("cashier").alias("job_title"),
        F.lit("200").alias("phone"),
        F.lit(dt.date(2026, 1, 5)).alias("hired_on"),
        F.lit(True).alias("is_active"),
    )
    places = t["customer"].select("c_custkey", "c_name", nation_station("c_nationkey").alias("station_code"), F.col("c_mktsegment").alias("fuel_code"))
    pairs = places.select("station_code", "fuel_code", amount(1000).alias("tank_capacity_liters"), amount(500).alias("current_quantity_liters"))
    suppliers = t["supplier"].select("s_suppkey", "s_name")
    server = F.col("o_orderkey") % suppliers.agg(F.count(F.lit(1))).scalar()
    sales = (
        t["orders"]
        .select("o_orderkey", "o_custkey", server.alias("_server"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("_server") == F.col("s_suppkey"), "left")
        .select(
            "station_code",
            "fuel_code",
            F.col("s_name").alias("employee_code"),
            F.col("c_name").alias("customer_code"),
            F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("receipt_number"),
            day("o_orderkey").alias("sale_datetime"),
            amount(10).alias("quantity_liters"),
            amount(2).alias("price_per_liter"),
            F.lit("card").alias("payment_method"),
            amount(0).alias("discount_amount"),
            F.lit(20).cast("decimal(12,2)").alias("total_amount"),
        )
    )
    batches = {"station": stations, "fuel": fuels, "customer": customers, "employee": employees, "station_fuel": pairs, "fuel_sale": sales}
    steps = [(loads.FUEL_LOADS[name], batch) for name, batch in batches.items()]
    _, done, again = _ran(steps, fuel_network.TABLES, loads.empty_tables(t.spark, fuel_network.TABLES))
    return _outcomes(done, again)


@registered(
    """
    WITH placed AS (
        SELECT n.n_nationkey, r.r_name FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey + 2
    ), events AS (
        SELECT c.c_nationkey + 3 AS asset_nation FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    )
    SELECT 'line' AS load, count(DISTINCT r_name) AS inserted, 0 AS rejected, 0 AS inserted_again FROM region
    UNION ALL SELECT 'asset', count(*), 0, 0 FROM nation
    UNION ALL SELECT 'maintenance_type', count(DISTINCT o_orderpriority), 0, 0 FROM orders
    UNION ALL SELECT 'station', count(*), 0, 0 FROM nation
    UNION ALL SELECT 'line_station', (SELECT count(*) FROM placed WHERE r_name IS NOT NULL), (SELECT count(*) FROM placed WHERE r_name IS NULL), 0
    UNION ALL SELECT 'maintenance_event', (SELECT count(*) FROM events WHERE asset_nation IN (SELECT n_nationkey FROM nation)),
                     (SELECT count(*) FROM events WHERE asset_nation NOT IN (SELECT n_nationkey FROM nation)), 0
    """
)
def transit_network_loads(t: Retail):
    """Lines, assets, stations, their places on lines, maintenance types and events, loaded in order and run twice.

    Regions are lines and nations stations, each with a station asset created at the nation's hour of 2026-01-01. A nation
    lies on the line of the region two keys on, so nations of the last regions are refused. Order priorities are
    maintenance types, and every order is an event of its type at the asset of its customer's nation shifted by three,
    so some assets are unknown and those events are refused.
    """
    hour = lambda key: F.lit(dt.datetime(2026, 1, 1)).cast("timestamp") + F.make_dt_interval(F.lit(0), F.col(key).cast("int"))
    lines = t["region"].select(
        F.col("r_name").alias("line_code"),
        F.col("r_name").alias("line_name"),
        F.concat(F.lit("#0000"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0")).alias("color_hex"),
        F.lit(dt.date(2026, 1, 2)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    assets = t["nation"].select(F.lit("station").alias("asset_type"), hour("n_nationkey").alias("created_at"))
    kinds = t["orders"].select(
        F.col("o_orderpriority").alias("maintenance_type_name"), F.lit(None).cast("string").alias("description"), F.lit(30).alias("default_interval_days")
    )
    stations = t["nation"].select(
        hour("n_nationkey").alias("created_at"),
        F.lit(None).cast("string").alias("parent_station_code"),
        F.col("n_name").alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.lit(dt.date(2026, 1, 5)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    regions = t["region"].select("r_regionkey", "r_name")
    placed = t["nation"].join(regions, F.col("r_regionkey") == F.col("n_regionkey") + 2, "left")
    order_on_line = Window.partitionBy("r_name").orderBy("n_nationkey")
    places = placed.select(
        F.col("r_name").alias("line_code"),
        F.col("n_name").alias("station_code"),
        F.row_number().over(order_on_line).cast("smallint").alias("station_sequence"),
        (F.row_number().over(order_on_line) * 10).cast("decimal(6,2)").alias("distance_from_origin_km"),
        F.lit(dt.date(2026, 1, 5)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    start = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp") + F.make_dt_interval((F.col("o_orderkey") % 30).cast("int"))
    events = (
        t["orders"]
        .select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(t["customer"].select("c_custkey", (F.col("c_nationkey") + 3).alias("_asset_nation")), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.lit("station").alias("asset_type"),
            hour("_asset_nation").alias("created_at"),
            F.col("o_orderpriority").alias("maintenance_type_name"),
            start.alias("scheduled_start"),
            (start + F.make_dt_interval(F.lit(1))).alias("scheduled_end"),
            F.lit(None).cast("timestamp").alias("actual_start"),
            F.lit(None).cast("timestamp").alias("actual_end"),
            F.lit("planned").alias("maintenance_status"),
            F.lit(None).cast("string").alias("notes"),
        )
    )
    batches = {"line": lines, "asset": assets, "maintenance_type": kinds, "station": stations, "line_station": places, "maintenance_event": events}
    steps = [(loads.TRANSIT_LOADS[name], batch) for name, batch in batches.items()]
    _, done, again = _ran(steps, transit.TABLES, loads.empty_tables(t.spark, transit.TABLES))
    return _outcomes(done, again)


@registered(
    """
    WITH seg AS (
        SELECT n_nationkey, n_name, lead(n_name) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS next_name FROM nation
    ), trips AS (
        SELECT o.o_orderkey, s.next_name, e.s_name
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN seg s ON s.n_nationkey = c.c_nationkey
        LEFT JOIN supplier e ON e.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)
    )
    SELECT 'line' AS load, count(*) AS inserted, 0 AS rejected, 0 AS inserted_again FROM region
    UNION ALL SELECT 'asset', 2 * (SELECT count(*) FROM nation) + (SELECT count(*) FROM supplier), 0, 0
    UNION ALL SELECT 'station', count(*), 0, 0 FROM nation
    UNION ALL SELECT 'line_station', count(*), 0, 0 FROM nation
    UNION ALL SELECT 'train', count(*), 0, 0 FROM supplier
    UNION ALL SELECT 'track_segment', count(next_name), count(*) - count(next_name), 0 FROM seg
    UNION ALL SELECT 'schedule_version', count(*), 0, 0 FROM region
    UNION ALL SELECT 'trip', count(next_name), count(*) - count(next_name), 0 FROM trips
    UNION ALL SELECT 'trip_stop', 2 * count(next_name), 2 * (count(*) - count(next_name)), 0 FROM trips
    UNION ALL SELECT 'train_assignment', count(*) FILTER (WHERE next_name IS NOT NULL AND s_name IS NOT NULL),
                     count(*) FILTER (WHERE next_name IS NULL OR s_name IS NULL), 0 FROM trips
    """
)
def transit_trips_loads(t: Retail):
    """Trains, track segments, schedules, trips, their stops and trains, on lines and stations; loaded in order and run twice.

    Regions are lines with one weekday schedule each, nations stations on their region's line, suppliers trains. A segment
    runs from each nation to the next one of its region, so the last nation of a region has none and is refused. Every
    order is a trip from its customer's nation to the next one of the region (refused where there is none) with a stop at
    each end, run by the train of supplier key order key modulo the number of suppliers; stops and trains of refused
    trips are refused too.
    """
    at = lambda day, key: F.lit(day).cast("timestamp") + F.make_dt_interval(F.lit(0), F.col(key).cast("int"))
    station_at, train_at, segment_at = (lambda key, d=d: at(d, key) for d in (dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)))
    lines = t["region"].select(
        F.col("r_name").alias("line_code"),
        F.col("r_name").alias("line_name"),
        F.concat(F.lit("#0000"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0")).alias("color_hex"),
        F.lit(dt.date(2026, 1, 2)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    nations = t["nation"].join(t["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    nations = nations.withColumn("next_name", F.lead("n_name").over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")))
    suppliers = t["supplier"].select("s_suppkey", "s_name")
    assets = union_all(
        [
            t["nation"].select(F.lit("station").alias("asset_type"), station_at("n_nationkey").alias("created_at")),
            t["nation"].select(F.lit("track_segment").alias("asset_type"), segment_at("n_nationkey").alias("created_at")),
            suppliers.select(F.lit("train").alias("asset_type"), train_at("s_suppkey").alias("created_at")),
        ]
    )
    stations = t["nation"].select(
        station_at("n_nationkey").alias("created_at"),
        F.lit(None).cast("string").alias("parent_station_code"),
        F.col("n_name").alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.lit(dt.date(2026, 1, 5)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    on_line = nations.select(
        F.col("r_name").alias("line_code"),
        F.col("n_name").alias("station_code"),
        F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).cast("smallint").alias("station_sequence"),
        F.lit(0).cast("decimal(6,2)").alias("distance_from_origin_km"),
        F.lit(dt.date(2026, 1, 5)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    trains = suppliers.select(
        train_at("s_suppkey").alias("created_at"),
        F.col("s_name").alias("fleet_number"),
        F.lit("M1").alias("model_name"),
        F.lit(100).alias("capacity"),
        F.lit(dt.date(2026, 2, 1)).alias("commissioned_on"),
        F.lit(None).cast("date").alias("decommissioned_on"),
    )
    segments = nations.select(
        segment_at("n_nationkey").alias("created_at"),
        F.col("n_name").alias("from_station_code"),
        F.col("next_name").alias("to_station_code"),
        F.lit(5).cast("decimal(6,2)").alias("length_km"),
        F.lit(dt.date(2026, 1, 5)).alias("opened_on"),
        F.lit(None).cast("date").alias("closed_on"),
    )
    schedule = F.concat(F.col("r_name"), F.lit(" weekday"))
    schedules = t["region"].select(
        F.col("r_name").alias("line_code"),
        schedule.alias("schedule_name"),
        F.lit("weekday").alias("day_type"),
        F.lit(dt.date(2026, 1, 5)).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(dt.datetime(2026, 1, 4)).alias("created_at"),
    )
    server = F.col("o_orderkey") % suppliers.agg(F.count(F.lit(1))).scalar()
    orders = (
        t["orders"]
        .select("o_orderkey", "o_custkey", server.alias("_server"))
        .join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "next_name", "r_name"), "c_nationkey")
        .withColumn("trip_code", F.concat(F.lit("TRIP"), F.col("o_orderkey").cast("string")))
    )
    trips = orders.select(
        schedule.alias("schedule_name"),
        F.col("n_name").alias("origin_station_code"),
        F.col("next_name").alias("destination_station_code"),
        "trip_code",
        F.lit("outbound").alias("direction"),
        ((F.col("o_orderkey") % 1000) * 60).cast("int").alias("planned_departure_time"),
        ((F.col("o_orderkey") % 1000) * 60 + 600).cast("int").alias("planned_arrival_time"),
        F.lit(0).cast("smallint").alias("arrival_day_offset"),
    )
    stop = lambda station, seq: orders.select(
        "trip_code",
        F.col("r_name").alias("line_code"),
        F.col(station).alias("station_code"),
        F.lit(seq).cast("smallint").alias("stop_sequence"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10 * (seq - 1))).alias("arrival_offset"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10 * (seq - 1) + 1)).alias("departure_offset"),
    )
    runs = orders.join(suppliers, F.col("_server") == F.col("s_suppkey"), "left").select(
        "trip_code", F.col("s_name").alias("fleet_number"), F.lit(dt.date(2026, 1, 5)).alias("valid_from"), F.lit(None).cast("date").alias("valid_to")
    )
    batches = {
        "line": lines,
        "asset": assets,
        "station": stations,
        "line_station": on_line,
        "train": trains,
        "track_segment": segments,
        "schedule_version": schedules,
        "trip": trips,
        "trip_stop": union_all([stop("n_name", 1), stop("next_name", 2)]),
        "train_assignment": runs,
    }
    steps = [(loads.TRANSIT_LOADS[name], batch) for name, batch in batches.items()]
    _, done, again = _ran(steps, transit.TABLES, loads.empty_tables(t.spark, transit.TABLES))
    return _outcomes(done, again)


@registered(
    """
    SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS ticket_number, o_orderpriority AS ticket_type_name,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS offer_valid_from, 0 AS rejected_rows
    FROM orders WHERE year(o_orderdate) < 2001
    UNION ALL
    SELECT NULL, NULL, NULL, count(*) FROM orders WHERE year(o_orderdate) >= 2001
    """
)
def ticket_sales_three_levels(t: Retail):
    """An order's priority names a ticket type, its year the offer of that type, and the sale takes the offer's id.

    There are no offers from 2001 on, so those sales are refused. Ids are traced back to the names.
    """
    tables = transit.TABLES
    year = F.date_trunc("year", "o_orderdate").cast("date")
    types = t["orders"].select(F.col("o_orderpriority").alias("ticket_type_name"), F.lit(None).cast("string").alias("description"))
    offers = t["orders"].where(F.col("o_orderdate") < F.lit(dt.date(2001, 1, 1))).select(
        F.col("o_orderpriority").alias("ticket_type_name"),
        F.make_dt_interval(F.lit(1)).alias("validity_period"),
        F.lit(2).cast("decimal(10,2)").alias("price"),
        year.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    ).distinct()
    day = F.col("o_orderdate").cast("timestamp")
    sales = t["orders"].select(
        F.col("o_orderpriority").alias("ticket_type_name"),
        year.alias("offer_valid_from"),
        F.lit(None).cast("string").alias("station_code"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("ticket_number"),
        day.alias("valid_from"),
        day.alias("valid_to"),
        F.lit("app").alias("sale_channel"),
    )
    steps = [(loads.TRANSIT_LOADS[n], b) for n, b in (("ticket_type", types), ("ticket_offer", offers), ("ticket_sale", sales))]
    current, reports = loads.run_loads(steps, tables, loads.empty_tables(t.spark, tables))
    named = (
        current["ticket_sale"]
        .select("ticket_number", "ticket_offer_id")
        .join(current["ticket_offer"].select("ticket_offer_id", "ticket_type_id", F.col("valid_from").alias("offer_valid_from")), "ticket_offer_id")
        .join(current["ticket_type"].select("ticket_type_id", "ticket_type_name"), "ticket_type_id")
        .select("ticket_number", "ticket_type_name", "offer_valid_from", F.lit(0).cast("long").alias("rejected_rows"))
    )
    refused = _count(reports["2:ticket_sale"].rejected, "rejected_rows")
    return named.unionByName(refused, allowMissingColumns=True)


# ------------------------------------------------------------------- film rental
@registered(
    """
    WITH known AS (SELECT * FROM part WHERE p_size <= 24), n AS (SELECT count(*) AS films FROM known),
    a AS (SELECT count(*) AS parts FROM part), s AS (SELECT max(s_suppkey) AS last, count(*) AS people FROM supplier)
    SELECT 'film' AS load, films AS inserted, parts - films AS rejected, 0 AS inserted_again FROM n, a
    UNION ALL SELECT 'actor', people, 0, 0 FROM s
    UNION ALL SELECT 'film_actor', (SELECT count(*) FROM known, s WHERE p_partkey <= last),
                     (SELECT count(*) FROM part, s WHERE p_size > 24 OR p_partkey > last), 0
    UNION ALL SELECT 'inventory', films, parts - films, 0 FROM n, a
    UNION ALL SELECT 'rental', films, parts - films, 0 FROM n, a
    UNION ALL SELECT 'payment', films, parts - films, 0 FROM n, a
    """
)
def film_rental_loads(t: Retail):
    """Parts are films in the language of nation ``p_size``, of which there are 25; suppliers are actors and staff."""
    empty = {n: t.spark.createDataFrame([], s) for n, s in film_rental.SCHEMAS.items()}
    title = F.concat_ws(" ", "p_brand", "p_name", F.col("p_partkey").cast("string")).alias("title")
    languages = t["nation"].select(F.col("n_nationkey").cast("long").alias("language_id"), F.col("n_name").alias("name"))
    batch = t["part"].select(
        title,
        F.lit(2000).alias("release_year"),
        F.concat(F.lit("NATION_"), F.col("p_size").cast("string")).alias("language_name"),
        F.lit("0.99").cast("decimal(4,2)").alias("rental_rate"),
    )
    name = lambda key: numbered_code("", F.col(key), 9).alias("last_name")
    people = t["supplier"].select(F.lit("Supplier").alias("first_name"), name("s_suppkey"))
    casting = t["part"].select(title, name("p_partkey"))
    titles = batch.select("title")
    when = F.lit(NOW).cast("timestamp")
    stores = t["region"].select(F.col("r_regionkey").cast("long").alias("store_id"))
    staff = t["supplier"].select(F.col("s_suppkey").alias("staff_id"), F.lit(0).cast("long").alias("store_id"))
    buyer = t["customer"].where(F.col("c_custkey") == t["customer"].agg(F.min("c_custkey")).scalar())
    buyer = buyer.select(F.col("c_custkey").alias("customer_id"))

    def steps(now):
        done = {"film": loads.insert_films(now["film"], languages, batch, NOW)}
        film = done["film"].snapshot
        done["actor"] = loads.insert_actors(now["actor"], people, NOW)
        cast = (film, {"title": "title"}, "film_id"), (done["actor"].snapshot, {"last_name": "last_name"}, "actor_id")
        done["film_actor"] = loads.insert_links(now["film_actor"], casting, *cast, NOW)
        done["inventory"] = loads.insert_copies(now["inventory"], film, stores, titles, NOW)
        copies = done["inventory"].snapshot
        rented = titles.withColumn("rental_date", when)
        done["rental"] = loads.insert_rentals(now["rental"], copies, film, staff, buyer, rented, NOW)
        paid = titles.withColumn("payment_date", when)
        done["payment"] = loads.insert_payments(now["payment"], done["rental"].snapshot, copies, film, buyer, paid)
        return done

    first = steps(empty)
    return _outcomes(first, steps({n: d.snapshot for n, d in first.items()}))


@registered(
    """
    WITH newest AS (SELECT max(p_partkey) AS copy FROM part), free AS (
        SELECT s_suppkey FROM supplier WHERE NOT EXISTS (
            SELECT 1 FROM lineitem, newest WHERE l_partkey = copy AND l_suppkey = s_suppkey AND l_linestatus = 'O')
    )
    SELECT row_number() OVER (ORDER BY s_suppkey) + (SELECT max(l_orderkey) FROM lineitem) AS rental_id,
           copy AS inventory_id, s_suppkey AS customer_id, TIMESTAMP '2026-01-31' AS rental_date,
           (SELECT max(s_suppkey) FROM supplier) AS staff_id
    FROM free, newest
    """
)
def guarded_open_rentals(t: Retail):
    """Each supplier rents the newest part, but for those who hold it in an open line."""
    moment = lambda c: F.col(c).cast("timestamp")
    rentals = t["lineitem"].select(
        F.col("l_orderkey").alias("rental_id"),
        moment("l_shipdate").alias("rental_date"),
        F.col("l_partkey").alias("inventory_id"),
        F.col("l_suppkey").alias("customer_id"),
        F.when(F.col("l_linestatus") != "O", moment("l_shipdate")).alias("return_date"),
        F.lit(1).cast("long").alias("staff_id"),
        moment("l_shipdate").alias("last_update"),
    )
    copies = t["part"].select(F.col("p_partkey").alias("inventory_id"))
    people = t["supplier"].select(F.col("s_suppkey").alias("customer_id"))
    staff = t["supplier"].select(F.col("s_suppkey").alias("staff_id"))
    added = loads.insert_open_rental(rentals, copies, staff, people, NOW).inserted
    day = F.col("rental_date").cast("timestamp_ntz").alias("rental_date")
    return added.select("rental_id", "inventory_id", "customer_id", day, "staff_id")


@registered(
    """
    WITH doomed AS (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING')
    SELECT 'payment' AS from_table, (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM doomed)) AS deleted,
           (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM doomed)) AS kept
    UNION ALL
    SELECT 'rental', (SELECT count(*) FROM doomed), (SELECT count(*) FROM orders) - (SELECT count(*) FROM doomed)
    """
)
def two_step_delete(t: Retail):
    """A segment's payments (lines) go first, then its rentals (orders)."""
    people = t["customer"].where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders, lines = t["orders"].select("o_orderkey", "o_custkey"), t["lineitem"].select("l_orderkey")
    rentals = changes.delete_matching(orders, people, {"o_custkey": "c_custkey"})
    payments = changes.delete_matching(lines, rentals.affected, {"l_orderkey": "o_orderkey"})
    parts = []
    for name, change in (("payment", payments), ("rental", rentals)):
        kept = _count(change.snapshot, "kept")
        parts.append(_count(change.affected, "deleted", from_table=name).withColumn("kept", kept.scalar()))
    return union_all(parts)


# ------------------------------------------------------------ messages and refusals
def _patches(t: Retail):
    status = F.col("o_orderstatus")
    return t["orders"].select(
        # Open orders name a customer that is not there.
        F.when(status == "O", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("c_custkey"),
        F.when(status == "F", "c_custkey").otherwise("c_mktsegment").alias("column_name"),
        F.col("o_orderpriority").alias("new_value"),
        F.col("o_orderkey").alias("seq"),
    )


def _patched(t: Retail):
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return changes.patch_columns(customers, _patches(t), "c_custkey", ["c_name", "c_mktsegment"], "seq")


@registered(
    """
    SELECT o_orderkey AS seq, 'c_custkey ' || CAST(o_custkey AS VARCHAR) || ': c_mktsegment is now ' || o_orderpriority AS message
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O') AND o_custkey IN (SELECT c_custkey FROM customer)
    """
)
def patch_messages(t: Retail):
    return _patched(t).messages.select("seq", "message")


@registered(
    """
    SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'column c_custkey may not be changed'
           ELSE 'no row has c_custkey ' || CAST(-1 - o_custkey AS VARCHAR) END AS reject_reason
    FROM orders WHERE o_orderstatus IN ('F', 'O')
    UNION ALL SELECT o_orderkey, 'no row has c_custkey ' || CAST(o_custkey AS VARCHAR)
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O') AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    """
)
def patch_rejects(t: Retail):
    return _patched(t).rejected.select("seq", "reject_reason")


@registered(
    """
    WITH batch AS (
        SELECT p_partkey AS seq, CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN ' ' ELSE p_brand || ' ' || p_name END AS title,
               CASE WHEN p_size <> 48 THEN p_type END AS language FROM part WHERE p_size > 25
    ), judged AS (
        SELECT seq, title, CASE WHEN title IS NULL THEN 'the title is missing' WHEN trim(title) = '' THEN 'the title is empty'
               WHEN language IS NULL THEN 'the language is missing' END AS reason FROM batch
    ), repeated AS (
        SELECT seq, 'the film ' || title || ' is there already' AS reason,
               row_number() OVER (PARTITION BY upper(title) ORDER BY seq) AS n,
               upper(title) IN (SELECT upper(p_brand || ' ' || p_name) FROM part WHERE p_size <= 25) AS taken
        FROM judged WHERE reason IS NULL
    )
    SELECT seq, reason AS reject_reason FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT seq, reason FROM repeated WHERE taken OR n > 1
    """
)
def register_rejects(t: Retail):
    """Films that cannot be registered: no title, no language, or there already."""
    title = F.concat("p_brand", F.lit(" "), "p_name")
    small, size = F.col("p_size") <= 25, F.col("p_size")
    catalogue = t["part"].where(small).select(F.col("p_partkey").alias("film_id"), title.alias("title"))
    catalogue = t.spark.createDataFrame([], film_rental.SCHEMAS["film"]).unionByName(catalogue, allowMissingColumns=True)
    languages = t.spark.createDataFrame([], film_rental.SCHEMAS["language"])
    batch = t["part"].where(~small).select(
        F.when(size == 49, " ").when(size != 50, title).alias("title"),
        F.when(size != 48, F.col("p_type")).alias("language_name"),
        F.col("p_partkey").alias("seq"),
    )
    return loads.register_films(catalogue, languages, batch, 2002, registered_at=NOW).rejected.select("seq", "reject_reason")


# ------------------------------------------------------------- checks before and after
@registered("SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderkey, o_custkey) IN (SELECT l_orderkey, l_suppkey FROM lineitem)")
def rows_in_place(t: Retail):
    """What a load of (order, supplier) pairs would find present among (order, customer) pairs."""
    wanted = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"))
    return loads.already_present(t["orders"].select("o_orderkey", "o_custkey"), wanted, ["o_orderkey", "o_custkey"])


@registered(
    """
    SELECT 2000 AS target_year, 2 AS target_quarter, p_type AS category_name,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, true AS same_as_report
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_shipdate >= TIMESTAMP '2000-04-01' AND l_shipdate < TIMESTAMP '2000-07-01'
    GROUP BY p_type HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0
    """
)
def revenue_by_sql_function(t: Retail):
    """A SQL table function with a named argument over a view, equal to the report in DataFrame form."""
    day = dt.date(2000, 5, 17)
    # Categories are numbered by a key that their name determines.
    bridge = _parts(t).select("film_id", F.xxhash64("category_name").alias("category_id"), "category_name")
    lines = t["lineitem"].select(
        F.col("l_partkey").alias("film_id"), F.col("l_shipdate").alias("payment_date"), money("l_extendedprice").alias("amount")
    )
    view = define_view(t.spark, "ambertill_line_payments", lambda spark: lines)
    name = films.define_revenue_function(t.spark, view, bridge, "ambertill_")
    found = t.spark.sql(f"SELECT * FROM {name}(target_date => DATE'{day}')")
    report = films.revenue_by_category_in_quarter(lines, "film_id", bridge, day)
    same = same_multiset(found, report.select(*(F.col(f.name).cast(f.dataType) for f in found.schema)))
    return found.select(
        "target_year", "target_quarter", "category_name", as_double(F.col("total_revenue")).alias("total_revenue"), F.lit(same).alias("same_as_report")
    )


@registered(
    """
    SELECT c_custkey, c_name, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code, n.copies
    FROM customer, (VALUES (1), (2)) n(copies)
    """
)
def snapshot_round_trip(t: Retail):
    """Written by a text code, appended to, and read back: the code stays text. The first reading is kept beside the second."""
    customers = t["customer"].select(
        "c_custkey", "c_name", F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation_code"), F.lit(1).alias("copies")
    )
    path = f"{scratch_dir(t.spark)}/snapshot-{uuid.uuid4().hex}"
    once = sinks.write_snapshot(customers, path, ("nation_code",))
    whole = f"{path}-whole"
    kept = sinks.create_table_as(once, whole)
    sinks.append_rows(kept.withColumn("copies", F.lit(2)), whole)
    return t.spark.read.schema(kept.schema).parquet(whole)


_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
}
_REFERENCES = {
    "nation": (ref("n_regionkey", "region", "r_regionkey"),),
    "customer": (ref("c_nationkey", "nation", "n_nationkey"),),
    "orders": (ref("o_custkey", "customer", "c_custkey"),),
    "lineitem": (ref("l_orderkey", "orders", "o_orderkey"), ref("l_partkey", "part", "p_partkey")),
    "events": (ref("user_id", "supplier", "s_suppkey"),),
}
_CHECKS = {
    "customer": {"balance not negative": "c_acctbal >= 0"},
    "part": {"size within 40": "p_size <= 40"},
    "orders": {"known status": "o_orderstatus in ('F', 'O')"},
    "lineitem": {"quantity within 45": "l_quantity <= 45", "discount within 0.09": "l_discount <= 0.09"},
    "events": {"value positive": "value > 0"},
}
_LENGTHS = {"customer": {"c_mktsegment": 8}, "part": {"p_name": 10}}


def _declared() -> dict[str, Table]:
    return {
        name: Table(name, SCHEMAS[name], key, references=_REFERENCES.get(name, ()), checks=_CHECKS.get(name, {}), max_length=_LENGTHS.get(name, {}))
        for name, key in _KEYS.items()
    }


def _audit_sql() -> str:
    parts = []

    def add(table: str, rule: str, count: str) -> None:
        parts.append(f"SELECT '{table}' AS table_name, '{rule.replace(chr(39), chr(39) * 2)}' AS rule, CAST(({count}) AS BIGINT) AS violations")

    for name, table in _declared().items():
        for c in table.primary_key:
            add(name, f"{c} is not null", f"SELECT count(*) FROM {name} WHERE {c} IS NULL")
        for c, n in table.max_length.items():
            add(name, f"{c} within {n} characters", f"SELECT count(*) FROM {name} WHERE length({c}) > {n}")
        for rule, check in table.checks.items():
            add(name, rule, f"SELECT count(*) FROM {name} WHERE NOT ({check})")
        keys = ", ".join(table.primary_key)
        add(name, f"unique ({keys})", f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {name} GROUP BY {keys})")
        for r in table.references:
            (mine,), (theirs,) = r.columns, r.targets
            add(name, f"{mine} in {r.table}", f"SELECT count(*) FROM {name} WHERE {mine} NOT IN (SELECT {theirs} FROM {r.table})")
    return " UNION ALL ".join(parts)


@registered(_audit_sql())
def declared_audit(t: Retail):
    """Keys, references, lengths and checks of eight tables: violations of every rule, each table read once."""
    return audit_in_one_pass(_declared(), {name: t[name] for name in _KEYS})


@registered(
    """
    SELECT (SELECT count(*) FROM lineitem) AS rows_left, (SELECT count(*) FROM lineitem) AS rows_right,
           true AS same, CAST(0 AS BIGINT) AS differing_rows
    """
)
def lines_same_multiset(t: Retail):
    """The line table against itself rebuilt from its return-flag parts: equal as multisets, by checksums of both sides."""
    lines = t["lineitem"]
    flag = F.col("l_returnflag")
    parts = [lines.where(flag == v) for v in ("A", "N", "R")] + [lines.where(flag.isNull() | ~flag.isin("A", "N", "R"))]
    rebuilt = union_all(parts)
    left, right = checksum(lines).first(), checksum(rebuilt).first()
    same = left == right
    differing = 0 if same else differences(lines, rebuilt).count()
    return t.spark.createDataFrame([(left["rows"], right["rows"], same, differing)], "rows_left long, rows_right long, same boolean, differing_rows long")


# ------------------------------------------------------------ life cycle of a saved table, array columns
@registered(
    """
    SELECT 'created' AS step, count(*) AS row_count FROM customer
    UNION ALL SELECT 'a third deleted', count(*) FILTER (WHERE NOT coalesce(c_custkey % 3 = 0, false)) FROM customer
    UNION ALL SELECT 'truncated', 0
    UNION ALL SELECT 'dropped', 0
    """
)
def table_life_cycle(t: Retail):
    """Create a saved table from the customers, delete a third into its next snapshot, truncate it, drop it.

    ``row_count`` of the last step is 1 if the table still exists, else 0.
    """
    spark = t.spark
    # Managed tables in the shared warehouse: TRUNCATE is refused on tables whose files lie elsewhere.
    first, second = f"life_{uuid.uuid4().hex}", f"life_{uuid.uuid4().hex}"
    customers = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    sinks.save_table(customers, first)
    created = spark.table(first).count()
    kept = changes.delete_where(spark.table(first), F.col("c_custkey") % 3 == 0).snapshot
    sinks.save_table(kept, second)
    sinks.drop_table(spark, first)
    after = spark.table(second).count()
    sinks.truncate_table(spark, second)
    truncated = spark.table(second).count()
    sinks.drop_table(spark, second)
    exists = int(spark.catalog.tableExists(second))
    steps = [("created", created), ("a third deleted", after), ("truncated", truncated), ("dropped", exists)]
    return spark.createDataFrame(steps, "step string, row_count long")


@registered("SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_components FROM embeddings")
def embedding_sizes(t: Retail):
    """``size`` of an array column of the given table; a NULL array has NULL size."""
    vectors = t.spark.read.parquet(f"{t.folder}/embeddings.parquet")
    return vectors.select("vec_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("int").alias("n_components"))


@registered(
    """
    SELECT vec_id, count(x) AS n_values, CAST(max(x) AS DOUBLE) AS largest
    FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id
    """
)
def embedding_components(t: Retail):
    """``unnest`` of an array column without positions: values per vector; NULL and empty arrays give no row."""
    vectors = t.spark.read.parquet(f"{t.folder}/embeddings.parquet")
    values = vectors.select("vec_id", F.explode("embedding").alias("x"))
    return values.groupBy("vec_id").agg(F.count("x").alias("n_values"), F.max("x").cast("double").alias("largest"))
