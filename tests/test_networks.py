"""Loads, ingest, patches and audits of the fuel and transit schemas."""

import datetime as dt
from decimal import Decimal

import pytest

from ambertill.operators.changes import insert_missing
from ambertill.operators.quality import row_counts
from ambertill.plans import fuel, loads
from ambertill.sources import fuel_network, transit
from ambertill.sources.declared import audit, with_load_date
from conftest import bag, plan_of, rows

UTC = dt.timezone.utc
D = dt.date


def at(*parts):
    return dt.datetime(*parts, tzinfo=UTC)


# ------------------------------------------------------------------------ fuel
@pytest.fixture(scope="module")
def fuel_batches(spark):
    def batch(schema, data):
        return spark.createDataFrame(data, schema)

    start, april, may = at(2025, 12, 31, 22), at(2026, 3, 31, 22), at(2026, 4, 30, 20, 59, 59)
    prices = [
        (s, f, kind, price, since, until)
        for s in ("ST1", "ST2")
        for f, kind, price, since, until in (
            ("A95", "regular", "76.99", start, None),
            ("DIESEL", "regular", "93.99", start, None),
            ("LPG", "promo", "46.99", april, may),
        )
    ]
    sales = [
        ("ST1", "A95", "E2", "C1", "RCPT000001", at(2026, 4, 1, 5, 15), "30.00", "76.99", "card", "0"),
        ("ST1", "DIESEL", "E2", "C2", "RCPT000002", at(2026, 4, 1, 15, 25), "45.00", "93.99", "fuel_card", "0"),
        ("ST1", "LPG", "E2", "C3", "RCPT000003", at(2026, 4, 1, 6, 25), "20.00", "46.99", "cash", "0"),
        ("ST2", "A95", "E5", "C1", "RCPT000004", at(2026, 4, 2, 10, 5), "10.00", "76.99", "mobile_app", "20.00"),
        ("ST2", "DIESEL", "E5", "C2", "RCPT000005", at(2026, 4, 2, 10, 25), "31.00", "93.99", "card", "0"),
        ("ST2", "LPG", "E5", "C3", "RCPT000006", at(2026, 4, 2, 10, 35), "32.00", "46.99", "card", "10.00"),
    ]
    return [
        ("station", batch("station_code string, station_name string, city string, address string, opened_on date, closed_on date",
            [("ST1", "North", "Town", "1 Road", D(2026, 1, 5), None), ("ST2", "South", "Town", "2 Road", D(2026, 1, 9), None)])),
        ("fuel", batch("fuel_code string, fuel_name string", [("A95", "Gasoline A-95"), ("DIESEL", "Diesel Fuel"), ("LPG", "Liquefied Petroleum Gas")])),
        ("customer", batch("customer_code string, first_name string, last_name string, phone string, email string, registered_at timestamp",
            [("C1", "A", "B", "1", "a@x", at(2026, 4, 1)), ("C2", None, None, None, None, at(2026, 4, 1)), ("C3", "D", "S", None, None, at(2026, 4, 1))])),
        ("employee", batch("station_code string, employee_code string, first_name string, last_name string, job_title string, phone string, hired_on date",
            [("ST1", "E2", "I", "K", "cashier", "2", D(2026, 1, 7)), ("ST2", "E5", "S", "T", "cashier", "5", D(2026, 1, 7)), ("ST9", "E9", "X", "Y", "z", "9", D(2026, 1, 7))])),
        ("station_fuel", batch("station_code string, fuel_code string, tank_capacity_liters string, current_quantity_liters string",
            [(s, f, "12000.00", "8400.00") for s in ("ST1", "ST2") for f in ("A95", "DIESEL", "LPG")])),
        ("price", batch("station_code string, fuel_code string, price_type string, price_per_liter string, valid_from timestamp, valid_to timestamp", prices)),
        ("fuel_sale", batch("station_code string, fuel_code string, employee_code string, customer_code string, receipt_number string, "
            "sale_datetime timestamp, quantity_liters string, price_per_liter string, payment_method string, discount_amount string", sales)
            .selectExpr("* except (quantity_liters, price_per_liter, discount_amount)", *(f"cast({c} as decimal(10,2)) {c}" for c in ("quantity_liters", "price_per_liter", "discount_amount")))),
    ]


@pytest.fixture(scope="module")
def network(spark, fuel_batches):
    plan = [(loads.FUEL_LOADS[name], batch) for name, batch in fuel_batches]
    return loads.run_loads(plan, fuel_network.TABLES, loads.empty_tables(spark, fuel_network.TABLES))


def test_loads_resolve_keys_and_reject_unknown_ones(network):
    data, reports = network
    assert dict(rows(row_counts(data))) == {
        "station": 2, "fuel": 3, "customer": 3, "employee": 2, "station_fuel": 6, "price": 6, "fuel_sale": 6,
    }
    rejected = reports["3:employee"].rejected
    assert rows(rejected, "employee_code", "reject_reason") == [("E9", "station not found for station_code")]
    assert bag(data["fuel"], "unit_name", "is_active") == [("liter", True)] * 3


def test_second_run_adds_nothing(network, fuel_batches):
    data, _ = network
    chosen = ("station", "price", "fuel_sale")
    plan = [(loads.FUEL_LOADS[name], batch) for name, batch in fuel_batches if name in chosen]
    _, again = loads.run_loads(plan, fuel_network.TABLES, data)
    assert all(done.inserted.isEmpty() for done in again.values())


def test_audit_is_clean_and_finds_planted_faults(spark, network):
    data, _ = network
    report = audit(fuel_network.TABLES, data)
    assert report.where("violations <> 0").isEmpty()
    assert report.count() == sum(
        len(t.rules()) + 1 + len(t.unique) + len(t.references) for t in fuel_network.TABLES.values()
    )
    bad = dict(data)
    bad["price"] = data["price"].unionByName(
        data["price"].limit(1).selectExpr("price_id", "999L station_fuel_id", "'free' price_type", "cast(-1 as decimal(10,2)) price_per_liter", "valid_from", "valid_from - interval 1 day valid_to")
    )
    found = dict(rows(audit({"price": fuel_network.TABLES["price"]}, bad).where("violations <> 0"), "rule", "violations"))
    assert found == {"known price type": 1, "price positive": 1, "valid_to after valid_from": 1, "unique (price_id)": 1, "station_fuel_id in station_fuel": 1}


def test_latest_quarter_report(network):
    data, _ = network
    found = rows(fuel.latest_quarter_report(data["fuel_sale"], data["station_fuel"], data["station"], data["fuel"]))
    as_int = [(r[0], r[1], r[2], r[3], *(int(v) for v in r[4:])) for r in found]
    assert as_int == [
        (2026, 2, "North", "Diesel Fuel", 45, 4230, 1, 4230, 0),
        (2026, 2, "North", "Gasoline A-95", 30, 2310, 1, 2310, 0),
        (2026, 2, "North", "Liquefied Petroleum Gas", 20, 940, 1, 940, 0),
        (2026, 2, "South", "Diesel Fuel", 31, 2914, 1, 2914, 0),
        (2026, 2, "South", "Liquefied Petroleum Gas", 32, 1494, 1, 1494, 10),
        (2026, 2, "South", "Gasoline A-95", 10, 750, 1, 750, 20),
    ]
    totals = bag(data["fuel_sale"], "total_amount")
    assert sum(t[0] for t in totals) == Decimal("12636.32")


def test_ingest(spark, network):
    data, _ = network
    schema = (
        "seq int, station_code string, fuel_code string, employee_code string, customer_code string, quantity_liters decimal(10,2), "
        "payment_method string, price_type string, discount_amount decimal(10,2), sale_datetime timestamp"
    )
    april, june, zero = at(2026, 4, 5), at(2026, 6, 5), Decimal(0)
    liters = lambda x: Decimal(x)
    batch = spark.createDataFrame(
        [
            (1, "ST1", "A95", "E2", "C3", liters("20"), "cash", "regular", zero, april),
            (2, "ST2", "LPG", "E5", "C1", liters("40.80"), "card", "promo", Decimal(10), april),
            (3, "ST2", "LPG", "E5", "C1", liters("40.80"), "card", "promo", Decimal(10), june),
            (4, "ST2", "A95", "E5", "C2", liters("42.50"), "mobile_app", "promo", Decimal(200), april),
            (5, "ST1", "LPG", "E2", "C1", liters("10"), "cash", "regular", zero, april),
            (6, "ST1", "H2", "E2", "C1", liters("10"), "cash", "regular", zero, april),
            (7, "ST1", "A95", "E7", "C1", liters("10"), "cash", "regular", zero, april),
            (8, "ST1", "A95", "E2", "C7", liters("10"), "cash", "regular", zero, april),
            (9, "ST1", "A95", "E2", "C1", liters("10"), "barter", "regular", zero, april),
            (10, "ST1", "A95", "E2", "C1", liters("1"), "cash", "regular", Decimal(77), april),
            (11, "ST1", "A95", "E2", "C1", liters("1"), "cash", "regular", zero, at(2025, 12, 31, 23)),
        ],
        schema,
    )
    done = fuel.ingest_sales(data, batch, dt.datetime(2026, 4, 6), next_receipt=7)
    assert bag(done.inserted, "fuel_sale_id", "receipt_number", "price_per_liter", "total_amount") == [
        (7, "RCPT000007", Decimal("76.99"), Decimal("1539.80")),
        (8, "RCPT000008", Decimal("46.99"), Decimal("1907.19")),
    ]
    reasons = dict(rows(done.rejected, "seq", "reject_reason"))
    assert reasons.pop(3).startswith("No promo price of ")
    assert reasons.pop(4).startswith("No promo price") and reasons.pop(5).startswith("No regular price")
    assert reasons == {
        6: "fuel not found for fuel_code",
        7: "employee not found for employee_code",
        8: "customer not found for customer_code",
        9: "rule broken: known payment method",
        10: "rule broken: discount within total",
        11: "rule broken: sold since 2026",
    }


def test_ingest_defaults(spark, network):
    data, _ = network
    batch = spark.createDataFrame(
        [(1, "ST1", "A95", "E2", "C3", Decimal("20"), "cash")],
        "seq int, station_code string, fuel_code string, employee_code string, customer_code string, quantity_liters decimal(10,2), payment_method string",
    )
    done = fuel.ingest_sales(data, batch, dt.datetime(2026, 5, 6), next_receipt=7)
    assert rows(done.inserted, "price_per_liter", "discount_amount", "sale_datetime") == [
        (Decimal("76.99"), Decimal("0.00"), dt.datetime(2026, 5, 6))
    ]
    assert done.rejected.isEmpty()


def test_customer_patches(spark, network):
    data, _ = network
    patches = spark.createDataFrame(
        [(1, "phone", "+99", 1), (2, "first_name", "Y", 2), (2, "customer_code", "X", 3), (77, "email", "e", 4)],
        "customer_id long, column_name string, new_value string, seq int",
    )
    done = fuel.patch_customers(data["customer"], patches)
    assert bag(done.snapshot, "customer_id", "first_name", "phone")[:2] == [(1, "A", "+99"), (2, "Y", None)]
    assert bag(done.rejected, "seq") == [(3,), (4,)]


def test_load_date_is_added_once(network):
    data, _ = network
    dated = with_load_date(data, D(2026, 4, 1))
    assert all("record_ts" in df.columns for df in dated.values())
    again = with_load_date(dated, D(2027, 1, 1))
    assert bag(again["station"], "record_ts") == [(D(2026, 4, 1),)] * 2


# --------------------------------------------------------------------- transit
@pytest.fixture(scope="module")
def transit_batches(spark):
    made = lambda schema, data: spark.createDataFrame(data, schema)
    minute = lambda m: at(2026, 1, 1, 7, m)
    gap = lambda m: dt.timedelta(minutes=m)
    clock = lambda h, m: 3600 * h + 60 * m
    since = D(2026, 1, 1)
    station = "created_at timestamp, parent_station_code string, station_code string, station_name string, opened_on date, closed_on date"
    return [
        ("line", made("line_code string, line_name string, color_hex string, opened_on date, closed_on date",
            [("L1", "Red", "#E53935", D(1960, 1, 1), None), ("L2", "Blue", "#1565C0", D(1976, 1, 1), None)])),
        ("asset", made("asset_type string, created_at timestamp",
            [("station", minute(0)), ("train", minute(5)), ("track_segment", minute(10)), ("station", minute(15)), ("station", minute(20))])),
        ("maintenance_type", made("maintenance_type_name string, description string, default_interval_days int", [("Inspection", "x", 30), ("Repair", None, None)])),
        ("ticket_type", made("ticket_type_name string, description string", [("Single", "one"), ("Day", "day")])),
        ("train", made("created_at timestamp, fleet_number string, model_name string, capacity int, commissioned_on date, decommissioned_on date",
            [(minute(5), "1207", "M", 1100, D(2015, 3, 1), None)])),
        ("station", made(station, [(minute(0), None, "HUB", "Hub", D(1976, 1, 1), None)])),
        ("station", made(station, [(minute(15), "HUB", "AAA", "A", D(1976, 1, 1), None), (minute(20), "HUB", "BBB", "B", D(1960, 1, 1), None), (minute(59), "HUB", "CCC", "C", D(1960, 1, 1), None)])),
        ("ticket_offer", made("ticket_type_name string, validity_period interval day to second, price string, valid_from date, valid_to date",
            [("Single", gap(90), "30.00", since, None), ("Day", gap(1440), "120.00", since, None)])),
        ("schedule_version", made("line_code string, schedule_name string, day_type string, effective_from date, effective_to date, created_at timestamp",
            [("L1", "Weekday", "weekday", since, None, minute(0)), ("L2", "Holiday", "holiday", since, D(2026, 1, 10), minute(1))])),
        ("line_station", made("line_code string, station_code string, station_sequence int, distance_from_origin_km string, valid_from date, valid_to date",
            [("L1", "HUB", 1, "0.00", since, None), ("L1", "AAA", 2, "2.40", since, None), ("L1", "BBB", 3, "5.10", since, None)])),
        ("track_segment", made("created_at timestamp, from_station_code string, to_station_code string, length_km string, opened_on date, closed_on date",
            [(minute(10), "HUB", "AAA", "2.40", since, None)])),
        ("trip", made("schedule_name string, origin_station_code string, destination_station_code string, trip_code string, direction string, planned_departure_time int, planned_arrival_time int",
            [("Weekday", "HUB", "BBB", "T1", "outbound", clock(8, 5), clock(8, 42)), ("Weekday", "BBB", "HUB", "T2", "inbound", clock(8, 45), clock(9, 22)), ("Holiday", "BBB", "HUB", "T2", "inbound", clock(8, 45), clock(9, 22))])),
        ("maintenance_event", made("asset_type string, created_at timestamp, maintenance_type_name string, scheduled_start timestamp, scheduled_end timestamp, actual_start timestamp, actual_end timestamp, notes string",
            [("station", minute(0), "Inspection", at(2026, 3, 15), at(2026, 3, 16), None, None, None)])),
        ("trip_stop", made("trip_code string, line_code string, station_code string, stop_sequence int, arrival_offset interval day to second, departure_offset interval day to second",
            [("T1", "L1", "HUB", 1, None, gap(0)), ("T1", "L1", "AAA", 2, gap(4), gap(5)), ("T2", "L1", "BBB", 1, None, gap(0))])),
        ("train_assignment", made("trip_code string, fleet_number string, valid_from date, valid_to date", [("T1", "1207", since, None), ("T1", "0000", D(2026, 5, 1), None)])),
        ("ticket_sale", made("ticket_type_name string, offer_valid_from date, station_code string, ticket_number string, sold_at timestamp, valid_from timestamp, valid_to timestamp, sale_channel string",
            [("Single", since, "HUB", "K1", at(2026, 3, 10), at(2026, 3, 10), at(2026, 3, 11), "kiosk"), ("Day", since, None, "K2", at(2026, 3, 10), at(2026, 3, 10), at(2026, 3, 11), "app"), ("Day", since, "ZZZ", "K3", at(2026, 3, 10), at(2026, 3, 10), at(2026, 3, 11), "app")])),
    ]


@pytest.fixture(scope="module")
def railway(spark, transit_batches):
    plan = [(loads.TRANSIT_LOADS[name], batch) for name, batch in transit_batches]
    return loads.run_loads(plan, transit.TABLES, loads.empty_tables(spark, transit.TABLES))


def test_transit_loads(railway):
    data, reports = railway
    assert dict(rows(row_counts(data))) == {
        "line": 2, "asset": 5, "maintenance_type": 2, "ticket_type": 2, "train": 1, "station": 3, "ticket_offer": 2,
        "schedule_version": 2, "line_station": 3, "track_segment": 1, "trip": 3, "maintenance_event": 1,
        "trip_stop": 2, "train_assignment": 1, "ticket_sale": 2,
    }
    reasons = [r[0] for done in reports.values() for r in rows(done.rejected, "reject_reason")]
    assert sorted(reasons) == [
        "asset not found for created_at",
        "station not found for station_code",
        "train not found for fleet_number",
        # Two schedules have a trip T2, so its code alone does not name one.
        "trip ambiguous for trip_code",
    ]
    assert bag(data["station"], "station_code", "parent_station_id") == [("AAA", 1), ("BBB", 1), ("HUB", None)]
    assert bag(data["ticket_sale"], "ticket_number", "sale_station_id") == [("K1", 1), ("K2", None)]
    assert bag(data["trip"], "arrival_day_offset") == [(0,)] * 3
    assert bag(data["maintenance_event"], "maintenance_status") == [("planned",)]


def test_transit_audit_and_rerun(railway, transit_batches):
    data, _ = railway
    assert audit(transit.TABLES, data).where("violations <> 0").isEmpty()
    chosen = ("line", "asset", "station", "trip_stop", "ticket_sale")
    plan = [(loads.TRANSIT_LOADS[name], batch) for name, batch in transit_batches if name in chosen]
    _, again = loads.run_loads(plan, transit.TABLES, data)
    assert all(done.inserted.isEmpty() for done in again.values())


def test_rules_of_both_schemas_cover_every_table():
    assert len(transit.TABLES) == 15 and len(fuel_network.TABLES) == 7
    for tables in (transit.TABLES, fuel_network.TABLES):
        for table in tables.values():
            columns = {c.split()[0] for c in table.schema.replace("decimal(10,2)", "d").replace("decimal(6,2)", "d").replace("decimal(12,2)", "d").split(", ")}
            named = {*table.primary_key, *table.required, *(c for u in table.unique for c in u), *(c for r in table.references for c in r.columns)}
            assert named <= columns, table.name
            assert all(r.table in tables for r in table.references)


def test_one_pass_audit_gives_the_same_rows(spark, network, railway):
    from ambertill.sources.declared import audit_in_one_pass

    data, _ = network
    bad = dict(data)
    bad["price"] = data["price"].unionByName(
        data["price"].limit(1).selectExpr("price_id", "999L station_fuel_id", "'free' price_type", "cast(-1 as decimal(10,2)) price_per_liter", "valid_from", "valid_from - interval 1 day valid_to")
    )
    for tables, frames in ((fuel_network.TABLES, data), (fuel_network.TABLES, bad), ({"price": fuel_network.TABLES["price"]}, bad), (transit.TABLES, railway[0])):
        assert bag(audit_in_one_pass(tables, frames)) == bag(audit(tables, frames))


def test_one_pass_audit_reads_a_table_once(spark):
    from ambertill.sources.declared import Table, audit_in_one_pass, ref

    tables = {
        "kid": Table("kid", "k long, a long, b long", ("k",), unique=(("a", "b"),), references=(ref("a", "mom", "m"), ref("b", "mom", "m")), checks={"b small": "b < 5"}),
        "mom": Table("mom", "m long", ("m",)),
    }
    kids = spark.createDataFrame([(1, 1, 1), (1, 2, 9), (2, 7, None), (None, 1, 1), (3, None, 2), (4, 1, 1)], "k long, a long, b long")
    moms = spark.createDataFrame([(1,), (2,), (2,), (None,)], "m long")
    data = {"kid": kids, "mom": moms}
    got = bag(audit_in_one_pass(tables, data))
    assert got == bag(audit(tables, data))
    assert ("kid", "a in mom", 1) in got and ("kid", "b in mom", 1) in got and ("kid", "unique (a, b)", 2) in got
    assert ("kid", "unique (k)", 1) in got and ("mom", "unique (m)", 1) in got and ("kid", "b small", 1) in got
    one = kids.groupingSets([["k"], ["a", "b"], ["a"], ["b"]], "k", "a", "b").count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and plan.count("Scan") == 1


def test_batches_are_made_once_for_both_runs(spark, monkeypatch):
    from ambertill.registered import jobs

    seen, plainly = [], loads.run_loads
    monkeypatch.setattr(loads, "run_loads", lambda steps, *rest: seen.append([batch for _, batch in steps]) or plainly(steps, *rest))
    names = spark.createDataFrame([(1, "A", "F1"), (2, "A", "F2"), (3, None, "F3")], "id long, fuel_code string, fuel_name string")
    batch = names.join(spark.range(1, 4), "id").drop("id")
    _, done, again = jobs._ran([(loads.FUEL_LOADS["fuel"], batch)], fuel_network.TABLES, loads.empty_tables(spark, fuel_network.TABLES))
    assert bag(done["fuel"].inserted, "fuel_code") == [("A",), (None,)] and bag(again["fuel"].inserted, "fuel_code") == [(None,)]
    assert len(seen) == 2 and all("Join" not in plan_of(b) for run in seen for b in run)
    assert bag(seen[0][0]) == bag(batch)
    assert "Join" in plan_of(batch)


def test_joins_with_an_empty_table_are_left_out(spark):
    empty = loads.empty_tables(spark, fuel_network.TABLES)["fuel"]
    assert empty.schema == spark.createDataFrame([], fuel_network.TABLES["fuel"].schema).schema and empty.isEmpty()
    batch = spark.createDataFrame([("A", "F1")], "fuel_code string, fuel_name string")
    added = insert_missing(empty, batch, ["fuel_code"]).affected
    assert "Join" not in plan_of(added) and bag(added) == [("A", "F1")]
