"""Fuel stations: 7 declared tables, and how each is loaded from natural keys."""

from __future__ import annotations

from ambertill.operators.matching import Lookup
from ambertill.sources.declared import Table, ref

#: Allowed values (fixed values).
PRICE_TYPES = ("regular", "promo", "partner_discount")
PAYMENT_METHODS = ("cash", "card", "mobile_app", "corporate_card", "fuel_card")
PATCHABLE = ("first_name", "last_name", "phone", "email")


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


#: Names, lengths, allowed values, conditions and defaults of the declared schema (fixed values).
TABLES = {
    t.name: t
    for t in (
        Table(
            "station",
            "station_id bigint, station_code string, station_name string, city string, address string, "
            "opened_on date, closed_on date",
            ("station_id",),
            unique=(("station_code",),),
            required=("station_code", "station_name", "city", "address", "opened_on"),
            max_length={"station_code": 50, "station_name": 100, "city": 100, "address": 100},
            checks={"closed after opened": "closed_on >= opened_on"},
        ),
        Table(
            "fuel",
            "fuel_id bigint, fuel_code string, fuel_name string, unit_name string, is_active boolean",
            ("fuel_id",),
            unique=(("fuel_code",),),
            required=("fuel_code", "fuel_name", "unit_name", "is_active"),
            max_length={"fuel_code": 50, "fuel_name": 100, "unit_name": 50},
            defaults={"unit_name": "'liter'", "is_active": "true"},
        ),
        Table(
            "customer",
            "customer_id bigint, customer_code string, first_name string, last_name string, phone string, "
            "email string, registered_at timestamp, is_active boolean",
            ("customer_id",),
            unique=(("customer_code",),),
            required=("customer_code", "registered_at", "is_active"),
            max_length={"customer_code": 50, "first_name": 50, "last_name": 50, "phone": 50, "email": 100},
            checks={"registered since 2026": "registered_at >= timestamp'2026-01-01 00:00:00+00:00'"},
            defaults={"registered_at": "current_timestamp()", "is_active": "true"},
        ),
        Table(
            "employee",
            "employee_id bigint, station_id bigint, employee_code string, first_name string, last_name string, "
            "job_title string, phone string, hired_on date, is_active boolean",
            ("employee_id",),
            unique=(("employee_code",),),
            references=(ref("station_id", "station"),),
            required=(
                "station_id", "employee_code", "first_name", "last_name", "job_title", "phone", "hired_on", "is_active",
            ),
            max_length={"employee_code": 50, "first_name": 50, "last_name": 50, "job_title": 50, "phone": 100},
            checks={"hired since 2026": "hired_on >= date'2026-01-01'"},
            defaults={"is_active": "true"},
        ),
        Table(
            "station_fuel",
            "station_fuel_id bigint, station_id bigint, fuel_id bigint, tank_capacity_liters decimal(10,2), "
            "current_quantity_liters decimal(10,2), is_available boolean",
            ("station_fuel_id",),
            unique=(("station_id", "fuel_id"),),
            references=(ref("station_id", "station"), ref("fuel_id", "fuel")),
            required=("station_id", "fuel_id", "tank_capacity_liters", "current_quantity_liters", "is_available"),
            checks={
                "capacity positive": "tank_capacity_liters > 0",
                "quantity not negative": "current_quantity_liters >= 0",
                "quantity within capacity": "current_quantity_liters <= tank_capacity_liters",
            },
            defaults={"is_available": "true"},
        ),
        Table(
            "price",
            "price_id bigint, station_fuel_id bigint, price_type string, price_per_liter decimal(10,2), "
            "valid_from timestamp, valid_to timestamp",
            ("price_id",),
            unique=(("station_fuel_id", "price_type", "valid_from"),),
            references=(ref("station_fuel_id", "station_fuel"),),
            required=("station_fuel_id", "price_type", "price_per_liter", "valid_from"),
            max_length={"price_type": 50},
            checks={
                "known price type": _one_of("price_type", PRICE_TYPES),
                "price positive": "price_per_liter > 0",
                "valid_to after valid_from": "valid_to >= valid_from",
            },
        ),
        Table(
            "fuel_sale",
            "fuel_sale_id bigint, station_fuel_id bigint, employee_id bigint, customer_id bigint, "
            "receipt_number string, sale_datetime timestamp, quantity_liters decimal(10,2), "
            "price_per_liter decimal(10,2), payment_method string, discount_amount decimal(10,2), "
            "total_amount decimal(12,2)",
            ("fuel_sale_id",),
            unique=(("receipt_number",),),
            references=(
                ref("station_fuel_id", "station_fuel"),
                ref("employee_id", "employee"),
                ref("customer_id", "customer"),
            ),
            required=(
                "station_fuel_id", "employee_id", "customer_id", "receipt_number", "sale_datetime",
                "quantity_liters", "price_per_liter", "payment_method", "discount_amount",
            ),
            max_length={"receipt_number": 50, "payment_method": 50},
            checks={
                "quantity positive": "quantity_liters > 0",
                "price positive": "price_per_liter > 0",
                "discount not negative": "discount_amount >= 0",
                "discount within total": "discount_amount <= quantity_liters * price_per_liter",
                "known payment method": _one_of("payment_method", PAYMENT_METHODS),
                "sold since 2026": "sale_datetime >= timestamp'2026-01-01 00:00:00+00:00'",
            },
            defaults={"sale_datetime": "current_timestamp()", "discount_amount": "cast(0 as decimal(10,2))"},
            generated={
                "total_amount": "cast(quantity_liters * price_per_liter - discount_amount as decimal(12,2))"
            },
        ),
    )
}

_STATION = Lookup("station_id", "station", "station_id", {"station_code": "station_code"})
_FUEL = Lookup("fuel_id", "fuel", "fuel_id", {"fuel_code": "fuel_code"})

#: From station and fuel code to the pair's id, in one go of two levels.
STATION_FUEL = (
    _STATION,
    _FUEL,
    Lookup(
        "station_fuel_id",
        "station_fuel",
        "station_fuel_id",
        {"station_id": "station_id", "fuel_id": "fuel_id"},
        message="station-fuel combination not found",
    ),
)
EMPLOYEE = Lookup("employee_id", "employee", "employee_id", {"employee_code": "employee_code"})
CUSTOMER = Lookup("customer_id", "customer", "customer_id", {"customer_code": "customer_code"})
