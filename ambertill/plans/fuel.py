"""Fuel sales: batch ingest with the price valid at the sale, and the quarter report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ambertill.functions.calendar import between_days, quarter_bounds
from ambertill.functions.numbers import rounded
from ambertill.functions.ordering import sort_columns
from ambertill.functions.text import numbered_code
from ambertill.operators.changes import patch_columns
from ambertill.operators.matching import resolve_keys, valid_at
from ambertill.operators.ordered import number_rows
from ambertill.session import stage
from ambertill.sources import fuel_network


class Ingested(NamedTuple):
    inserted: DataFrame
    rejected: DataFrame


def ingest_sales(
    data: Mapping[str, DataFrame], batch: DataFrame, now: dt.datetime, next_receipt: int, prefix: str = "RCPT"
) -> Ingested:
    """Turn a batch of sales by natural keys into rows of ``fuel_sale``.

    The batch has station_code, fuel_code, employee_code, customer_code,
    quantity_liters, payment_method, a unique ``seq``, and optionally price_type
    (regular), discount_amount (0) and sale_datetime (``now``). Rejected rows
    carry the first reason: unknown code, no valid price, or a broken rule.
    """
    sale = fuel_network.TABLES["fuel_sale"]
    defaults = {
        "price_type": F.lit("regular"),
        "discount_amount": F.lit(0).cast("decimal(10,2)"),
        "sale_datetime": F.lit(now).cast("timestamp"),
    }
    batch = batch.withColumns({c: v for c, v in defaults.items() if c not in batch.columns})
    lookups = (*fuel_network.STATION_FUEL, fuel_network.EMPLOYEE, fuel_network.CUSTOMER)
    resolved, unknown = resolve_keys(batch, data, lookups)
    priced = valid_at(
        resolved,
        data["price"],
        ["station_fuel_id", "price_type"],
        "sale_datetime",
        "valid_from",
        "valid_to",
        ["price_per_liter"],
    )
    completed = priced.withColumns({c: F.expr(e) for c, e in sale.generated.items()})
    no_price = F.format_string(
        "No %s price of %s at station %s is valid at %s",
        "price_type", "fuel_code", "station_code", F.date_format("sale_datetime", "yyyy-MM-dd HH:mm:ss"),
    )
    # A sale without its time has no price either, so what is missing is named first.
    needed = ("quantity_liters", "payment_method", "discount_amount", "sale_datetime")
    reason = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in needed))
    broken = F.when(F.col("price_per_liter").isNull(), no_price)
    for name, check in sale.checks.items():
        broken = broken.when(F.expr(check) == F.lit(False), F.lit(f"rule broken: {name}"))
    reason = F.coalesce(reason, broken)
    judged = stage(completed.withColumn("reject_reason", reason), "judged")
    refused = judged.where(F.col("reject_reason").isNotNull()).select(*batch.columns, "reject_reason")
    accepted = judged.where(F.col("reject_reason").isNull())
    first_id = data["fuel_sale"].agg(F.coalesce(F.max("fuel_sale_id"), F.lit(0))).first()[0] + 1
    numbered = number_rows(accepted, ["sale_datetime", "seq"], "fuel_sale_id", start=first_id)
    # Ids are dense, so receipts follow from them without a second numbering.
    receipt = numbered_code(prefix, F.col("fuel_sale_id") + F.lit(next_receipt - first_id), 6)
    types = data["fuel_sale"].schema
    inserted = numbered.withColumn("receipt_number", receipt)
    return Ingested(
        inserted.select(*(F.col(f.name).cast(f.dataType) for f in types)), unknown.unionByName(refused)
    )


def patch_customers(customers: DataFrame, patches: DataFrame, sequence: str = "seq"):
    """Batch of (customer_id, column_name, new_value) for the columns customers may change."""
    return patch_columns(customers, patches, "customer_id", fuel_network.PATCHABLE, sequence)


def latest_quarter_report(
    sales: DataFrame, station_fuels: DataFrame | None, stations: DataFrame, fuels: DataFrame
) -> DataFrame:
    """Liters, revenue, checks and averages per station and fuel in the newest quarter.

    The newest sale is looked up first, which turns the quarter into a literal
    range; facts are summed per pair before the names are joined. Sales name
    their pair by ``station_fuel_id``, or without ``station_fuels`` by
    ``station_id`` and ``fuel_id``.
    """
    newest = sales.agg(F.max("sale_datetime").cast("date")).first()[0]
    first, after = quarter_bounds(newest or dt.date(1970, 1, 1))
    pair = ["station_id", "fuel_id"] if station_fuels is None else ["station_fuel_id"]
    sums = (
        sales.where(between_days(F.col("sale_datetime"), first, after))
        .groupBy(*pair)
        .agg(
            F.sum("quantity_liters").alias("liters"),
            F.sum("total_amount").alias("revenue"),
            F.sum("discount_amount").alias("discount"),
            F.count("receipt_number").alias("checks"),
        )
    )
    if station_fuels is not None:
        sums = sums.join(station_fuels.select("station_fuel_id", "station_id", "fuel_id"), "station_fuel_id")
    named = sums.join(stations.select("station_id", "station_name"), "station_id").join(
        fuels.select("fuel_id", "fuel_name"), "fuel_id"
    )
    # Stations or fuels that share a name are reported together.
    named = named.groupBy("station_name", "fuel_name").agg(
        *(F.sum(c).alias(c) for c in ("liters", "revenue", "discount", "checks"))
    )
    return named.select(
        F.lit(first.year).alias("sales_year"),
        F.lit((first.month + 2) // 3).alias("sales_quarter"),
        "station_name",
        "fuel_name",
        rounded(F.col("liters"), 0).alias("total_liters_sold"),
        rounded(F.col("revenue"), 0).alias("total_revenue"),
        F.col("checks").alias("total_check_number"),
        rounded(F.col("revenue") / F.col("checks"), 0).alias("avg_check"),
        rounded(F.col("discount") / F.col("checks"), 0).alias("avg_discount_per_check"),
    ).orderBy(*sort_columns(["station_name", "-total_revenue", "fuel_name"]))
