"""Star schema of sales: one fact, five dimensions.

Reports ask for the dimensions they need, so no dimension is joined in vain.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

SCHEMAS = {
    "sales": "cust_id bigint, channel_id int, time_id date, prod_id bigint, amount_sold decimal(10,2)",
    "customers": "cust_id bigint, country_id int, cust_first_name string, cust_last_name string, "
    "cust_income_level string, cust_year_of_birth int",
    "countries": "country_id int, country_region string",
    "channels": "channel_id int, channel_desc string",
    "times": "time_id date, calendar_year int, calendar_quarter_number int, calendar_month_desc string, "
    "calendar_week_number int, day_name string",
    "products": "prod_id bigint, prod_name string, prod_category string, prod_category_desc string, "
    "prod_list_price decimal(8,2)",
}


class SalesHistory:
    """``star("customers", "times")`` is the fact joined to those dimensions."""

    _keys = {"customers": "cust_id", "channels": "channel_id", "times": "time_id", "products": "prod_id"}

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def star(self, *dimensions: str) -> DataFrame:
        fact = self.tables["sales"]
        for name in dimensions:
            if name == "countries":
                continue
            dimension = self.tables[name]
            if name == "customers" and "countries" in dimensions:
                dimension = dimension.join(self.tables["countries"], "country_id")
            fact = fact.join(dimension, self._keys[name])
        return fact
