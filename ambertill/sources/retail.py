"""Order-and-parts tables read as the two schemas the reports are written for.

Sales history: a sale is an order, or an order line; the channel is the order
priority. Film rental: a film is a part, an actor a supplier, a rental an order
line. Only columns are renamed and derived here; all rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ambertill.functions.calendar import calendar_columns
from ambertill.functions.numbers import money
from ambertill.session import use_utc
from ambertill.sources.frames import read_table

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        use_utc(spark)
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet", SCHEMAS[name])

    # ------------------------------------------------------------ dimensions
    def nations(self) -> DataFrame:
        """Nation with its region: 25 rows whatever the scale."""
        return self["nation"].join(self["region"], F.col("n_regionkey") == F.col("r_regionkey"))

    def customers(self, with_region: bool = False) -> DataFrame:
        customers = self["customer"].select(
            F.col("c_custkey").alias("cust_id"),
            F.col("c_name").alias("cust_last_name"),
            F.col("c_mktsegment").alias("cust_income_level"),
            F.col("c_nationkey").alias("country_id"),
        )
        if with_region:
            countries = self.nations().select(
                F.col("n_nationkey").alias("country_id"),
                F.col("n_name").alias("country_name"),
                F.col("r_name").alias("country_region"),
            )
            customers = customers.join(countries, "country_id")
        return customers

    def products(self) -> DataFrame:
        return self["part"].select(
            F.col("p_partkey").alias("prod_id"),
            F.col("p_name").alias("prod_name"),
            F.col("p_type").alias("prod_category"),
            F.col("p_brand").alias("prod_category_desc"),
            money("p_retailprice").alias("prod_list_price"),
            F.col("p_size").alias("prod_size"),
        )

    # ----------------------------------------------------------------- stars
    def order_star(self, *dimensions: str) -> DataFrame:
        """A sale is an order."""
        fact = self["orders"].select(
            F.col("o_orderkey").alias("sale_id"),
            F.col("o_custkey").alias("cust_id"),
            F.col("o_orderpriority").alias("channel_desc"),
            F.col("o_orderdate").alias("time_id"),
            money("o_totalprice").alias("amount_sold"),
        )
        if {"customers", "countries"} & set(dimensions):
            fact = fact.join(self.customers("countries" in dimensions), "cust_id")
        return calendar_columns(fact, "time_id") if "times" in dimensions else fact

    def product_sales(self) -> DataFrame:
        """Sales per product with its attributes: summed before the join."""
        lines = self["lineitem"].groupBy(F.col("l_partkey").alias("prod_id"))
        return lines.agg(F.sum(money("l_extendedprice")).alias("amount_sold")).join(self.products(), "prod_id")

    def customer_sales(self) -> DataFrame:
        """Order totals per customer with their attributes: summed before the join."""
        orders = self["orders"].groupBy(F.col("o_custkey").alias("cust_id"))
        return orders.agg(F.sum(money("o_totalprice")).alias("amount_sold")).join(self.customers(), "cust_id")

    def line_star(self, *dimensions: str) -> DataFrame:
        """A sale is an order line; its buyer is known through the order.

        The two large tables meet last: lines after the product filter of the
        report, orders after its customer filter (filters move into the inputs).
        """
        line = self["lineitem"].select(
            F.col("l_orderkey").alias("sale_id"),
            F.col("l_partkey").alias("prod_id"),
            F.col("l_shipdate").alias("time_id"),
            money("l_extendedprice").alias("amount_sold"),
        )
        if "products" in dimensions:
            line = line.join(self.products(), "prod_id")
        if {"customers", "countries"} & set(dimensions):
            buyers = self["orders"].select(F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("cust_id"))
            line = line.join(buyers.join(self.customers("countries" in dimensions), "cust_id"), "sale_id")
        return calendar_columns(line, "time_id") if "times" in dimensions else line
