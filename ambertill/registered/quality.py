"""Audits, row filters, counts and small expression reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ambertill.functions.numbers import as_double
from ambertill.functions.text import numbered_code
from ambertill.operators import access, quality
from ambertill.registered import registered
from ambertill.session import stage
from ambertill.sources.frames import sample_rows, unnest_with_position
from ambertill.sources.retail import SCHEMAS, Retail


@registered(
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in SCHEMAS)
)
def table_counts(t: Retail):
    return quality.row_counts({name: t[name] for name in SCHEMAS})


@registered(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
)
def key_duplicates(t: Retail):
    return quality.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@registered(
    """
    SELECT user_id, count(*) AS row_count FROM events WHERE NOT EXISTS (
        SELECT 1 FROM supplier WHERE s_suppkey = user_id) GROUP BY 1
    """
)
def fk_orphans(t: Retail):
    """Users of events who are not suppliers."""
    return quality.orphans(t["events"], t["supplier"], {"user_id": "s_suppkey"})


@registered(
    """
    SELECT 'orders_to_customer' AS reference, count(*) AS orphan_rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
    UNION ALL
    SELECT 'lines_to_part', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
    """
)
def fk_orphan_totals(t: Retail):
    parts = {
        "orders_to_customer": quality.orphans(t["orders"], t["customer"], {"o_custkey": "c_custkey"}),
        "lines_to_part": quality.orphans(t["lineitem"], t["part"], {"l_partkey": "p_partkey"}),
    }
    first, second = (
        lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(name).alias("reference"), "orphan_rows"
        )
        for name, lost in parts.items()
    )
    return first.unionByName(second)


@registered(
    """
    SELECT 'price above 1000' AS rule, count(*) FILTER (NOT (l_extendedprice > 1000)) AS violations FROM lineitem
    UNION ALL SELECT 'discount below 0.09', count(*) FILTER (NOT (l_discount < 0.09)) FROM lineitem
    UNION ALL SELECT 'flag is one letter', count(*) FILTER (NOT regexp_matches(l_returnflag, '^[A-Z]$')) FROM lineitem
    UNION ALL SELECT 'status known', count(*) FILTER (NOT (l_linestatus IN ('F'))) FROM lineitem
    UNION ALL SELECT 'status or flag', count(*) FILTER (NOT (l_linestatus = 'F' OR l_returnflag = 'N')) FROM lineitem
    UNION ALL SELECT 'order key known', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
    """
)
def rule_violations(t: Retail):
    rules = {
        "price above 1000": F.col("l_extendedprice") > 1000,
        "discount below 0.09": F.col("l_discount") < 0.09,
        "flag is one letter": F.col("l_returnflag").rlike("^[A-Z]$"),
        "status known": F.col("l_linestatus").isin("F"),
        "status or flag": (F.col("l_linestatus") == "F") | (F.col("l_returnflag") == "N"),
        "order key known": quality.null_rule("l_orderkey"),
    }
    return quality.rule_violations(t["lineitem"], rules)


@registered(
    """
    SELECT CAST(min(l_shipdate) AS DATE) AS min_date, CAST(max(l_shipdate) AS DATE) AS max_date FROM lineitem
    """
)
def date_coverage(t: Retail):
    found = quality.coverage(t["lineitem"], "l_shipdate")
    return found.select(*(F.col(c).cast("date").alias(c) for c in found.columns))


@registered(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS payment_year, CAST(quarter(l_shipdate) AS INTEGER) AS payment_quarter,
           count(*) AS payments_nmb, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM lineitem GROUP BY ALL
    """
)
def revenue_by_quarter(t: Retail):
    report = quality.by_year_and_quarter(t["lineitem"], "l_shipdate", "l_extendedprice")
    return report.withColumn("total_revenue", as_double(F.col("total_revenue")))


PRINCIPAL = "client_customer_000000007"


def _owners(t: Retail):
    name = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    number = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    return access.owners(t["customer"], PRINCIPAL, [(name, 2), (number, 3)], "c_custkey").withColumnRenamed(
        "c_custkey", "o_custkey"
    )


_OWN = """
    SELECT {columns} FROM orders WHERE o_custkey {test} (
        SELECT c_custkey FROM customer
        WHERE lower(split_part(c_name, '#', 1)) = split_part('client_customer_000000007', '_', 2)
          AND lower(split_part(c_name, '#', 2)) = split_part('client_customer_000000007', '_', 3))
"""


@registered(_OWN.format(columns="o_orderkey, o_custkey, o_totalprice", test="IN"))
def row_filter_by_principal(t: Retail):
    own = access.own_rows(t["orders"], _owners(t), "o_custkey")
    return access.visible_columns(own, ["o_orderkey", "o_custkey", "o_totalprice"])


@registered(_OWN.format(columns="o_orderkey, o_custkey", test="NOT IN"))
def row_filter_complement(t: Retail):
    others = access.not_in(t["orders"], _owners(t), "o_custkey")
    return access.visible_columns(others, ["o_orderkey", "o_custkey"])


@registered(
    """
    SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1
    """
)
def types_per_brand(t: Retail):
    """A sorted list as text; distinct types per brand are few at any scale."""
    distinct = t["part"].select("p_brand", "p_type").distinct()
    return distinct.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list("p_type")), ", ").alias("types"))


@registered(
    """
    SELECT o_orderkey, CAST(n.pos AS INTEGER) AS position, n.word
    FROM orders, unnest(string_split(o_orderpriority, '-')) WITH ORDINALITY AS n(word, pos)
    """
)
def priority_words(t: Retail):
    """Array elements with their 1-based position."""
    words = t["orders"].select("o_orderkey", F.split("o_orderpriority", "-").alias("words"))
    return unnest_with_position(words, "words", "word", "position").select("o_orderkey", "position", "word")


@registered(
    """
    SELECT c_custkey, 'RCPT' || CASE WHEN length(CAST(c_custkey AS VARCHAR)) > 6 THEN CAST(c_custkey AS VARCHAR)
                                ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS receipt,
           c_name || CASE WHEN c_acctbal < 0 THEN '' ELSE ', ' || c_mktsegment END AS label,
           CASE WHEN c_acctbal >= 0 THEN c_name || ' ' || c_mktsegment END AS strict_label,
           CAST(least(c_acctbal, 500.0) AS DOUBLE) AS capped
    FROM customer
    """
)
def text_rules(t: Retail):
    """NULL-skipping and NULL-propagating text, padded codes, LEAST with NULL."""
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return t["customer"].select(
        "c_custkey",
        numbered_code("RCPT", F.col("c_custkey"), 6).alias("receipt"),
        F.concat_ws("", "c_name", F.concat(F.lit(", "), known)).alias("label"),
        F.concat("c_name", F.lit(" "), known).alias("strict_label"),
        F.least("c_acctbal", F.lit(500.0)).alias("capped"),
    )


@registered(
    """
    SELECT o_orderkey, CAST(last_day(o_orderdate) AS DATE) AS month_end,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start
    FROM orders WHERE (o_orderpriority, o_orderstatus) IN (('1-URGENT', 'F'), ('5-LOW', 'O'))
      AND o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    """
)
def row_values_and_dates(t: Retail):
    """Row-value IN as a semi join to an inline table, a half-open range, date truncation."""
    pairs = t.spark.createDataFrame([("1-URGENT", "F"), ("5-LOW", "O")], "o_orderpriority string, o_orderstatus string")
    day = F.col("o_orderdate")
    chosen = t["orders"].where((day >= F.lit(dt.date(1999, 1, 1))) & (day < F.lit(dt.date(2000, 1, 1))))
    return chosen.join(pairs, ["o_orderpriority", "o_orderstatus"], "left_semi").select(
        "o_orderkey",
        F.last_day("o_orderdate").alias("month_end"),
        F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter_start"),
    )


@registered(
    "SELECT least(count(*), 100) AS rows_drawn, least(count(*), 100) AS rows_of_the_table FROM lineitem"
)
def any_hundred_lines(t: Retail):
    """A sample of any 100 rows: how many were drawn, and how many of them the table has."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    drawn = stage(sample_rows(lines, 100), "drawn")
    found = drawn.join(lines, lines.columns, "left_semi")
    count = F.count(F.lit(1))
    return drawn.agg(count.alias("rows_drawn")).withColumn("rows_of_the_table", found.agg(count).scalar())
