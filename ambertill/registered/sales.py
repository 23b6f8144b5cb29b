"""Sales reports on orders and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambertill.plans import sales
from ambertill.registered import registered
from ambertill.sources.retail import Retail

CATEGORY, REGION, YEAR = "promo", "asia", 2000
MONTHS = ("2000-01", "2000-02", "2000-03")
REGIONS = {"AMERICA": "america_sales", "EUROPE": "europe_sales"}


@registered(
    """
    WITH yearly AS (
        SELECT r_name AS country_region, CAST(year(o_orderdate) AS INTEGER) AS calendar_year,
               o_orderpriority AS channel_desc, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS sold
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE') AND year(o_orderdate) BETWEEN 1998 AND 2001
        GROUP BY ALL
    ), shares AS (
        SELECT *, CAST(sold AS DOUBLE) * 100.0::DOUBLE
            / CAST(sum(sold) OVER (PARTITION BY country_region, calendar_year) AS DOUBLE) AS pct
        FROM yearly
    ), compared AS (
        SELECT *, lag(pct) OVER (PARTITION BY country_region, channel_desc ORDER BY calendar_year) AS prev
        FROM shares
    )
    SELECT country_region, calendar_year, channel_desc, CAST(sold AS DOUBLE) AS amount_sold,
           pct AS pct_by_channels, prev AS pct_previous_period, pct - prev AS pct_diff,
           format('{:,}', CAST(round(sold, 0) AS BIGINT)) || ' $' AS amount_sold_text,
           CAST(round(CAST(pct AS DECIMAL(38,10)), 2) AS VARCHAR) || ' %' AS pct_by_channels_text,
           CAST(round(CAST(prev AS DECIMAL(38,10)), 2) AS VARCHAR) || ' %' AS pct_previous_period_text,
           CAST(round(CAST(pct - prev AS DECIMAL(38,10)), 2) AS VARCHAR) || ' %' AS pct_diff_text
    FROM compared WHERE calendar_year BETWEEN 1999 AND 2001
    """
)
def channel_share_yoy(t: Retail):
    star = t.order_star("countries", "times")
    return sales.channel_share_by_year(star, ("AMERICA", "ASIA", "EUROPE"), 1999, 2001)


@registered(
    """
    WITH daily AS (
        SELECT CAST(week(o_orderdate) AS INTEGER) AS wk, CAST(o_orderdate AS DATE) AS d,
               dayname(o_orderdate) AS dn, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
        FROM orders WHERE year(o_orderdate) = 1999 AND week(o_orderdate) BETWEEN 48 AND 52
        GROUP BY ALL
    ), framed AS (
        SELECT *, sum(s) OVER (PARTITION BY wk ORDER BY d ROWS UNBOUNDED PRECEDING) AS cum,
            CASE WHEN dn = 'Monday' THEN CAST(sum(s) OVER (ORDER BY d ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS DOUBLE)
                     / count(s) OVER (ORDER BY d ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)
                 WHEN dn = 'Friday' THEN CAST(sum(s) OVER (ORDER BY d ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS DOUBLE)
                     / count(s) OVER (ORDER BY d ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING)
                 ELSE CAST(sum(s) OVER (ORDER BY d ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS DOUBLE)
                     / count(s) OVER (ORDER BY d ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS avg3
        FROM daily
    )
    SELECT wk AS calendar_week_number, d AS time_id, dn AS day_name, CAST(s AS DOUBLE) AS sales,
           CAST(cum AS DOUBLE) AS cum_sum,
           CAST(round(CAST(avg3 AS DECIMAL(38,10)), 2) AS DOUBLE) AS centered_3_day_avg
    FROM framed WHERE wk BETWEEN 49 AND 51
    """
)
def weekly_cumsum_centered(t: Retail):
    return sales.weekly_running_sales(t.order_star("times"), 1999, 49, 51)


@registered(
    """
    WITH products AS (
        SELECT p_partkey, p_name, p_brand, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
               sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL
    )
    SELECT p_partkey AS prod_id, p_name AS prod_name, p_brand AS prod_category_desc,
           CAST(price AS DOUBLE) AS prod_list_price, CAST(round(s, 0) AS DOUBLE) AS sales,
           CAST(round(sum(s) OVER (ORDER BY price RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING), 0) AS DOUBLE)
               AS sales_in_price_range,
           CAST(round(sum(s) OVER (ORDER BY price GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 0) AS DOUBLE)
               AS sales_in_price_group
    FROM products
    """
)
def price_neighbourhoods(t: Retail):
    return sales.price_neighbourhoods(t.product_sales())


@registered(
    """
    WITH bands AS (
        SELECT c_mktsegment AS cust_income_level, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IS NOT NULL GROUP BY ALL
    )
    SELECT cust_income_level, CAST(round(s, 0) AS DOUBLE) AS sales,
           CAST(round(sum(s) OVER (ORDER BY cust_income_level GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 0) AS DOUBLE)
               AS sales_in_income_group
    FROM bands
    """
)
def segment_groups_sales(t: Retail):
    return sales.income_band_neighbours(t.customer_sales())


@registered(
    """
    WITH sizes AS (
        SELECT p_size AS prod_size, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL
    )
    SELECT prod_size, CAST(round(s, 0) AS DOUBLE) AS sales,
           CAST(round(sum(s) OVER (ORDER BY prod_size RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING), 0) AS DOUBLE)
               AS sales_in_size_segment
    FROM sizes
    """
)
def size_range_sales(t: Retail):
    return sales.sales_around(t.product_sales(), "prod_size", 20, "sales_in_size_segment")


@registered(
    """
    WITH weekly AS (
        SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS y, CAST(week(o_orderdate) AS INTEGER) AS w,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
        FROM orders WHERE isoyear(o_orderdate) IN (1999, 2000) GROUP BY ALL
    ), framed AS (
        SELECT *, CAST(sum(s) OVER last3 AS DOUBLE) / count(s) OVER last3 AS a
        FROM weekly WINDOW last3 AS (ORDER BY y, w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    )
    SELECT y AS calendar_year, w AS calendar_week_number, CAST(round(s, 0) AS DOUBLE) AS sales,
           CAST(round(CAST(a AS DECIMAL(38,10)), 0) AS DOUBLE) AS three_weeks_moving_avg
    FROM framed WHERE y = 2000
    """
)
def weekly_trailing_avg(t: Retail):
    weeks = t.order_star("times").withColumn("calendar_year", F.col("calendar_week_year"))
    return sales.trailing_weeks(weeks, 2000)


_TOP = """
    WITH sums AS (
        SELECT o_orderpriority AS channel_desc, {customer}, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY channel_desc ORDER BY s DESC, {key}) AS rn,
               CAST(s AS DOUBLE) * 100.0::DOUBLE / CAST(sum(s) OVER (PARTITION BY channel_desc) AS DOUBLE) AS pct
        FROM sums
    )
    SELECT channel_desc, {key}, CAST(s AS DOUBLE) AS amount_sold, pct AS sales_percentage,
           CAST(s AS VARCHAR) AS amount_sold_text,
           CAST(round(CAST(pct AS DECIMAL(38,10)), 4) AS VARCHAR) || '%' AS sales_percentage_text
    FROM ranked WHERE rn <= 5
"""


@registered(_TOP.format(customer="c_name AS cust_last_name", key="cust_last_name"))
def topn_customers_per_channel(t: Retail):
    return sales.top_customers_by_channel(t.order_star("customers"), ["cust_last_name"], 5)


@registered(_TOP.format(customer="c_custkey AS cust_id", key="cust_id"))
def topn_customer_keys_per_channel(t: Retail):
    return sales.top_customers_by_channel(t.order_star(), ["cust_id"], 5)


_QUARTERS = """
    WITH sums AS (
        SELECT p_brand AS prod_category_desc, quarter(l_shipdate) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS a
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
        WHERE year(l_shipdate) = 2000 AND p_type ILIKE 'promo' AND r_name ILIKE 'asia'
    ), wide AS (
        SELECT prod_category_desc, coalesce(sum(a) FILTER (q = 1), 0) AS q1, coalesce(sum(a) FILTER (q = 2), 0) AS q2,
               coalesce(sum(a) FILTER (q = 3), 0) AS q3, coalesce(sum(a) FILTER (q = 4), 0) AS q4, sum(a) AS year_sum
        FROM sums GROUP BY 1
    )
    SELECT prod_category_desc, CAST(q1 AS DOUBLE) AS q1, CAST(q2 AS DOUBLE) AS q2, CAST(q3 AS DOUBLE) AS q3,
           CAST(q4 AS DOUBLE) AS q4, CAST(year_sum AS DOUBLE) AS year_sum,
           CAST(CAST(q1 AS DECIMAL(38,2)) AS VARCHAR) AS q1_text, CAST(CAST(q2 AS DECIMAL(38,2)) AS VARCHAR) AS q2_text,
           CAST(CAST(q3 AS DECIMAL(38,2)) AS VARCHAR) AS q3_text, CAST(CAST(q4 AS DECIMAL(38,2)) AS VARCHAR) AS q4_text,
           CAST(CAST(year_sum AS DECIMAL(38,2)) AS VARCHAR) AS year_sum_text
    FROM wide
"""


@registered(_QUARTERS)
def quarter_case_pivot(t: Retail):
    star = t.line_star("products", "countries", "times")
    return sales.quarters_by_case(star, "prod_category_desc", CATEGORY, REGION, YEAR)


@registered(_QUARTERS)
def quarter_crosstab(t: Retail):
    star = t.line_star("products", "countries", "times")
    return sales.quarters_by_crosstab(star, "prod_category_desc", CATEGORY, REGION, YEAR)


@registered(
    """
    WITH yearly AS (
        SELECT o_orderpriority AS channel_desc, year(o_orderdate) AS y, c_custkey AS cust_id, c_name AS cust_last_name,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) IN (1998, 1999, 2001) GROUP BY ALL
    ), top AS (
        SELECT * FROM yearly
        QUALIFY row_number() OVER (PARTITION BY channel_desc, y ORDER BY s DESC, cust_id) <= 300
    )
    SELECT channel_desc, cust_id, cust_last_name, CAST(sum(s) AS DOUBLE) AS amount_sold,
           CAST(sum(s) AS VARCHAR) AS amount_sold_text
    FROM top GROUP BY channel_desc, cust_id, cust_last_name HAVING count(DISTINCT y) = 3
    """
)
def cohort_top300_all_years(t: Retail):
    people = t.customers().select("cust_id", "cust_last_name")
    return sales.always_in_top(t.order_star("times"), people, (1998, 1999, 2001), 300)


_REGIONS = """
    WITH sums AS (
        SELECT strftime(l_shipdate, '%Y-%m') AS calendar_month_desc, p_type AS prod_category,
               sum(CASE WHEN r_name = 'AMERICA' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS a,
               sum(CASE WHEN r_name = 'EUROPE' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS e
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
        WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_shipdate < TIMESTAMP '2000-04-01'
          AND r_name IN ('AMERICA', 'EUROPE')
        GROUP BY 1, 2
    )
    SELECT calendar_month_desc, prod_category, CAST(a AS DOUBLE) AS america_sales, CAST(e AS DOUBLE) AS europe_sales
    {texts} FROM sums
"""


@registered(_REGIONS.format(texts=""))
def month_category_regions_case(t: Retail):
    return sales.regions_side_by_side(t.line_star("products", "countries", "times"), MONTHS, REGIONS)


@registered(
    _REGIONS.format(
        texts=", CAST(CAST(a AS DECIMAL(38,2)) AS VARCHAR) AS america_sales_text, "
        "CAST(CAST(e AS DECIMAL(38,2)) AS VARCHAR) AS europe_sales_text"
    )
)
def month_category_regions_window(t: Retail):
    return sales.regions_side_by_side_windowed(t.line_star("products", "countries", "times"), MONTHS, REGIONS)
