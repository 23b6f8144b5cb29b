"""Catalogue and rental reports: a film is a part, an actor a supplier, a rental an order line."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ambertill.functions.numbers import as_double, money
from ambertill.plans import films
from ambertill.registered import ORACLES, registered
from ambertill.sources.retail import Retail

#: Text per part type, the counterpart of the audience text per film rating.
TYPE_TEXTS = {"ECONOMY": "Budget range", "STANDARD": "Everyday range", "PROMO": "Campaign range"}


def _parts(t: Retail):
    return t["part"].select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        money("p_retailprice").alias("rental_rate"),
        F.col("p_size").alias("release_year"),
        F.col("p_type").alias("category_name"),
        F.col("p_type").alias("rating"),
        F.col("p_brand").alias("language"),
    )


def _line_payments(t: Retail):
    return t["lineitem"].select(
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("staff_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey").alias("payment_id"),
        F.col("l_partkey").alias("store_id"),
        F.col("l_orderkey").alias("rental_id"),
    )


def _customers(t: Retail):
    return t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


def _as_doubles(df, *columns: str):
    return df.withColumns({c: as_double(F.col(c)) for c in columns})


_CATALOGUE = """
    SELECT p_partkey AS film_id, p_name AS film_title, p_retailprice AS rental_rate, p_size AS release_year,
           p_type AS category_name
    FROM part WHERE lower(p_type) = 'promo' AND p_size BETWEEN 17 AND 19 AND p_retailprice > 910
"""


@registered(_CATALOGUE)
def parts_by_type_and_price(t: Retail):
    return _as_doubles(films.films_of_category(_parts(t), "Promo", 17, 19, 910), "rental_rate")


@registered(_CATALOGUE)
def parts_by_type_and_price_semi(t: Retail):
    parts = _parts(t)
    links = parts.select("film_id", "category_name")
    return _as_doubles(films.films_of_category_by_subquery(parts, links, "Promo", 17, 19, 910), "rental_rate")


_STORES = """
    SELECT CAST(n_nationkey AS INTEGER) AS store_id,
           n_name || CASE WHEN r_name = 'ASIA' THEN '' ELSE ', ' || r_name END AS full_address,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS store_revenue
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey
    WHERE l_shipdate >= TIMESTAMP '2000-04-01' GROUP BY ALL
"""


def _nation_stores(t: Retail):
    return t.nations().select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_name").alias("address"),
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("address2"),
    )


@registered(_STORES)
def nation_revenue_since(t: Retail):
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("staff_id"), F.col("s_nationkey").alias("store_id"))
    payments = _line_payments(t).drop("store_id")
    report = films.store_revenue_since(payments, "staff_id", suppliers, _nation_stores(t), dt.date(2000, 4, 1))
    return _as_doubles(report, "store_revenue")


@registered(_STORES)
def nation_revenue_since_joined(t: Retail):
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("staff_id"), F.col("s_nationkey").alias("store_id"))
    payments = _line_payments(t).drop("store_id").join(suppliers, "staff_id")
    return _as_doubles(
        films.store_revenue_since_joined(payments, _nation_stores(t), dt.date(2000, 4, 1)), "store_revenue"
    )


def _supplied(t: Retail):
    """Distinct (supplier, part) pairs with the part's size as year."""
    pairs = t["lineitem"].select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")).distinct()
    return pairs.join(_parts(t).select("film_id", "release_year"), "film_id")


def _suppliers(t: Retail):
    return t["supplier"].select(F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("last_name"))


@registered(
    """
    SELECT s_suppkey AS actor_id, count(DISTINCT p_partkey) AS number_of_movies, s_name AS last_name
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
    WHERE p_size >= 15 GROUP BY ALL ORDER BY number_of_movies DESC, actor_id LIMIT 5
    """
)
def topn_suppliers_by_parts(t: Retail):
    return films.busiest_actors(_supplied(t), _suppliers(t), 15, 5)


@registered(
    """
    SELECT s_name AS last_name, CAST(count(DISTINCT (s_suppkey, p_partkey)) AS BIGINT) AS number_of_movies
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
    WHERE p_size >= 15 GROUP BY ALL ORDER BY number_of_movies DESC, last_name LIMIT 5
    """
)
def topn_supplier_names_by_parts(t: Retail):
    return films.busiest_names(_supplied(t), _suppliers(t), 15, 5)


@registered(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS release_year,
           sum(CASE WHEN lower(p_type) = 'promo' THEN 1 ELSE 0 END)::BIGINT AS number_of_promo,
           sum(CASE WHEN lower(p_type) = 'economy' THEN 1 ELSE 0 END)::BIGINT AS number_of_economy,
           sum(CASE WHEN lower(p_type) = 'large' THEN 1 ELSE 0 END)::BIGINT AS number_of_large
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE lower(p_type) IN ('promo', 'economy', 'large') GROUP BY 1
    """
)
def type_counts_per_year(t: Retail):
    parts = _parts(t).select("film_id", "category_name")
    shipped = t["lineitem"].groupBy(F.col("l_partkey").alias("film_id"), F.year("l_shipdate").alias("release_year"))
    shipped = shipped.agg(F.count(F.lit(1)).alias("shipped"))
    categories = {"Promo": "number_of_promo", "Economy": "number_of_economy", "Large": "number_of_large"}
    return films.category_counts_per_year(shipped.join(parts, "film_id"), categories, "shipped")


_LAST_LINE = "l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_partkey DESC"


@registered(
    f"""
    WITH lines AS (
        SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'
    ), revenue AS (
        SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lines GROUP BY 1
    ), latest AS (SELECT DISTINCT ON (l_suppkey) l_suppkey, l_partkey FROM lines ORDER BY l_suppkey, {_LAST_LINE})
    SELECT s_name AS employee_name, latest.l_partkey AS last_working_store, CAST(revenue.s AS DOUBLE) AS total_revenue
    FROM revenue JOIN latest USING (l_suppkey) JOIN supplier ON s_suppkey = l_suppkey
    ORDER BY revenue.s DESC, s_suppkey LIMIT 3
    """
)
def top_suppliers_last_part(t: Retail):
    staff = t["supplier"].select(F.col("s_suppkey").alias("staff_id"), "s_name")
    report = films.best_staff_with_last_store(
        _line_payments(t), F.col("s_name"), staff, dt.date(2000, 1, 1), dt.date(2001, 1, 1), 3
    )
    return _as_doubles(report, "total_revenue")


_LAST_PART = f"""
    SELECT DISTINCT ON (l_suppkey) l_suppkey AS staff_id, l_partkey AS store_id,
           CAST(l_shipdate AS DATE) AS payment_day
    FROM lineitem ORDER BY l_suppkey, {_LAST_LINE}
"""


@registered(_LAST_PART)
def last_part_per_supplier(t: Retail):
    last = films.last_row_per_key(_line_payments(t), "staff_id", ["-payment_date", "-payment_id"])
    return last.select("staff_id", "store_id", F.col("payment_date").cast("date").alias("payment_day"))


@registered(_LAST_PART)
def last_part_per_supplier_by_maxima(t: Retail):
    last = films.last_row_by_maxima(_line_payments(t), "staff_id", "payment_date", "payment_id")
    day = F.col("payment_date").cast("date").alias("payment_day")
    # Lines equal in every tie-breaking column come out once each.
    return last.select("staff_id", "store_id", day).distinct()


_TIES = """
    WITH counted AS (
        SELECT p_partkey AS film_id, p_name AS title, p_type AS rating, count(*) AS number_of_rentals
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_partkey, p_name, p_type
    )
    SELECT film_id, title, rating,
           CASE rating WHEN 'ECONOMY' THEN 'Budget range' WHEN 'STANDARD' THEN 'Everyday range'
                WHEN 'PROMO' THEN 'Campaign range' ELSE 'Unknown Rating' END AS rating_description,
           number_of_rentals
    FROM counted QUALIFY rank() OVER (ORDER BY number_of_rentals DESC{more}) <= {n}
"""


def _most_ordered(t: Retail, n: int, order: list[str]):
    lines = t["lineitem"].select(F.col("l_partkey").alias("film_id"))
    parts = _parts(t).select("film_id", "title", "rating")
    return films.most_rented_with_ties(lines, parts, ("rating", TYPE_TEXTS), n, order)


@registered(_TIES.format(more=", title", n=5))
def top5_parts_with_ties(t: Retail):
    return _most_ordered(t, 5, ["-number_of_rentals", "title"])


@registered(_TIES.format(more="", n=5))
def top5_parts_with_count_ties(t: Retail):
    return _most_ordered(t, 5, ["-number_of_rentals"])


def _order_years(t: Retail):
    return t["orders"].select(F.col("o_custkey").alias("customer_id"), F.year("o_orderdate").alias("release_year"))


@registered(
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name,
           CAST(max(year(o_orderdate)) AS INTEGER) AS last_film_release_year,
           CAST(2002 - max(year(o_orderdate)) AS INTEGER) AS actor_inactive_period
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL
    """
)
def customer_inactivity(t: Retail):
    return films.inactive_years(_order_years(t), _customers(t), "customer_id", 2002)


@registered(
    """
    WITH steps AS (
        SELECT o.o_custkey AS k, year(o.o_orderdate) AS y,
               (SELECT min(year(n.o_orderdate)) FROM orders n
                WHERE n.o_custkey = o.o_custkey AND year(n.o_orderdate) > year(o.o_orderdate)) AS nxt
        FROM orders o
    )
    SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(max(nxt - y) AS INTEGER) AS max_career_gap
    FROM steps JOIN customer ON c_custkey = k WHERE nxt IS NOT NULL GROUP BY ALL
    """
)
def longest_order_gap(t: Retail):
    return films.longest_career_gap(_order_years(t), _customers(t), "customer_id", "release_year", "customer_name")


@registered(
    """
    SELECT 2000 AS target_year, 2 AS target_quarter, p_type AS category_id, p_type AS category_name,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_shipdate >= TIMESTAMP '2000-04-01' AND l_shipdate < TIMESTAMP '2000-07-01'
    GROUP BY p_type HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0
    """
)
def revenue_by_type_quarter(t: Retail):
    bridge = _parts(t).select("film_id", F.col("category_name").alias("category_id"), "category_name")
    report = films.revenue_by_category_in_quarter(_line_payments(t), "film_id", bridge, dt.date(2000, 5, 17))
    return _as_doubles(report, "total_revenue")


@registered(
    """
    WITH lines AS (
        SELECT n_name AS country, l_partkey, count(*) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        GROUP BY ALL
    ), best AS (
        SELECT country, l_partkey FROM lines QUALIFY rank() OVER (PARTITION BY country ORDER BY n DESC) = 1
    )
    SELECT w.country, p_name AS title, p_brand AS language, p_partkey AS film_id
    FROM (VALUES ('NATION_3'), ('NATION_7'), ('NATION_12')) w(country)
    LEFT JOIN best ON best.country = w.country LEFT JOIN part ON p_partkey = l_partkey
    """
)
def top_part_per_nation(t: Retail):
    nations = t["nation"].select("n_nationkey", F.col("n_name").alias("country"))
    buyers = t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    ordered = t["orders"].join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "country")
    lines = t["lineitem"].select("l_orderkey", F.col("l_partkey").alias("film_id"))
    rentals = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).select("country", "film_id")
    wanted = ["NATION_3", " NATION_7 ", "NATION_12", "NATION_3"]
    return films.most_popular_by_country(rentals, _parts(t), nations, wanted, ["title", "language", "film_id"])


@registered(
    """
    SELECT c_name AS country FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    """
)
def customers_without_orders(t: Retail):
    named = _customers(t).withColumnRenamed("customer_name", "country")
    return films.countries_without_rentals(named, named, t["orders"].select(F.col("o_custkey").alias("customer_id")))


@registered(
    """
    WITH matching AS (SELECT * FROM part WHERE p_name ILIKE '%RING%'),
    held AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM matching)),
    in_store AS (
        SELECT DISTINCT l_partkey FROM held h WHERE NOT EXISTS (
            SELECT 1 FROM lineitem o WHERE o.l_partkey = h.l_partkey AND o.l_suppkey = h.l_suppkey
              AND o.l_linestatus = 'O')
    ), latest AS (
        SELECT l_partkey, l_orderkey, l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC) = 1
    )
    SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS row_num, p_name AS film_title, p_partkey AS film_id,
           p_brand AS language, c_name AS customer_name, CAST(l_shipdate AS DATE) AS rental_date
    FROM matching JOIN in_store s ON s.l_partkey = p_partkey LEFT JOIN latest ON latest.l_partkey = p_partkey
    LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    """
)
def parts_in_stock(t: Retail):
    copy = F.struct("l_partkey", "l_suppkey").alias("inventory_id")
    copies = t["lineitem"].select(copy, F.col("l_partkey").alias("film_id")).distinct()
    rentals = t["lineitem"].select(
        F.col("l_orderkey").alias("rental_id"),
        copy,
        F.col("l_orderkey").alias("customer_id"),
        F.col("l_shipdate").alias("rental_date"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
    )
    # The buyer of a line is reached through its order, only for the lines shown.
    buyers = t["orders"].join(_customers(t), F.col("o_custkey") == F.col("customer_id"))
    buyers = buyers.select(F.col("o_orderkey").alias("customer_id"), "customer_name")
    found = films.films_in_stock(_parts(t), copies, rentals, buyers, "%ring%")
    return found.withColumn("rental_date", F.col("rental_date").cast("date"))


@registered(
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer WHERE c_custkey IN (
        SELECT user_id FROM events
        WHERE date_trunc('month', ts) = (SELECT date_trunc('month', max(ts)) FROM events)
        GROUP BY user_id HAVING count(*) > 60 AND sum(CAST(value AS DECIMAL(18,2))) > 600)
    """
)
def reward_customers(t: Retail):
    payments = t["events"].select(
        F.col("user_id").alias("customer_id"), F.col("ts").alias("payment_date"), money("value").alias("amount")
    )
    return films.reward_customers(_customers(t), payments, 60, 600)


@registered(
    """
    WITH lines AS (
        SELECT o_custkey AS k, CAST(l_quantity AS DECIMAL(18,2)) AS rate, CAST(l_quantity AS INTEGER) AS allowed,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS cost,
               date_diff('day', CAST(o_orderdate AS DATE), CAST(least(coalesce(
                   CASE WHEN l_linestatus <> 'O' THEN l_shipdate END, TIMESTAMP '2000-06-30'),
                   TIMESTAMP '2000-06-30') AS DATE)) AS held
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate <= TIMESTAMP '2000-06-30'
    ), fees AS (
        SELECT k, sum(rate) AS rent, sum(CASE WHEN held > allowed AND held <= allowed * 2 THEN held - allowed ELSE 0 END) AS late,
               sum(CASE WHEN held > allowed * 2 THEN cost ELSE 0 END) AS lost FROM lines GROUP BY k
    ), paid AS (
        SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS p FROM orders
        WHERE o_orderdate <= TIMESTAMP '2000-06-30' GROUP BY 1
    )
    SELECT c_custkey AS customer_id, CAST(coalesce(rent, 0) AS DOUBLE) AS rent_fees,
           CAST(coalesce(late, 0) AS DOUBLE) AS overdue_fees, CAST(coalesce(lost, 0) AS DOUBLE) AS replacement_fees,
           CAST(coalesce(p, 0) AS DOUBLE) AS payments,
           CAST(coalesce(rent, 0) + coalesce(late, 0) + coalesce(lost, 0) - coalesce(p, 0) AS DOUBLE) AS balance
    FROM customer LEFT JOIN fees ON fees.k = c_custkey LEFT JOIN paid ON paid.k = c_custkey
    """
)
def customer_balances(t: Retail):
    rentals, payments = _balance_inputs(t)
    report = films.customer_balances(_customers(t), rentals, payments, dt.datetime(2000, 6, 30))
    return _as_doubles(report, "rent_fees", "overdue_fees", "replacement_fees", "payments", "balance")


def _balance_inputs(t: Retail):
    orders = t["orders"].select("o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderdate")
    rentals = (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "customer_id",
            F.col("o_orderdate").alias("rental_date"),
            F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
            money("l_quantity").alias("rental_rate"),
            F.col("l_quantity").cast("int").alias("rental_duration"),
            money("l_extendedprice").alias("replacement_cost"),
        )
    )
    payments = t["orders"].select(
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("payment_date")
    )
    return rentals, payments


@registered(ORACLES["customer_balances"])
def customer_balances_lateral(t: Retail):
    """``customer_balances`` through a SQL table function called laterally per customer."""
    rentals, payments = _balance_inputs(t)
    name = films.define_balance_function(t.spark, rentals, payments, "q_")
    _customers(t).createOrReplaceTempView("q_balance_customers")
    report = t.spark.sql(
        f"SELECT c.customer_id, b.* FROM q_balance_customers c, LATERAL {name}(c.customer_id, TIMESTAMP '2000-06-30 00:00:00') b"
    )
    return _as_doubles(report, "rent_fees", "overdue_fees", "replacement_fees", "payments", "balance")


def _activity(t: Retail):
    orders = t["orders"].select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("rental_id"))
    lines = t["lineitem"].select("l_orderkey", F.col("l_linenumber").alias("payment_id"))
    return _customers(t), orders, lines.join(orders, F.col("l_orderkey") == F.col("rental_id"))


_ACTIVE = """
    WITH o AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
    l AS (SELECT o_custkey AS k, count(*) AS m FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT c_custkey AS customer_id, c_name AS customer_name, n AS number_of_rentals, m AS number_of_payments
    FROM customer JOIN o ON o.k = c_custkey JOIN l ON l.k = c_custkey WHERE {0}
"""


@registered(_ACTIVE.format("n >= 15 AND m >= 60"))
def active_customers(t: Retail):
    return films.active_customers(*_activity(t), 15, 60)


@registered(_ACTIVE.format("n > 16 AND m > 66"))
def customers_above(t: Retail):
    return films.customers_above(*_activity(t), 16, 66)


@registered(
    """
    SELECT c_custkey AS customer_id, o_orderkey AS rental_id, CAST(o_orderdate AS DATE) AS rental_date,
           l_linenumber AS payment_id, CAST(l_shipdate AS DATE) AS payment_date
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING'
    """
)
def segment_history(t: Retail):
    """All orders and their lines for the customers of one segment."""
    people = t["customer"].where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("customer_id"))
    orders = t["orders"].select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_orderdate").cast("date").alias("rental_date"),
    )
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("rental_id"),
        F.col("l_linenumber").alias("payment_id"),
        F.col("l_shipdate").cast("date").alias("payment_date"),
    )
    return films.rental_history(people, orders, lines)


@registered(
    """
    WITH lines AS (
        SELECT n_name AS country, l_partkey, count(*) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        GROUP BY ALL
    ), best AS (
        SELECT country, l_partkey FROM lines QUALIFY rank() OVER (PARTITION BY country ORDER BY n DESC) = 1
    )
    SELECT w.country, p_name AS title, p_brand AS language, p_partkey AS film_id
    FROM (VALUES ('NATION_3'), ('NATION_7'), ('NATION_12')) w(country)
    LEFT JOIN best ON best.country = w.country LEFT JOIN part ON p_partkey = l_partkey
    """
)
def top_part_per_nation_sql(t: Retail):
    """The same report through a SQL table function called with an array of names."""
    nations = t["nation"].select("n_nationkey", F.col("n_name").alias("country"))
    buyers = t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    ordered = t["orders"].join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "country")
    lines = t["lineitem"].select("l_orderkey", F.col("l_partkey").alias("film_id"))
    rentals = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).select("country", "film_id")
    name = films.define_popular_function(t.spark, rentals, _parts(t).select("film_id", "title", "language"), nations, "ambertill_")
    return t.spark.sql(f"SELECT * FROM {name}(array('NATION_3', ' NATION_7 ', 'NATION_12', 'NATION_3'))")
