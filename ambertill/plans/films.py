"""Film catalogue and rental reports.

Inputs are the joined frames of ``sources.film_rental`` (or frames with the
same columns); every report states the columns it reads.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ambertill.functions.calendar import between_days, days_between, moment, month_bounds, quarter_bounds
from ambertill.functions.numbers import money, total
from ambertill.functions.ordering import sort_columns
from ambertill.functions.text import joined_address, labelled
from ambertill.operators.changes import few_copies
from ambertill.operators.matching import longest_gap
from ambertill.operators.ordered import number_rows
from ambertill.operators.pivoting import counts_when
from ambertill.operators.ranking import best_with_ties, first_per_key, top_with_ties

# ------------------------------------------------------------------- catalogue
FILM_COLUMNS = ["film_id", "film_title", "rental_rate", "release_year", "category_name"]


def films_of_category(films: DataFrame, category: str, first_year: int, last_year: int, above_rate: float) -> DataFrame:
    """Films of a category in a year range above a rate, by title.

    Reads film_id, title, rental_rate, release_year, category_name.
    """
    return (
        films.where(F.lower("category_name") == category.lower())
        .where(F.col("release_year").between(first_year, last_year) & (F.col("rental_rate") > above_rate))
        .withColumnRenamed("title", "film_title")
        .select(*FILM_COLUMNS)
        .orderBy("film_title", "film_id")
    )


def films_of_category_by_subquery(
    films: DataFrame, links: DataFrame, category: str, first_year: int, last_year: int, above_rate: float
) -> DataFrame:
    """The same report as ``IN (subquery)``.

    All categories of a film that has the wanted one are listed. ``links`` holds
    film_id and category_name.
    """
    wanted = links.where(F.lower("category_name") == category.lower()).select("film_id")
    return (
        films.where(F.col("release_year").between(first_year, last_year) & (F.col("rental_rate") > above_rate))
        .join(wanted, "film_id", "left_semi")
        .withColumnRenamed("title", "film_title")
        .select(*FILM_COLUMNS)
        .orderBy("film_title", "film_id")
    )


def sum_through(rows: DataFrame, amount: str, key: str, bridge: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    """Sum per ``key``, map the few sums to groups by ``bridge``, and sum again.

    The first sum and the join share one shuffle by ``key``, and a key that
    holds much of the table reaches the join as a single row.
    """
    per_key = rows.groupBy(key).agg(total(amount).alias("_sum"))
    return per_key.join(bridge, key).groupBy(*group).agg(F.sum("_sum").alias(out))


def store_revenue_since(
    payments: DataFrame, key: str, bridge: DataFrame, stores: DataFrame, since: dt.date
) -> DataFrame:
    """Revenue per store from a date on, with its address.

    Reads payments(key, amount, payment_date), bridge(key, store_id),
    stores(store_id, address, address2).
    """
    recent = payments.where(F.col("payment_date") >= F.lit(since))
    sums = sum_through(recent, "amount", key, bridge, ["store_id"], "store_revenue")
    return (
        stores.join(sums, "store_id")
        .select("store_id", joined_address(F.col("address"), F.col("address2")).alias("full_address"), "store_revenue")
        .orderBy(*sort_columns(["-store_revenue", "store_id"]))
    )


def store_revenue_since_joined(payments: DataFrame, stores: DataFrame, since: dt.date) -> DataFrame:
    """The same revenue, joined first and grouped by store and address."""
    return (
        payments.where(F.col("payment_date") >= F.lit(since))
        .join(stores, "store_id")
        .groupBy("store_id", "address", "address2")
        .agg(total("amount").alias("store_revenue"))
        .select("store_id", joined_address(F.col("address"), F.col("address2")).alias("full_address"), "store_revenue")
        .orderBy(*sort_columns(["-store_revenue", "store_id"]))
    )


def busiest_actors(appearances: DataFrame, people: DataFrame, since_year: int, n: int) -> DataFrame:
    """The ``n`` actors with most films, counted by id; names are joined to the winners only.

    Reads appearances(actor_id, film_id, release_year), people(actor_id, names).
    """
    counts = (
        appearances.where(F.col("release_year") >= since_year)
        .groupBy("actor_id")
        .agg(F.count("film_id").alias("number_of_movies"))
    )
    order = ["-number_of_movies", "actor_id"]
    winners = counts.orderBy(*sort_columns(order)).limit(n)
    return winners.join(people, "actor_id").orderBy(*sort_columns(order))


def busiest_names(appearances: DataFrame, people: DataFrame, since_year: int, n: int) -> DataFrame:
    """The same by name only: actors who share a name are counted as one."""
    names_only = [c for c in people.columns if c != "actor_id"]
    counts = (
        appearances.where(F.col("release_year") >= since_year)
        .groupBy("actor_id")
        .agg(F.count("film_id").alias("_films"))
        .join(people, "actor_id")
        .groupBy(*names_only)
        .agg(F.sum("_films").alias("number_of_movies"))
    )
    return counts.orderBy(*sort_columns(["-number_of_movies", *names_only])).limit(n)


def category_counts_per_year(films: DataFrame, categories: Mapping[str, str], count: str | None = None) -> DataFrame:
    """Films per year, one column per category. Other categories are filtered out first.

    Rows that stand for several films say so in the column ``count``.
    """
    name = F.lower("category_name")
    cases = {out: name == category.lower() for category, out in categories.items()}
    return (
        films.where(name.isin([c.lower() for c in categories]))
        .groupBy("release_year")
        .agg(*counts_when(cases, F.col(count) if count else 1))
        .orderBy(*sort_columns(["-release_year"]))
    )


def best_staff_with_last_store(
    payments: DataFrame, staff_name: Column, staff: DataFrame, first: dt.date, after: dt.date, n: int
) -> DataFrame:
    """Staff with most revenue in a period and the store of their last payment.

    Sum and last payment come from one aggregation. Reads payments(staff_id,
    store_id, amount, payment_date, payment_id).
    """
    latest = F.max_by("store_id", F.struct("payment_date", "payment_id"))
    sums = (
        payments.where(between_days(F.col("payment_date"), first, after))
        .groupBy("staff_id")
        .agg(total("amount").alias("total_revenue"), latest.alias("last_working_store"))
    )
    return (
        sums.join(staff, "staff_id")
        .orderBy(*sort_columns(["-total_revenue", "staff_id"]))
        .limit(n)
        .select(staff_name.alias("employee_name"), "last_working_store", "total_revenue")
    )


def last_row_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``DISTINCT ON (key)``."""
    return first_per_key(rows, [key], order)


def last_row_by_maxima(rows: DataFrame, key: str, time: str, row_id: str) -> DataFrame:
    """The same row found by maxima: of the latest time, and of the highest id at that time.

    One aggregation with partial results; only one row of rows equal in both comes out.
    """
    others = [c for c in rows.columns if c != key]
    known = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    best = known.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(time, row_id)).alias("_row"))
    return best.select(*(F.col(key) if c == key else F.col(f"_row.{c}") for c in rows.columns))


def most_rented_with_ties(
    rentals: DataFrame, films: DataFrame, label: tuple[str, Mapping[str, str]], n: int, order: Sequence[str]
) -> DataFrame:
    """Most rented films, ties kept, with a text for the rating.

    Ties are level on the whole ``order`` list: with the title in it only equal
    titles tie, without it all films with the same count do. Reads
    rentals(film_id), films(film_id, title, rating column).
    """
    column, texts = label
    counted = rentals.groupBy("film_id").agg(F.count(F.lit(1)).alias("number_of_rentals")).join(films, "film_id")
    text = labelled(F.col(column), texts, "Unknown Rating").alias("rating_description")
    best = top_with_ties(counted, order, n).select(*films.columns, text, "number_of_rentals")
    return best.orderBy(*sort_columns(order), "film_id")


def inactive_years(appearances: DataFrame, people: DataFrame, key: str, as_of_year: int) -> DataFrame:
    """Years since the last release; one row per person with any appearance."""
    last = appearances.groupBy(key).agg(F.max("release_year").alias("last_film_release_year"))
    return (
        people.join(last, key)
        .withColumn("actor_inactive_period", F.lit(as_of_year) - F.col("last_film_release_year"))
        .orderBy(*sort_columns(["-actor_inactive_period", key]))
    )


def longest_career_gap(appearances: DataFrame, people: DataFrame, key: str, value: str, last_name: str) -> DataFrame:
    """Longest step between consecutive release years; names are joined at the end."""
    gaps = longest_gap(appearances, [key], value, "max_career_gap")
    return people.join(gaps, key).orderBy(*sort_columns(["-max_career_gap", last_name, key]))


# --------------------------------------------------------------------- revenue
def revenue_by_category_in_quarter(payments: DataFrame, key: str, bridge: DataFrame, day: dt.date | None) -> DataFrame:
    """Revenue per category in the quarter of ``day``; no day, no rows.

    Reads payments(key, amount, payment_date), bridge(key, category_id,
    category_name). The quarter becomes a date range, which reaches the scan.
    """
    if day is None:
        year = quarter = F.lit(None).cast("int")
        chosen = payments.limit(0)
    else:
        first, after = quarter_bounds(day)
        year, quarter = F.lit(day.year), F.lit((day.month + 2) // 3)
        chosen = payments.where(between_days(F.col("payment_date"), first, after))
    sums = sum_through(chosen, "amount", key, bridge, ["category_id", "category_name"], "total_revenue")
    return sums.where(F.col("total_revenue") > 0).select(
        year.alias("target_year"), quarter.alias("target_quarter"), "category_id", "category_name", "total_revenue"
    )


def define_revenue_function(spark: SparkSession, payments: DataFrame, bridge: DataFrame, prefix: str = "") -> str:
    """The same report as a SQL table function over two views, for callers who write SQL.

    ``SELECT * FROM revenue_by_category_qtr(target_date => date'2017-04-01')``. Payments are
    keyed by film_id. The quarter stays a range on the bare payment date.
    """
    payments.createOrReplaceTempView(f"{prefix}film_payments")
    bridge.createOrReplaceTempView(f"{prefix}film_categories")
    name = f"{prefix}revenue_by_category_qtr"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(target_date DATE)
        RETURNS TABLE (target_year INT, target_quarter INT, category_id BIGINT, category_name STRING,
                       total_revenue DECIMAL(28,2))
        RETURN SELECT year(target_date), quarter(target_date), c.category_id, c.category_name, sum(p.amount)
        FROM {prefix}film_payments p JOIN {prefix}film_categories c ON c.film_id = p.film_id
        WHERE p.payment_date >= date_trunc('quarter', target_date)
          AND p.payment_date < date_trunc('quarter', target_date) + INTERVAL 3 MONTHS
        GROUP BY c.category_id, c.category_name
        HAVING sum(p.amount) > 0
        """
    )
    return name


# ------------------------------------------------------------------- countries
def checked_names(names: Sequence[str | None] | None) -> list[str]:
    """Trimmed names, first occurrence kept; raises on missing input."""
    if names is None:
        raise ValueError("No list of countries was given")
    if not names:
        raise ValueError("The list of countries is empty")
    if any(n is None or not n.strip(" ") for n in names):
        raise ValueError("A country in the list has no name")
    return list(dict.fromkeys(n.strip(" ") for n in names))


def most_popular_by_country(
    rentals: DataFrame, films: DataFrame, countries: DataFrame, names: Sequence[str | None] | None, shown: Sequence[str]
) -> DataFrame:
    """Most rented film of each requested country; ties stay, empty countries give NULLs.

    Reads rentals(country, film_id), films(film_id and the ``shown`` columns,
    title first), countries(country). Films are joined to the winners only.
    """
    wanted = checked_names(names)
    spark = rentals.sparkSession
    requested = spark.createDataFrame(list(enumerate(wanted, start=1)), "country_order int, country string")
    known = countries.select("country").where(F.col("country").isin(wanted)).distinct()
    # The names are no more than the caller's own list; the check runs in the report's own job.
    unknown = requested.join(known, "country", "left_anti").agg(F.array_sort(F.collect_list("country")).alias("_names"))
    error = unknown.select(F.when(F.size("_names") > 0, F.concat(F.lit("Unknown countries: "), F.array_join("_names", ", "))).alias("_error"))
    counted = (
        rentals.where(F.col("country").isin(wanted) & F.col("film_id").isNotNull())
        .groupBy("country", "film_id")
        .agg(F.count(F.lit(1)).alias("rentals_count"))
    )
    best = best_with_ties(counted, ["country"], "rentals_count").join(films, "film_id")
    report = requested.join(best, "country", "left").select("country_order", "country", *shown)
    return checked(report, error).orderBy(*sort_columns(["country_order", *shown])).select("country", *shown)


def countries_without_rentals(countries: DataFrame, customer_country: DataFrame, rentals: DataFrame) -> DataFrame:
    """Countries none of whose customers rented anything."""
    active = rentals.select("customer_id").distinct().join(customer_country, "customer_id").select("country").distinct()
    return countries.select("country").distinct().join(active, "country", "left_anti").orderBy("country")


# ----------------------------------------------------------------------- stock
def films_in_stock(
    films: DataFrame, copies: DataFrame, rentals: DataFrame, customers: DataFrame, pattern: str | None
) -> DataFrame:
    """Matching films with a copy in store, and who rented the film last.

    Reads films(film_id, title, language), copies(inventory_id, film_id),
    rentals(rental_id, inventory_id, customer_id, rental_date, return_date),
    customers(customer_id, customer_name). The search narrows the films first;
    the rental history is read only for copies of those. The latest rental of
    each film (highest id on equal dates) is chosen before names are joined.
    """
    if pattern is None:
        raise ValueError("No title pattern was given")
    if not pattern.strip(" "):
        raise ValueError("The title pattern is empty")
    matching = films.where(F.col("title").ilike(pattern))
    held = copies.join(matching.select("film_id"), "film_id", "left_semi")
    history = rentals.join(held, "inventory_id")
    out_now = history.where(F.col("return_date").isNull()).select("inventory_id").distinct()
    in_store = held.join(out_now, "inventory_id", "left_anti").select("film_id").distinct()
    last = history.groupBy("film_id").agg(
        F.max(F.struct("rental_date", "rental_id", "customer_id")).alias("_last")
    ).select("film_id", "_last.rental_date", "_last.customer_id")
    last = last.join(customers, "customer_id", "left")
    found = matching.join(in_store, "film_id").join(last, "film_id", "left")
    columns = ["film_id", "title", "language", "customer_name", "rental_date"]
    return number_rows(found.select(*columns), ["title", "film_id"], "row_num").select(
        "row_num", F.col("title").alias("film_title"), "film_id", "language", "customer_name", "rental_date"
    )


def checked(df: DataFrame, error: DataFrame) -> DataFrame:
    """The rows of ``df``, or an error raised while they are computed, in the same job.

    ``error`` is one row with a string column ``_error``, NULL when all is well. It is appended as
    a row that a filter always drops; evaluating that filter raises the message.
    """
    guard = error.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields),
        F.when(F.col("_error").isNotNull(), F.raise_error(F.col("_error"))).otherwise(F.lit(False)).alias("_keep"),
    )
    return df.withColumn("_keep", F.lit(True)).unionByName(guard).where(F.col("_keep")).drop("_keep")


def rows_or_error(df: DataFrame, message: str) -> DataFrame:
    """"Nothing found" as an error raised inside the plan: the check stops at the first row found."""
    found = df.select(F.lit(1).alias("_one")).limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return checked(df, found.select(F.when(F.col("_n") == 0, F.lit(message)).alias("_error")))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """"Nothing found" is an error, as the interactive search reports it."""
    if df.isEmpty():
        raise LookupError(message)
    return df


# ------------------------------------------------------------------- customers
def reward_customers(
    customers: DataFrame, payments: DataFrame, min_purchases: int, min_amount: float
) -> DataFrame:
    """Customers above both thresholds in the latest month that has payments.

    The month is looked up first, so that it is a literal range for the scan.
    """
    if min_purchases <= 0:
        raise ValueError("The least number of purchases must be positive")
    if min_amount <= 0:
        raise ValueError("The least amount must be positive")
    latest = payments.agg(F.max("payment_date").cast("date")).first()[0]
    if latest is None:
        return customers.limit(0)
    first, after = month_bounds(latest)
    eligible = (
        payments.where(between_days(F.col("payment_date"), first, after))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("_purchases"), total("amount").alias("_amount"))
        .where((F.col("_purchases") > min_purchases) & (F.col("_amount") > min_amount))
    )
    return customers.join(eligible, "customer_id", "left_semi")


def customer_balances(customers: DataFrame, rentals: DataFrame, payments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """What each customer owes as of a time, for all customers in one pass.

    Rental fees, one unit per day held beyond the film's duration, and instead
    of that the replacement cost once the days held exceed twice the duration;
    minus payments. Reads rentals(customer_id, rental_date, return_date,
    rental_rate, rental_duration, replacement_cost) and payments(customer_id,
    amount, payment_date). Each side is reduced to one row per customer before
    the join.
    """
    ends = moment(as_of, rentals, "return_date")
    until = F.least(F.coalesce(F.col("return_date"), ends), ends)
    held, allowed = days_between(until, F.col("rental_date")), F.col("rental_duration").cast("int")
    late = (held > allowed) & (held <= allowed * 2)
    fees = (
        rentals.where(F.col("rental_date") <= moment(as_of, rentals, "rental_date"))
        .groupBy("customer_id")
        .agg(
            total("rental_rate").alias("rent_fees"),
            F.sum(F.when(late, held - allowed).otherwise(0)).cast("decimal(28,2)").alias("overdue_fees"),
            F.sum(F.when(held > allowed * 2, money("replacement_cost")).otherwise(F.lit(0))).alias("replacement_fees"),
        )
    )
    paid = (
        payments.where(F.col("payment_date") <= moment(as_of, payments, "payment_date"))
        .groupBy("customer_id")
        .agg(total("amount").alias("payments"))
    )
    parts = ["rent_fees", "overdue_fees", "replacement_fees", "payments"]
    zero = F.lit(0).cast("decimal(28,2)")
    filled = (
        customers.select("customer_id")
        .join(fees, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select("customer_id", *(F.coalesce(F.col(p), zero).alias(p) for p in parts))
    )
    balance = F.col("rent_fees") + F.col("overdue_fees") + F.col("replacement_fees") - F.col("payments")
    return filled.withColumn("balance", balance)


def active_customers(
    customers: DataFrame, rentals: DataFrame, payments: DataFrame, min_rentals: int, min_payments: int
) -> DataFrame:
    """At least so many rentals and payments, each counted before the join.

    Joining the raw rows would multiply one customer's rentals by their
    payments, only for a distinct count to undo it. Both thresholds are applied
    to the counts, so only customers that pass one of them reach the join.
    """
    result = customers
    for rows, row_id, out, least in (
        (rentals, "rental_id", "number_of_rentals", min_rentals),
        (payments, "payment_id", "number_of_payments", min_payments),
    ):
        counts = rows.groupBy("customer_id").agg(F.count(row_id).alias(out)).where(F.col(out) >= least)
        # A customer without rows counts 0, which passes only a threshold of 0.
        result = result.join(counts, "customer_id", "inner" if least > 0 else "left").na.fill(0, [out])
    return result.orderBy(*sort_columns(["-number_of_rentals", "-number_of_payments", "customer_id"]))


def customers_above(
    customers: DataFrame, rentals: DataFrame, payments: DataFrame, rentals_over: int, payments_over: int
) -> DataFrame:
    """More than so many of each."""
    return active_customers(customers, rentals, payments, rentals_over + 1, payments_over + 1)


def rental_history(customer: DataFrame, rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Every rental of the given customers with its payments; a customer without any keeps one row.

    Rentals are narrowed to the customers first, and payments to those rentals. Customers, and rentals, without a
    partner are added apart: inner joins are split where one customer holds many rows, outer joins only on
    one side. All joins hash the narrowed side and stream the other, so a task holds the former only and sorts neither.
    """
    people = customer.select("customer_id")
    rented = rentals.select("customer_id", "rental_id", "rental_date").join(people.hint("shuffle_hash"), "customer_id")
    paid = payments.select("rental_id", "payment_id", "payment_date")
    columns = ["customer_id", "rental_id", "rental_date", "payment_id", "payment_date"]
    with_payment = paid.join(rented.hint("shuffle_hash"), "rental_id").select(*columns)
    unpaid = rented.join(few_copies(with_payment, ["rental_id"]).hint("shuffle_hash"), "rental_id", "left_anti")
    idle = people.join(few_copies(rented, ["customer_id"]).hint("shuffle_hash"), "customer_id", "left_anti")
    listed = with_payment.unionByName(unpaid, allowMissingColumns=True).unionByName(idle, allowMissingColumns=True)
    return listed.select(*columns).orderBy(*sort_columns(["rental_date", "payment_date"]))


def define_popular_function(spark: SparkSession, rentals: DataFrame, films: DataFrame, countries: DataFrame, prefix: str = "") -> str:
    """``most_popular_by_country`` as a SQL table function of an array of names, for callers who write SQL.

    ``SELECT * FROM most_popular_films_by_countries(array('Chad', 'Brazil'))``. Reads views of
    rentals(country, film_id), films(film_id, title, language) and countries(country). Names are
    trimmed and kept once; the argument checks and unknown names raise from a guard row of the
    same query, with the messages of the DataFrame form.
    """
    rentals.createOrReplaceTempView(f"{prefix}country_rentals")
    films.createOrReplaceTempView(f"{prefix}country_films")
    countries.select("country").createOrReplaceTempView(f"{prefix}known_countries")
    name = f"{prefix}most_popular_films_by_countries"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(input_countries ARRAY<STRING>)
        RETURNS TABLE (country STRING, title STRING, language STRING, film_id BIGINT)
        RETURN
        WITH given AS (
            SELECT pos, trim(c) AS country FROM (SELECT posexplode(input_countries) AS (pos, c))
        ), wanted AS (
            SELECT country, min(pos) AS country_order FROM given GROUP BY country
        ), unknown AS (
            SELECT array_join(array_sort(collect_list(w.country)), ', ') AS names
            FROM wanted w LEFT ANTI JOIN {prefix}known_countries k ON k.country = w.country
        ), counted AS (
            SELECT r.country, r.film_id, count(*) AS n
            FROM {prefix}country_rentals r LEFT SEMI JOIN wanted w ON w.country = r.country
            WHERE r.film_id IS NOT NULL GROUP BY r.country, r.film_id
        ), best AS (
            SELECT c.country, c.film_id FROM counted c
            JOIN (SELECT country, max(n) AS top FROM counted GROUP BY country) b ON b.country = c.country AND c.n = b.top
        ), guard AS (
            SELECT CASE
                WHEN input_countries IS NULL THEN raise_error('No list of countries was given')
                WHEN size(input_countries) = 0 THEN raise_error('The list of countries is empty')
                WHEN exists(input_countries, x -> x IS NULL OR trim(x) = '') THEN raise_error('A country in the list has no name')
                WHEN names <> '' THEN raise_error('Unknown countries: ' || names)
                ELSE false END AS bad
            FROM unknown
        )
        SELECT w.country, f.title, f.language, CAST(f.film_id AS BIGINT) AS film_id
        FROM wanted w LEFT JOIN best b ON b.country = w.country LEFT JOIN {prefix}country_films f ON f.film_id = b.film_id
        UNION ALL
        SELECT NULL, NULL, NULL, NULL FROM guard WHERE bad
        """
    )
    return name


def define_balance_function(spark: SparkSession, rentals: DataFrame, payments: DataFrame, prefix: str = "") -> str:
    """``customer_balances`` of one customer as a SQL table function, to be called laterally for many.

    ``SELECT c.customer_id, b.* FROM customers c, LATERAL customer_balance(c.customer_id, TIMESTAMP '2000-06-30') b``.
    Reads views of rentals(customer_id, rental_date, return_date, rental_rate, rental_duration, replacement_cost) and
    payments(customer_id, amount, payment_date), with the rules of ``customer_balances``; a customer without rows owes 0.
    Spark turns the lateral call into one aggregate by customer and a join, so it costs what the DataFrame form costs.
    """
    rentals.createOrReplaceTempView(f"{prefix}balance_rentals")
    payments.createOrReplaceTempView(f"{prefix}balance_payments")
    name = f"{prefix}customer_balance"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(who BIGINT, as_of TIMESTAMP)
        RETURNS TABLE (rent_fees DECIMAL(28,2), overdue_fees DECIMAL(28,2), replacement_fees DECIMAL(28,2),
                       payments DECIMAL(28,2), balance DECIMAL(28,2))
        RETURN
        WITH held AS (
            SELECT rental_rate, CAST(rental_duration AS INT) AS allowed, replacement_cost,
                   datediff(CAST(least(coalesce(return_date, as_of), as_of) AS DATE), CAST(rental_date AS DATE)) AS days
            FROM {prefix}balance_rentals WHERE customer_id = who AND rental_date <= as_of
        ), fees AS (
            SELECT CAST(coalesce(sum(rental_rate), 0) AS DECIMAL(28,2)) AS rent_fees,
                   CAST(coalesce(sum(CASE WHEN days > allowed AND days <= allowed * 2 THEN days - allowed ELSE 0 END), 0) AS DECIMAL(28,2)) AS overdue_fees,
                   CAST(coalesce(sum(CASE WHEN days > allowed * 2 THEN replacement_cost ELSE 0 END), 0) AS DECIMAL(28,2)) AS replacement_fees
            FROM held
        ), paid AS (
            SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(28,2)) AS payments
            FROM {prefix}balance_payments WHERE customer_id = who AND payment_date <= as_of
        )
        SELECT rent_fees, overdue_fees, replacement_fees, payments, rent_fees + overdue_fees + replacement_fees - payments
        FROM fees CROSS JOIN paid
        """
    )
    return name
