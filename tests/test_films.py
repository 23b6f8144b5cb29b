import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ambertill.operators.quality import by_year_and_quarter, same_rows
from ambertill.plans import films, loads
from ambertill.sources import film_rental
from ambertill.sources.frames import define_view, inline
from ambertill.sources.film_rental import SCHEMAS
from conftest import bag, plan_of, rows

T = dt.datetime
NOW = T(2026, 1, 1)


def film(i, title, year, language=1, duration=3, rate="1.99", length=90, cost="20.00", rating="PG"):
    return (i, title, None, year, language, duration, Decimal(rate), length, Decimal(cost), rating, NOW)


@pytest.fixture(scope="module")
def shop(spark):
    data = {
        "film": [
            film(1, "ACADEMY DINOSAUR", 2017),
            film(2, "DOCTOR GRAIL", 2018, rate="0.99", rating="R"),
            film(3, "ZORRO ARK", 2015, rating="XX"),
            film(4, "DOCTOR LOST", 2019, rate="2.99"),
        ],
        "category": [(1, "Animation"), (2, "Drama"), (3, "Travel")],
        "film_category": [(1, 1, NOW), (2, 1, NOW), (3, 2, NOW), (4, 1, NOW), (4, 3, NOW)],
        "actor": [(1, "ANN", "LEE", NOW), (2, "ANN", "LEE", NOW), (3, "BO", "RAY", NOW)],
        "film_actor": [(1, 1, NOW), (1, 3, NOW), (2, 2, NOW), (3, 1, NOW), (3, 2, NOW), (3, 4, NOW)],
        "language": [(1, "English", NOW), (2, "French", NOW)],
        "inventory": [(1, 1, 1, NOW), (2, 1, 2, NOW), (3, 2, 1, NOW), (4, 4, 2, NOW), (5, 3, 1, NOW)],
        "rental": [
            (1, T(2017, 4, 1), 1, 1, T(2017, 4, 4), 1, NOW),
            (2, T(2017, 4, 2), 2, 2, T(2017, 4, 6), 2, NOW),
            (3, T(2017, 5, 1), 3, 1, T(2017, 5, 7), 1, NOW),
            (4, T(2017, 5, 2), 4, 3, None, 2, NOW),
            (5, T(2017, 6, 1), 5, 1, T(2017, 6, 8), 1, NOW),
            (6, T(2017, 6, 2), 1, 2, None, 1, NOW),
        ],
        "payment": [
            (1, 1, 1, 1, Decimal("5.00"), T(2017, 4, 1, 12)),
            (2, 2, 2, 2, Decimal("3.00"), T(2017, 4, 2)),
            (3, 1, 1, 3, Decimal("2.00"), T(2017, 6, 5)),
            (4, 3, 2, 4, Decimal("9.00"), T(2017, 6, 6)),
            (5, 3, 2, 4, Decimal("1.00"), T(2017, 6, 30, 23)),
        ],
        "customer": [
            (1, 1, "KIM", "POE", "k@x", 1, True, dt.date(2017, 1, 1), NOW, 1),
            (2, 1, "LOU", "ROE", "l@x", 2, True, dt.date(2017, 1, 1), NOW, 1),
            (3, 2, "MAX", "DOE", "m@x", 3, True, dt.date(2017, 1, 1), NOW, 1),
        ],
        "store": [(1, 4), (2, 5)],
        "staff": [(1, "SAM", "ONE", 1), (2, "TIM", "TWO", 2)],
        "address": [(1, "a1", None, 1), (2, "a2", None, 1), (3, "a3", None, 2), (4, "Main 1", None, 3), (5, "Side 2", "Floor 3", 3)],
        "city": [(1, 1), (2, 2), (3, 3)],
        "country": [(1, "Brazil"), (2, "Chad"), (3, "Australia")],
    }
    return {name: spark.createDataFrame(data[name], SCHEMAS[name]) for name in SCHEMAS}


def test_catalogue_variants_agree(shop):
    joined = films.films_of_category(film_rental.films_with_category(shop), "animation", 2017, 2019, 1)
    assert rows(joined, "film_title") == [("ACADEMY DINOSAUR",), ("DOCTOR LOST",)]
    subquery = films.films_of_category_by_subquery(
        film_rental.films_with_category(shop), film_rental.film_categories(shop), "Animation", 2017, 2019, 1
    )
    # A film in two categories is listed with both by the subquery form.
    assert same_rows(subquery.where("category_name = 'Animation'"), joined)
    assert subquery.count() == 3


def test_store_revenue_variants_agree(shop):
    stores, since = film_rental.stores_with_address(shop), dt.date(2017, 4, 2)
    copies = shop["inventory"].select("inventory_id", "store_id")
    a = films.store_revenue_since(film_rental.payments_by_copy(shop), "inventory_id", copies, stores, since)
    b = films.store_revenue_since_joined(film_rental.payments_by_store(shop), stores, since)
    assert rows(a) == rows(b) == [(2, "Side 2, Floor 3", Decimal("13.00")), (1, "Main 1", Decimal("2.00"))]


def test_actor_counts_by_id_and_by_name(shop):
    people = shop["actor"].select("actor_id", "first_name", "last_name")
    acted = film_rental.actors_with_films(shop)
    assert bag(films.busiest_actors(acted, people, 2015, 5), "actor_id", "number_of_movies") == [(1, 2), (2, 1), (3, 3)]
    assert bag(films.busiest_names(acted, people, 2015, 5)) == [("ANN", "LEE", 3), ("BO", "RAY", 3)]


def test_category_counts(shop):
    found = films.category_counts_per_year(film_rental.films_with_category(shop), {"drama": "d", "TRAVEL": "t"})
    assert rows(found) == [(2019, 0, 1), (2015, 1, 0)]


def test_last_store_two_ways(shop):
    paid = film_rental.payments_by_store(shop)
    best = films.best_staff_with_last_store(
        paid, F.concat_ws(" ", "first_name", "last_name"), shop["staff"].drop("store_id"), dt.date(2017, 1, 1), dt.date(2018, 1, 1), 3
    )
    assert rows(best) == [("TIM TWO", 2, Decimal("13.00")), ("SAM ONE", 1, Decimal("7.00"))]
    one = films.last_row_per_key(paid, "staff_id", ["-payment_date", "-payment_id"])
    two = films.last_row_by_maxima(paid, "staff_id", "payment_date", "payment_id")
    assert bag(one, "staff_id", "payment_id") == bag(two, "staff_id", "payment_id") == [(1, 3), (2, 5)]


def test_most_rented_with_ties(shop):
    rented = film_rental.rented_films(shop).select("film_id")
    titles = shop["film"].select("film_id", "title", "rating")
    label = ("rating", film_rental.AUDIENCE)
    written = films.most_rented_with_ties(rented, titles, label, 2, ["-number_of_rentals", "title"])
    assert rows(written, "film_id", "rating_description", "number_of_rentals") == [
        (1, "Parental guidance suggested", 3), (2, "17+ (parent required for under 17)", 1),
    ]
    by_count = films.most_rented_with_ties(rented, titles, label, 2, ["-number_of_rentals"])
    assert [r[0] for r in rows(by_count, "film_id")] == [1, 2, 3, 4]
    assert rows(by_count.where("film_id = 3"), "rating_description") == [("Unknown Rating",)]


def test_inactivity_and_gaps(shop):
    people = shop["actor"].select("actor_id", "last_name")
    acted = film_rental.actors_with_films(shop).select("actor_id", "release_year")
    assert rows(films.inactive_years(acted, people, "actor_id", 2026), "actor_id", "actor_inactive_period") == [(1, 9), (2, 8), (3, 7)]
    gaps = films.longest_career_gap(acted, people, "actor_id", "release_year", "last_name")
    assert rows(gaps, "actor_id", "max_career_gap") == [(1, 2), (3, 1)]
    assert "NestedLoop" not in plan_of(gaps)


def test_revenue_by_category(shop):
    paid, bridge = film_rental.payments_by_film(shop), film_rental.film_categories(shop)
    report = lambda day: films.revenue_by_category_in_quarter(paid, "film_id", bridge, day)
    found = bag(report(dt.date(2017, 4, 1)))
    assert found == [(2017, 2, 1, "Animation", Decimal("20.00")), (2017, 2, 3, "Travel", Decimal("10.00"))]
    assert report(None).count() == 0
    assert report(dt.date(2026, 4, 8)).count() == 0
    manual = (
        paid.join(bridge, "film_id")
        .where("year(payment_date) = 2017 and quarter(payment_date) = 2")
        .groupBy(F.year("payment_date").alias("target_year"), F.quarter("payment_date").alias("target_quarter"), "category_id", "category_name")
        .agg(F.sum("amount").cast("decimal(38,2)").alias("total_revenue"))
    )
    assert same_rows(report(dt.date(2017, 4, 1)), manual)


def test_revenue_as_sql_function_and_as_view(spark, shop):
    paid, bridge = film_rental.payments_by_film(shop), film_rental.film_categories(shop)
    name = films.define_revenue_function(spark, paid, bridge)
    expected = films.revenue_by_category_in_quarter(paid, "film_id", bridge, dt.date(2017, 4, 1))
    found = spark.sql(f"SELECT * FROM {name}(target_date => date'2017-06-30')")
    assert bag(found) == bag(expected)
    assert spark.sql(f"SELECT * FROM {name}(CAST(NULL AS DATE))").count() == 0
    assert spark.sql(f"SELECT * FROM {name}(date'2026-04-08')").count() == 0
    view = define_view(spark, "revenue_now", lambda _: expected)
    assert view.count() == 2


def test_rental_history(shop):
    found = films.rental_history(shop["customer"].where("customer_id in (1, 3)"), shop["rental"], shop["payment"])
    assert rows(found, "customer_id", "rental_id", "payment_id") == [(1, 1, 1), (1, 3, 3), (3, 4, 4), (3, 4, 5), (1, 5, None)]
    idle = films.rental_history(shop["customer"].where("customer_id = 2"), shop["rental"].limit(0), shop["payment"])
    assert rows(idle, "customer_id", "rental_id") == [(2, None)]


def test_payments_by_quarter(shop):
    assert rows(by_year_and_quarter(shop["payment"], "payment_date", "amount")) == [(2017, 2, 5, Decimal("20.00"))]


def popular(shop, names):
    return films.most_popular_by_country(
        film_rental.rentals_by_country(shop),
        film_rental.films_with_language(shop),
        shop["country"],
        names,
        ["title", "rating", "language", "length", "release_year"],
    )


def test_popular_films_keep_order_ties_and_empty_countries(shop):
    found = rows(popular(shop, ["Chad", " Australia ", "Brazil", "Chad"]), "country", "title")
    assert found == [("Chad", "DOCTOR LOST"), ("Australia", None), ("Brazil", "ACADEMY DINOSAUR")]


@pytest.mark.parametrize(
    "names, message",
    [(None, "No list"), ([], "list of countries is empty"), (["Chad", " "], "has no name")],
)
def test_popular_films_argument_errors(shop, names, message):
    with pytest.raises(ValueError, match=message):
        popular(shop, names)


def jobs_of(spark, action):
    """Result of ``action`` and the number of Spark jobs it ran."""
    tracker = spark.sparkContext.statusTracker()
    group = f"check-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        try:
            result = action()
        except Exception as error:  # noqa: BLE001 - the error is the result
            result = error
    finally:
        spark.sparkContext.setJobGroup(None, None)
    return result, len(tracker.getJobIdsForGroup(group))


def test_unknown_countries_fail_inside_the_report_job(shop):
    spark = shop["country"].sparkSession
    report = popular(shop, ["Nowhere", "Chad", "Atlantis"])  # nothing runs yet
    error, jobs = jobs_of(spark, report.collect)
    assert "Unknown countries: Atlantis, Nowhere" in str(error)
    found, jobs = jobs_of(spark, popular(shop, ["Chad"]).collect)
    assert [r.title for r in found] == ["DOCTOR LOST"]


def test_nothing_found_fails_inside_the_search_job(shop):
    spark = shop["country"].sparkSession
    error, jobs = jobs_of(spark, films.rows_or_error(stock(shop, "%no sleep%"), "No films in stock match the pattern: %no sleep%").collect)
    assert "No films in stock match the pattern: %no sleep%" in str(error)
    found, _ = jobs_of(spark, films.rows_or_error(stock(shop, "%o%"), "none").collect)
    assert len(found) == 3


def test_countries_without_rentals(shop):
    found = films.countries_without_rentals(shop["country"], film_rental.customer_country(shop), shop["rental"])
    assert rows(found) == [("Australia",)]


def stock(shop, pattern):
    people = shop["customer"].select("customer_id", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"))
    return films.films_in_stock(
        film_rental.films_with_language(shop), shop["inventory"].select("inventory_id", "film_id"), shop["rental"], people, pattern
    )


def test_stock_search(shop):
    # Film 1 has one copy out and one in; film 4's only copy is out.
    assert rows(stock(shop, "%o%").orderBy("row_num"), "row_num", "film_title", "customer_name") == [
        (1, "ACADEMY DINOSAUR", "LOU ROE"), (2, "DOCTOR GRAIL", "KIM POE"), (3, "ZORRO ARK", "KIM POE"),
    ]
    assert same_rows(stock(shop, "%doctor%"), stock(shop, "%DOCTOR%"))


def test_stock_errors(shop):
    with pytest.raises(ValueError, match="No title"):
        stock(shop, None)
    with pytest.raises(ValueError, match="empty"):
        stock(shop, "  ")
    with pytest.raises(LookupError, match="no sleep"):
        films.require_rows(stock(shop, "%no sleep%"), "No films in stock match the pattern: %no sleep%")


def test_rewards_are_strict_and_use_the_latest_month_with_data(shop):
    reward = lambda n, amount: bag(films.reward_customers(shop["customer"], shop["payment"], n, amount), "customer_id")
    assert reward(1, 9.99) == [(3,)]
    assert reward(1, 10) == [] and reward(2, 1) == []
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError, match="must be positive"):
            reward(*bad)


@pytest.mark.parametrize("days, fee, replacement", [(3, 0, 0), (4, 1, 0), (6, 3, 0), (7, 0, 20)])
def test_balance_by_days_held(spark, days, fee, replacement):
    people = spark.createDataFrame([(1,)], "customer_id int")
    rented = spark.createDataFrame(
        [(1, T(2017, 1, 1, 23), T(2017, 1, 1) + dt.timedelta(days=days), 5.0, 3, 20.0), (1, T(2017, 9, 1), None, 7.0, 3, 20.0)],
        "customer_id int, rental_date timestamp, return_date timestamp, rental_rate double, rental_duration int, replacement_cost double",
    )
    paid = spark.createDataFrame([(1, 2.0, T(2017, 1, 2)), (1, 50.0, T(2018, 1, 1))], "customer_id int, amount double, payment_date timestamp")
    found = films.customer_balances(people, rented, paid, T(2017, 2, 1)).first()
    assert (found.overdue_fees, found.replacement_fees, found.balance) == (fee, replacement, 5 + fee + replacement - 2)


def test_open_rentals_count_up_to_the_date_and_idle_customers_owe_nothing(spark, shop):
    found = dict(rows(films.customer_balances(shop["customer"], film_rental.rented_films(shop), shop["payment"], T(2017, 5, 6)), "customer_id", "balance"))
    # Customer 3: rate 2.99, held 4 of 3 days, nothing paid yet.
    assert found[3] == Decimal("3.99")
    assert films.customer_balances(shop["customer"], film_rental.rented_films(shop), shop["payment"], T(2016, 1, 1)).agg(F.sum("balance")).first()[0] == 0


def test_activity_equals_the_distinct_count_form(shop):
    people = shop["customer"].select("customer_id")
    found = films.active_customers(people, shop["rental"], shop["payment"], 1, 1)
    naive = (
        people.join(shop["rental"], "customer_id", "left")
        .join(shop["payment"].select("customer_id", "payment_id"), "customer_id", "left")
        .groupBy("customer_id")
        .agg(F.countDistinct("rental_id").alias("number_of_rentals"), F.countDistinct("payment_id").alias("number_of_payments"))
    )
    assert same_rows(found, naive)
    assert bag(films.active_customers(people, shop["rental"], shop["payment"].limit(0), 3, 0), "customer_id") == [(1,)]
    assert bag(films.customers_above(people, shop["rental"], shop["payment"], 2, 1), "customer_id") == [(1,)]


# ------------------------------------------------------------------ loads
def test_film_loads_are_rerunnable(spark, shop):
    batch = spark.createDataFrame(
        [("STRANGE HOUSE", 2022, "English", 7, "4.99"), ("LONG SHADOW", 2011, "English", 14, "9.99"), ("ZORRO ARK", 2015, "English", 3, "1.99"), ("LOST TONGUE", 2011, "Klingon", 1, "1.00")],
        "title string, release_year int, language_name string, rental_duration int, rental_rate string",
    )
    done = loads.insert_films(shop["film"], shop["language"], batch, NOW)
    assert bag(done.inserted, "film_id", "title") == [(5, "LONG SHADOW"), (6, "STRANGE HOUSE")]
    assert loads.insert_films(done.snapshot, shop["language"], batch, NOW).inserted.count() == 0

    wanted = spark.createDataFrame([("STRANGE HOUSE", "Drama"), ("LONG SHADOW", "Travel")], "title string, category string")
    link = lambda target: loads.insert_links(
        target, wanted, (done.snapshot, {"title": "title"}, "film_id"), (shop["category"], {"category": "name"}, "category_id"), NOW
    )
    links = link(shop["film_category"])
    assert bag(links.inserted, "film_id", "category_id") == [(5, 3), (6, 2)]
    assert "NestedLoop" not in plan_of(links.inserted) and link(links.snapshot).inserted.count() == 0

    people = spark.createDataFrame([("BO", "RAY"), ("EVE", "LAW")], "first_name string, last_name string")
    actors = loads.insert_actors(shop["actor"], people, NOW)
    assert bag(actors.inserted, "actor_id", "first_name") == [(4, "EVE")]

    titles = wanted.select("title")
    copies = loads.insert_copies(shop["inventory"], done.snapshot, shop["store"], titles, NOW)
    assert bag(copies.inserted, "inventory_id", "film_id", "store_id") == [(6, 5, 1), (7, 6, 1)]

    customer = shop["customer"].where("customer_id = 2")
    visits = spark.createDataFrame(
        [("STRANGE HOUSE", T(2017, 1, 10, 10), T(2017, 1, 20, 10)), ("LONG SHADOW", T(2017, 1, 11, 11), T(2017, 1, 21, 11))],
        "title string, rental_date timestamp, return_date timestamp",
    )
    rent = lambda target: loads.insert_rentals(target, copies.snapshot, done.snapshot, shop["staff"], customer, visits, NOW)
    rented = rent(shop["rental"])
    assert bag(rented.inserted, "rental_id", "inventory_id", "customer_id", "staff_id") == [(7, 7, 2, 1), (8, 6, 2, 1)]
    assert rent(rented.snapshot).inserted.count() == 0

    bills = spark.createDataFrame([("STRANGE HOUSE", T(2017, 1, 10, 10, 5)), ("LONG SHADOW", T(2017, 1, 11, 11, 5))], "title string, payment_date timestamp")
    pay = lambda target: loads.insert_payments(target, rented.snapshot, copies.snapshot, done.snapshot, customer, bills)
    paid = pay(shop["payment"])
    assert bag(paid.inserted, "rental_id", "amount") == [(7, Decimal("4.99")), (8, Decimal("9.99"))]
    assert pay(paid.snapshot).inserted.count() == 0


def test_rows_already_present(spark, shop):
    wanted = inline(spark, [("ACADEMY DINOSAUR", 2017), ("DOCTOR GRAIL", 1999)], "title string, release_year int")
    assert rows(loads.already_present(shop["film"], wanted, ["title", "release_year"]), "film_id") == [(1,)]


def test_open_rental_is_inserted_once(shop):
    customer = shop["customer"].where("customer_id = 2")
    first = loads.insert_open_rental(shop["rental"], shop["inventory"], shop["staff"], customer, NOW)
    assert bag(first.inserted, "rental_id", "inventory_id", "staff_id", "return_date") == [(7, 5, 2, None)]
    assert loads.insert_open_rental(first.snapshot, shop["inventory"], shop["staff"], customer, NOW).inserted.count() == 0


def test_registering_films(spark, shop):
    batch = spark.createDataFrame(
        [(1, " Operation Fortune "), (2, "operation fortune"), (3, "academy dinosaur"), (4, None), (5, " "), (6, "Second Tale")], "seq int, title string"
    )
    done = loads.register_films(shop["film"], shop["language"], batch, 2026)
    assert rows(done.inserted.orderBy("film_id")) == [
        (5, "OPERATION FORTUNE", "Klingon", 2026, 3, Decimal("4.99"), Decimal("19.99")),
        (6, "SECOND TALE", "Klingon", 2026, 3, Decimal("4.99"), Decimal("19.99")),
    ]
    assert bag(done.languages, "language_id", "name")[-1] == (3, "Klingon")
    assert dict(rows(done.rejected, "seq", "reject_reason")) == {
        2: "the film operation fortune is there already",
        3: "the film academy dinosaur is there already",
        4: "the title is missing",
        5: "the title is empty",
    }
    assert done.films.count() == 6
    named = spark.createDataFrame([(1, "The Pact", 2025, " ENGLISH ")], "seq int, title string, release_year int, language_name string")
    again = loads.register_films(done.films, done.languages, named, 2026)
    assert rows(again.inserted, "film_id", "language", "release_year") == [(7, "English", 2025)]
    assert again.languages.count() == 3


def test_popular_films_as_sql_function(shop):
    spark = shop["country"].sparkSession
    name = films.define_popular_function(
        spark, film_rental.rentals_by_country(shop), film_rental.films_with_language(shop).select("film_id", "title", "language"), shop["country"], "t_"
    )
    got = bag(spark.sql(f"SELECT * FROM {name}(array('Chad', ' Australia ', 'Brazil', 'Chad'))"), "country", "title")
    assert got == bag(popular(shop, ["Chad", " Australia ", "Brazil", "Chad"]), "country", "title")
    for argument, message in [
        ("CAST(NULL AS ARRAY<STRING>)", "No list of countries"),
        ("CAST(array() AS ARRAY<STRING>)", "list of countries is empty"),
        ("array('Chad', ' ')", "has no name"),
        ("array('Chad', CAST(NULL AS STRING))", "has no name"),
        ("array('Nowhere', 'Chad', 'Atlantis')", "Unknown countries: Atlantis, Nowhere"),
    ]:
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM {name}({argument})").collect()


@pytest.mark.parametrize("as_of", [T(2017, 5, 6), T(2016, 1, 1)])
def test_balance_as_lateral_sql_function(spark, shop, as_of):
    rented, paid = film_rental.rented_films(shop), shop["payment"]
    name = films.define_balance_function(spark, rented, paid, "t_")
    shop["customer"].select("customer_id").createOrReplaceTempView("t_balance_people")
    got = spark.sql(f"SELECT c.customer_id, b.* FROM t_balance_people c, LATERAL {name}(c.customer_id, TIMESTAMP '{as_of}') b")
    want = films.customer_balances(shop["customer"], rented, paid, as_of)
    columns = ["customer_id", "rent_fees", "overdue_fees", "replacement_fees", "payments", "balance"]
    assert bag(got.select(columns), *columns) == bag(want.select(columns), *columns)
    # One aggregate by customer and a join: no call per row.
    assert "BatchEvalPython" not in plan_of(got) and "Aggregate" in plan_of(got)
