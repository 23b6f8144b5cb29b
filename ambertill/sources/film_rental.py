"""Film rental schema and the join chains its reports start from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

SCHEMAS = {
    "film": "film_id bigint, title string, description string, release_year int, language_id bigint, "
    "rental_duration smallint, rental_rate decimal(4,2), length smallint, replacement_cost decimal(5,2), "
    "rating string, last_update timestamp",
    "category": "category_id bigint, name string",
    "film_category": "film_id bigint, category_id bigint, last_update timestamp",
    "actor": "actor_id bigint, first_name string, last_name string, last_update timestamp",
    "film_actor": "actor_id bigint, film_id bigint, last_update timestamp",
    "language": "language_id bigint, name string, last_update timestamp",
    "inventory": "inventory_id bigint, film_id bigint, store_id bigint, last_update timestamp",
    "rental": "rental_id bigint, rental_date timestamp, inventory_id bigint, customer_id bigint, "
    "return_date timestamp, staff_id bigint, last_update timestamp",
    "payment": "payment_id bigint, customer_id bigint, staff_id bigint, rental_id bigint, "
    "amount decimal(5,2), payment_date timestamp",
    "customer": "customer_id bigint, store_id bigint, first_name string, last_name string, email string, "
    "address_id bigint, activebool boolean, create_date date, last_update timestamp, active int",
    "store": "store_id bigint, address_id bigint",
    "staff": "staff_id bigint, first_name string, last_name string, store_id bigint",
    "address": "address_id bigint, address string, address2 string, city_id bigint",
    "city": "city_id bigint, country_id bigint",
    "country": "country_id bigint, country string",
}

#: Audience text per film rating (fixed values).
AUDIENCE = {
    "G": "All ages",
    "PG": "Parental guidance suggested",
    "PG-13": "13+ (parent required to be cautious for under 13)",
    "R": "17+ (parent required for under 17)",
    "NC-17": "17+ only",
}

Tables = Mapping[str, DataFrame]


def films_with_category(t: Tables) -> DataFrame:
    category = t["category"].select("category_id", F.col("name").alias("category_name"))
    return t["film"].join(t["film_category"].select("film_id", "category_id"), "film_id").join(category, "category_id")


def actors_with_films(t: Tables) -> DataFrame:
    links = t["film_actor"].select("actor_id", "film_id")
    return (
        t["actor"]
        .select("actor_id", "first_name", "last_name")
        .join(links, "actor_id")
        .join(t["film"].select("film_id", "release_year"), "film_id")
    )


def rented_films(t: Tables) -> DataFrame:
    """One row per rental with its film."""
    copies = t["inventory"].select("inventory_id", "film_id", "store_id")
    rentals = t["rental"].select("rental_id", "inventory_id", "customer_id", "rental_date", "return_date")
    films = t["film"].select(
        "film_id", "title", "rating", "language_id", "length", "release_year",
        "rental_rate", "rental_duration", "replacement_cost",
    )
    return rentals.join(copies, "inventory_id").join(films, "film_id")


def payments_by_copy(t: Tables) -> DataFrame:
    """Payments with the rented copy."""
    rentals = t["rental"].select("rental_id", "inventory_id")
    payments = t["payment"].select("payment_id", "rental_id", "staff_id", "amount", "payment_date")
    return payments.join(rentals, "rental_id")


def payments_by_store(t: Tables) -> DataFrame:
    return payments_by_copy(t).join(t["inventory"].select("inventory_id", "store_id"), "inventory_id")


def payments_by_film(t: Tables) -> DataFrame:
    return payments_by_copy(t).join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")


def stores_with_address(t: Tables) -> DataFrame:
    return t["store"].join(t["address"].select("address_id", "address", "address2"), "address_id")


def film_categories(t: Tables) -> DataFrame:
    """Bridge from films to categories."""
    category = t["category"].select("category_id", F.col("name").alias("category_name"))
    return t["film_category"].select("film_id", "category_id").join(category, "category_id")


def customer_country(t: Tables) -> DataFrame:
    """Each customer's country name."""
    return (
        t["customer"]
        .select("customer_id", "address_id")
        .join(t["address"].select("address_id", "city_id"), "address_id")
        .join(t["city"], "city_id")
        .join(t["country"], "country_id")
        .select("customer_id", "country")
    )


def rentals_by_country(t: Tables) -> DataFrame:
    """Rented film and country of the customer, one row per rental."""
    rentals = t["rental"].select("rental_id", "inventory_id", "customer_id")
    copies = t["inventory"].select("inventory_id", "film_id")
    return rentals.join(customer_country(t), "customer_id").join(copies, "inventory_id")


def films_with_language(t: Tables) -> DataFrame:
    language = t["language"].select("language_id", F.col("name").alias("language"))
    return t["film"].join(language, "language_id")
