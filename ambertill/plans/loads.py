"""Rerunnable loads: resolve natural keys, skip what is present, number the rest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.functions.ordering import SortKeys
from ambertill.functions.text import folded
from ambertill.operators.changes import assign_ids, insert_ignore, insert_missing, union_all
from ambertill.operators.matching import Lookup, resolve_keys
from ambertill.operators.ranking import first_per_key
from ambertill.session import stage
from ambertill.sources import fuel_network
from ambertill.sources.declared import Table


@dataclass(frozen=True)
class Load:
    """How a batch with natural keys becomes rows of ``table``.

    ``match`` columns decide whether a row is already present. With ``once`` a
    repeat inside the batch is dropped too (conflict-ignore); without it only
    rows of the table count (not-exists).
    """

    table: str
    match: tuple[str, ...]
    lookups: tuple[Lookup, ...] = ()
    once: bool = False
    id_column: str | None = None
    order: SortKeys = field(default=())


class Loaded(NamedTuple):
    snapshot: DataFrame
    inserted: DataFrame
    rejected: DataFrame


def run_load(load: Load, declared: Mapping[str, Table], data: Mapping[str, DataFrame], batch: DataFrame) -> Loaded:
    table, target = declared[load.table], data[load.table]
    resolved, rejected = resolve_keys(batch, data, load.lookups)
    columns = [c for c in target.columns if c != load.id_column]
    rows = table.completed(resolved)
    rows = rows.select(*(F.col(c).cast(target.schema[c].dataType) for c in columns))
    order = [*(load.order or load.match)]
    present = target.drop(load.id_column) if load.id_column else target
    if load.once:
        added = insert_ignore(present, rows, load.match, order).affected
    else:
        added = insert_missing(present, rows, load.match).affected
    if load.id_column:
        if load.once or not target.isEmpty():
            added = stage(added, "added")  # numbering samples its input before it sorts it: the choice would run twice
        added = assign_ids(added, target, load.id_column, order)
    else:
        added = stage(added, "inserted")
    added = added.select(*target.columns)
    return Loaded(target.unionByName(added), added, rejected)


def run_loads(
    loads: Sequence[tuple[Load, DataFrame]], declared: Mapping[str, Table], data: Mapping[str, DataFrame]
) -> tuple[dict[str, DataFrame], dict[str, Loaded]]:
    """Loads in order, parents first; later loads see the rows of earlier ones."""
    current, reports = dict(data), {}
    for position, (load, batch) in enumerate(loads):
        done = run_load(load, declared, current, batch)
        current[load.table] = done.snapshot
        reports[f"{position}:{load.table}"] = done
    return current, reports


def empty_tables(spark, declared: Mapping[str, Table]) -> dict[str, DataFrame]:
    """Tables without rows; ``limit(0)`` tells the optimizer so, and it leaves out their joins and scans."""
    return {name: spark.createDataFrame([], t.schema).limit(0) for name, t in declared.items()}


# ------------------------------------------------------------------------ fuel
FUEL_LOADS = {
    "station": Load("station", ("station_code",), once=True, id_column="station_id"),
    "fuel": Load("fuel", ("fuel_code",), once=True, id_column="fuel_id"),
    "customer": Load("customer", ("customer_code",), once=True, id_column="customer_id"),
    "employee": Load(
        "employee", ("employee_code",), (fuel_network.STATION_FUEL[0],), once=True, id_column="employee_id"
    ),
    "station_fuel": Load(
        "station_fuel", ("station_id", "fuel_id"), fuel_network.STATION_FUEL[:2], once=True, id_column="station_fuel_id"
    ),
    "price": Load(
        "price",
        ("station_fuel_id", "price_type", "valid_from"),
        fuel_network.STATION_FUEL,
        once=True,
        id_column="price_id",
    ),
    "fuel_sale": Load(
        "fuel_sale",
        ("receipt_number",),
        (*fuel_network.STATION_FUEL, fuel_network.EMPLOYEE, fuel_network.CUSTOMER),
        once=True,
        id_column="fuel_sale_id",
    ),
}


# --------------------------------------------------------------------- transit
def _asset(kind: str | None) -> Lookup:
    on = {"created_at": "created_at"} if kind else {"asset_type": "asset_type", "created_at": "created_at"}
    return Lookup("asset_id", "asset", "asset_id", on, fixed={"asset_type": kind} if kind else {})


def _station(out: str = "station_id", code: str = "station_code", required: bool = True) -> Lookup:
    return Lookup(out, "station", "station_id", {code: "station_code"}, required)


_LINE = Lookup("line_id", "line", "line_id", {"line_code": "line_code"})
_TRIP = Lookup("trip_id", "trip", "trip_id", {"trip_code": "trip_code"})

TRANSIT_LOADS = {
    "line": Load("line", ("line_code",), once=True, id_column="line_id"),
    "asset": Load("asset", ("asset_type", "created_at"), id_column="asset_id", order=("created_at", "asset_type")),
    "maintenance_type": Load(
        "maintenance_type", ("maintenance_type_name",), once=True, id_column="maintenance_type_id"
    ),
    "ticket_type": Load("ticket_type", ("ticket_type_name",), once=True, id_column="ticket_type_id"),
    "train": Load("train", ("fleet_number",), (_asset("train"),), id_column="train_id"),
    # Parents first, then children that name their parent.
    "station": Load(
        "station",
        ("station_code",),
        (_asset("station"), _station("parent_station_id", "parent_station_code", required=False)),
        id_column="station_id",
    ),
    "ticket_offer": Load(
        "ticket_offer",
        ("ticket_type_id", "valid_from"),
        (Lookup("ticket_type_id", "ticket_type", "ticket_type_id", {"ticket_type_name": "ticket_type_name"}),),
        id_column="ticket_offer_id",
    ),
    "schedule_version": Load(
        "schedule_version",
        ("line_id", "schedule_name", "effective_from"),
        (_LINE,),
        id_column="schedule_version_id",
    ),
    "line_station": Load(
        "line_station", ("line_id", "station_id", "valid_from"), (_LINE, _station()), id_column="line_station_id"
    ),
    "track_segment": Load(
        "track_segment",
        ("from_station_id", "to_station_id", "opened_on"),
        (
            _asset("track_segment"),
            _station("from_station_id", "from_station_code"),
            _station("to_station_id", "to_station_code"),
        ),
        id_column="track_segment_id",
    ),
    "trip": Load(
        "trip",
        ("schedule_version_id", "trip_code"),
        (
            Lookup(
                "schedule_version_id", "schedule_version", "schedule_version_id", {"schedule_name": "schedule_name"}
            ),
            _station("origin_station_id", "origin_station_code"),
            _station("destination_station_id", "destination_station_code"),
        ),
        id_column="trip_id",
    ),
    "maintenance_event": Load(
        "maintenance_event",
        ("asset_id", "maintenance_type_id", "scheduled_start"),
        (
            _asset(None),
            Lookup(
                "maintenance_type_id",
                "maintenance_type",
                "maintenance_type_id",
                {"maintenance_type_name": "maintenance_type_name"},
            ),
        ),
        id_column="maintenance_event_id",
    ),
    # The stop's place on the line needs two levels: line and station, then their pair.
    "trip_stop": Load(
        "trip_stop",
        ("trip_id", "stop_sequence"),
        (
            _TRIP,
            _LINE,
            _station(),
            Lookup(
                "line_station_id",
                "line_station",
                "line_station_id",
                {"line_id": "line_id", "station_id": "station_id"},
            ),
        ),
    ),
    "train_assignment": Load(
        "train_assignment",
        ("trip_id", "valid_from"),
        (_TRIP, Lookup("train_id", "train", "train_id", {"fleet_number": "fleet_number"})),
        id_column="train_assignment_id",
    ),
    "ticket_sale": Load(
        "ticket_sale",
        ("ticket_number",),
        (
            Lookup("ticket_type_id", "ticket_type", "ticket_type_id", {"ticket_type_name": "ticket_type_name"}),
            Lookup(
                "ticket_offer_id",
                "ticket_offer",
                "ticket_offer_id",
                {"ticket_type_id": "ticket_type_id", "offer_valid_from": "valid_from"},
            ),
            _station("sale_station_id", required=False),
        ),
        id_column="ticket_sale_id",
    ),
}


def already_present(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a load would find in place: ``(a, b, ..) IN ((..), (..))`` as a semi join."""
    return target.join(wanted.select(*keys), list(keys), "left_semi")


# ----------------------------------------------------------------- film rental
_LANGUAGE = Lookup("language_id", "language", "language_id", {"language_name": "name"})


def _refused(rows: DataFrame, batch: DataFrame, condition: Column, reason: str) -> DataFrame:
    return rows.where(condition).select(*batch.columns, F.lit(reason).alias("reject_reason"))


def insert_films(films: DataFrame, languages: DataFrame, batch: DataFrame, loaded_at) -> Loaded:
    """New films with their language's id; films with the same title and year are left out.

    Rows whose language is unknown, or the name of several, are refused.
    """
    resolved, rejected = resolve_keys(batch, {"language": languages}, [_LANGUAGE])
    rows = resolved.withColumn("last_update", F.lit(loaded_at).cast("timestamp"))
    return _inserted(films, rows, ("title", "release_year"), "film_id", rejected)


def insert_links(
    target: DataFrame,
    wanted: DataFrame,
    left: tuple[DataFrame, Mapping[str, str], str],
    right: tuple[DataFrame, Mapping[str, str], str],
    loaded_at,
) -> Loaded:
    """Rows of a link table from a mapping of natural keys.

    The mapping stands for a condition such as "(title is A and category is X)
    or (title is B and category is Y)" and turns it into two equality joins. A name held by several rows links each of
    them; mappings that find nothing on a side are refused.
    """
    rows = wanted
    ids = []
    for table, on, id_column in (left, right):
        side = table.select(id_column, *(F.col(theirs).alias(mine) for mine, theirs in on.items()))
        rows = rows.join(side, list(on), "left")
        ids.append(id_column)
    rows = stage(rows.withColumn("last_update", F.lit(loaded_at).cast("timestamp")), "links")
    missing = [_refused(rows, wanted, F.col(i).isNull(), f"{i} not found") for i in ids[:1]]
    missing.append(_refused(rows, wanted, F.col(ids[0]).isNotNull() & F.col(ids[1]).isNull(), f"{ids[1]} not found"))
    found = rows.where(F.col(ids[0]).isNotNull() & F.col(ids[1]).isNotNull())
    return _inserted(target, found, ids, None, union_all(missing).distinct())


def insert_actors(actors: DataFrame, batch: DataFrame, loaded_at) -> Loaded:
    rows = batch.withColumn("last_update", F.lit(loaded_at).cast("timestamp"))
    return _inserted(actors, rows, ("first_name", "last_name"), "actor_id")


def insert_copies(inventory: DataFrame, films: DataFrame, stores: DataFrame, titles: DataFrame, loaded_at) -> Loaded:
    """One copy per title in the first store, unless it has one. Unknown titles are refused, and all without a store."""
    rows = titles.join(films.select("film_id", "title"), "title", "left").withColumns(
        {
            "store_id": stores.agg(F.min("store_id")).scalar(),
            "last_update": F.lit(loaded_at).cast("timestamp"),
        }
    )
    rows = stage(rows, "copies")
    no_film, no_store = F.col("film_id").isNull(), F.col("store_id").isNull()
    rejected = _refused(rows, titles, no_film, "title not found").unionByName(
        _refused(rows, titles, ~no_film & no_store, "no store")
    )
    return _inserted(inventory, rows.where(~no_film & ~no_store), ("store_id", "film_id"), "inventory_id", rejected)


def insert_rentals(
    rentals: DataFrame,
    inventory: DataFrame,
    films: DataFrame,
    staff: DataFrame,
    customer: DataFrame,
    batch: DataFrame,
    loaded_at,
) -> Loaded:
    """Rentals of titles by one customer, served by the first employee of the first store concerned.

    ``customer`` holds at most one row; more than one is an error when the job runs. Titles without a copy are
    refused, and all where there is no customer or no employee.
    """
    titled = films.select("film_id", "title").join(batch.select("title").distinct(), "title", "left_semi")
    copies = inventory.select("inventory_id", "store_id", "film_id").join(titled, "film_id")
    first_store = copies.agg(F.min("store_id").alias("store_id"))
    one_values = {
        "customer_id": customer.select("customer_id").scalar(),
        "staff_id": staff.join(first_store, "store_id").agg(F.min("staff_id")).scalar(),
        "last_update": F.lit(loaded_at).cast("timestamp"),
    }
    rows = stage(batch.join(copies, "title", "left").withColumns(one_values), "rentals")
    no_copy, no_one = F.col("inventory_id").isNull(), F.col("customer_id").isNull() | F.col("staff_id").isNull()
    rejected = _refused(rows, batch, no_copy, "no copy of the title").unionByName(
        _refused(rows, batch, ~no_copy & no_one, "no customer or no employee")
    )
    match = ("rental_date", "inventory_id", "customer_id")
    return _inserted(rentals, rows.where(~no_copy & ~no_one), match, "rental_id", rejected)


def insert_payments(
    payments: DataFrame, rentals: DataFrame, inventory: DataFrame, films: DataFrame, customer: DataFrame, batch: DataFrame
) -> Loaded:
    """A payment of the rental rate for each of the customer's rentals of the titles; titles never rented are refused."""
    rented = (
        rentals.select("rental_id", "inventory_id", "customer_id", "staff_id")
        .join(customer.select("customer_id"), "customer_id", "left_semi")
        .join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(films.select("film_id", "title", F.col("rental_rate").alias("amount")), "film_id")
    )
    rows = stage(batch.join(rented, "title", "left"), "payments")
    none = F.col("rental_id").isNull()
    rejected = _refused(rows, batch, none, "title not rented by the customer")
    match = ("customer_id", "rental_id", "amount", "payment_date")
    return _inserted(payments, rows.where(~none), match, "payment_id", rejected)


def insert_open_rental(rentals: DataFrame, inventory: DataFrame, staff: DataFrame, customer: DataFrame, now) -> Loaded:
    """Rent the newest copy to a customer, unless they hold it already."""
    moment = F.lit(now).cast("timestamp")
    rows = customer.select("customer_id").withColumns(
        {
            "inventory_id": inventory.agg(F.max("inventory_id")).scalar(),
            "staff_id": staff.agg(F.max("staff_id")).scalar(),
        }
    )
    held = rentals.where(F.col("return_date").isNull())
    fresh = insert_missing(held.select("inventory_id", "customer_id"), rows.drop("staff_id"), ("inventory_id", "customer_id"))
    rows = rows.join(fresh.affected, ["inventory_id", "customer_id"], "left_semi").withColumns(
        {"rental_date": moment, "return_date": F.lit(None).cast("timestamp"), "last_update": moment}
    )
    return _numbered(rentals, rows, "rental_id", ["customer_id"])


def _inserted(
    target: DataFrame, rows: DataFrame, match: Sequence[str], id_column: str | None, rejected: DataFrame | None = None
) -> Loaded:
    if rejected is None:
        rejected = rows.limit(0).withColumn("reject_reason", F.lit(None).cast("string"))
    columns = [c for c in target.columns if c != id_column]
    missing = {c: F.lit(None) for c in columns if c not in rows.columns}
    typed = rows.withColumns(missing).select(*(F.col(c).cast(target.schema[c].dataType) for c in columns))
    present = target.drop(id_column) if id_column else target
    added = insert_missing(present, typed, match).affected
    if id_column is None:
        added = stage(added, "inserted").select(*target.columns)
        return Loaded(target.unionByName(added), added, rejected)
    return _numbered(target, added, id_column, list(match), rejected)


def _numbered(
    target: DataFrame, rows: DataFrame, id_column: str, order: SortKeys, rejected: DataFrame | None = None
) -> Loaded:
    added = assign_ids(rows, target, id_column, order)
    added = added.select(*(F.col(c).cast(target.schema[c].dataType) for c in target.columns))
    return Loaded(target.unionByName(added), added, rows.limit(0) if rejected is None else rejected)


#: Terms of a newly registered film (fixed values).
NEW_FILM_TERMS = {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99"}
DEFAULT_LANGUAGE = "Klingon"


class Registered(NamedTuple):
    films: DataFrame
    languages: DataFrame
    inserted: DataFrame
    rejected: DataFrame


def register_films(
    films: DataFrame,
    languages: DataFrame,
    batch: DataFrame,
    year: int,
    default_language: str = DEFAULT_LANGUAGE,
    registered_at: dt.datetime | None = None,
) -> Registered:
    """Register a batch of (title, release_year, language_name, seq), adding missing languages.

    Titles compare trimmed and case-blind, against the catalogue and inside the
    batch, where the lowest ``seq`` wins. Columns left out of the batch take the
    defaults; a NULL given in the batch is not a default. Of languages whose names differ in case or
    blanks only, the one of the lowest id is taken. New films and languages are stamped with ``registered_at`` (else the time of the job) where their tables
    have a ``last_update``.
    """
    for column, default in (("release_year", F.lit(year)), ("language_name", F.lit(default_language))):
        if column not in batch.columns:
            batch = batch.withColumn(column, default)
    title, language = F.btrim(F.col("title")), F.btrim(F.col("language_name"))
    reason = (
        F.when(F.col("title").isNull(), "the title is missing")
        .when(title == "", "the title is empty")
        .when(F.col("language_name").isNull() | (language == ""), "the language is missing")
    )
    checked = batch.withColumn("reject_reason", reason).withColumn("_title", F.upper(title))
    sound = checked.where(F.col("reject_reason").isNull())
    taken = films.select(folded(F.col("title")).alias("_title")).distinct()
    duplicate = F.format_string("the film %s is there already", title)
    first = first_per_key(sound, ["_title"], ["seq"])
    fresh = stage(first.join(taken, "_title", "left_anti").withColumn("_language", F.upper(language)), "new-films")
    repeats = sound.join(fresh.select("seq"), "seq", "left_anti").withColumn("reject_reason", duplicate)
    rejected = checked.where(F.col("reject_reason").isNotNull()).unionByName(repeats).drop("_title")

    known = languages.select("language_id", folded(F.col("name")).alias("_language"))
    absent = first_per_key(fresh.join(known, "_language", "left_anti"), ["_language"], ["seq"]).select(
        language.alias("name"), "seq"
    )
    added = assign_ids(absent, languages, "language_id", ["seq"]).drop("seq")
    added = added.withColumn("language_id", F.col("language_id").cast(languages.schema["language_id"].dataType))
    stamp = F.current_timestamp() if registered_at is None else F.lit(registered_at).cast("timestamp")
    if "last_update" in languages.columns:
        added = added.withColumn("last_update", stamp.cast(languages.schema["last_update"].dataType))
    all_languages = languages.unionByName(added, allowMissingColumns=True)

    lowest = F.min(F.struct("language_id", "name")).alias("_first")
    ids = all_languages.groupBy(folded(F.col("name")).alias("_language")).agg(lowest)
    ids = stage(ids.select("_language", "_first.language_id", F.col("_first.name").alias("language")), "languages")
    types = {f.name: f.dataType for f in films.schema}
    terms = {c: F.lit(v).cast(types[c]) for c, v in NEW_FILM_TERMS.items()}
    rows = fresh.join(ids, "_language").withColumns({"title": F.col("_title"), **terms})
    if "last_update" in films.columns:
        rows = rows.withColumn("last_update", stamp)
    numbered = assign_ids(rows, films, "film_id", ["seq"])
    shown = ["film_id", "title", "language", "release_year", *NEW_FILM_TERMS]
    stored = numbered.select(*(F.col(c).cast(types[c]) for c in types if c in numbered.columns))
    return Registered(
        films.unionByName(stored, allowMissingColumns=True), all_languages, numbered.select(*shown), rejected
    )
