"""Joins: natural-key lookups, price valid at a time, gaps between events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ambertill.operators.changes import few_copies
from ambertill.operators.ordered import next_distinct, number_rows, running
from ambertill.session import stage


# ---------------------------------------------------------------- key lookups
@dataclass(frozen=True)
class Lookup:
    """Find ``id_column`` of ``table`` by natural key and call it ``out``.

    ``on`` maps columns of the batch (or results of earlier lookups) to columns
    of the table. ``required`` lookups reject the row when nothing is found.
    """

    out: str
    table: str
    id_column: str
    on: Mapping[str, str]
    required: bool = True
    message: str = ""
    fixed: Mapping[str, object] = field(default_factory=dict)

    def reason(self) -> str:
        return self.message or f"{self.table} not found for {', '.join(self.on)}"


def _within_batch(table: DataFrame, batch: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Only the rows of ``table`` whose natural key the batch holds.

    The smallest and largest batch value of every key column (one small aggregate) become range
    filters that reach the table's scan, where Parquet skips row groups by their statistics; a semi
    join with the batch's keys then leaves exactly the rows a lookup can find. The table is no longer
    aggregated whole for a small batch.
    """
    bounds = batch.agg(*(F.min(mine).alias(f"lo{i}") for i, mine in enumerate(on)), *(F.max(mine).alias(f"hi{i}") for i, mine in enumerate(on))).first()
    for i, theirs in enumerate(on.values()):
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if low is None:
            return table.limit(0)
        table = table.where(F.col(theirs).between(F.lit(low), F.lit(high)))
    wanted = few_copies(batch.select(*(F.col(mine).alias(f"_b_{theirs}") for mine, theirs in on.items())), [f"_b_{t}" for t in on.values()])
    same = F.lit(True)
    for theirs in on.values():
        same = same & (F.col(theirs) == F.col(f"_b_{theirs}"))
    return table.join(wanted, same, "left_semi")


def resolve_keys(batch: DataFrame, tables: Mapping[str, DataFrame], lookups: Sequence[Lookup]):
    """Replace natural keys by ids; returns ``(resolved, rejected)``.

    A lookup never multiplies rows: the table is first reduced to one row per
    natural key with a match count, and more than one match is a rejection.
    The first failing lookup, in the order given, names the reason.

    Only table rows whose key the batch holds are read and reduced (``_within_batch``), when the
    lookup's keys are batch columns and the table has more rows than the batch: a smaller one is cheaper to
    reduce whole than to compare with the batch once more. The reduced table is stored before the join. Its size is then known, so
    Spark broadcasts it only when it is small; and otherwise both join inputs
    are plain shuffles, which adaptive execution splits where one code holds
    much of the batch (it cannot split beside an aggregation on the join key).
    """
    current = batch
    reason: Column = F.lit(None).cast("string")
    failures: list[Column] = []
    by_batch = [lookup for lookup in lookups if set(lookup.on) <= set(batch.columns)]
    size = batch.count() if by_batch else 0
    for lookup in lookups:
        table = tables[lookup.table]
        for column, value in lookup.fixed.items():
            table = table.where(F.col(column) == F.lit(value))
        prefix = f"_{lookup.out}_"
        if lookup in by_batch and table.count() > size:
            table = _within_batch(table, batch, lookup.on)
        keys = table.groupBy(*(F.col(c).alias(prefix + c) for c in lookup.on.values())).agg(
            F.min(lookup.id_column).alias(lookup.out), F.count(F.lit(1)).alias(prefix + "matches")
        )
        keys = stage(keys, "lookup")
        same = F.lit(True)
        known = F.lit(True)
        for mine, theirs in lookup.on.items():
            same = same & (F.col(mine) == F.col(prefix + theirs))
            known = known & F.col(mine).isNotNull()
        current = current.join(keys, same, "left")
        missing = F.col(lookup.out).isNull()
        if not lookup.required:
            missing = missing & known
        failures.append(
            F.when(F.col(prefix + "matches") > 1, F.lit(f"{lookup.table} ambiguous for {', '.join(lookup.on)}")).when(
                missing, F.lit(lookup.reason())
            )
        )
    reason = F.coalesce(*failures, reason) if failures else reason
    found = [lookup.out for lookup in lookups]
    checked = current.withColumn("reject_reason", reason).select(*batch.columns, *found, "reject_reason")
    checked = stage(checked, "resolved")  # the good and the refused rows come from one run of the joins
    return (
        checked.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        checked.where(F.col("reject_reason").isNotNull()).select(*batch.columns, "reject_reason"),
    )


# ------------------------------------------------------------ interval lookup
def valid_at(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str | None,
    payload: Sequence[str],
) -> DataFrame:
    """Attach to each fact the version valid at its time; NULL when none is.

    Both interval ends belong to the interval, a NULL end is open, and among
    several valid versions the latest start wins. ``payload`` columns must not
    exist in ``facts``; ``keys`` have the same names on both sides.

    Versions and facts are merged in time order, and each fact takes the last
    version started before it. That is one pass, with no pairs of facts and
    versions; it also carries the latest end so far. Only facts whose version has ended while an
    older one is still open go through the exact interval search of ``_latest_open``.
    """
    time_type = versions.schema[valid_from].dataType
    if time_type.typeName() == "date":
        time_type = T.TimestampType()  # dates are compared as timestamps
    start = F.col(valid_from).cast(time_type)
    end = F.lit(None).cast(time_type) if valid_to is None else F.col(valid_to).cast(time_type)
    version_rows = versions.where(_all_known([*keys, valid_from])).select(
        *keys,
        start.alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(start.alias("start"), end.alias("end"), *payload).alias("_v"),
        F.struct(end.isNull().alias("open"), end.alias("end")).alias("_e"),
    )
    fact_rows = facts.select(
        *facts.columns, F.col(at).cast(time_type).alias("_t"), F.lit(1).alias("_side")
    )
    outputs = {"_latest": ("last", "_v")} | ({} if valid_to is None else {"_open": ("max", "_e")})
    merged = fact_rows.unionByName(version_rows, allowMissingColumns=True)
    scanned = running(merged, keys, ["_t", "_side", "_v"], outputs).where("_side = 1")
    covers = F.col("_latest.end").isNull() | (F.col("_latest.end") >= F.col("_t"))
    current = F.when(F.col("_t").isNotNull() & covers, F.col("_latest"))
    if valid_to is None:
        found = scanned.withColumn("_hit", current)
    else:
        numbered = stage(scanned.withColumn("_fact", F.monotonically_increasing_id()), "valid-at")
        outlived = F.col("_open.open") | (F.col("_open.end") >= F.col("_t"))
        unsettled = numbered.where((F.col("_latest.end") < F.col("_t")) & outlived)
        older = _latest_open(unsettled.select("_fact", *keys, "_t"), version_rows, keys)
        if older is None:
            found = numbered.withColumn("_hit", current)
        else:
            found = numbered.join(older, "_fact", "left").withColumn("_hit", F.coalesce(current, F.col("_older")))
    return found.select(*facts.columns, *(F.col(f"_hit.{c}").alias(c) for c in payload))


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


#: Day, hour, minute, second, millisecond and microsecond, in microseconds.
TIME_UNITS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


def _latest_open(points: DataFrame, versions: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Latest-started version covering each point, by equality joins only.

    Time is cut into blocks of 1, 2, 4, ... units. An interval is the union of
    at most two blocks per size, and a point lies in one block per size, so
    "covers" becomes equality on (key, size, block). Versions are reduced to
    the latest per block before the join: each block matches at most one row,
    however many versions overlap. The unit is the coarsest one all points are
    multiples of, which keeps the number of sizes low. Versions of keys without
    such points, and those that ended before or started after them, are left out first. None without points.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    at = micros(F.col("_t"))
    # One row: the span and the unit decide how many block sizes are needed.
    span = points.agg(F.min(at), F.max(at), *(F.bool_and(at % u == 0) for u in TIME_UNITS)).first()
    if span[0] is None:
        return None
    unit = next(u for u, fits in zip(TIME_UNITS, span[2:]) if fits)
    low, high = span[0] // unit, span[1] // unit
    # Points are whole units, so a start may be rounded up and an end down.
    down = lambda name: F.expr(f"({name} - pmod({name}, {unit})) div {unit}")
    start, end = down("_s") + F.expr(f"int(pmod(_s, {unit}) > 0)"), down("_until")
    sizes = max((high - low).bit_length(), 1) + 1
    size = F.explode(F.sequence(F.lit(0), F.lit(sizes - 1))).alias("_size")

    first = F.expr("shiftright(_a + shiftleft(1L, _size) - 1, _size)")
    last = F.expr("shiftright(_b + 1, _size) - 1")
    asked = points.groupBy(*keys).agg(F.min("_t").alias("_from"), F.max("_t").alias("_upto"))
    asked = stage(asked, "asked")  # sized, and apart from the join, as in resolve_keys
    concerned = versions.join(asked, list(keys)).where("_t <= _upto and (_v.end is null or _v.end >= _from)")
    blocks = (
        concerned.withColumns({"_s": at, "_until": micros(F.col("_v.end"))})
        .withColumn("_a", F.greatest(start - F.lit(low), F.lit(0)))
        .withColumn("_b", F.coalesce(F.least(end, F.lit(high)), F.lit(high)) - F.lit(low))
        .where("_a <= _b")
        .select(*keys, "_v", "_a", "_b", size)
        .select(*keys, "_v", "_size", first.alias("_first"), last.alias("_last"))
        .where("_first <= _last")
        .withColumn(
            "_block",
            F.explode(
                F.array_compact(
                    F.array(F.when(F.col("_first") % 2 == 1, F.col("_first")), F.when(F.col("_last") % 2 == 0, F.col("_last")))
                )
            ),
        )
        .groupBy(*keys, "_size", "_block")
        .agg(F.max("_v").alias("_v"))
    )
    blocks = stage(blocks, "blocks")
    wanted = points.withColumn("_s", at).select("_fact", *keys, (down("_s") - F.lit(low)).alias("_p"), size)
    wanted = wanted.withColumn("_block", F.expr("shiftright(_p, _size)"))
    hits = wanted.join(blocks, [*keys, "_size", "_block"])
    return hits.groupBy("_fact").agg(F.max("_v").alias("_older"))


# ------------------------------------------------------------------------ gaps
def with_next(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Smallest larger value of the same key, over distinct values (NULL comes last and has none).

    Range slices are found once and read back partitioned by slice, so the rows are shuffled once;
    only the first row of each slice is carried to the slice before it (``next_distinct``).
    """
    return next_distinct(df, keys, value, out)


def longest_gap(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Widest step between consecutive values; keys with one value are left out."""
    steps = with_next(df, keys, value, "_next").where(F.col("_next").isNotNull())
    return steps.groupBy(*keys).agg(F.max(F.col("_next") - F.col(value)).alias(out))
