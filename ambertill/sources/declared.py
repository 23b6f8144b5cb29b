"""Declared tables: columns, keys, references and checks, and their audit."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.operators import quality
from ambertill.operators.changes import add_column, union_all
from ambertill.session import stage


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    table: str
    targets: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """``schema`` is a Spark DDL string. ``checks`` are SQL conditions by rule name."""

    name: str
    schema: str
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    required: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    generated: Mapping[str, str] = field(default_factory=dict)

    def rules(self):
        rules = {f"{c} is not null": quality.null_rule(c) for c in (*self.primary_key, *self.required)}
        rules |= {f"{c} within {n} characters": quality.length_rule(c, n) for c, n in self.max_length.items()}
        return rules | {name: F.expr(check) for name, check in self.checks.items()}

    def completed(self, df: DataFrame) -> DataFrame:
        """Fill defaulted columns the batch leaves out, then work out generated ones."""
        df = df.withColumns({c: F.expr(e) for c, e in self.defaults.items() if c not in df.columns})
        return df.withColumns({c: F.expr(e) for c, e in self.generated.items()})


def ref(columns: str, table: str, targets: str | None = None) -> Reference:
    mine = tuple(columns.split())
    return Reference(mine, table, tuple(targets.split()) if targets else mine)


def audit(tables: Mapping[str, Table], data: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule of every table: ``(table_name, rule, violations)``.

    Violations count rows for checks and orphans, and surplus rows for keys.
    """
    parts: list[DataFrame] = []

    def report(table: str, rule: str, counted: DataFrame, expression) -> DataFrame:
        return counted.agg(F.coalesce(expression, F.lit(0)).cast("long").alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
        )

    for name, table in tables.items():
        df = data[name]
        parts.append(
            quality.rule_violations(df, table.rules()).select(F.lit(name).alias("table_name"), "rule", "violations")
        )
        for key in (table.primary_key, *table.unique):
            repeated = quality.duplicate_keys(df, key)
            parts.append(report(name, f"unique ({', '.join(key)})", repeated, F.sum(F.col("row_count") - 1)))
        for r in table.references:
            lost = quality.orphans(df, data[r.table], dict(zip(r.columns, r.targets)))
            parts.append(report(name, f"{', '.join(r.columns)} in {r.table}", lost, F.sum("row_count")))
    return union_all(parts)


def with_load_date(data: Mapping[str, DataFrame], loaded_on, column: str = "record_ts") -> dict[str, DataFrame]:
    """Add the load-date column to every table that lacks it."""
    return {name: add_column(df, column, F.lit(loaded_on).cast("date")) for name, df in data.items()}


def _grouping_id(columns: list[str], chosen: tuple[str, ...]) -> int:
    """Spark's ``grouping_id()`` of a grouping set: a 1 bit for every column left out, the first column highest."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in chosen)


def audit_in_one_pass(tables: Mapping[str, Table], data: Mapping[str, DataFrame]) -> DataFrame:
    """The same rows as ``audit``, reading every table once.

    Each table is expanded once into one row per grouping set it needs (its keys, its own
    references, and the columns other tables refer to) and aggregated once: the count of rows and
    of every rule's violations per group. Key surplus, orphans and rule totals then come from these
    groups, which are written once so that the later steps do not read the table again; orphans
    join groups of the child with groups of the parent, not rows.
    """
    referred = {r.table for t in tables.values() for r in t.references}
    needed: dict[str, list[tuple[str, ...]]] = {name: [] for name in (*tables, *referred)}

    def need(name: str, columns: tuple[str, ...]) -> None:
        if columns not in needed[name]:
            needed[name].append(columns)

    for name, table in tables.items():
        for key in (table.primary_key, *table.unique):
            need(name, key)
        for r in table.references:
            need(name, r.columns)
            need(r.table, r.targets)
    groups, columns = {}, {}
    for name in needed:
        rules = tables[name].rules() if name in tables else {}
        columns[name] = list(dict.fromkeys(c for chosen in needed[name] for c in chosen))
        # The rules are worked out before the grouping, so that the expansion carries flags, not expressions.
        flagged = data[name].select(
            *columns[name], *(F.coalesce(rule == F.lit(False), F.lit(False)).cast("int").alias(f"_bad{i}") for i, rule in enumerate(rules.values()))
        )
        counted = flagged.groupingSets([list(chosen) for chosen in needed[name]], *columns[name]).agg(
            F.grouping_id().alias("_set"),
            F.count(F.lit(1)).alias("_rows"),
            *(F.sum(f"_bad{i}").alias(f"_rule{i}") for i in range(len(rules))),
        )
        groups[name] = stage(counted, f"audit-{name}")

    def of(name: str, chosen: tuple[str, ...]) -> DataFrame:
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in chosen])
        return groups[name].where((F.col("_set") == _grouping_id(columns[name], chosen)) & known)

    def report(table: str, rule: str, counted: DataFrame, expression: Column) -> DataFrame:
        return counted.agg(F.coalesce(expression, F.lit(0)).cast("long").alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
        )

    parts: list[DataFrame] = []
    for name, table in tables.items():
        rules = list(table.rules())
        first = groups[name].where(F.col("_set") == _grouping_id(columns[name], needed[name][0]))
        totals = first.agg(*(F.coalesce(F.sum(f"_rule{i}"), F.lit(0)).cast("long").alias(f"_rule{i}") for i in range(len(rules))))
        pairs = ", ".join(f"'{rule.replace(chr(39), chr(92) + chr(39))}', `_rule{i}`" for i, rule in enumerate(rules))
        if rules:
            parts.append(totals.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)").select(F.lit(name).alias("table_name"), "rule", "violations"))
        for key in (table.primary_key, *table.unique):
            parts.append(report(name, f"unique ({', '.join(key)})", of(name, key).where(F.col("_rows") > 1), F.sum(F.col("_rows") - 1)))
        for r in table.references:
            owners = of(r.table, r.targets).select(*(F.col(theirs).alias(f"_p_{mine}") for mine, theirs in zip(r.columns, r.targets)))
            same = reduce(lambda a, b: a & b, [F.col(mine) == F.col(f"_p_{mine}") for mine in r.columns])
            lost = of(name, r.columns).join(owners, same, "left_anti")
            parts.append(report(name, f"{', '.join(r.columns)} in {r.table}", lost, F.sum("_rows")))
    return union_all(parts)
