"""Filter interaction audit with wide packed counters.

Five quality filters fail a document or not; applied in a given order, each removes what fails it
and is still there. The audit reports, for every part (a column value), every one of the 120
orders and every step, how many documents stay, go, would have gone (redundant), fail that filter
alone, and how many good or toxic documents go.

Method. A document is reduced to a small *type*: the mask of the filters it fails and its two
labels. Every type maps to one big integer whose fields (one per order, step and count) hold that
type's outcome, 0 or 1, in all 600 steps. Spark counts documents per (part, type) with map-side
partial sums, so a part holding a third of all rows is a few hundred rows after the first stage;
per part, the counts times the packed integers are summed in one task and the sum is unpacked.
A field is as wide as the bit length of the part's document count, so no field can carry into the
next: the unpacked numbers are exact.

Defined cases: null text is empty; null ``lang`` and the empty string are the same part; labels
count when any labels row of the document has quality=1 (good) or toxic=1; a null ``doc_id`` has
no labels and, for E, comes after all ids (it fails E when a row with an id has the same text;
rows that repeat id and text do not fail E because of each other); an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ambertill.session import stage

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELDS = len(ORDERS) * len(FILTERS) * len(COUNTS)
# The filters' word pattern, limits and characters.
_WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 100
DISTINCT_SHARE = 80
UPPER_SHARE = 10
_SYMBOLS = r"[#$%&*|]"
#: A text held by more than this share of all rows is salted before the join to its first id.
HOT_SHARE = 1024


def failures(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """Conditions A to D of one document, in built-in expressions."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(_WORD), 0)
    upper = F.length(body) - F.length(F.regexp_replace(body, "[A-Z]", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(DISTINCT_SHARE) * F.size(words),
        "C": F.lit(100) * upper > F.lit(UPPER_SHARE) * F.length(body),
        "D": body.rlike(_SYMBOLS),
    }


def typed(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text") -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and ``n``: documents counted by type."""
    digest = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)
    conditions = failures(docs, text)
    rows = docs.select(
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"),
        F.col("doc_id").cast("long").alias("_doc"),
        digest.alias("_digest"),
        *(c.alias(f"_{name}") for name, c in conditions.items()),
    )
    later = F.when(F.col("_doc").isNull(), F.col("_first").isNotNull()).otherwise(F.col("_doc") > F.col("_first"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_label_doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("_toxic"),
    )
    joined = _with_first(rows).join(marks, F.col("_doc") == F.col("_label_doc"), "left")
    bits = [F.col(f"_{name}").cast("int") * (1 << i) for i, name in enumerate("ABCD")] + [F.coalesce(later, F.lit(False)).cast("int") * 16]
    mask = bits[0] + bits[1] + bits[2] + bits[3] + bits[4]
    return joined.groupBy(
        F.col("_part").alias("part"), mask.alias("mask"), F.coalesce("_good", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic")
    ).agg(F.count(F.lit(1)).alias("n"))


def _with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_first``: the smallest id of rows with the same ``_digest``.

    The smallest ids are found by a partial aggregate. Texts held by more than 1/``HOT_SHARE`` of
    all rows (at most ``HOT_SHARE`` of them, so their list is small enough to broadcast) are salted:
    their rows are spread over ``spark.sql.shuffle.partitions`` salts and their first id is copied
    to every salt, so that no group of copies reaches the join in one task.
    """
    spark = rows.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = stage(rows.groupBy("_digest").agg(F.min("_doc").alias("_first"), F.count(F.lit(1)).alias("_copies")), "firsts")
    total = firsts.agg(F.sum("_copies")).first()[0] or 0
    limit = max(1, total // HOT_SHARE)
    hot = firsts.where(F.col("_copies") > limit).select(F.col("_digest").alias("_hot_digest"))
    marked = rows.join(F.broadcast(hot), F.col("_digest") == F.col("_hot_digest"), "left")
    salt = F.when(F.col("_hot_digest").isNotNull(), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts))).otherwise(F.lit(0))
    keyed = marked.withColumn("_salt", salt.cast("int")).drop("_hot_digest")
    copies = F.when(F.col("_copies") > limit, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = firsts.select(F.col("_digest").alias("_f_digest"), "_first", F.explode(copies).alias("_f_salt"))
    same = (F.col("_digest") == F.col("_f_digest")) & (F.col("_salt") == F.col("_f_salt"))
    return keyed.join(spread, same).drop("_f_digest", "_f_salt", "_salt")


def outcomes(mask: int, good: int, toxic: int) -> list[int]:
    """0 or 1 for every field: order by order, step by step, the six counts in the order of ``COUNTS``."""
    out = []
    for order in ORDERS:
        gone = False
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            removed = fails and not gone
            gone = gone or fails
            out += [int(not gone), int(removed), int(fails and not removed), int(mask == bit), int(removed and good == 1), int(removed and toxic == 1)]
    return out


def pack(fields: list[int], width: int) -> int:
    """One integer with field ``f`` at bits ``f * width`` and up."""
    return int("".join(format(v, f"0{width}b") for v in reversed(fields)), 2)


def unpack(value: int, width: int, fields: int = FIELDS) -> list[int]:
    digits = format(value, f"0{fields * width}b")
    return [int(digits[len(digits) - (f + 1) * width : len(digits) - f * width], 2) for f in range(fields)]


def _audit_part(frame: pd.DataFrame) -> pd.DataFrame:
    total = int(frame["n"].sum())
    width = max(1, total.bit_length())
    summed = 0
    for mask, good, toxic, n in frame[["mask", "good", "toxic", "n"]].itertuples(index=False):
        summed += int(n) * pack(outcomes(int(mask), int(good), int(toxic)), width)
    values = unpack(summed, width)
    rows, removed = [], {}
    for o, order in enumerate(ORDERS):
        for s, letter in enumerate(order):
            counts = values[(o * len(FILTERS) + s) * len(COUNTS) :][: len(COUNTS)]
            removed[letter] = removed.get(letter, 0) + counts[1]
            rows.append([frame["part"].iloc[0], order, s + 1, letter, *counts])
    table = pd.DataFrame(rows, columns=["part", "filter_order", "step", "filter", *COUNTS])
    table["shapley"] = table["filter"].map(removed)
    return table


SCHEMA = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in (*COUNTS, "shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text") -> DataFrame:
    """600 rows per part: ``part``, ``filter_order``, ``step``, ``filter`` and the counts (see module)."""
    return typed(docs, labels, part, text).groupBy("part").applyInPandas(_audit_part, SCHEMA)
