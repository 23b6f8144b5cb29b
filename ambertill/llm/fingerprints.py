"""Document fingerprints: every shingle hash below a fixed share of all hashes, in built-in expressions only.

A sketch grows with its document, so a short text can be found inside a very long one, and the
sketch of a union is the union of the sketches. With half the share a sketch is a part of the denser one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ambertill.operators.ordered import number_rows
from ambertill.session import stage

SHINGLE = 5
#: One hash in so many is kept.
ONE_IN = 8
_BLANK = "[\\x20\\x09-\\x0D]+"
_LEAST = -(1 << 63)


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sketch(text: Column, shingle: int = SHINGLE, one_in: int = ONE_IN) -> Column:
    """The kept hashes of a text, ascending and distinct.

    Shingles are ``shingle`` consecutive words (runs of other than blanks, unchanged), a shorter text with words is one
    shingle; hashes are signed, so the kept share is the least ``1 / one_in`` of the signed range.
    """
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def all_shingles(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(1), n - shingle + 1), lambda k: F.xxhash64(*(F.element_at(h, k + j) for j in range(shingle))))
        return F.when(n >= shingle, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    # Bound once: an expression that is named twice would be worked out twice.
    shingles = F.element_at(F.transform(F.array(hashed), all_shingles), 1)
    limit = F.lit(_LEAST + (1 << 64) // one_in)
    return F.array_sort(F.array_distinct(F.filter(shingles, lambda h: h < limit)))


def written(kept: Column) -> Column:
    """A sketch as text: sixteen hexadecimal digits for each hash."""
    return F.concat_ws("", F.transform(kept, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))


def containment(a: Column, b: Column, equal: Column) -> Column:
    """How much of the smaller sketch is in the other; 1 for ``equal`` texts, else 0 if one has no hash."""
    least = F.least(F.size(a), F.size(b))
    return F.when(equal, F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / least)


def sketches(docs: DataFrame, **options) -> DataFrame:
    """``doc_id`` and ``sketch`` of every row; null is an empty text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), sketch(_text(), **options).alias("sketch"))


def merged(table: DataFrame, *keys: str) -> DataFrame:
    """The sketch of all documents of each group of a table with ``sketch``."""
    hashes = table.select(*keys, F.explode_outer("sketch").alias("hash")).distinct()
    return hashes.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with the text of the next document, as far as an edit needs it, and its sketch.

    Columns: ``doc_id``, ``text``, ``content``, ``n_chars``, ``sketch``, ``prefix``, ``next_content`` and ``next_sketch``. The next document is the one of the next higher id (null first), after the
    last the first. Rows with one id are ordered by a hash of their text, and rows equal in both have the same next
    document.
    """
    # Keys that are never null, so joins need no special case.
    named = F.col("doc_id").isNotNull()
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    content = F.xxhash64(_text())
    order = docs.select(
        named.alias("named"), F.col("doc_id").cast("long").alias("place"), name.alias("name"), content.alias("content"), F.length(_text()).alias("n_chars")
    ).distinct()
    numbered = number_rows(order, ["named", "place", "content"], "number", 0).drop("named", "place")
    total = numbered.count()
    after = numbered.select(
        ((F.col("number") + 1) % max(1, total)).alias("number"), F.col("name").alias("to_name"), F.col("content").alias("to_content"), F.floor(F.col("n_chars") / 2).cast("int").alias("wanted")
    )
    wishes = stage(numbered.select("number", "name", "content").join(after, "number").drop("number"), "wishes")

    # Both joins below use all columns, so that they share one exchange of the texts.
    full = docs.select(name.alias("name"), content.alias("content"), _text().alias("text")).withColumn("sketch", sketch(F.col("text")))
    given = full.join(wishes, ["name", "content"]).select(
        F.col("to_name").alias("name"),
        F.col("to_content").alias("content"),
        F.col("content").alias("next_content"),
        F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("prefix"),
        F.col("sketch").alias("next_sketch"),
    )
    # Rows that repeat an id and a text offer the same.
    once = Window.partitionBy("name", "content").orderBy("name")
    given = given.withColumn("offer", F.row_number().over(once)).where("offer = 1").drop("offer")
    whole = full.join(given, ["name", "content"], "left")
    return whole.withColumns({"n_chars": F.length("text").cast("long"), "doc_id": F.when(F.col("name") != "", F.col("name")).cast("long")})


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they and their neighbours are.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of the
    next document. Null and empty texts have an empty fingerprint; an empty table gives an empty result.
    Other columns than ``doc_id`` and ``text`` are ignored.
    """
    text = F.col("text")
    own = F.substring(text, F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    edited = with_next(docs).withColumn("edited", F.concat(own, F.coalesce("prefix", F.lit(""))))
    both = edited.withColumn("edited_sketch", sketch(F.col("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch"), text == F.col("edited")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch"), F.col("content") == F.col("next_content")).alias("near_next"),
    )
