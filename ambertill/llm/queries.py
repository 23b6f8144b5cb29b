"""One registered query for each operator: the whole table, production parameters, the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ambertill.llm import bpe_stream, decontamination, filter_audit, orchard, fingerprints, html_text, language, lm_scoring, mixing, sharding, simhash, substring_dedup, suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def registered(name: str, oracle: str | None = None):
    def wrap(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return wrap


@registered(
    "op1_substring_dedup",
    r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), starts AS (
        SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS s FROM texts)
    ), again AS (
        SELECT k FROM starts GROUP BY k HAVING count(*) > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS w FROM starts JOIN again USING (k)
    ), words AS (
        SELECT doc_id, unnest(range(1, len(ws) + 1)) AS w, unnest(ws) AS word FROM texts
    ), kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY w) AS text
        FROM words ANTI JOIN gone USING (doc_id, w) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@registered("op9_suffix_array_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated_bytes(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@registered("op10_simhash")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@registered(
    "op2_decontamination",
    rf"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format("text")}, ''), '{_LETTERS}') AS ws FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(coalesce({_LOWER.format("text")}, ''), '{_LETTERS}') AS ws FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') AS k
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM items WHERE len(ws) > 0)
    ), sizes AS (
        SELECT DISTINCT n FROM windows
    ), starts AS (
        SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS k
        FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS s FROM texts, sizes)
    ), found AS (
        SELECT doc_id, item_id, n, s FROM starts JOIN windows USING (n, k)
    ), hit AS (
        SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS w FROM found) GROUP BY doc_id
    ), listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@registered(
    "op3_mixing",
    r"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), sources AS (
        SELECT source, source_size, 3 * source_size AS cap,
               1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
        FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
    ), lists AS (
        SELECT list(cap) AS caps, list(weight) AS weights, CAST(sum(source_size) AS BIGINT) AS total FROM sources
    ), levels AS (
        SELECT 0 AS k, CAST(0 AS DOUBLE) AS level, caps, weights, total FROM lists
        UNION ALL
        SELECT k + 1,
               (total - list_sum(list_transform(range(1, len(caps) + 1), lambda i: CASE WHEN caps[i] < weights[i] * level THEN caps[i] ELSE 0 END)))
               / list_sum(list_transform(range(1, len(caps) + 1), lambda i: CASE WHEN caps[i] < weights[i] * level THEN 0 ELSE weights[i] END)),
               caps, weights, total
        FROM levels WHERE k < 50
    ), shares AS (
        SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT max(level) FROM levels)) AS target FROM sources
    ), rates AS (
        SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM shares
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(size * (floor(rate) + CASE WHEN
             CAST('0x' || substr(md5('20:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < rate - floor(rate)
             THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
    """,
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.repetitions(table(spark, folder, "documents"))
    return mix.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).cast("long").alias("taken")
    )


@registered("op6_sharding")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.sharded(table(spark, folder, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@registered("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = language.remainder(3) == 1
    found = language.predict(docs, language.train(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@registered("op5_lm_scoring")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"))


@registered("op8_fingerprints")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(table(spark, folder, "documents"))


@registered("op4_html_extraction")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@registered("op11_bpe")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe_stream.tokenized(table(spark, folder, "documents"))
    return coded.select(F.col("_row.doc_id").alias("doc_id"), *bpe_stream.digests(F.col("ids"), F.col("decoded")))


@registered("op12_orchard_kmeans")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = orchard.clustered(table(spark, folder, "embeddings"))
    return found.select(F.col("_row.vec_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@registered(
    "op13_filter_audit",
    r"""
    WITH lab AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
    ), d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), firsts AS (
        SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
    ), m AS (
        SELECT d.part,
               (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END)
             + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 10 * length(d.t) THEN 4 ELSE 0 END)
             + (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END)
             + (CASE WHEN (d.doc_id IS NULL AND f.first_id IS NOT NULL) OR d.doc_id > f.first_id THEN 16 ELSE 0 END) AS mask,
               coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic
        FROM d JOIN firsts f ON d.t = f.t LEFT JOIN lab ON d.doc_id = lab.doc_id
    ), types AS (
        SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY part, mask, good, toxic
    ), letters AS (
        SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
    ), orders AS (
        SELECT a.l || b.l || c.l || d.l || e.l AS o
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l
    ), steps AS (
        SELECT o, s, substr(o, s, 1) AS f, CAST(1 << (ascii(substr(o, s, 1)) - 65) AS INTEGER) AS fbit,
               CAST(coalesce(list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(substr(o, i, 1)) - 65))), 0) AS INTEGER) AS before
        FROM orders, range(1, 6) r(s)
    ), outcome AS (
        SELECT t.part, st.o, st.s, st.f, t.n, t.good, t.toxic,
               (t.mask & st.before) <> 0 AS gone, (t.mask & st.fbit) <> 0 AS fails, t.mask = st.fbit AS alone
        FROM types t JOIN steps st ON true
    ), counted AS (
        SELECT part, o, s, f,
               sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN NOT gone AND fails AND good = 1 THEN n ELSE 0 END) AS good_lost,
               sum(CASE WHEN NOT gone AND fails AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
        FROM outcome GROUP BY part, o, s, f
    )
    SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, f AS filter,
           CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM counted
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
