"""Time the headline queries and the generated-table jobs; prints one JSON line.

``BENCH_SF_DIR`` is the folder of input tables, ``BENCH_CPUS`` the local cores.
The first four entries repeat the published measurements: create a table of
10^7 text rows, delete every third row, truncate, drop.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from ambertill.operators.changes import delete_where
from ambertill.registered import QUERIES
from ambertill.session import build_session, clear_scratch
from ambertill.sources import frames, sinks

HEADLINE = [
    "channel_share_yoy",
    "weekly_cumsum_centered",
    "price_neighbourhoods",
    "segment_groups_sales",
    "weekly_trailing_avg",
    "topn_customers_per_channel",
    "topn_customer_keys_per_channel",
    "quarter_crosstab",
    "cohort_top300_all_years",
    "month_category_regions_case",
    "nation_revenue_since",
    "topn_suppliers_by_parts",
    "top_suppliers_last_part",
    "top5_parts_with_count_ties",
    "longest_order_gap",
    "revenue_by_type_quarter",
    "top_part_per_nation",
    "parts_in_stock",
    "customer_balances",
    "active_customers",
    "asof_price_events",
    "asof_price_events_sliced",
    "interval_price_events",
    "key_resolution",
    "latest_quarter_report_by_nation",
    "insert_ignore",
    "delete_by_semi",
    "update_latest",
    "dense_ids",
    "fk_orphans",
    "rule_violations",
]
GENERATED_ROWS = 10_000_000


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def generated_table_jobs(spark) -> dict[str, float]:
    text = frames.series(spark, 1, GENERATED_ROWS).select(F.concat(F.lit("veeeeeeery_long_string"), F.col("x")).alias("col"))
    number = F.replace("col", F.lit("veeeeeeery_long_string"), F.lit("")).cast("int")
    times = {"create_10m_rows": timed(lambda: sinks.save_table(text, "table_to_delete"))}
    kept = delete_where(spark.table("table_to_delete"), number % 3 == 0).snapshot
    times["delete_third_of_10m"] = timed(lambda: sinks.save_table(kept, "table_after_delete"))
    left = spark.table("table_after_delete").count()
    assert left == GENERATED_ROWS - GENERATED_ROWS // 3, left
    times["truncate_10m"] = timed(lambda: sinks.truncate_table(spark, "table_to_delete"))
    times["drop_table"] = timed(lambda: sinks.drop_table(spark, "table_after_delete"))
    sinks.drop_table(spark, "table_to_delete")
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": "8" if cpus == "*" else cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    consume(QUERIES["table_counts"](spark, folder))  # start the engine
    times = {} if sys.argv[1:] else generated_table_jobs(spark)
    for name in names:
        times[name] = timed(lambda: consume(QUERIES[name](spark, folder)))
    report = {
        "metric": "total time of headline queries and generated-table jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
