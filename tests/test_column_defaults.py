"""A column default kept in the catalogue: no file is rewritten."""

import datetime as dt
import hashlib
from pathlib import Path

from ambertill.sources import sinks
from conftest import bag


def test_default_column_leaves_old_files(spark, tmp_path):
    path = tmp_path / "people"
    spark.createDataFrame([(1, "a"), (2, None)], "id long, name string").write.option("path", str(path)).format("parquet").saveAsTable("people_defaults")
    before = {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in path.glob("*.parquet")}
    assert sinks.add_column_with_default(spark, "people_defaults", "record_ts", "DATE", "DATE'2026-01-02'")
    assert not sinks.add_column_with_default(spark, "people_defaults", "record_ts", "DATE", "DATE'1999-01-01'")
    sinks.insert_columns(spark.createDataFrame([(3, "c")], "id long, name string"), "people_defaults")
    sinks.insert_columns(spark.createDataFrame([(4, dt.date(2020, 5, 5))], "id long, record_ts date"), "people_defaults")
    day = dt.date(2026, 1, 2)
    assert bag(spark.table("people_defaults")) == [(1, "a", day), (2, None, day), (3, "c", day), (4, None, dt.date(2020, 5, 5))]
    after = {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in path.glob("*.parquet")}
    assert all(after[name] == digest for name, digest in before.items())
    spark.sql("DROP TABLE people_defaults")
