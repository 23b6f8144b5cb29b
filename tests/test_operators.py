import datetime as dt

import pytest
from pyspark.sql import functions as F

from ambertill.operators import access, changes, pivoting, quality
from ambertill.operators.matching import Lookup, resolve_keys
from ambertill.operators.ranking import best_with_ties, first_per_key, first_per_known_key, top_n_per_group, top_with_ties
from ambertill.sources import frames, sinks
from conftest import bag, plan_of, rows


@pytest.fixture
def scores(spark):
    data = [("a", 3), ("b", 3), ("c", 2), ("d", 2), ("e", 1), ("f", None)]
    return spark.createDataFrame(data, "id string, n int")


def test_ties_on_the_whole_sort_list(scores):
    # NULL sorts first when descending.
    assert rows(top_with_ties(scores, ["-n"], 2).orderBy("id"), "id") == [("a",), ("b",), ("f",)]
    assert rows(top_with_ties(scores, ["-n", "id"], 2).orderBy("id"), "id") == [("a",), ("f",)]
    assert rows(top_with_ties(scores, ["n"], 2).orderBy("id"), "id") == [("c",), ("d",), ("e",)]


def test_ties_when_fewer_rows_than_asked(scores):
    assert top_with_ties(scores, ["-n"], 50).count() == 6
    assert top_with_ties(scores.limit(0), ["-n"], 5).count() == 0


def test_best_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("y", 4, 1)], "g string, id int, n int")
    assert bag(best_with_ties(df, ["g"], "n"), "id") == [(1,), (2,), (4,)]


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("x", i) for i in range(9)] + [("y", 1)], "g string, v int")
    top = top_n_per_group(df, ["g"], ["-v"], 2)
    assert bag(top, "g", "v") == [("x", 7), ("x", 8), ("y", 1)]
    assert "WindowGroupLimit" in plan_of(top) and "Partial" in plan_of(top)


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "y")], "k int, v string")
    assert bag(first_per_key(df, ["k"], ["v"])) == [(1, "a"), (None, "x")]
    assert bag(first_per_known_key(df, ["k"], ["v"])) == [(1, "a"), (None, "x"), (None, "y")]


def test_crosstab_keeps_missing_as_null_until_filled(spark):
    df = spark.createDataFrame([("p", 1, 2.0), ("p", 1, 3.0), ("q", 4, 1.0)], "r string, c int, m double")
    wide = pivoting.crosstab(df, ["r"], "c", {1: "q1", 4: "q4"}, "m")
    assert [(r, float(a or -1), float(b or -1)) for r, a, b in bag(wide)] == [("p", 5, -1), ("q", -1, 1)]
    filled = pivoting.with_row_total(wide, ["q1", "q4"], "t")
    assert [tuple(map(float, r[1:])) for r in bag(filled)] == [(5, 0, 5), (0, 1, 1)]


def test_counts_when(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    found = df.agg(*pivoting.counts_when({"a": F.col("x") == "a", "z": F.col("x") == "z"})).first()
    assert tuple(found) == (2, 0)


# ------------------------------------------------------------------ changes
@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "id int, v string")


def test_conflict_ignore_drops_repeats_in_the_batch(spark, target):
    batch = spark.createDataFrame([(2, "x"), (3, "b"), (3, "a"), (None, "n"), (None, "m")], "id int, v string")
    change = changes.insert_ignore(target, batch, ["id"], ["v"])
    assert bag(change.affected) == [(3, "a"), (None, "m"), (None, "n")]
    again = changes.insert_ignore(change.snapshot, batch.where("id is not null"), ["id"], ["v"])
    assert again.affected.count() == 0 and again.snapshot.count() == 5


def test_not_exists_keeps_repeats_in_the_batch(spark, target):
    batch = spark.createDataFrame([(2, "x"), (3, "b"), (3, "a")], "id int, v string")
    assert bag(changes.insert_missing(target, batch, ["id"]).affected) == [(3, "a"), (3, "b")]


def test_deletes(spark, target):
    doomed = spark.createDataFrame([(2,), (2,), (9,), (None,)], "k int")
    change = changes.delete_matching(target, doomed, {"id": "k"})
    assert bag(change.snapshot) == [(1, "one")] and bag(change.affected) == [(2, "two")]
    with_null = target.unionByName(spark.createDataFrame([(None, "?")], "id int, v string"))
    change = changes.delete_where(with_null, F.col("id") > 1)
    assert bag(change.snapshot, "v") == [("?",), ("one",)]
    assert changes.truncate(target).count() == 0


def test_delete_every_third_generated_row(spark):
    text = frames.series(spark, 1, 3000).select(F.concat(F.lit("long_string"), F.col("x")).alias("col"))
    number = F.replace("col", F.lit("long_string"), F.lit("")).cast("int")
    change = changes.delete_where(text, number % 3 == 0)
    assert (change.snapshot.count(), change.affected.count()) == (2000, 1000)


def test_update_from_and_latest_open(spark, target):
    change = changes.update_from(
        target, spark.createDataFrame([(2, "new")], "id int, w string"), ["id"], {"v": F.col("_s_w")}
    )
    assert bag(change.snapshot) == [(1, "one"), (2, "new")] and bag(change.affected) == [(2, "new")]
    day = dt.date(2026, 1, 1)
    open_rows = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, "a", day), (4, "b", day), (5, None, None)], "id int, k string, closed date"
    )
    closed = changes.close_latest_open(open_rows.where("k = 'a' or k = 'b'"), ["k"], "id", "closed", {"closed": F.lit("2026-02-02")})
    assert bag(closed.affected, "id", "closed") == [(2, dt.date(2026, 2, 2))]
    assert bag(closed.snapshot, "id", "closed")[0] == (1, None)


def test_patches(spark):
    people = spark.createDataFrame([(1, "A", "x", 7), (2, "B", None, 8)], "id int, name string, mail string, age int")
    patches = spark.createDataFrame(
        [(1, "name", "C", 1), (1, "name", "D", 2), (2, "mail", "m", 3), (1, "mail", None, 4), (1, "age", "9", 5), (7, "name", "Z", 6)],
        "id int, column_name string, new_value string, seq int",
    )
    done = changes.patch_columns(people, patches, "id", ["name", "mail"], "seq")
    assert bag(done.snapshot) == [(1, "D", None, 7), (2, "B", "m", 8)]
    assert bag(done.rejected, "seq", "reject_reason") == [
        (5, "column age may not be changed"),
        (6, "no row has id 7"),
    ]
    assert "id 2: mail is now m" in [r[0] for r in rows(done.messages, "message")]


def test_add_column_once(target):
    added = changes.add_column(target, "d", F.lit(1))
    assert changes.add_column(added, "d", F.lit(2)).select("d").distinct().collect()[0][0] == 1


def test_assigned_ids_go_on_after_the_largest(spark, target):
    rows_ = spark.createDataFrame([("z",), ("y",)], "v string")
    assert bag(changes.assign_ids(rows_, target, "id", ["v"]), "v", "id") == [("y", 3), ("z", 4)]
    assert bag(changes.assign_ids(rows_, target.limit(0), "id", ["v"]), "id") == [(1,), (2,)]


# ------------------------------------------------------------- key lookups
def test_lookups_reject_instead_of_multiplying(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "dup"), (3, "none"), (4, None)], "n int, code string")
    tables = {"t": spark.createDataFrame([(10, "a"), (11, "dup"), (12, "dup")], "id int, code string")}
    good, bad = resolve_keys(batch, tables, [Lookup("tid", "t", "id", {"code": "code"})])
    assert bag(good, "n", "tid") == [(1, 10)]
    assert bag(bad, "n", "reject_reason") == [
        (2, "t ambiguous for code"), (3, "t not found for code"), (4, "t not found for code"),
    ]
    good, bad = resolve_keys(batch, tables, [Lookup("tid", "t", "id", {"code": "code"}, required=False)])
    assert bag(good, "n", "tid") == [(1, 10), (4, None)] and bag(bad, "n") == [(2,), (3,)]


# ------------------------------------------------------------------ audits
def test_audit_rules(spark):
    df = spark.createDataFrame([(1, "#AABBCC"), (1, "red"), (None, None), (None, "x" * 9)], "k int, c string")
    assert bag(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    rules = {"colour": F.col("c").rlike("^#[0-9A-Fa-f]{6}$"), "known": quality.null_rule("k"), "short": quality.length_rule("c", 8)}
    # A rule that is NULL is satisfied.
    assert dict(rows(quality.rule_violations(df, rules))) == {"colour": 2, "known": 2, "short": 1}


def test_orphans_skip_null_and_count_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert bag(quality.orphans(child, parent, {"fk": "id"})) == [(2, 2)]


def test_same_rows_is_a_multiset_test(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    assert quality.same_rows(a, a) and not quality.same_rows(a, a.distinct())


# ------------------------------------------------------------------ access
def test_own_rows_and_their_complement(spark):
    people = spark.createDataFrame([(1, "Ann", "Lee"), (2, "Bo", "Ray")], "id int, first string, last string")
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id int, v string")
    mine = access.owners(people, "client_ann_lee", [(F.col("first"), 2), (F.col("last"), 3)], "id")
    own = access.own_rows(facts, mine, "id")
    assert bag(own, "v") == [("x",)]
    assert bag(access.not_in(facts, mine, "id"), "v") == [("y",)]
    # Inside the filtered view nothing else is left.
    assert access.not_in(own, mine, "id").count() == 0
    nobody = access.owners(people, "client_no_one", [(F.col("first"), 2), (F.col("last"), 3)], "id")
    assert access.own_rows(facts, nobody, "id").count() == 0
    assert access.not_in(facts, nobody, "id").count() == 3
    assert access.not_in(facts, spark.createDataFrame([(1,), (None,)], "id int"), "id").count() == 0
    assert access.visible_columns(people, ["id", "first"]).columns == ["id", "first"]


# ------------------------------------------------------- sources and sinks
def test_sources(spark):
    assert frames.series(spark, 1, 10).count() == 10
    arrays = frames.inline(spark, [(1, ["b", "a"])], "id int, xs array<string>")
    assert bag(frames.unnest_with_position(arrays, "xs", "x", "pos"), "x", "pos") == [("a", 2), ("b", 1)]
    assert bag(frames.unnest(arrays, "xs", "x"), "x") == [("a",), ("b",)]
    view = frames.define_view(spark, "small_view", lambda s: s.range(3))
    assert view.count() == 3 and spark.table("small_view").count() == 3
    assert frames.sample_rows(spark.range(100), 7).count() == 7


def test_sinks(spark, tmp_path):
    made = sinks.create_table_as(spark.range(4), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.create_table_as(made, str(tmp_path / "t"))
    sinks.append_rows(spark.range(2), str(tmp_path / "t"))
    assert frames.read_table(spark, str(tmp_path / "t"), "id bigint").count() == 6
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_snapshot(made, str(tmp_path / "t"))
    written = sinks.write_snapshot(made.withColumn("p", F.col("id") % 2), str(tmp_path / "s"), ("p",))
    assert written.columns == ["id", "p"] and written.count() == 4
    sinks.save_table(spark.range(3), "kept_rows")
    sinks.truncate_table(spark, "kept_rows")
    assert spark.table("kept_rows").count() == 0
    sinks.drop_table(spark, "kept_rows")
    assert not spark.catalog.tableExists("kept_rows")


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = sinks.save_table(spark.range(20).withColumn("a", F.lit(1)), "bucketed_a", ("id",), 3)
        b = sinks.save_table(spark.range(20).withColumn("b", F.lit(1)), "bucketed_b", ("id",), 3)
        joined = a.join(b, "id")
        assert "Exchange" not in plan_of(joined) and joined.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        sinks.drop_table(spark, "bucketed_a")
        sinks.drop_table(spark, "bucketed_b")


def test_multiset_checksum_counts_repeats_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (None, 1), (1, None), (2, 2)], "x int, y int")
    assert quality.same_multiset(a, a.orderBy("y", "x").select("y", "x"))
    assert not quality.same_multiset(a, a.distinct().unionByName(a.limit(0)))
    swapped = spark.createDataFrame([(None, 1), (1, None), (None, 1), (2, 2)], "x int, y int")
    assert not quality.same_multiset(a, swapped)  # same values, NULLs in other columns
    b = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 2)], "x int, y int")
    assert not quality.same_multiset(a, b)
    assert bag(quality.differences(a, b)) == sorted([(None, 1, "left"), (1, None, "right")], key=repr)
    empty = a.limit(0)
    assert quality.same_multiset(empty, empty) and tuple(quality.checksum(empty).first()) == (0, 0, 0)


def test_multiset_checksum_sends_no_rows(spark):
    a = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(4)
    plan = quality.checksum(a)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert all("SinglePartition" in line or "RoundRobinPartitioning" in line for line in exchanges)
    assert "HashAggregate" in plan


def test_lookup_reads_only_the_batch_keys(spark, tmp_path):
    from ambertill.operators.matching import Lookup, _within_batch, resolve_keys

    path = str(tmp_path / "parent")
    spark.range(1000).selectExpr("id AS pid", "concat('code', id) AS code", "id % 10 AS grp").write.parquet(path)
    parent = spark.read.parquet(path)
    batch = spark.createDataFrame([(7, "code7"), (9, "code9"), (9, "code9"), (None, None), (3, "nope")], "n long, code string")
    narrowed = _within_batch(parent, batch, {"code": "code"})
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(code,code7)" in plan and "LessThanOrEqual(code,nope)" in plan
    assert sorted(r.pid for r in narrowed.collect()) == [7, 9]
    good, bad = resolve_keys(batch, {"parent": parent}, [Lookup("pid", "parent", "pid", {"code": "code"})])
    assert bag(good, "n", "pid") == [(7, 7), (9, 9), (9, 9)]
    assert bag(bad, "n", "reject_reason") == sorted([(None, "parent not found for code"), (3, "parent not found for code")], key=repr)


def test_lookup_compares_only_a_larger_table_with_the_batch(spark, monkeypatch):
    from ambertill.operators import matching

    narrowed, plainly = [], matching._within_batch
    monkeypatch.setattr(matching, "_within_batch", lambda table, batch, on: narrowed.append(tuple(on)) or plainly(table, batch, on))
    large = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "z"), (6, "y")], "lid int, code string")
    small = spark.createDataFrame([(7, "p"), (8, "q"), (9, "q"), (10, None), (11, "u")], "sid int, place string")
    batch = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "a", "q"), (4, None, "p"), (5, "a", None)], "n int, code string, place string")
    lookups = [Lookup("lid", "large", "lid", {"code": "code"}), Lookup("sid", "small", "sid", {"place": "place"})]
    good, bad = resolve_keys(batch, {"large": large, "small": small}, lookups)
    assert bag(good, "n", "lid", "sid") == [(1, 1, 7)]
    assert bag(bad, "n", "reject_reason") == [
        (2, "large ambiguous for code"), (3, "small ambiguous for place"), (4, "large not found for code"), (5, "small not found for place"),
    ]
    assert narrowed == [("code",)]
