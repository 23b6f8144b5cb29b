import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ambertill.operators import framing
from ambertill.operators.matching import longest_gap, valid_at, with_next
from ambertill.operators.ordered import number_rows, running
from ambertill.session import scratch_dir
from conftest import bag, plan_of, rows


def test_number_rows_is_dense_and_ordered(spark):
    values = [(random.Random(i).choice([None, *range(40)]), i) for i in range(500)]
    df = spark.createDataFrame(values, "x int, id int")
    found = rows(number_rows(df, ["-x", "id"], "n", start=11).orderBy("n"), "x", "id", "n")
    expected = sorted(values, key=lambda v: (v[0] is not None, -(v[0] or 0), v[1]))
    assert [r[:2] for r in found] == expected
    assert [r[2] for r in found] == list(range(11, 511))


def test_number_rows_of_nothing(spark):
    assert rows(number_rows(spark.createDataFrame([], "x int"), ["x"], "n")) == []


def test_running_values(spark):
    rng = random.Random(5)
    # One key holds most of the rows, so it spans several slices.
    data = [(rng.choice(["hot"] * 6 + ["a", None]), i, rng.choice([None, rng.randint(-9, 9)])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, v int")
    outputs = {"l": ("last", "v"), "m": ("max", "v"), "s": ("sum", "v")}
    found = {r.t: (r.l, r.m, r.s) for r in running(df, ["k"], ["t"], outputs).collect()}
    seen: dict = {}
    for k, t, v in data:
        past = seen.setdefault(k, [])
        if v is not None:
            past.append(v)
        assert found[t] == ((past[-1], max(past), sum(past)) if past else (None, None, None))


@pytest.mark.parametrize("size", [0, 1, 200])
def test_one_type_for_all_sizes(spark, size):
    df = spark.range(size).selectExpr("id % 2 as k", "id as t", "cast(id as decimal(18,2)) as v")
    found = running(df, ["k"], ["t"], {"s": ("sum", "v"), "m": ("max", "v"), "l": ("last", "v")})
    assert dict(found.dtypes) == dict(df.dtypes) | {"s": "decimal(28,2)", "m": "decimal(18,2)", "l": "decimal(18,2)"}
    assert found.count() == size


def brute_force(facts, versions):
    result = {}
    for fid, key, at in facts:
        fits = [
            (start, end or dt.datetime.max, price)
            for vkey, start, end, price in versions
            if key is not None and vkey == key and at is not None and start <= at and (end is None or end >= at)
        ]
        result[fid] = max(fits)[2] if fits else None
    return result


FACTS = "fid int, k string, at timestamp_ntz"
VERSIONS = "k string, s timestamp_ntz, e timestamp_ntz, price int"


@pytest.mark.parametrize("seed", range(3))
def test_valid_at_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2026, 1, 1)
    when = lambda: base + dt.timedelta(hours=rng.randint(0, 400), microseconds=rng.choice([0, 0, 1, 999999]))
    keys = ["hot"] * 5 + ["a", "b", "c"]
    facts = [(i, rng.choice(keys + [None]), rng.choice([when(), when(), when(), None])) for i in range(250)]
    starts = set()
    versions = []
    for price in range(150):
        key, start = rng.choice(keys), when()
        if (key, start) not in starts:
            starts.add((key, start))
            length = rng.choice([0, 1, 5, 50, 300])
            versions.append((key, start, rng.choice([start + dt.timedelta(hours=length)] * 5 + [None]), price))
    found = valid_at(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["k"], "at", "s", "e", ["price"]
    )
    assert {r.fid: r.price for r in found.collect()} == brute_force(facts, versions)


def test_valid_at_ends_are_inclusive_and_gaps_are_empty(spark):
    day = lambda d: dt.date(2026, 1, d)
    versions = spark.createDataFrame([("a", day(1), day(5), 10), ("a", day(8), None, 20)], "k string, s date, e date, price int")
    facts = spark.createDataFrame([(d, "a", day(d)) for d in (1, 5, 6, 8, 30)], "fid int, k string, at date")
    found = valid_at(facts, versions, ["k"], "at", "s", "e", ["price"])
    assert bag(found, "fid", "price") == bag(spark.createDataFrame([(1, 10), (5, 10), (6, None), (8, 20), (30, 20)], "a int, b int"))


def test_older_version_that_outlives_a_newer_one(spark):
    t = lambda h: dt.datetime(2026, 1, 1, h)
    versions = spark.createDataFrame([("a", t(0), None, 1), ("a", t(2), t(3), 2), ("a", t(4), t(5), 3)], VERSIONS)
    facts = spark.createDataFrame([(h, "a", t(h)) for h in range(8)], FACTS)
    found = valid_at(facts, versions, ["k"], "at", "s", "e", ["price"])
    assert [p for _, p in sorted(rows(found, "fid", "price"))] == [1, 1, 2, 2, 3, 3, 1, 1]


@pytest.mark.parametrize("step", [dt.timedelta(days=1), dt.timedelta(minutes=7), dt.timedelta(milliseconds=3)])
def test_coarse_facts_against_fine_versions_before_and_after_1970(spark, step):
    rng = random.Random(3)
    base = dt.datetime(1969, 12, 31, 12) - 20 * step if step.days == 0 else dt.datetime(1969, 12, 12)
    facts = [(i, "a", base + i * step) for i in range(40)]
    versions = []
    for price in range(25):
        start = base + rng.random() * 40 * step
        versions.append(("a", start, start + rng.choice([1, 3, 25]) * step * rng.random(), price))
    versions.append(("a", base + 3 * step, base + 9 * step, 99))  # ends that fall on a fact
    found = valid_at(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["k"], "at", "s", "e", ["price"]
    )
    assert {r.fid: r.price for r in found.collect()} == brute_force(facts, versions)


def test_valid_at_never_pairs_facts_with_versions(spark):
    facts = spark.createDataFrame([(1, "a", dt.datetime(2026, 1, 1))], FACTS)
    versions = spark.createDataFrame([("a", dt.datetime(2025, 1, 1), None, 1)], VERSIONS)
    plan = plan_of(valid_at(facts, versions, ["k"], "at", "s", "e", ["price"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_frames_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    keys = sorted(rng.sample(range(-300, 300), 80))
    data = [(k, rng.randint(1, 99)) for k in keys for _ in range(rng.randint(1, 3))] + [(None, 5), (None, 6)]
    df = spark.createDataFrame(data, "k int, v long")
    keyed = framing.per_key(df, "k", "v")
    total = {k: sum(v for kk, v in data if kk == k) for k in {k for k, _ in data}}
    near = {r.k: r.o for r in framing.range_sums(keyed, "k", "v", 7, 3, "o").collect()}
    assert near == {
        k: 11 if k is None else sum(v for kk, v in total.items() if kk is not None and k - 7 <= kk <= k + 3) for k in total
    }
    order = [*keys, None]
    framed = {r.k: r.o for r in framing.groups_sums(framing.rank_keys(keyed, "k"), "v", 2, 1, "o").collect()}
    assert framed == {k: sum(total[x] for x in order[max(i - 2, 0) : i + 2]) for i, k in enumerate(order)}


def test_groups_frame_on_text_and_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(framing, "RANKS_PER_BUCKET", 3)
    df = spark.createDataFrame([(c, 1) for c in "hgfedcba"], "k string, v long")
    found = dict(rows(framing.groups_sums(framing.rank_keys(df, "k"), "v", 1, 1, "o"), "k", "o"))
    assert found == {c: 2 if c in "ah" else 3 for c in "abcdefgh"}


def test_range_frame_on_decimal_prices(spark):
    df = spark.createDataFrame([("7.99", 1), ("17.99", 2), ("18.00", 4), ("45.50", 8)], "p string, v long")
    keyed = df.withColumn("p", F.col("p").cast("decimal(10,2)"))
    found = {str(k): o for k, o in rows(framing.range_sums(keyed, "p", "v", 10, 10, "o"), "p", "o")}
    assert found == {"7.99": 3, "17.99": 7, "18.00": 6, "45.50": 8}


def test_gaps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("a", 5), ("b", 2), ("c", 1), ("c", 9)], "k string, y int")
    assert bag(longest_gap(df, ["k"], "y", "gap")) == [("a", 3), ("c", 8)]
    assert bag(with_next(df, ["k"], "y", "n"))[:2] == [("a", 1, 4), ("a", 4, 5)]


def test_scratch_folder_comes_from_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return "/shared/place/" if key == "spark.checkpoint.dir" else default

    class OnCluster:
        conf = Conf()

    assert scratch_dir(OnCluster()) == "/shared/place"
    assert scratch_dir(spark)


def test_a_cluster_without_shared_folder_is_refused():
    class Nothing:
        def get(self, key, default=None):
            return default

    class Unset:
        conf = Nothing()
        sparkContext = type("Context", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Unset())


def _next_brute(data):
    out = {}
    for k, v in set(data):
        larger = [w for kk, w in data if kk == k and v is not None and w is not None and w > v]
        out[(k, v)] = min(larger) if larger else None
    return sorted(((k, v, n) for (k, v), n in out.items()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_next_distinct_across_slices(spark, seed):
    from ambertill.operators.ordered import next_distinct

    draw = random.Random(seed)
    # one key holds most rows, so it runs over many slices
    data = [(draw.choice([1, 1, 1, 1, 2, 3, None]), draw.choice([None, *range(40)])) for _ in range(400)]
    df = spark.createDataFrame(data, "k long, v long")
    got = sorted(rows(next_distinct(df, ["k"], "v", "nxt")), key=repr)
    assert got == _next_brute(data)


def test_next_distinct_sorts_once(spark):
    from ambertill.operators.ordered import bucketed_slices, SLICE
    from pyspark.sql import Window

    df = spark.range(300).selectExpr("id % 3 AS k", "id AS v")
    sliced = bucketed_slices(df, [F.col("k"), F.col("v")])
    within = Window.partitionBy(SLICE).orderBy("k", "v")
    plan = plan_of(sliced.select(SLICE, "k", "v").distinct().select("k", F.lead("v").over(within)))
    assert "Exchange" not in plan


def test_with_next_keeps_its_rows(spark):
    data = [(1, 3), (1, 3), (1, 5), (2, None), (None, 4), (None, 9), (1, None)]
    df = spark.createDataFrame(data, "k long, v long")
    assert sorted(rows(with_next(df, ["k"], "v", "nxt")), key=repr) == _next_brute(data)
