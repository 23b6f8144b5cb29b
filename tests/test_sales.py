"""Reports on a hand-made star: namesakes, a missing year, a missing day, NULL keys, equal prices."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ambertill.functions.calendar import calendar_columns
from ambertill.plans import sales
from ambertill.sources.sales_history import SCHEMAS, SalesHistory
from conftest import bag, plan_of, rows

D = dt.date


@pytest.fixture(scope="module")
def history(spark):
    make = lambda name, data: spark.createDataFrame(data, SCHEMAS[name])
    facts = [
        # cust, channel, day, product, amount
        (1, 1, D(1998, 3, 1), 1, "100.00"),
        (1, 1, D(1999, 3, 1), 1, "60.00"),
        (2, 2, D(1999, 4, 1), 2, "40.00"),
        (1, 1, D(2001, 5, 1), 1, "30.00"),  # channel 1 has no sale in 2000
        (2, 2, D(2000, 5, 1), 2, "10.00"),
        (2, 2, D(2001, 5, 1), 3, "70.00"),
        (3, 1, D(2000, 1, 15), 4, "25.50"),
        (3, 1, D(2000, 2, 15), 3, "4.50"),
        (4, 2, D(2000, 3, 15), 3, "1.00"),
    ]
    facts = [(*f[:4], Decimal(f[4])) for f in facts]
    days = spark.createDataFrame(
        [(D(1998, 1, 1) + dt.timedelta(days=i),) for i in range(4 * 366)], "time_id date"
    )
    times = calendar_columns(days, "time_id").drop("calendar_week_year")
    return SalesHistory(
        {
            "sales": make("sales", facts),
            "customers": make(
                "customers",
                [(1, 1, "Ann", "Lee", "B: 2", 1950), (2, 1, "Ann", "Lee", "A: 1", 1965), (3, 2, "Bo", "Ray", None, 1990), (4, 2, "Cy", "Fox", "D: 9", 1980)],
            ),
            "countries": make("countries", [(1, "Europe"), (2, "Americas")]),
            "channels": make("channels", [(1, "Direct"), (2, "Web")]),
            "times": times,
            "products": make(
                "products",
                [(1, "P1", "Photo", "photo", Decimal("10.00")), (2, "P2", "Photo", "photo", Decimal("10.00")), (3, "P3", "Other", "other", Decimal("25.00")), (4, "P4", "photo", "x", None)],
            ),
        }
    )


def test_share_uses_the_previous_row_even_over_a_missing_year(history):
    star = history.star("customers", "countries", "channels", "times")
    found = {
        (r.calendar_year, r.channel_desc): r
        for r in sales.channel_share_by_year(star, ["Europe"], 1999, 2001).collect()
    }
    assert found[1999, "Direct"].pct_by_channels_text == "60.00 %"
    assert found[1999, "Direct"].pct_previous_period_text == "100.00 %"
    assert found[1999, "Direct"].pct_diff_text == "-40.00 %"
    assert found[1999, "Web"].pct_previous_period_text is None
    assert found[1999, "Web"].amount_sold_text == "40 $"
    assert found[2001, "Direct"].pct_previous_period_text == "60.00 %"  # from 1999
    assert (1998, "Direct") not in found


def test_namesakes_count_as_one_by_name_and_as_two_by_key(history):
    star = history.star("customers", "channels")
    names = ["cust_last_name", "cust_first_name"]
    by_name = bag(sales.top_customers_by_channel(star, names, 5), "channel_desc", "cust_last_name", "amount_sold_text")
    assert ("Direct", "Lee", "190.00") in by_name
    both = star.withColumn("channel_desc", F.lit("all"))
    assert ("Lee", "310.00") in bag(sales.top_customers_by_channel(both, names, 1), "cust_last_name", "amount_sold_text")
    by_key = sales.top_customers_by_channel(both, ["cust_id", *names], 2)
    assert rows(by_key, "cust_id", "amount_sold_text", "sales_percentage_text") == [(1, "190.00", "55.7185%"), (2, "120.00", "35.1906%")]


def test_price_frames_with_equal_and_unknown_prices(history):
    found = {r.prod_id: r for r in sales.price_neighbourhoods(history.star("products")).collect()}
    # Price 10.00 sells 190 + 50, price 25.00 sells 75.50, the unknown price 25.50.
    assert (found[1].sales_in_price_range, found[1].sales_in_price_group) == (240.0, 316.0)
    assert (found[2].sales_in_price_range, found[3].sales_in_price_range) == (240.0, 76.0)
    # 25.00 has two neighbours, 10.00 and NULL; NULL is a peer group of its own.
    assert found[3].sales_in_price_group == 341.0
    assert (found[4].sales_in_price_range, found[4].sales_in_price_group) == (26.0, 101.0)


def test_income_bands_skip_null(history):
    found = bag(sales.income_band_neighbours(history.star("customers")))
    assert found == [("A: 1", 120.0, 310.0), ("B: 2", 190.0, 311.0), ("D: 9", 1.0, 191.0)]


def test_birth_years(history):
    found = dict(rows(sales.sales_around(history.star("customers"), "cust_year_of_birth", 20, "near"), "cust_year_of_birth", "near"))
    assert found == {1950: 310.0, 1965: 311.0, 1980: 151.0, 1990: 31.0}


def test_quarters_two_ways(history):
    star = history.star("products", "customers", "countries", "times")
    case = sales.quarters_by_case(star, "prod_name", "PHOTO", "americas", 2000)
    cross = sales.quarters_by_crosstab(star, "prod_name", "photo", "Americas", 2000)
    assert rows(case) == rows(cross)
    assert rows(case, "prod_name", "q1_text", "q2_text", "year_sum_text") == [("P4", "25.50", "0.00", "25.50")]


def test_regions_two_ways(history):
    star = history.star("products", "customers", "countries", "times")
    months, regions = ["2000-01", "2000-02", "2000-03"], {"Americas": "americas_sales", "Europe": "europe_sales"}
    case = sales.regions_side_by_side(star, months, regions)
    window = sales.regions_side_by_side_windowed(star, months, regions)
    assert rows(case) == rows(window, *case.columns)
    assert rows(case)[0] == ("2000-01", "photo", 25.5, 0.0)


def test_always_in_top(history):
    people = history.tables["customers"].select("cust_id", "cust_last_name", "cust_first_name")
    found = sales.always_in_top(history.star("channels", "times"), people, (1998, 1999, 2001), 300)
    assert rows(found, "channel_desc", "cust_id", "amount_sold_text") == [("Direct", 1, "190.00")]


def test_weekly_frames_are_rows_not_days(spark):
    # Week 49 of 1999 starts on Monday 6 December; the 8th has no sale.
    amounts = {D(1999, 12, d): Decimal(a) for d, a in [(4, 1), (5, 2), (6, 4), (7, 8), (9, 16), (10, 32), (11, 64), (12, 128), (13, 256)]}
    base = spark.createDataFrame([(k, v) for k, v in amounts.items()], "time_id date, amount_sold decimal(10,2)")
    found = {r.time_id.day: r for r in sales.weekly_running_sales(calendar_columns(base, "time_id"), 1999, 49, 49).collect()}
    assert sorted(found) == [6, 7, 9, 10, 11, 12]
    assert found[6].centered_3_day_avg == 3.75  # Monday: Saturday to Tuesday
    assert found[9].centered_3_day_avg == 18.67  # the day before is the 7th
    assert found[10].centered_3_day_avg == 60.0  # Friday: Thursday to Sunday
    assert found[12].centered_3_day_avg == 149.33  # reaches into week 50
    assert [found[d].cum_sum for d in (6, 7, 9)] == [4.0, 12.0, 28.0]


def test_trailing_weeks_look_back_into_the_year_before(spark):
    data = [(D(1999, 12, 20), 3), (D(1999, 12, 27), 6), (D(2000, 1, 3), 9), (D(2000, 1, 10), 30)]
    base = calendar_columns(spark.createDataFrame(data, "time_id date, amount_sold int"), "time_id")
    found = rows(sales.trailing_weeks(base, 2000), "calendar_week_number", "three_weeks_moving_avg")
    assert sorted(found) == [(1, 6.0), (2, 15.0)]


def test_top_n_plan(history):
    plan = plan_of(sales.top_customers_by_channel(history.star("customers", "channels"), ["cust_id"], 5))
    assert "WindowGroupLimit" in plan and "SinglePartition" not in plan.split("+- AQEShuffleRead")[0]
