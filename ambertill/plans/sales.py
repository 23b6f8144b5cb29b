"""Sales-history reports. Each takes a star: the fact joined to the dimensions it names.

All group to report grain before any window runs, so windows see report rows,
not facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

import datetime as dt

from ambertill.functions.calendar import any_of, between_days, in_years, month_bounds, month_of
from ambertill.functions.numbers import as_double, fixed, grouped, money, percent_of, rounded, total, total_of_sums, with_unit
from ambertill.functions.ordering import sort_columns
from ambertill.operators import framing
from ambertill.operators.pivoting import crosstab, sums_when, with_row_total
from ambertill.operators.ranking import top_n_per_group
from ambertill.session import stage


def channel_share_by_year(star: DataFrame, regions: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Share of each channel in its region and year, against the previous period.

    One year more is read to feed the first LAG and dropped after it. The
    previous period is the previous row, which may be older than one year.
    """
    yearly = (
        star.where(F.col("country_region").isin(list(regions)))
        .where(in_years(F.col("time_id"), first_year - 1, last_year))
        .where(F.col("calendar_year").between(first_year - 1, last_year))
        .groupBy("country_region", "calendar_year", "channel_desc")
        .agg(total("amount_sold").alias("amount_sold"))
    )
    whole = Window.partitionBy("country_region", "calendar_year")
    shares = yearly.withColumn("pct_by_channels", percent_of(F.col("amount_sold"), F.sum("amount_sold").over(whole)))
    history = Window.partitionBy("country_region", "channel_desc").orderBy(*sort_columns(["calendar_year"]))
    compared = shares.withColumn("pct_previous_period", F.lag("pct_by_channels").over(history)).withColumn(
        "pct_diff", F.col("pct_by_channels") - F.col("pct_previous_period")
    )
    percent = lambda name: with_unit(fixed(F.col(name), 2), " %")
    return (
        compared.where(F.col("calendar_year").between(first_year, last_year))
        .select(
            "country_region",
            "calendar_year",
            "channel_desc",
            as_double(F.col("amount_sold")).alias("amount_sold"),
            "pct_by_channels",
            "pct_previous_period",
            "pct_diff",
            with_unit(grouped(F.col("amount_sold")), " $").alias("amount_sold_text"),
            percent("pct_by_channels").alias("pct_by_channels_text"),
            percent("pct_previous_period").alias("pct_previous_period_text"),
            percent("pct_diff").alias("pct_diff_text"),
        )
        .orderBy(*sort_columns(["country_region", "calendar_year", "channel_desc"]))
    )


def _average(column: str, window) -> Column:
    return as_double(F.sum(column).over(window)) / F.count(column).over(window)


def weekly_running_sales(star: DataFrame, year: int, first_week: int, last_week: int) -> DataFrame:
    """Sum accumulated within the week, and a centred average that spans weekends.

    Monday looks back over the weekend, Friday ahead over it. One week on each
    side is read so that the first and last day have neighbours.
    """
    # Week n of the calendar year lies within a week of the n-th seven days.
    start = dt.date(year, 1, 1)
    reach = between_days(
        F.col("time_id"),
        max(start, start + dt.timedelta(days=7 * (first_week - 3))),
        min(dt.date(year + 1, 1, 1), start + dt.timedelta(days=7 * (last_week + 2))),
    )
    # Days at either end of the year may count to a week of the year beside it.
    edges = any_of(
        between_days(F.col("time_id"), a, b)
        for a, b in ((start, start + dt.timedelta(days=4)), (dt.date(year, 12, 28), dt.date(year + 1, 1, 1)))
    )
    daily = (
        star.where(reach | edges)
        .where(F.col("calendar_year") == year)
        .where(F.col("calendar_week_number").between(first_week - 1, last_week + 1))
        .groupBy("calendar_week_number", F.col("time_id").cast("date").alias("time_id"), "day_name")
        .agg(total("amount_sold").alias("sales"))
    )
    days = Window.orderBy("time_id")  # at most the days of the weeks asked for
    week = Window.partitionBy("calendar_week_number").orderBy("time_id")
    centred = (
        F.when(F.col("day_name") == "Monday", _average("sales", days.rowsBetween(-2, 1)))
        .when(F.col("day_name") == "Friday", _average("sales", days.rowsBetween(-1, 2)))
        .otherwise(_average("sales", days.rowsBetween(-1, 1)))
    )
    return (
        daily.withColumn("cum_sum", F.sum("sales").over(week.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("centered_3_day_avg", centred)
        .where(F.col("calendar_week_number").between(first_week, last_week))
        .select(
            "calendar_week_number",
            "time_id",
            "day_name",
            as_double(rounded(F.col("sales"), 2)).alias("sales"),
            as_double(rounded(F.col("cum_sum"), 2)).alias("cum_sum"),
            as_double(rounded(F.col("centered_3_day_avg"), 2)).alias("centered_3_day_avg"),
        )
        .orderBy("calendar_week_number", "time_id")
    )


def price_neighbourhoods(star: DataFrame, spread: int = 10) -> DataFrame:
    """Sales of each product beside those of similar prices: within ``spread``
    (RANGE) and in the adjacent price groups (GROUPS).

    The star may hold sums per product. They are stored once; the frames are worked out per distinct price
    in buckets, and joined back by price.
    """
    keys = ["prod_id", "prod_name", "prod_category_desc", "prod_list_price"]
    products = stage(star.groupBy(*keys).agg(total_of_sums("amount_sold").alias("sales")), "product-sales")
    ranked = framing.rank_keys(framing.per_key(products, "prod_list_price", "sales"), "prod_list_price")
    near = framing.range_sums(ranked, "prod_list_price", "sales", spread, spread, "sales_in_price_range")
    framed = framing.groups_sums(near, "sales", 1, 1, "sales_in_price_group").select(
        F.col("prod_list_price").alias("_price"), "sales_in_price_range", "sales_in_price_group"
    )
    joined = products.join(framed, F.col("prod_list_price").eqNullSafe(F.col("_price")))
    return joined.select(
        "prod_id",
        "prod_name",
        "prod_category_desc",
        as_double(F.col("prod_list_price")).alias("prod_list_price"),
        *(
            as_double(rounded(F.col(c), 0)).alias(c)
            for c in ("sales", "sales_in_price_range", "sales_in_price_group")
        ),
    )


def income_band_neighbours(star: DataFrame) -> DataFrame:
    """Sales of each income band with its neighbours; bands are text, so GROUPS."""
    bands = star.where(F.col("cust_income_level").isNotNull()).groupBy("cust_income_level")
    ranked = framing.rank_keys(bands.agg(total_of_sums("amount_sold").alias("sales")), "cust_income_level")
    return framing.groups_sums(ranked, "sales", 1, 1, "sales_in_income_group").select(
        "cust_income_level",
        as_double(rounded(F.col("sales"), 0)).alias("sales"),
        as_double(rounded(F.col("sales_in_income_group"), 0)).alias("sales_in_income_group"),
    )


def sales_around(star: DataFrame, key: str, spread: int, out: str) -> DataFrame:
    """Sales per value of a numeric key (birth year) and within ``spread`` of it."""
    keyed = star.groupBy(key).agg(total_of_sums("amount_sold").alias("sales"))
    return framing.range_sums(keyed, key, "sales", spread, spread, out).select(
        key, as_double(rounded(F.col("sales"), 0)).alias("sales"), as_double(rounded(F.col(out), 0)).alias(out)
    )


def trailing_weeks(star: DataFrame, year: int, weeks: int = 3) -> DataFrame:
    """Average of a week and the ones before it; the year before is read as well.

    Rows are weeks: a week without sales is not filled in.
    """
    weekly = (
        star.where(in_years(F.col("time_id"), year - 1, year, pad_days=7))
        .where(F.col("calendar_year").isin(year - 1, year))
        .groupBy("calendar_year", "calendar_week_number")
        .agg(total("amount_sold").alias("sales"))
    )
    # At most 54 weeks in each of two years.
    window = Window.orderBy("calendar_year", "calendar_week_number").rowsBetween(-(weeks - 1), 0)
    return (
        weekly.withColumn("moving_avg", _average("sales", window))
        .where(F.col("calendar_year") == year)
        .select(
            "calendar_year",
            "calendar_week_number",
            as_double(rounded(F.col("sales"), 0)).alias("sales"),
            as_double(rounded(F.col("moving_avg"), 0)).alias("three_weeks_moving_avg"),
        )
    )


def top_customers_by_channel(star: DataFrame, customer: Sequence[str], n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` customers of each channel with their share of the channel.

    ``customer`` are the columns that identify a customer: by name, namesakes
    count as one. The channel total is a separate aggregate joined to the few
    winners; a window over all customers of a channel would be one task.
    """
    sums = star.groupBy("channel_desc", *customer).agg(total("amount_sold").alias("_sold"))
    winners = top_n_per_group(sums, ["channel_desc"], ["-_sold", *(tiebreak or customer)], n)
    channels = sums.groupBy("channel_desc").agg(F.sum("_sold").alias("_channel"))
    share = percent_of(F.col("_sold"), F.col("_channel"))
    return (
        winners.join(channels, "channel_desc")
        .select(
            "channel_desc",
            *customer,
            as_double(F.col("_sold")).alias("amount_sold"),
            share.alias("sales_percentage"),
            fixed(F.col("_sold"), 2).alias("amount_sold_text"),
            with_unit(fixed(share, 4), "%").alias("sales_percentage_text"),
        )
        # By the number, not by its text.
        .orderBy("channel_desc", F.col("amount_sold").desc())
    )


def _category_region_year(star: DataFrame, category: str, region: str, year: int) -> DataFrame:
    return (
        star.where(in_years(F.col("time_id"), year, year))
        .where(F.col("calendar_year") == year)
        .where(F.col("prod_category").ilike(category) & F.col("country_region").ilike(region))
    )


QUARTERS = {1: "q1", 2: "q2", 3: "q3", 4: "q4"}


def _quarter_report(df: DataFrame, product: str) -> DataFrame:
    columns = [*QUARTERS.values(), "year_sum"]
    return df.select(
        product,
        *(as_double(F.col(c)).alias(c) for c in columns),
        *(fixed(F.col(c), 2).alias(f"{c}_text") for c in columns),
    ).orderBy(F.col("year_sum").desc(), product)


def quarters_by_case(star: DataFrame, product: str, category: str, region: str, year: int) -> DataFrame:
    cases = {name: F.col("calendar_quarter_number") == q for q, name in QUARTERS.items()}
    sums = (
        _category_region_year(star, category, region, year)
        .groupBy(product)
        .agg(*sums_when(cases, money("amount_sold")), total("amount_sold").alias("year_sum"))
    )
    return _quarter_report(sums, product)


def quarters_by_crosstab(star: DataFrame, product: str, category: str, region: str, year: int) -> DataFrame:
    wide = crosstab(
        _category_region_year(star, category, region, year), [product], "calendar_quarter_number", QUARTERS, "amount_sold"
    )
    return _quarter_report(with_row_total(wide, list(QUARTERS.values()), "year_sum"), product)


def always_in_top(
    star: DataFrame, people: DataFrame, years: Sequence[int], n: int, key: str = "cust_id"
) -> DataFrame:
    """Customers among the top ``n`` of a channel in every one of the years.

    Facts are ranked by key alone. After the top ``n`` per channel and year the
    data has at most ``channels x years x n`` rows, and only then are the names
    of ``people`` joined.
    """
    yearly = (
        star.where(any_of(in_years(F.col("time_id"), y, y) for y in sorted(set(years))))
        .where(F.col("calendar_year").isin(list(years)))
        .groupBy("channel_desc", "calendar_year", key)
        .agg(total("amount_sold").alias("amount_sold"))
    )
    top = top_n_per_group(yearly, ["channel_desc", "calendar_year"], ["-amount_sold", key], n)
    return (
        top.groupBy("channel_desc", key)
        .agg(F.countDistinct("calendar_year").alias("_years"), F.sum("amount_sold").alias("_sold"))
        .where(F.col("_years") == len(set(years)))
        .join(people, key)
        .select(
            "channel_desc",
            *people.columns,
            as_double(F.col("_sold")).alias("amount_sold"),
            fixed(F.col("_sold"), 2).alias("amount_sold_text"),
        )
        .orderBy(F.col("amount_sold").desc(), "channel_desc", key)
    )


def _months_regions(star: DataFrame, months: Sequence[str], regions: Mapping[str, str]) -> DataFrame:
    return (
        star.where(any_of(between_days(F.col("time_id"), *month_bounds(month_of(m))) for m in sorted(set(months))))
        .where(F.col("calendar_month_desc").isin(list(months)))
        .where(F.col("country_region").isin(list(regions)))
    )


def regions_side_by_side(star: DataFrame, months: Sequence[str], regions: Mapping[str, str]) -> DataFrame:
    """Month and category with one sum per region; ``regions`` maps region to column."""
    cases = {out: F.col("country_region") == region for region, out in regions.items()}
    keys = ["calendar_month_desc", "prod_category"]
    sums = _months_regions(star, months, regions).groupBy(*keys).agg(*sums_when(cases, money("amount_sold")))
    return sums.select(*keys, *(as_double(F.col(c)).alias(c) for c in cases)).orderBy(*keys)


def regions_side_by_side_windowed(star: DataFrame, months: Sequence[str], regions: Mapping[str, str]) -> DataFrame:
    """The same sums as conditional window sums over regional totals, made distinct."""
    keys = ["calendar_month_desc", "prod_category"]
    regional = (
        _months_regions(star, months, regions)
        .groupBy(*keys, "country_region")
        .agg(total("amount_sold").alias("amount_sold"))
    )
    window = Window.partitionBy(*keys)  # one row per region
    sums = {
        out: F.sum(F.when(F.col("country_region") == region, F.col("amount_sold")).otherwise(F.lit(0))).over(window)
        for region, out in regions.items()
    }
    texts = [fixed(F.col(c), 2).alias(f"{c}_text") for c in sums]
    return (
        regional.withColumns(sums)
        .select(*keys, *(as_double(F.col(c)).alias(c) for c in sums), *texts)
        .distinct()
        .orderBy(*keys)
    )
