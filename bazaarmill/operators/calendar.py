"""Rule-driven business calendar and "next suitable day" lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

MonthDays = tuple[int, int, int]  # month, first day, last day


@dataclass(frozen=True)
class CalendarRules:
    """Which days are closed, busy or on sale. Dates are ISO text; windows repeat each year."""

    opening: str | None = None
    closed_weekdays: tuple[int, ...] = (1,)  # 1 = Sunday
    closed_dates: tuple[tuple[str, str], ...] = ()
    closed_windows: tuple[MonthDays, ...] = ()
    payday_from: int | None = 25
    peak_windows: tuple[MonthDays, ...] = ()
    sale_windows: tuple[MonthDays, ...] = ()


# Opening date, closures, peak seasons and sale weeks of the 2024 trading year.
PEAKS = ((12, 1, 31), (4, 15, 28), (7, 15, 31), (8, 1, 31), (9, 1, 10), (1, 8, 20), (9, 5, 20))
SALES = ((2, 5, 25), (6, 3, 23), (11, 4, 24))
YEAR_2024 = CalendarRules(
    opening="2024-01-04",
    closed_dates=(("2024-03-29", "2024-03-29"), ("2024-04-01", "2024-04-01"), ("2024-12-25", "2024-12-27")),
    peak_windows=PEAKS,
    sale_windows=SALES,
)
# The same trading rules without dates that belong to one year.
EVERY_YEAR = CalendarRules(closed_windows=((12, 25, 27),), peak_windows=PEAKS, sale_windows=SALES)


# The flags are SQL text over the column full_date: one parsed expression each, instead of hundreds of
# small column objects for every calendar that a query needs.


def _any(conditions: list[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions) or "false"


def _in_windows(windows: tuple[MonthDays, ...]) -> str:
    return _any([f"month(full_date) = {m} AND day(full_date) BETWEEN {a} AND {b}" for m, a, b in windows])


def store_open(rules: CalendarRules) -> str:
    closed = [f"dayofweek(full_date) = {d}" for d in rules.closed_weekdays]
    if rules.opening:
        closed.append(f"full_date < DATE '{rules.opening}'")
    closed += [f"full_date BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in rules.closed_dates]
    return f"NOT ({_any([*closed, _in_windows(rules.closed_windows)])})"


def peak_period(rules: CalendarRules) -> str:
    payday = [f"day(full_date) >= {rules.payday_from}"] if rules.payday_from else []
    return _any([*payday, _in_windows(rules.peak_windows)])


def sale_period(rules: CalendarRules) -> str:
    return _in_windows(rules.sale_windows)


def with_attributes(days: DataFrame, rules: CalendarRules) -> DataFrame:
    """Fifteen calendar attributes for a table that has one ``full_date`` per row."""
    return days.selectExpr(
        "CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INT) AS date_key",
        "full_date",
        "year(full_date) AS year",
        "month(full_date) AS month",
        "date_format(full_date, 'MMMM') AS month_name",
        "quarter(full_date) AS quarter",
        # week 1 holds January 1, weeks start on Sunday
        "CAST(ceil((dayofyear(full_date) + dayofweek(trunc(full_date, 'YEAR')) - 1) / 7) AS INT) AS week_of_year",
        "dayofweek(full_date) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "dayofweek(full_date) IN (1, 7) AS is_weekend",
        f"{store_open(rules)} AS is_open",
        f"{peak_period(rules)} AS is_peak",
        f"{sale_period(rules)} AS is_sale",
        "year(full_date) AS fiscal_year",
        "month(full_date) AS fiscal_month",
    )


def _spine(bounds: DataFrame) -> DataFrame:
    """One row per day, opened year by year.

    Dates have years 1 to 9999, so a calendar never has more than 3.7 million rows, whatever the data.
    """
    years = bounds.select("first_day", "last_day", F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("_year"))
    start, end = (F.make_date("_year", F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    return years.select(F.explode(F.sequence(F.greatest(start, "first_day"), F.least(end, "last_day"))).alias("full_date"))


def calendar(
    spark: SparkSession, start: str, end: str, rules: CalendarRules = YEAR_2024
) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return with_attributes(_spine(bounds), rules)


def calendar_for(df: DataFrame, date_col: str, rules: CalendarRules) -> DataFrame:
    """Calendar of all full years that the data touches."""
    bounds = df.agg(
        F.trunc(F.min(date_col), "YEAR").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(F.max(date_col), "YEAR"), 12), 1).alias("last_day"),
    )
    return with_attributes(_spine(bounds), rules)


def next_days(cal: DataFrame, flag: str, name: str) -> DataFrame:
    """For each day, the first day on or after it where the flag holds (null when there is none).

    Found inside each year; a day with none left in its year gets the first one of a later year. Only the
    years, at most 9999, meet in one window.
    """
    hit, year = F.when(F.col(flag), F.col("full_date")), F.year("full_date")
    within = W.partitionBy(year).orderBy("full_date").rowsBetween(W.currentRow, W.unboundedFollowing)
    later = W.orderBy("_year").rowsBetween(1, W.unboundedFollowing)
    firsts = cal.groupBy(year.alias("_year")).agg(F.min(hit).alias("_first")).select("_year", F.min("_first").over(later).alias("_later"))
    days = cal.select(F.col("full_date").alias("_from"), year.alias("_in"), F.min(hit).over(within).alias("_here"))
    return days.join(firsts, F.col("_in") == F.col("_year")).select("_from", F.coalesce("_here", "_later").alias(name))


def next_date(
    df: DataFrame,
    date_col: str,
    cal: DataFrame,
    flag: str = "is_open",
    name: str = "next_date",
    upper: Column | None = None,
) -> DataFrame:
    """Forward as-of join as a plain equi-join: the lookup is precomputed per calendar day.

    The lookup is broadcast: two dates for each day of a calendar, so at most 3.7 million rows (60 MB).

    ``upper`` drops matches after that date; rows keep a null then.
    """
    found = df.join(F.broadcast(next_days(cal, flag, name)), F.col(date_col) == F.col("_from"), "left").drop("_from")
    if upper is not None:
        found = found.withColumn(name, F.when(F.col(name) <= upper, F.col(name)))
    return found


def numbered_open_days(cal: DataFrame, by: list[str]) -> DataFrame:
    """Open days with their position inside the group and the group's size, for index picks."""
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    return cal.filter("is_open").withColumns(
        {
            "day_index": (F.row_number().over(w.orderBy("full_date")) - 1).cast("bigint"),
            "day_count": F.count(F.lit(1)).over(w),
        }
    )
