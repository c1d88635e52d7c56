"""Per-user velocity and anomaly features.

Each transaction gets trailing counts and sums over its user's transactions (one
hour, one day, seven days; bounds and equal times included) and the ratio of its
amount to the user's running average.

A user with a bounded number of rows is handled by window functions over one
shuffle. A hot user is not: its rows are first summed per second, trailing values
are running sums over blocks of the clock, and running totals are computed over
ranges (see ``skew``). Both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmill import functions as fn
from cardmill.operators.skew import HOT_ROWS, RANGE_ROWS, hot_keys, running_totals
from cardmill.schemas import STAGING, conform

# Trailing windows in seconds.
HOUR, DAY, WEEK = 3_600, 86_400, 604_800

LOOKBACK_DAYS = 7

COUNT_FRAMES = {"txn_count_last_1h": HOUR, "txn_count_last_24h": DAY, "txn_count_last_7d": WEEK}
SUM_FRAMES = {"amount_sum_last_1h": HOUR, "amount_sum_last_24h": DAY}

_ROW_ORDER = ["_second", "transaction_id"]


def _trailing(window, count: Column, total: Column) -> dict[str, Column]:
    """Trailing counts and sums, given per-row count and amount columns."""
    return {
        **{name: F.sum(count).over(window.rangeBetween(-s, 0)) for name, s in COUNT_FRAMES.items()},
        **{name: F.sum(total).over(window.rangeBetween(-s, 0)) for name, s in SUM_FRAMES.items()},
    }


def _bounded_users(txns: DataFrame) -> DataFrame:
    """One shuffle and one sort: the row order also serves the windows over seconds.

    A moving frame costs its length per row, which is why only users with few rows come here.
    """
    user = Window.partitionBy("user_id")
    rows = user.orderBy(*_ROW_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    running = txns.withColumns(
        {"running_sum": F.sum("amount").over(rows), "running_count": F.count("amount").over(rows)}
    )
    one = F.when(F.col("transaction_id").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return running.withColumns(_trailing(user.orderBy("_second"), one, F.col("amount")))


def _velocity_per_second(txns: DataFrame) -> DataFrame:
    """Trailing counts and sums per (user, second), in time that grows with the seconds only.

    Every second enters once and leaves each trailing window again: one row adds
    its transactions at its own time, one row per window takes them away when the
    window has passed. Plain running sums over these rows are the trailing values;
    a moving frame would add up its whole content for every row.

    A second belongs to a seven-day block of the clock and also enters the next
    block, so a task needs no more than two blocks of seconds for one user,
    however many transactions the user has.
    """
    seconds = txns.groupBy("user_id", "_second").agg(
        F.count("transaction_id").alias("_rows"),
        F.count("amount").alias("_amounts"),
        F.coalesce(F.sum("amount"), F.lit(0).cast("decimal(28,2)")).alias("_total"),
    )
    lengths = sorted({*COUNT_FRAMES.values(), *SUM_FRAMES.values()})
    second, block, leaves = F.col("_second"), F.col("_block"), F.col("_leaves")
    own = F.floor(second / F.lit(WEEK)).cast("bigint")
    moves = (
        seconds.withColumn("_block", F.explode(F.array(own, own + 1)))
        # 0 enters; a length leaves the windows of that length.
        .withColumn("_leaves", F.explode(F.array(F.lit(0), *map(F.lit, lengths))))
        .withColumn("_at", F.when(leaves == 0, second).otherwise(second + leaves + 1))
        .filter(F.col("_at") < (block + 1) * WEEK)
    )
    window = Window.partitionBy("user_id", "_block").orderBy("_at")

    def present(name: str, length: int) -> Column:
        value = F.col(name)
        return F.sum(F.when(leaves == 0, value).when(leaves == length, -value)).over(window)

    trailing = {name: present("_rows", s) for name, s in COUNT_FRAMES.items()}
    trailing |= {name: present("_total", s) for name, s in SUM_FRAMES.items()}
    trailing |= {f"_known_{name}": present("_amounts", s) for name, s in SUM_FRAMES.items()}
    entered = moves.withColumns(trailing).filter((leaves == 0) & (block == own))
    return entered.select(
        "user_id",
        "_second",
        *COUNT_FRAMES,
        *(F.when(F.col(f"_known_{name}") > 0, F.col(name)).alias(name) for name in SUM_FRAMES),
    )


def _hot_users(txns: DataFrame, rows: int, range_rows: int) -> DataFrame:
    running = running_totals(txns, "user_id", _ROW_ORDER, "amount", rows, range_rows)
    return running.join(_velocity_per_second(txns), ["user_id", "_second"], "left")


def velocity(
    txns: DataFrame,
    opening: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add trailing counts and sums, ``user_avg_amount`` and the ratio to it.

    ``txns`` needs ``user_id`` (not NULL), a unique ``transaction_id``,
    ``transaction_date`` and decimal ``amount``. ``opening`` holds each user's
    earlier totals (``user_id, amount_sum, amount_count``) when ``txns`` does
    not reach back to the user's first transaction; further columns of it say
    for which rows of the user.
    """
    timed = txns.withColumn("_second", fn.event_second(F.col("transaction_date")))
    hot, rows = hot_keys(timed, "user_id", hot_rows)
    if hot is None:
        featured = _bounded_users(timed)
    else:
        bounded = _bounded_users(timed.join(hot, "user_id", "left_anti"))
        split = _hot_users(timed.join(hot, "user_id", "left_semi"), rows, range_rows)
        featured = bounded.unionByName(split)

    total, count = F.col("running_sum"), F.col("running_count")
    if opening is not None:
        featured = featured.join(opening, [c for c in opening.columns if c not in ("amount_sum", "amount_count")], "left")
        total = F.coalesce(total + F.col("amount_sum"), total, F.col("amount_sum"))
        count = count + F.coalesce("amount_count", F.lit(0))
    average = F.try_divide(total.cast("double"), count.cast("double"))
    ratio = F.when(F.col("user_avg_amount") > 0, F.col("amount").cast("double") / F.col("user_avg_amount"))
    return (
        featured.withColumn("user_avg_amount", average)
        .withColumns({"amount_vs_user_avg_ratio": ratio, **{c: F.col(c).cast("double") for c in SUM_FRAMES}})
        .drop("_second", "running_sum", "running_count", "amount_sum", "amount_count")
    )


def add_time_and_place_flags(txns: DataFrame) -> DataFrame:
    ts = F.col("transaction_date")
    return txns.withColumns(
        {
            "is_night_txn": fn.is_night(ts),
            "is_weekend": fn.is_weekend(ts),
            "is_foreign_merchant": fn.foreign_state(F.col("merchant_state")),
        }
    )


def fraud_features(txns: DataFrame, opening: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Feature table of all given (valid) transactions."""
    return conform(add_time_and_place_flags(velocity(txns, opening, hot_rows)), STAGING["features"])


def in_days(first: date, last: date) -> Column:
    """Days from ``first`` to ``last``: whole years between them, months at the ends, days in those months."""
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    after = (year > first.year) | (year == first.year) & ((month > first.month) | (month == first.month) & (day >= first.day))
    before = (year < last.year) | (year == last.year) & ((month < last.month) | (month == last.month) & (day <= last.day))
    return after & before


def between_days(df: DataFrame, first: date, last: date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``."""
    return df.filter(in_days(first, last))


def spans(days: Iterable[date], back: int = 0) -> list[tuple[date, date]]:
    """The days, each with ``back`` days before it, as runs of days that neither touch nor overlap, in order."""
    runs: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        first = day - timedelta(days=back)
        if runs and first <= runs[-1][1] + timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((first, day))
    return runs


def in_spans(runs: Sequence[tuple[date, date]]) -> Column:
    """Rows of the runs, by conditions on the partition columns alone."""
    return reduce(or_, (in_days(first, last) for first, last in runs), F.lit(False))


def on_days(df: DataFrame, days: Iterable[date]) -> DataFrame:
    return df.filter(in_spans(spans(days)))


def daily_features(
    txns: DataFrame, target: date, opening: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Features of one day, computed from that day and the seven days before it.

    Without ``opening`` the running average covers those eight days only; with
    the totals of ``amounts_before`` it covers the user's whole history.
    """
    window = between_days(txns, target - timedelta(days=LOOKBACK_DAYS), target)
    return between_days(fraud_features(window, opening, hot_rows), target, target)


def daily_amounts(txns: DataFrame) -> DataFrame:
    """Amount total and count per user and day: the state from which a day's opening totals are read."""
    return txns.groupBy("user_id", "year", "month", "day").agg(
        F.sum("amount").alias("amount_sum"), F.count("amount").alias("amount_count")
    )


def amounts_before(daily: DataFrame, target: date) -> DataFrame:
    """Each user's amount total and count before the lookback of ``target`` starts."""
    start = target - timedelta(days=LOOKBACK_DAYS)
    earlier = between_days(daily, date.min, start - timedelta(days=1))
    return earlier.groupBy("user_id").agg(
        F.sum("amount_sum").alias("amount_sum"), F.sum("amount_count").alias("amount_count")
    )


def amounts_between(daily: DataFrame, runs: Sequence[tuple[date, date]]) -> DataFrame:
    """For each user and run of days: amount total and count of all earlier days that lie in no run.

    Days of one user are summed by the run they come before; a running sum over the runs, of which there are at most as
    many as a user has, then counts every day once. A sum holds up to the user's next one.
    """
    day, starts = F.make_date("year", "month", "day"), F.array(*(F.lit(first) for first, _ in runs))
    outside = daily.filter(~in_spans(runs) & (day < F.lit(runs[-1][0])))
    before = outside.withColumn("_run", F.size(F.filter(starts, lambda s: s <= day)))
    steps = before.groupBy("user_id", "_run").agg(F.sum("amount_sum").alias("amount_sum"), F.sum("amount_count").alias("amount_count"))
    order = Window.partitionBy("user_id").orderBy("_run")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    totals = steps.select(
        "user_id",
        F.col("_run").alias("_from"),
        (F.lead("_run", 1, len(runs)).over(order) - 1).alias("_to"),
        *(F.sum(c).over(so_far).alias(c) for c in ("amount_sum", "amount_count")),
    )
    return totals.select("user_id", F.explode(F.sequence("_from", "_to")).alias("_run"), "amount_sum", "amount_count")


def features_on_days(txns: DataFrame, days: Sequence[date], daily: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Features of any number of days in one pass over them and their lookbacks.

    Lookbacks that overlap are read once. With the totals of ``daily_amounts`` the running average covers each user's
    whole history: rows between two runs of days are not read but added from those totals.
    """
    runs = spans(days, LOOKBACK_DAYS)
    if not runs:
        return fraud_features(txns.filter(F.lit(False)))
    calendar = txns.sparkSession.createDataFrame(
        [(d.year, d.month, d.day, i) for i, run in enumerate(runs) for d in _each_day(*run)], "year int, month int, day int, _run int"
    )
    window = txns.filter(in_spans(runs)).join(calendar, ["year", "month", "day"])
    opening = None if daily is None else amounts_between(daily, runs)
    return on_days(fraud_features(window, opening, hot_rows), days)


def _each_day(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]
