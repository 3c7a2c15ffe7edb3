"""Trade surveillance over two platforms.

*Trades* carry their open and close time in one row, identified by a ticket. *Deals* are
single steps of a position: ``entry`` 0 opens it, ``entry`` 1 closes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import micros_between, seconds_between, tumbling_index
from millrace.functions.times import MICROS
from millrace.plans.pairing import differing_pairs
from millrace.plans.skew import join_group_stats

OPEN, CLOSE = 0, 1


def all_logins(deals: DataFrame, trades: DataFrame) -> DataFrame:
    """Logins of both platforms, each once, ascending."""
    both = deals.select("login").union(trades.select("login"))
    return both.distinct().orderBy(F.asc_nulls_last("login"))


def marked_keys(marks: DataFrame, key: str, flags: str = "type") -> DataFrame:
    """Keys marked to be skipped: the lowest bit of the flags is set. A key may come several times."""
    return marks.where(F.col(flags).bitwiseAND(1) == 1).select(key)


def drop_marked(rows: DataFrame, marks: DataFrame, key: str, flags: str = "type") -> DataFrame:
    """Rows whose key is not marked."""
    return rows.join(marked_keys(marks, key, flags), key, "left_anti").select(*rows.columns)


def open_deals(deals: DataFrame) -> DataFrame:
    """Opening deals in the shape of trades: action as cmd, time as open_time."""
    return deals.where(F.col("entry") == OPEN).select(
        "login", "positionid", F.col("action").alias("cmd"), F.col("time").alias("open_time")
    )


def short_trades(trades: DataFrame, n: int = 60) -> DataFrame:
    """Trades closed less than n seconds after opening, also those closed before it."""
    lasted = micros_between(F.col("open_time"), F.col("close_time"))
    return trades.where(lasted < n * MICROS).select(
        "login", "ticket", seconds_between(F.col("open_time"), F.col("close_time")).alias("diff")
    )


def short_deals(deals: DataFrame, n: int = 60, marks: DataFrame | None = None) -> DataFrame:
    """Opening deals whose position's latest close follows in less than n seconds.

    Deals are summarised per position first: its latest close and its number of opens. Marks
    are applied to that summary, one row per position, instead of to the deals.
    """
    is_open = F.col("entry") == OPEN
    positions = (
        deals.where(F.col("entry").isin(OPEN, CLOSE) & F.col("positionid").isNotNull())
        .groupBy("positionid")
        .agg(
            F.max(F.when(~is_open, F.col("time"))).alias("t2"),
            F.count_if(is_open).alias("_opens"),
        )
        .where(F.col("t2").isNotNull() & (F.col("_opens") > 0))
    )
    if marks is not None:
        positions = drop_marked(positions, marks, "positionid")
    opens = deals.where(is_open & F.col("positionid").isNotNull()).select(
        "login", "positionid", F.col("time").alias("t1")
    )
    paired = join_group_stats(opens, positions, ["positionid"])
    return paired.where(micros_between(F.col("t1"), F.col("t2")) < n * MICROS).select(
        "login", "positionid", "t1", "t2", seconds_between(F.col("t1"), F.col("t2")).alias("diff")
    )


def short_counts(short: DataFrame, id: str) -> DataFrame:
    """Short trades or deals per login."""
    return short.groupBy("login").agg(F.count(id).alias("minute_deals_count"))


def short_counts_all(trade_counts: DataFrame, deal_counts: DataFrame) -> DataFrame:
    """Counts of both platforms as a set: equal rows merge, a login with two counts stays twice."""
    return (
        trade_counts.union(deal_counts)
        .distinct()
        .orderBy(F.desc("minute_deals_count"), F.asc_nulls_last("login"))
    )


def buy_vs_sell_counts(trades: DataFrame, s: int = 30) -> DataFrame:
    """Per login, pairs of its trades with different cmd opened in the same s-second window.

    Our own definition. The pairs are counted, never formed: n trades in a window have
    (n^2 - sum of squares per cmd) / 2 of them. Squares are decimal as they may pass a bigint.
    """
    size = F.col("_n").cast("decimal(19,0)")
    per_cmd = (
        trades.where(F.col("cmd").isNotNull() & F.col("open_time").isNotNull())
        .groupBy("login", tumbling_index(F.col("open_time"), s).alias("time_window"), "cmd")
        .agg(F.count("*").alias("_n"))
    )
    per_window = per_cmd.groupBy("login", "time_window").agg(
        F.sum("_n").cast("decimal(19,0)").alias("_all"), F.sum(size * size).alias("_same")
    )
    pairs = (F.col("_all") * F.col("_all") - F.col("_same")) / 2
    return per_window.groupBy("login").agg(
        F.sum(pairs.cast("decimal(38,0)")).cast("bigint").alias("buy_vs_sell_half_minute_count")
    )


def login_report(logins: DataFrame, short: DataFrame, buy_vs_sell: DataFrame) -> DataFrame:
    """All logins with their short-deal and buy-vs-sell counts; a missing login also matches itself."""

    def attach(report: DataFrame, counts: DataFrame) -> DataFrame:
        other = counts.withColumnRenamed("login", "_login")
        same = F.col("login").eqNullSafe(F.col("_login"))
        return report.join(other, same, "left").drop("_login")

    report = attach(attach(logins.select("login"), short), buy_vs_sell)
    return report.orderBy(F.asc_nulls_last("login"), F.desc("minute_deals_count"))


def windowed(trades: DataFrame, id: str, s: int = 30) -> DataFrame:
    """(login, id, cmd, time_window): trades with the index of their s-second window."""
    return trades.select(
        "login", id, "cmd", tumbling_index(F.col("open_time"), s).alias("time_window")
    )


def _window_users(rows: DataFrame, id: str) -> DataFrame:
    """One row per window and login: trades counted, and the range of their cmd codes.

    The id is the key of a trade and never null, so counting it also counts the rows.
    """
    return rows.groupBy("time_window", "login").agg(
        F.count(id).alias("same_window_count"),
        F.min("cmd").alias("low_cmd"),
        F.max("cmd").alias("high_cmd"),
    )


def same_window_counts(rows: DataFrame, id: str) -> DataFrame:
    """Windowed rows with the number of trades their login has in the window."""
    keys = ["time_window", "login"]
    stats = _window_users(rows, id).select(*keys, "same_window_count")
    return join_group_stats(rows, stats, keys)


def busy_users(rows: DataFrame, id: str, n: int = 10) -> DataFrame:
    """Windowed rows of logins with more than n trades in the window, and how many such logins it has."""
    keys = ["time_window", "login"]
    users = _window_users(rows, id).select(*keys, "same_window_count")
    users = users.where(F.col("same_window_count") > n)
    sizes = users.groupBy("time_window").agg(F.count("*").alias("users_count"))
    sized = join_group_stats(users, sizes, ["time_window"])
    return join_group_stats(rows, sized, keys)


def crowded_windows(busy: DataFrame) -> DataFrame:
    """Rows of windows with at least two busy logins."""
    return busy.where(F.col("users_count") > 1)


def _opposite_users(trades: DataFrame, id: str, s: int, n: int) -> DataFrame:
    """Busy logins of each window, with the range of their cmd codes."""
    return _window_users(windowed(trades, id, s), id).where(
        (F.col("same_window_count") > n) & F.col("low_cmd").isNotNull()
    )


def _opposite(users: DataFrame, block: int | None) -> DataFrame:
    options = {} if block is None else {"block": block}
    return differing_pairs(
        users, group="time_window", member="login", low="low_cmd", high="high_cmd", **options
    )


def opposite_pairs(
    trades: DataFrame, id: str, s: int = 30, n: int = 10, block: int | None = None
) -> DataFrame:
    """Pairs of busy logins (left > right) holding trades of different cmd in one window."""
    return _opposite(_opposite_users(trades, id, s, n), block)


def suspicious_pairs(
    trades: DataFrame, deals: DataFrame, s: int = 30, n: int = 10, block: int | None = None
) -> DataFrame:
    """Opposite pairs of both platforms as one set.

    Even windows are those of trades, odd ones those of deals, so that one search covers both and returns a pair once.
    """
    both = [_opposite_users(trades, "ticket", s, n), _opposite_users(open_deals(deals), "positionid", s, n)]
    apart = [x.withColumn("time_window", F.col("time_window") * 2 + i) for i, x in enumerate(both)]
    return _opposite(apart[0].unionByName(apart[1]), block)
