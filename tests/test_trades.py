import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import trades
from millrace.plans import pairing, reports

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def trade(login, ticket, cmd=0, start=0.0, lasts=10.0):
    return (login, ticket, cmd, at(start), None if lasts is None else at(start + lasts))


def deal(login, position, entry, when, action=0):
    return (login, position, action, entry, at(when))


def test_logins_are_a_sorted_set(frame):
    some = frame([trade(3, 1), trade(1, 2), trade(1, 3), trade(None, 4)], schemas.TRADE)
    other = frame([deal(2, 1, 0, 0), deal(3, 1, 1, 0)], schemas.DEAL)
    assert [r.login for r in trades.all_logins(other, some).collect()] == [1, 2, 3, None]


def test_marked_trades_are_dropped(frame, rows):
    some = frame([trade(1, t) for t in (1, 2, 3, 4, None)], schemas.TRADE)
    marks = frame([(1, 1), (1, 3), (1, 1), (2, 2), (3, 7), (9, 1), (4, None)], schemas.TRADE_MARK)
    kept = trades.drop_marked(some, marks, "ticket")
    assert kept.columns == some.columns
    assert rows(kept.select("ticket")) == [(2,), (4,), (None,)]


def test_short_trades_boundary(frame, rows):
    lasting = [59.999999, 60.0, -5.0, None, 0.0]
    some = frame([trade(1, i, lasts=s) for i, s in enumerate(lasting)], schemas.TRADE)
    assert rows(trades.short_trades(some)) == [(1, 0, 59.999999), (1, 2, -5.0), (1, 4, 0.0)]


DEALS = [
    deal(1, 10, 0, 0), deal(1, 10, 1, 20), deal(1, 10, 1, 59),  # latest close counts
    deal(2, 11, 0, 0), deal(2, 11, 1, 20), deal(2, 11, 1, 60),  # latest close is too late
    deal(3, 12, 0, 0),  # never closed
    deal(4, 13, 1, 5),  # never opened
    deal(5, 14, 0, 30), deal(5, 14, 1, 10),  # closed before it opened
    deal(6, 15, 0, 0), deal(7, 15, 0, 50), deal(6, 15, 1, 70),  # two opens, one in time
    deal(8, None, 0, 0), deal(8, None, 1, 1),  # no position
    deal(9, 16, 0, 0), deal(9, 16, 1, 1),  # marked
    deal(9, 17, 2, 0), deal(9, 17, 1, 1),  # another kind of entry
]


def test_short_deals(frame, rows):
    marks = frame([(16, 1), (10, 2)], schemas.DEAL_MARK)
    found = trades.short_deals(frame(DEALS, schemas.DEAL), marks=marks)
    assert found.columns == ["login", "positionid", "t1", "t2", "diff"]
    assert rows(found.select("login", "positionid", "diff")) == [
        (1, 10, 59.0), (5, 14, -20.0), (7, 15, 20.0),
    ]


def test_short_deals_equals_dropping_marked_deals_first(frame, rows):
    deals, marks = frame(DEALS, schemas.DEAL), frame([(16, 1), (10, 3)], schemas.DEAL_MARK)
    first = trades.short_deals(trades.drop_marked(deals, marks, "positionid"))
    assert rows(first) == rows(trades.short_deals(deals, marks=marks))


def test_equal_counts_merge_and_different_ones_stay(frame):
    ddl = "login bigint, minute_deals_count bigint"
    first, second = frame([(1, 5), (2, 7)], ddl), frame([(1, 5), (2, 3), (3, 7)], ddl)
    found = trades.short_counts_all(first, second).collect()
    assert [tuple(r) for r in found] == [(2, 7), (3, 7), (1, 5), (2, 3)]


def test_login_report(frame):
    logins = frame([(1,), (2,), (3,), (None,)], "login bigint")
    short = frame([(2, 3), (2, 7), (None, 1)], "login bigint, minute_deals_count bigint")
    sides = frame([(1, 4), (2, 9)], "login bigint, buy_vs_sell_half_minute_count bigint")
    found = [tuple(r) for r in trades.login_report(logins, short, sides).collect()]
    assert found == [(1, None, 4), (2, 7, 9), (2, 3, 9), (3, None, None), (None, 1, None)]


def test_buy_vs_sell_counts(frame, rows):
    some = frame(
        [
            trade(1, 1, 0, 0), trade(1, 2, 0, 10), trade(1, 3, 1, 29.9),  # 2 pairs
            trade(1, 4, 0, 30), trade(1, 5, 1, 59), trade(1, 6, 2, 59),  # 3 pairs
            trade(2, 7, 0, 0), trade(2, 8, 0, 1),  # one side only
            trade(3, 9, None, 0), trade(3, 10, 1, 0),  # null matches nothing
        ],
        schemas.TRADE,
    )
    assert rows(trades.buy_vs_sell_counts(some)) == [(1, 5), (2, 0), (3, 0)]


def test_buy_vs_sell_survives_squares_beyond_bigint(spark):
    # Group sizes this large cannot be built from rows, so only the arithmetic is exercised.
    size = F.lit(4_000_000_000).cast("decimal(19,0)")
    assert spark.range(1).select((size * size).alias("v")).first().v == 16 * 10**18


def window_rows(frame):
    data, ticket = [], 0
    for window, login, count in [(0, 1, 10), (0, 2, 11), (0, 3, 12), (1, 2, 11), (2, None, 11), (2, 4, 11)]:
        for i in range(count):
            ticket += 1
            data.append(trade(login, ticket, i % 2, window * 30 + i))
    data.append((5, 999, 0, None, None))
    return frame(data, schemas.TRADE)


def test_window_counts_equal_window_functions(frame, rows):
    some = trades.windowed(window_rows(frame), "ticket")
    per_login = F.count("ticket").over(Window.partitionBy("time_window", "login"))
    plain = some.withColumn("same_window_count", per_login)
    found = trades.same_window_counts(some, "ticket")
    assert found.columns == plain.columns
    assert rows(found) == rows(plain)


def test_busy_users_equal_window_functions(frame, rows):
    some = trades.windowed(window_rows(frame), "ticket")
    per_login = F.count("ticket").over(Window.partitionBy("time_window", "login"))
    kept = some.withColumn("same_window_count", per_login).where("same_window_count > 10")
    # A window holds the null login as one more user.
    users = F.count_distinct("login") + F.max(F.col("login").isNull().cast("int"))
    sizes = kept.groupBy("time_window").agg(users.cast("bigint").alias("users_count"))
    plain = kept.join(sizes, "time_window").select(*kept.columns, "users_count")
    found = trades.busy_users(some, "ticket")
    assert rows(found) == rows(plain)
    assert {r.login for r in found.collect()} == {2, 3, 4, None}  # exactly 10 trades is not busy
    crowded = trades.crowded_windows(found)
    assert {r.time_window - 56802240 * 1 for r in crowded.collect()} == {0, 2}


def literal_pairs(some, s, n):
    rows = trades.windowed(some, "ticket", s)
    per_login = F.count("ticket").over(Window.partitionBy("time_window", "login"))
    busy = rows.withColumn("c", per_login).where(F.col("c") > n)
    a, b = busy.alias("a"), busy.alias("b")
    on = "a.time_window = b.time_window AND a.login > b.login AND a.cmd <> b.cmd"
    return a.join(b, F.expr(on)).select(
        F.col("a.login").alias("left"), F.col("b.login").alias("right")
    ).distinct()


@pytest.mark.parametrize("block", [None, 1, 2, 5])
@pytest.mark.parametrize("share", [0.0, 1.0])
@pytest.mark.parametrize("seed", range(2))
def test_opposite_pairs_equal_the_plain_join(frame, rows, monkeypatch, block, share, seed):
    """Large windows are split whether their sizes are broadcast (share 0) or joined (share 1)."""
    monkeypatch.setattr(pairing, "SPLIT_SHARE", share)
    random.seed(seed)
    data = []
    for ticket in range(600):
        # A third of all trades falls in window 0; some logins keep to one cmd, some are null.
        window = 0 if ticket % 3 == 0 else random.randrange(8)
        login = random.choice([None, *range(40)])
        cmd = random.choice([None, 0, 1, 6]) if (login or 0) % 3 else (login or 0) % 2
        data.append(trade(login, ticket, cmd, window * 30 + random.random() * 29))
    some = frame(data, schemas.TRADE)
    expected = rows(literal_pairs(some, 30, 2))
    assert len(expected) > 20
    assert rows(trades.opposite_pairs(some, "ticket", 30, 2, block=block)) == expected


def test_pairs_need_differing_cmds_and_enough_trades(frame, rows):
    def group(login, count, cmds, start):
        return [
            trade(login, login * 1000 + start * 50 + i, cmds[i % len(cmds)], start) for i in range(count)
        ]

    some = frame(
        [
            *group(1, 11, [0], 0), *group(2, 11, [1], 0),  # opposite
            *group(3, 11, [0], 30), *group(4, 11, [0], 30),  # equal
            *group(5, 11, [0], 60), *group(6, 10, [1], 60),  # 6 is not busy
            *group(7, 11, [0], 90), *group(8, 11, [None], 90),  # null matches nothing
            *group(9, 11, [0, 1], 120), *group(10, 11, [0], 120),  # 9 holds both
        ],
        schemas.TRADE,
    )
    assert rows(trades.opposite_pairs(some, "ticket")) == [(10, 9), (2, 1)]


def test_windows_of_a_single_cmd_are_not_paired(frame):
    """A huge window in which everybody buys must cost nothing."""
    members = frame([(0, i, 1, 1) for i in range(50)], "g bigint, m bigint, low int, high int")
    hot, others = pairing._split_groups(members, "g", "low", "high", block=10)
    assert hot.union(others).count() == 1 and hot.union(others).first()._blocks == 0


def test_every_large_window_is_split_with_the_shipped_share(frame):
    """However many members there are in all: below the share a window is listed too, only not broadcast."""
    rows = [(0, i, i % 2, i % 2) for i in range(300)] + [(1, i, i % 2, i % 2) for i in range(25)]
    members = frame(rows, "g bigint, m bigint, low int, high int")
    for share in (pairing.SPLIT_SHARE, 0.5):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(pairing, "SPLIT_SHARE", share)
            hot, others = pairing._split_groups(members, "g", "low", "high", block=10)
            blocks = {r._group: r._blocks for r in hot.union(others).collect()}
        assert blocks == {0: 30, 1: 3}


def test_suspicious_pairs_are_a_set_over_both_platforms(frame, rows):
    some = frame(
        [trade(login, login * 100 + i, login % 2, 0) for login in (1, 2) for i in range(11)], schemas.TRADE
    )
    both = frame(
        [deal(login, login * 100 + i, entry, 0, login % 2) for login in (1, 2, 4) for i in range(11) for entry in (0, 1)],
        schemas.DEAL,
    )
    assert rows(trades.suspicious_pairs(some, both)) == [(2, 1), (4, 1)]


def test_composed_report_has_one_row_per_login_without_double_counts(frame):
    some = frame([trade(1, 1, 0, 0), trade(1, 2, 1, 1, 100), trade(2, 3)], schemas.TRADE)
    deals = frame(DEALS, schemas.DEAL)
    marks = frame([(3, 1)], schemas.TRADE_MARK)
    none = frame([], schemas.DEAL_MARK)
    report = reports.login_report(some, marks, deals, none)
    found = {tuple(r) for r in report.collect()}
    assert (1, 1, 1) in found and (2, None, None) in found and (9, 1, None) in found


@pytest.mark.parametrize("rows_per_block", [pairing.BLOCK_ROWS, 7])
def test_a_pair_of_many_windows_and_both_platforms_is_returned_once(frame, rows, monkeypatch, rows_per_block):
    monkeypatch.setattr(pairing, "BLOCK_ROWS", rows_per_block)
    some = [trade(x, x * 1000 + w * 10 + i, x % 2, w * 30) for x in range(1, 7) for w in range(5) for i in range(3)]
    both = [deal(x, x * 1000 + i, e, 30, x % 2) for x in range(1, 7) for i in range(3) for e in (0, 1)]
    expected = [(a, b) for a in range(1, 7) for b in range(1, a) if (a - b) % 2]
    for block in (None, 1, 2):
        found = trades.suspicious_pairs(frame(some, schemas.TRADE), frame(both, schemas.DEAL), 30, 2, block=block)
        assert rows(found) == expected
        assert rows(trades.opposite_pairs(frame(some, schemas.TRADE), "ticket", 30, 2, block=block)) == expected


def test_pairs_of_named_members(frame, rows):
    members = frame([(d, m, c, c) for d in ("x", "y") for m, c in (("b", 1), ("é", 2), ("Z", 1), ("z", None))], "g string, m string, low int, high int")
    for block in (1, 100):
        assert rows(pairing.differing_pairs(members, "g", "m", "low", "high", block=block)) == [("é", "Z"), ("é", "b")]
