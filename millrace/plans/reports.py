"""Reports: several results computed from one input and written as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace import schemas
from millrace.operators import activity, trades
from millrace.sources.writers import write_csv


def activity_results(events: DataFrame, members: int = 10, type: str = "PushEvent") -> dict[str, DataFrame]:
    """The activity results over flat events, by name."""
    pushes = activity.count_by_submitter(events, type)
    return {
        "owners_with_many_repos": activity.owners_with_many_repos(events),
        "active_submitters": activity.active_submitters(pushes),
        "inactive_submitters": activity.inactive_submitters(pushes),
        "names": activity.distinct_names(events),
        "repos_with_many_members": activity.repos_with_many_members(events, members),
    }


def activity_report(archive: DataFrame, folder: str, files: int | None = None) -> None:
    """Write the flat events and all activity results below a folder.

    The results are computed from the stored flat events: the archive's JSON is parsed once, each
    result reads only its columns, and a lost executor costs no parsing.
    """
    folder = folder.rstrip("/")
    activity.flatten_events(archive).write.mode("overwrite").parquet(f"{folder}/events")
    events = archive.sparkSession.read.schema(schemas.FLAT_EVENT).parquet(f"{folder}/events")
    for name, result in activity_results(events).items():
        write_csv(result, f"{folder}/{name}", files)


def login_report(
    trade_rows: DataFrame,
    trade_marks: DataFrame,
    deal_rows: DataFrame,
    deal_marks: DataFrame,
    n: int = 60,
    s: int = 30,
) -> DataFrame:
    """Per login of either platform: short deals, and trade pairs of opposite direction."""
    useful = trades.drop_marked(trade_rows, trade_marks, "ticket")
    short = trades.short_counts_all(
        trades.short_counts(trades.short_trades(useful, n), "ticket"),
        trades.short_counts(trades.short_deals(deal_rows, n, deal_marks), "positionid"),
    )
    return trades.login_report(
        trades.all_logins(deal_rows, trade_rows), short, trades.buy_vs_sell_counts(useful, s)
    )
