"""Event type codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored codes of the archive's event types.
EVENT_TYPE_CODES = {
    "CreateEvent": 1,
    "CommitCommentEvent": 2,
    "ReleaseEvent": 3,
    "DeleteEvent": 4,
    "MemberEvent": 5,
    "PullRequestEvent": 6,
    "ForkEvent": 7,
    "IssuesEvent": 8,
    "WatchEvent": 9,
    "IssueCommentEvent": 10,
    "PublicEvent": 11,
    "PushEvent": 12,
    "GollumEvent": 13,
    "PullRequestReviewCommentEvent": 14,
    "PullRequestReviewEvent": 15,
}


def event_type_code(event_type: Column, codes: dict[str, int] | None = None) -> Column:
    """Code of an event type; null for null and for types without a code."""
    pairs = (EVENT_TYPE_CODES if codes is None else codes).items()
    table = F.create_map(*[F.lit(item) for pair in pairs for item in pair])
    return F.try_element_at(table, event_type)
