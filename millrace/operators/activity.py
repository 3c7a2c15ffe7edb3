"""Activity reports over an event archive, and the typed form of its events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import archive_stamp, first_name_token, path_part


def flatten_events(archive: DataFrame) -> DataFrame:
    """Nested events to (type, submitter, owner, repo); a part the repo path lacks is null."""
    path = F.col("repo.name")
    return archive.select(
        "type",
        F.col("actor.login").alias("submitter"),
        path_part(path, 0).alias("owner"),
        path_part(path, 1).alias("repo"),
    )


def typed_events(archive: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested events to nine typed columns and those to ``keep``; text that does not parse becomes null."""
    path = F.col("repo.name")
    return archive.select(
        F.col("type").alias("event_type"),
        path.alias("repo"),
        F.col("actor.login").alias("actor_name"),
        path_part(path, 0).alias("owner"),
        path_part(path, 1).alias("repo_name"),
        archive_stamp(F.col("created_at")).alias("created_at"),
        F.col("actor.id").try_cast("bigint").alias("actor_id"),
        F.col("repo.id").try_cast("bigint").alias("repo_id"),
        F.col("id").try_cast("bigint").alias("event_id"),
        *keep,
    )


def _ranked(counts: DataFrame, keep: Column, *names: str) -> DataFrame:
    return counts.where(keep).orderBy(F.desc("count"), *names)


def owners_with_many_repos(events: DataFrame, n: int = 1) -> DataFrame:
    """Owners with more than n different repos."""
    repos = events.select("owner", "repo").distinct()
    return _ranked(repos.groupBy("owner").count(), F.col("count") > n, "owner")


def repos_with_many_members(events: DataFrame, n: int = 10) -> DataFrame:
    """Repos with more than n different submitters."""
    members = events.select("submitter", "owner", "repo").distinct()
    return _ranked(members.groupBy("owner", "repo").count(), F.col("count") > n, "owner", "repo")


def count_by_submitter(events: DataFrame, type: str = "PushEvent") -> DataFrame:
    """Events of one type per submitter."""
    return events.where(F.col("type") == type).groupBy("submitter").count()


def active_submitters(counts: DataFrame, n: int = 1) -> DataFrame:
    """Submitters counted more than n times."""
    return _ranked(counts, F.col("count") > n, "submitter")


def inactive_submitters(counts: DataFrame, n: int = 1) -> DataFrame:
    """Submitters counted at most n times."""
    return _ranked(counts, F.col("count") <= n, "submitter")


def distinct_names(events: DataFrame) -> DataFrame:
    """Owners and submitters together, each name once; both come from a single scan."""
    return events.select(F.explode(F.array("owner", "submitter")).alias("name")).distinct()


def count_names_by_class(
    names: DataFrame, lookup: DataFrame, token: str = "token", label: str = "class"
) -> DataFrame:
    """Names per class, where a dictionary maps the first word of a name to its class.

    Names are counted per word before the dictionary is joined, so a very common first word
    is one row by then. A word listed under several classes takes the least of them.
    """
    words = (
        names.select(first_name_token(F.col("name")).alias(token))
        .groupBy(token)
        .agg(F.count("*").alias("people"))
    )
    classes = lookup.groupBy(token).agg(F.min(label).alias(label))
    return (
        words.join(classes, token, "left")
        .groupBy(F.coalesce(F.col(label), F.lit("unknown")).alias(label))
        .agg(F.sum("people").alias("count"))
    )
