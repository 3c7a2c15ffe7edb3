import datetime as dt
import json

import pytest

from millrace import schemas
from millrace.operators import activity

FLAT = schemas.FLAT_EVENT


def nested(type, user, path, id="1", stamp="2024-01-01T00:00:00Z"):
    return (id, type, ("7", path), ("9", user), stamp)


@pytest.fixture
def events(frame):
    return frame(
        [
            ("PushEvent", "ann", "org", "a"),
            ("PushEvent", "ann", "org", "b"),
            ("WatchEvent", "bob", "org", "a"),
            ("PushEvent", "bob", "solo", "x"),
            ("PushEvent", "cid", "org", "a"),
            ("WatchEvent", "cid", "org", "a"),
            ("PushEvent", None, "solo", "x"),
        ],
        FLAT,
    )


def test_flatten(frame, rows):
    archive = frame(
        [nested("A", "u", "o/r"), nested("B", "v", "bare"), nested("C", None, None)],
        schemas.ARCHIVE_EVENT,
    )
    flat = activity.flatten_events(archive)
    assert flat.columns == ["type", "submitter", "owner", "repo"]
    assert rows(flat) == [("A", "u", "o", "r"), ("B", "v", "bare", None), ("C", None, None, None)]


def test_typed_events_tolerates_bad_text(frame):
    archive = frame(
        [nested("A", "u", "o/r", id="12"), nested("B", "v", "bare", id="x", stamp="2024-13-01")],
        schemas.ARCHIVE_EVENT,
    )
    typed = activity.typed_events(archive)
    assert [f.dataType.simpleString() for f in typed.schema] == [
        part.split()[1] for part in schemas.TYPED_EVENT.split(", ")
    ]
    assert typed.columns == [part.split()[0] for part in schemas.TYPED_EVENT.split(", ")]
    good, bad = typed.withColumn("created_at", typed.created_at.cast("timestamp_ntz")).orderBy("event_type").collect()
    assert tuple(good) == ("A", "o/r", "u", "o", "r", dt.datetime(2024, 1, 1), 9, 7, 12)
    assert tuple(bad) == ("B", "bare", "v", "bare", None, None, 9, 7, None)


def test_ids_read_from_numbers_or_text(spark, tmp_path):
    lines = [
        {"id": "5", "type": "A", "repo": {"id": 6, "name": "o/r"}, "actor": {"id": "8", "login": "u"}},
        {"id": 5, "type": "A", "repo": {"id": "6", "name": "o/r"}, "actor": {"id": 8, "login": "u"}},
    ]
    (tmp_path / "e.json").write_text("\n".join(map(json.dumps, lines)))
    archive = spark.read.schema(schemas.ARCHIVE_EVENT).json(str(tmp_path))
    ids = activity.typed_events(archive).select("event_id", "repo_id", "actor_id").distinct()
    assert [tuple(r) for r in ids.collect()] == [(5, 6, 8)]


def test_owners_with_many_repos(events):
    found = activity.owners_with_many_repos(events)
    assert [tuple(r) for r in found.collect()] == [("org", 2)]
    assert activity.owners_with_many_repos(events, 2).count() == 0


def test_submitters_are_split_at_the_threshold(events):
    counts = activity.count_by_submitter(events)
    assert [tuple(r) for r in activity.active_submitters(counts).collect()] == [("ann", 2)]
    rest = [tuple(r) for r in activity.inactive_submitters(counts).collect()]
    assert rest == [(None, 1), ("bob", 1), ("cid", 1)]


def test_members_count_people_once(events):
    found = activity.repos_with_many_members(events, 2)
    assert [tuple(r) for r in found.collect()] == [("org", "a", 3)]
    assert activity.repos_with_many_members(events, 3).count() == 0


def test_distinct_names_of_both_roles(events, rows):
    names = {name for (name,) in rows(activity.distinct_names(events))}
    assert names == {"ann", "bob", "cid", "org", "solo", None}


def test_names_by_class(frame, rows):
    names = frame([("AnnSmith",), ("ann",), ("Ann",), ("BobX",), ("42",), (None,)], "name string")
    lookup = frame([("Ann", "f"), ("Bob", "m"), ("Bob", "z")], "token string, class string")
    found = activity.count_names_by_class(names, lookup)
    assert rows(found) == [("f", 2), ("m", 1), ("unknown", 3)]
