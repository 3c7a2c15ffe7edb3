"""Stored tables that change by commits: dimensions, idempotent appends and the landing ledger."""

import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace.sources import commits, dimensions, writers
from millrace.streaming.landing import land_events, taken_files

DDL = "id bigint, v string"


def values(frame, *found):
    return frame([(v, "x") for v in found], "v string, other string")


def test_a_name_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.names(spark, path) == [] and commits.newest(spark, path) == commits.Version(0, {})
    assert commits.contents(spark, path, "a int").count() == 0
    assert commits.publish(spark, path, "x", {"a": 1})
    assert not commits.publish(spark, path, "x", {"a": 2})
    assert commits.content(spark, path, "x") == {"a": 1} and commits.names(spark, path) == ["x"]
    # Writers of one name at the same time: no reader ever finds another's content behind a published one.
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda i: commits.publish(spark, path, f"n{i % 2}", {"a": i}), range(4)))
    assert sum(won) >= 2 and commits.names(spark, path) == ["n0", "n1", "x"]


def test_old_versions_go_with_the_folders_only_they_name(spark, tmp_path):
    path = tmp_path / "t"
    for number, folders in enumerate((["a"], ["a", "b"], ["b", "c"]), 1):
        for folder in [*folders, "unnamed"]:
            (path / folder).mkdir(parents=True, exist_ok=True)
        assert commits.publish_version(spark, str(path), number, {"folders": folders})
    commits.forget_versions(spark, str(path), 3, lambda state: state["folders"])
    assert len(commits.names(spark, str(path))) == 3
    commits.forget_versions(spark, str(path), 1, lambda state: state["folders"])
    assert [p.name for p in sorted(path.iterdir()) if not p.name.startswith("_")] == ["b", "c", "unnamed"]
    assert commits.newest(spark, str(path)) == commits.Version(3, {"folders": ["b", "c"]})


def test_dimension_ids_stay_gapless_over_failed_and_repeated_loads(spark, frame, rows, tmp_path):
    path = str(tmp_path / "dim")
    with pytest.raises(ValueError, match="no dimension"):
        dimensions.read_dimension(spark, path)
    for _ in range(2):
        dimensions.create_dimension(spark, path, DDL)
    assert rows(dimensions.read_dimension(spark, path)) == []
    first = values(frame, "b", "a", None, "b")
    written = []

    def dies(folder):
        written.append(spark.read.parquet(folder).count())
        raise OSError("gone")

    with pytest.raises(OSError, match="gone"):
        dimensions.load_dimension(first, path, "v", "id", before_commit=dies)
    assert written == [2] and rows(dimensions.read_dimension(spark, path)) == [] and dimensions.high_mark(spark, path) == 0
    assert dimensions.load_dimension(first, path, "v", "id") == 2
    assert dimensions.load_dimension(first, path, "v", "id") == 0
    assert dimensions.load_dimension(values(frame, "aa", "b", "c", ""), path, "v", "id") == 3
    assert rows(dimensions.read_dimension(spark, path)) == [(1, "a"), (2, "b"), (3, ""), (4, "aa"), (5, "c")]
    assert dimensions.high_mark(spark, path) == 5
    dimensions.drop_dimension(spark, path)
    dimensions.create_dimension(spark, path, DDL)
    assert rows(dimensions.read_dimension(spark, path)) == []


def test_overlapping_loads_give_no_id_and_no_value_twice(spark, frame, rows, tmp_path):
    path = str(tmp_path / "dim")
    dimensions.create_dimension(spark, path, DDL)
    turns = []

    def other_load(folder):
        if not turns:
            turns.append(1)
            dimensions.load_dimension(values(frame, "b", "x"), path, "v", "id")

    assert dimensions.load_dimension(values(frame, "a", "b"), path, "v", "id", before_commit=other_load) == 1
    assert rows(dimensions.read_dimension(spark, path)) == [(1, "b"), (2, "x"), (3, "a")]
    named = set(commits.newest(spark, path).content["folders"])
    assert {f"data/{p.name}" for p in (tmp_path / "dim" / "data").iterdir()} == named

    def always(folder):
        dimensions.load_dimension(values(frame, f"y{len(turns)}"), path, "v", "id")
        turns.append(1)

    with pytest.raises(commits.CommitConflict):
        dimensions.load_dimension(values(frame, "late"), path, "v", "id", attempts=2, before_commit=always)


def test_dimension_packs_its_folders_while_readers_go_on(spark, frame, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(dimensions, "MOST_FOLDERS", 3)
    path = str(tmp_path / "dim")
    dimensions.create_dimension(spark, path, DDL)
    opened = []
    for i in range(6):
        dimensions.load_dimension(values(frame, f"v{i}"), path, "v", "id")
        opened.append(dimensions.read_dimension(spark, path))
        assert len(commits.newest(spark, path).content["folders"]) <= 3
        # A reader of the version before still finds its files.
        assert opened[max(0, i - 1)].count() == max(1, i)
    assert rows(dimensions.read_dimension(spark, path)) == [(i + 1, f"v{i}") for i in range(6)]


def test_dimension_rows_compare_the_value_only(spark, frame, rows, tmp_path):
    path = str(tmp_path / "dim")
    dimensions.create_dimension(spark, path, DDL)
    source = frame([(1, "a"), (2, "a"), (2, "a"), (None, "b"), (3, None)], DDL)
    assert dimensions.load_dimension_rows(source, path, "v", "id") == 2
    assert dimensions.load_dimension_rows(frame([(9, "a"), (9, "c")], DDL), path, "v", "id") == 1
    assert rows(dimensions.read_dimension(spark, path)) == [(1, "a"), (2, "a"), (9, "c")]


@pytest.mark.parametrize("partitions", [(), ("d",)])
def test_a_batch_is_appended_once(spark, frame, rows, tmp_path, monkeypatch, partitions):
    path = str(tmp_path / "a")
    schema = "x int, d string"
    assert writers.read_appended(spark, path, schema).count() == 0
    for batch in ("2024-01-01", "2024-01-02"):
        some = frame([(1, batch), (2, "d")], schema)
        publish = commits.publish
        with monkeypatch.context() as patch:  # dies before its commit: nothing of it is seen
            patch.setattr(commits, "publish", lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                writers.append_once(some, path, batch, *partitions)
        theirs = f"data/{writers.BATCH}=their{batch}"
        some.limit(1).write.partitionBy(*partitions).parquet(f"{path}/{theirs}")

        def quicker(spark, path, name, content):  # another writer of the batch commits first
            assert publish(spark, path, name, {"folder": theirs})
            return publish(spark, path, name, content)

        before = set((tmp_path / "a" / "data").iterdir())
        with monkeypatch.context() as patch:
            patch.setattr(commits, "publish", quicker)
            assert not writers.append_once(some, path, batch, *partitions)
        assert set((tmp_path / "a" / "data").iterdir()) == before
        assert not writers.append_once(some, path, batch, *partitions)
    assert writers.append_once(frame([], schema), path, "empty", *partitions)
    assert commits.names(spark, path) == ["2024-01-01", "2024-01-02", "empty"]
    assert rows(writers.read_appended(spark, path, schema)) == [(1, "2024-01-01"), (1, "2024-01-02")]
    with pytest.raises(ValueError, match="batch key"):
        writers.append_once(frame([], schema), path, "a/b")


def test_appended_batches_read_back(spark, frame, rows, tmp_path):
    for name, partitions in (("plain", ()), ("parted", ("d",))):
        path = str(tmp_path / name)
        for batch in ("one", "two", "one"):
            writers.append_once(frame([(1, batch), (2, None)], "x int, d string"), path, batch, *partitions)
        assert rows(writers.read_appended(spark, path, "x int, d string")) == [(1, "one"), (1, "two"), (2, None), (2, None)]


ARRIVAL = (
    '{"id": "%d", "type": "PushEvent", "repo": {"id": 1, "name": "o/r"}, '
    '"actor": {"id": 2, "login": "u"}, "created_at": "2024-01-01T00:00:00Z"}\n'
)


def test_a_new_checkpoint_takes_no_file_again(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table = str(tmp_path / "table")

    def ids(progress, **options):
        return sorted(r.event_id for r in land_events(spark, str(landing), table, str(tmp_path / progress), **options).collect())

    for hour in range(3):
        (landing / f"{hour} +%.json").write_text(ARRIVAL % hour + ARRIVAL % (hour + 100))
    assert ids("one", files_per_batch=2) == [0, 1, 2, 100, 101, 102]
    (landing / "3.json").write_text(ARRIVAL % 3)
    (landing / "empty.json").write_text("")
    assert ids("two", files_per_batch=3) == [0, 1, 2, 3, 100, 101, 102]
    assert ids("two") == [0, 1, 2, 3, 100, 101, 102]
    shutil.rmtree(tmp_path / "two")  # the same place, but a stream of its own
    (landing / "4.json").write_text(ARRIVAL % 4)
    assert ids("two") == [0, 1, 2, 3, 4, 100, 101, 102]
    ledger = taken_files(spark, table).collect()
    assert len(ledger) == 5 and all(r.landed_size > 0 and r.landed_time for r in ledger)


def test_a_batch_that_died_before_its_commit_is_replaced(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "0.json").write_text(ARRIVAL % 0)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", lambda *args: 1 / 0)
        with pytest.raises(Exception):  # noqa: B017, the stream's own error
            land_events(spark, str(landing), table, progress)
    assert commits.names(spark, table) == []
    for _ in range(2):
        assert [r.event_id for r in land_events(spark, str(landing), table, progress).collect()] == [0]
