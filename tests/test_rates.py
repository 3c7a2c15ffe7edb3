import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import rates
from millrace.sources import commits, readers, tables

D1, D2, D3 = (dt.date(2024, 1, day) for day in (30, 31, 1))


def raw(frame, *data):
    return frame(list(data), schemas.RAW_RATE)


def stored(spark, path):
    found = tables.read_daily_rates(spark, path).drop("timestamp")
    return {tuple(r) for r in found.collect()}


def test_parse(frame, rows):
    parsed = rates.parse_rates(
        raw(frame, ("USD", "1,25", "BTC", "2024-01-30"), ("USD", "oops", "BTC", "30.01.2024"))
    )
    assert [f"{f.name} {f.dataType.simpleString()}" for f in parsed.schema] == schemas.TYPED_RATE.split(", ")
    assert rows(parsed) == [("BTC", "USD", 1.25, D1), ("BTC", "USD", None, None)]


def test_daily_columns_keep_their_names(frame):
    daily = rates.daily_rates(
        rates.parse_rates(raw(frame, *[("USD", r, "BTC", "2024-01-30") for r in ("1", "2", "6", "bad")]))
    )
    assert daily.columns == [part.split()[0] for part in schemas.DAILY_RATE.split(", ")]
    row = daily.first()
    assert (row.min_rate, row.avg_rate, row.max_rate) == (1.0, 3.0, 6.0)
    assert row.timestamp is not None


def daily(frame, *dates):
    return frame([("B", "S", 1.0, 1.0, 1.0, date, None) for date in dates], schemas.DAILY_RATE)


def test_drop_last_day(frame):
    kept = rates.drop_last_day(daily(frame, D1, D2, D2, None))
    assert {r.date for r in kept.collect()} == {D1, None}
    assert rates.drop_last_day(daily(frame)).count() == 0
    assert rates.drop_last_day(daily(frame, None)).count() == 1


def test_rows_of_new_days(frame):
    some = rates.parse_rates(
        raw(frame, *[("S", "1", "B", d) for d in ("2024-01-30", "2024-01-31", "2024-01-31", "bad")])
    )
    found = rates.rows_of_new_days(some, daily(frame, D1, None))
    assert found.columns == some.columns
    assert sorted(str(r.date) for r in found.collect()) == ["2024-01-31", "2024-01-31", "None"]


def test_refresh(spark, frame, tmp_path):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    tables.create_daily_rates(spark, path)
    assert stored(spark, path) == set()

    first = raw(frame, ("S", "1", "B", "2024-01-30"), ("S", "2", "B", "2024-01-31"))
    tables.refresh_daily(first, path)
    assert stored(spark, path) == {("B", "S", 1.0, 1.0, 1.0, D1), ("B", "S", 2.0, 2.0, 2.0, D2)}

    # The newest stored day gets a second rate, an older day too, and a day in a new month follows.
    later = first.union(
        raw(
            frame,
            ("S", "4", "B", "2024-01-31"),
            ("S", "9", "B", "2024-01-30"),
            ("S", "5", "B", "2024-02-01"),
        )
    )
    expected = {
        ("B", "S", 1.0, 1.0, 1.0, D1),
        ("B", "S", 2.0, 3.0, 4.0, D2),
        ("B", "S", 5.0, 5.0, 5.0, dt.date(2024, 2, 1)),
    }
    for _ in range(2):
        tables.refresh_daily(later, path)
        assert stored(spark, path) == expected
        assert tables.read_daily_rates(spark, path).count() == 3

    # No raw rows left for the newest day: it stays. Nothing else changes either.
    tables.refresh_daily(later.where("date < '2024-02-01'"), path)
    assert stored(spark, path) == expected


def test_refresh_keeps_load_time_of_carried_days(spark, frame, tmp_path):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    some = raw(frame, ("S", "1", "B", "2024-01-30"), ("S", "2", "B", "2024-01-31"))
    tables.refresh_daily(some, path)
    before = {r.date: r.timestamp for r in tables.read_daily_rates(spark, path).collect()}
    tables.refresh_daily(some, path)
    after = {r.date: r.timestamp for r in tables.read_daily_rates(spark, path).collect()}
    assert after[D1] == before[D1] and after[D2] > before[D2]


def test_refresh_of_undated_rates_is_repeatable(spark, frame, tmp_path):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    some = raw(frame, ("S", "1", "B", "bad"), ("S", "2", "B", "2024-01-31"))
    for _ in range(2):
        tables.refresh_daily(some, path)
        assert stored(spark, path) == {("B", "S", 1.0, 1.0, 1.0, None), ("B", "S", 2.0, 2.0, 2.0, D2)}


def test_latest_document(spark, tmp_path):
    (tmp_path / "latest.json").write_text(
        '{\n "motd": {"msg": "m", "url": "u"},\n "success": "True", "base": "USD",\n'
        ' "date": "2031-07-05",\n "rates": {\n  "BTC": 0.0078125\n }\n}'
    )
    documents = readers.read_documents(spark, str(tmp_path))
    assert [tuple(r) for r in rates.rate_from_document(documents, "BTC").collect()] == [
        (0.0078125, "2031-07-05")
    ]
    assert rates.rate_from_document(documents, "EUR").first().rate is None


@pytest.mark.parametrize("extra", ["", ",start_date,end_date"])
def test_clean_landed(spark, tmp_path, extra):
    cells = ",2024-01-01,2024-02-01" if extra else ""
    (tmp_path / "r.csv").write_text(f"date,code,rate,base{extra}\n2024-01-30,USD,1.5,BTC{cells}\n")
    clean = rates.clean_landed(readers.read_csv(spark, str(tmp_path)))
    assert clean.columns == ["date", "code", "rate", "base"]
    assert rates.row_count(clean).first().cnt == 1
    assert rates.parse_rates(clean).first().rate == 1.5


def test_refresh_touches_only_months_with_changes(spark, frame, tmp_path):
    path = tmp_path / "daily"
    tables.create_daily_rates(spark, str(path))
    some = raw(frame, ("S", "1", "B", "2023-05-30"), ("S", "2", "B", "2024-01-31"))
    tables.refresh_daily(some, str(path))
    held = {p.name for p in path.glob("data/*/month=202305/*.parquet")}
    tables.refresh_daily(some, str(path))
    assert held and {p.name for p in path.glob("data/*/month=202305/*.parquet")} == held
    assert len(list(path.glob("data/*/month=202401"))) == 2
    read = tables.read_daily_rates(spark, str(path)).where(F.col("date") == D2)
    assert read.count() == 1


def test_readers_see_a_refresh_whole_or_not_at_all(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    first = raw(frame, ("S", "1", "B", "2024-01-30"), ("S", "2", "B", "2024-02-01"))
    more = first.union(raw(frame, ("S", "4", "B", "2024-02-01"), ("S", "7", "B", "2024-03-05")))
    tables.refresh_daily(first, path)
    old = {("B", "S", 1.0, 1.0, 1.0, D1), ("B", "S", 2.0, 2.0, 2.0, dt.date(2024, 2, 1))}
    new = {("B", "S", 1.0, 1.0, 1.0, D1), ("B", "S", 2.0, 3.0, 4.0, dt.date(2024, 2, 1)), ("B", "S", 7.0, 7.0, 7.0, dt.date(2024, 3, 5))}
    opened = tables.read_daily_rates(spark, path)
    publish = commits.publish_version
    seen = []

    def failing(*args):
        seen.append(stored(spark, path))  # all rows are written, nothing is published
        raise OSError("lost")

    monkeypatch.setattr(commits, "publish_version", failing)
    with pytest.raises(OSError, match="lost"):
        tables.refresh_daily(more, path)
    assert seen == [old] and stored(spark, path) == old
    monkeypatch.setattr(commits, "publish_version", publish)
    tables.refresh_daily(more, path)
    assert stored(spark, path) == new
    assert {tuple(r) for r in opened.drop("timestamp").collect()} == old


def test_refresh_starts_again_behind_another_one(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    ours, theirs = raw(frame, ("S", "1", "B", "2024-01-30")), raw(frame, ("S", "3", "B", "2023-05-05"))
    publish, turns = commits.publish_version, []

    def late(*args):
        if not turns:  # another refresh is published between our write and our commit
            turns.append(1)
            tables.refresh_daily(theirs, path)
        return publish(*args)

    monkeypatch.setattr(commits, "publish_version", late)
    tables.refresh_daily(ours, path)
    # The other one stored an older day only, so both days are in the table.
    assert {r[5] for r in stored(spark, path)} == {D1, dt.date(2023, 5, 5)}
    named = {f for f in tables._folders(commits.newest(spark, path).content)}
    assert {f"data/{p.parent.name}/{p.name}" for p in (tmp_path / "daily").glob("data/*/month=*")} == named
    monkeypatch.setattr(commits, "publish_version", lambda *args: False)
    with pytest.raises(commits.CommitConflict):
        tables.refresh_daily(ours, path, attempts=2)


def test_refresh_writes_nothing_when_nothing_arrives_and_forgets_old_versions(spark, frame, tmp_path):
    path = str(tmp_path / "daily")
    tables.create_daily_rates(spark, path)
    some = raw(frame, ("S", "1", "B", "2024-01-30"), ("S", "2", "B", "2024-01-31"))
    tables.refresh_daily(some, path)
    state = commits.names(spark, path)
    tables.refresh_daily(some.where("date < '2024-01-31'"), path)
    assert commits.names(spark, path) == state
    for _ in range(5):
        tables.refresh_daily(some, path)
    assert len(commits.names(spark, path)) == tables.KEPT_VERSIONS
    assert len(list((tmp_path / "daily").glob("data/*/month=202401"))) == tables.KEPT_VERSIONS
    assert len(stored(spark, path)) == 2
