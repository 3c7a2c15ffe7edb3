import pytest
from pyspark.errors import AnalysisException

from millrace import schemas
from millrace.operators import ratings, text
from millrace.plans import reports
from millrace.sources import readers, writers
from millrace.sources.jdbc import Connection, ReadSlices
from millrace.streaming.landing import land_events


def test_typed_ratings(frame, rows):
    some = ratings.typed_ratings(
        frame([("u", "m", "4.5", "86400"), ("u", "m", "x", None)], schemas.RATING)
    )
    assert dict(some.dtypes) == {"userId": "string", "movieId": "string", "rating": "double", "timestamp": "timestamp"}
    assert rows(some.selectExpr("rating", "unix_seconds(timestamp)")) == [(4.5, 86400), (None, None)]


def test_top_titles_merge_equal_titles_and_break_ties_by_title(frame):
    movies = frame([("1", "B"), ("2", "A"), ("3", "A"), ("4", "C"), ("5", "unrated")], schemas.MOVIE)
    some = [("1", "5"), ("1", "3"), ("2", "1"), ("3", "2"), ("4", "4"), ("4", None), ("9", "5"), (None, "5")]
    rated = ratings.typed_ratings(
        frame([("u", movie, rating, "0") for movie, rating in some], schemas.RATING)
    )
    found = [tuple(r) for r in ratings.top_titles(rated, movies).collect()]
    assert found == [("A", 2, 1.5), ("B", 2, 4.0), ("C", 2, 4.0)]
    assert [r.title for r in ratings.top_titles(rated, movies, 1).collect()] == ["A"]


def test_top_titles_equal_the_plain_join(spark, frame, rows):
    rated = spark.range(3000).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 50) AS string) AS movieId",
        "cast(id % 6 AS double) AS rating",
        "timestamp_seconds(id) AS timestamp",
    )
    movies = spark.range(40).selectExpr("cast(id AS string) AS movieId", "concat('t', id % 15) AS title")
    movies = movies.union(movies.where("movieId IN ('3', '7')"))
    joined = rated.join(movies, "movieId").createOrReplaceTempView("joined_ratings")
    plain = spark.sql(
        "SELECT title, count(timestamp) AS qty_ratings, avg(rating) AS avg_rating FROM joined_ratings "
        "GROUP BY title ORDER BY 2 DESC, 1 LIMIT 10"
    )
    assert joined is None and rows(ratings.top_titles(rated, movies)) == rows(plain)


def test_line_counts(spark, tmp_path):
    (tmp_path / "t.txt").write_text("abc\nb\n\nxyz\nA\n")
    lines = readers.read_lines(spark, str(tmp_path))
    assert tuple(text.line_counts(lines).first()) == (1, 2)
    assert tuple(text.line_counts(lines, "z").first()) == (1,)


def test_sample_is_repeatable(spark):
    some = spark.range(10_000, numPartitions=4)
    first = text.sample_rows(some, 0.1)
    assert first.collect() == text.sample_rows(some, 0.1).collect()
    assert 800 < first.count() < 1200


def test_with_uuid_numbers_every_row(spark):
    found = text.with_uuid(spark.range(1000))
    assert found.select("uuid").distinct().count() == 1000


def test_csv_round_trip(spark, frame, rows, tmp_path):
    some = frame([("a,b", '"q"'), ("line\nbreak", None)], "x string, y string")
    target = tmp_path / "out"
    writers.write_csv(some.limit(1), str(target), files=1)
    writers.write_csv(some.limit(1), str(target), files=1)
    assert len(list(target.glob("part-*.csv"))) == 1
    assert rows(readers.read_csv(spark, str(target))) == [("a,b", '"q"')]
    assert rows(readers.read_csv(spark, str(target), "x string, y string")) == [("a,b", '"q"')]


def test_dated_csv_is_never_replaced(spark, frame, tmp_path):
    some = frame([(1,)], "x int")
    path = writers.write_csv_dated(some, str(tmp_path), "2024-01-31", "r")
    assert path == f"{tmp_path}/2024-01-31/r"
    with pytest.raises(AnalysisException, match="already exists"):
        writers.write_csv_dated(some, str(tmp_path), "2024-01-31", "r")


def test_append(spark, frame, rows, tmp_path):
    path = str(tmp_path / "a")
    for value in (1, 2):
        writers.append_rows(frame([(value, "d")], "x int, d string"), path, "d")
    assert rows(spark.read.schema("x int, d string").parquet(path)) == [(1, "d"), (2, "d")]


def test_several_archive_files(spark, tmp_path):
    for hour in range(3):
        (tmp_path / f"{hour}.json").write_text('{"id": "%d", "type": "A"}\n' % hour)
    paths = [str(tmp_path / f"{hour}.json") for hour in (0, 2)]
    found = readers.read_archive(spark, paths, spread=4)
    assert {r.id for r in found.collect()} == {"0", "2"} and found.rdd.getNumPartitions() == 4


def test_jdbc_options():
    """Only the options are checked: no database is at hand."""
    connection = Connection("jdbc:x://host/db", "me", "secret", driver="org.x.Driver")
    assert connection.options() == {
        "url": "jdbc:x://host/db", "user": "me", "password": "secret", "driver": "org.x.Driver",
        "fetchsize": "10000", "batchsize": "10000",
    }
    assert "secret" not in repr(connection)
    assert ReadSlices("id", 0, 100, 4).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }


ARRIVAL = (
    '{"id": "%d", "type": "PushEvent", "repo": {"id": 1, "name": "o/r"}, '
    '"actor": {"id": 2, "login": "u"}, "created_at": "2024-01-01T00:00:00Z"}\n'
)


def test_landing_takes_every_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    assert land_events(spark, str(landing), table, progress).count() == 0
    for hour in range(4):
        (landing / f"{hour}.json").write_text(ARRIVAL % hour)
        if hour % 2:
            events = land_events(spark, str(landing), table, progress, files_per_batch=1)
            assert sorted(r.event_id for r in events.collect()) == list(range(hour + 1))
    again = land_events(spark, str(landing), table, progress)
    assert again.count() == 4
    assert again.columns == [part.split()[0] for part in schemas.TYPED_EVENT.split(", ")]


def test_activity_report_writes_every_result(spark, tmp_path):
    (tmp_path / "e.json").write_text("".join(ARRIVAL % i for i in range(3)))
    archive = readers.read_archive(spark, str(tmp_path / "e.json"))
    reports.activity_report(archive, str(tmp_path / "out"), files=1)
    assert {p.name for p in (tmp_path / "out").iterdir()} == {
        "events", "owners_with_many_repos", "active_submitters", "inactive_submitters", "names", "repos_with_many_members",
    }
    pushes = readers.read_csv(spark, str(tmp_path / "out" / "active_submitters"))
    assert [tuple(r) for r in pushes.collect()] == [("u", "3")]


def _csv(folder, *files):
    folder.mkdir()
    for i, content in enumerate(files):
        (folder / f"part {i}+.csv").write_text(content)
    return str(folder)


def test_csv_columns_go_by_name_whatever_their_order(spark, rows, tmp_path):
    path = _csv(tmp_path / "mixed", "date,code,rate,base\n2020-01-02,USD,1.5,EUR\n",
                "start,end,date,code,rate,base\na,b,2020-01-03,GBP,2.5,EUR\n", "code,date\nJPY,2020-01-04\n")
    found = readers.read_csv(spark, path).select("code", "date", "rate", "base", "start")
    assert rows(found) == sorted(
        [("USD", "2020-01-02", "1.5", "EUR", None), ("GBP", "2020-01-03", "2.5", "EUR", "a"), ("JPY", "2020-01-04", None, None, None)],
        key=repr,
    )
    typed = readers.read_csv(spark, path, "base string, rate double, date date, code string")
    assert {(r.code, r.rate, str(r.date)) for r in typed.collect()} == {
        ("USD", 1.5, "2020-01-02"), ("GBP", 2.5, "2020-01-03"), ("JPY", None, "2020-01-04")}


def test_csv_schema_in_another_order_than_the_header(spark, tmp_path):
    path = _csv(tmp_path / "one", "date,code,rate,base\n2020-01-02,USD,x,EUR\n")
    found = readers.read_csv(spark, path, "code string, rate double, base string, date string").first()
    assert tuple(found) == ("USD", None, "EUR", "2020-01-02")


def test_headers_cost_no_more_for_longer_files(spark, tmp_path):
    def read_bytes():
        statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in statistics if s.getScheme() == "file")

    cost = {}
    for name, lines in (("short", 20_000), ("long", 2_000_000)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a b+c%41.csv").write_text("\n  \nx,y\n" + "1,some text of the row\n" * lines)
        (folder / "other.csv").write_text("y,z\n1,2\n")
        (folder / "blank.csv").write_text(" \n")
        before = read_bytes()
        found = readers.read_csv(spark, str(folder))
        cost[name] = read_bytes() - before
        assert found.columns == ["x", "y", "z"]
    assert (tmp_path / "long" / "a b+c%41.csv").stat().st_size > 40_000_000
    assert cost["long"] < cost["short"] + 1_000_000 < 3_000_000
    assert found.where("z IS NULL").count() == 2_000_000 and found.where("z = 2").first().y == "1"


def test_stable_samples_and_ids_follow_the_rows(spark, frame, rows):
    some = frame([(i % 300, None if i % 7 == 0 else f"v{i % 300}") for i in range(2400)] + [(5, "hot")] * 800, "x int, y string")
    drawn = text.sample_rows_stable(some, 0.3)
    assert rows(drawn) == rows(text.sample_rows_stable(some.repartition(13), 0.3))
    assert rows(drawn) != rows(text.sample_rows_stable(some, 0.3, seed=4))
    assert 0.25 < drawn.count() / 3200 < 0.35 and drawn.where("y = 'hot'").count() > 180
    assert drawn.exceptAll(some).count() == 0
    named = text.with_stable_uuid(some)
    assert rows(named) == rows(text.with_stable_uuid(some.repartition(13)))
    assert rows(named.drop("uuid")) == rows(some) and named.select("uuid").distinct().count() == 3200
    assert text.sample_rows_stable(some, 0.0).count() == 0 and text.sample_rows_stable(some, 1.0).count() == 3200
