import datetime as dt
import uuid
from pathlib import Path

import pytest

from millrace import schemas
from millrace.operators import warehouse as wh
from millrace.sources import tables

MOMENTS = [dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc) for day in (1, 2, 3)]
T1, T2, T3 = MOMENTS
SPECS = list(wh.expand_model(wh.EVENT_MODEL))


def typed(frame, *data):
    """(event, type, actor, actor name, repo, repo name, time) as typed events."""
    return frame(
        [
            (type, f"o/{name}", actor_name, "o", name, time, actor, repo, event)
            for event, type, actor, actor_name, repo, name, time in data
        ],
        schemas.TYPED_EVENT,
    )


def test_model_expands_to_hubs_satellites_and_links():
    assert {(s.kind, s.name) for s in SPECS} == {
        ("hub", "hub_event"), ("hub", "hub_actor"), ("hub", "hub_repo"),
        ("satellite", "sat_event_type"), ("satellite", "sat_actor_name"), ("satellite", "sat_repo_name"),
        ("link", "link_event_actor"), ("link", "link_event_repo"),
    }
    by_name = {s.name: s for s in SPECS}
    assert by_name["sat_actor_name"].columns == ["actor_id", "actor_name", "from_time"]
    assert by_name["link_event_repo"].columns == ["event_id", "repo_id"]


def test_deep_models_link_each_level_to_its_parent():
    specs = wh.expand_model({"a": {"x": "string", "b": {"c": {"y": "string"}}}})
    assert [s.name for s in specs] == ["hub_a", "sat_a_x", "hub_b", "link_a_b", "hub_c", "link_b_c", "sat_c_y"]


def test_model_tables_lists_the_specs(spark):
    assert wh.model_tables(spark, wh.EVENT_MODEL).count() == len(SPECS)


def test_hub_new_keys(frame, rows):
    source = frame([(1,), (2,), (2,), (None,), (3,)], "k bigint")
    assert rows(wh.hub_new_keys(source, frame([(1,)], "k bigint"), "k")) == [(2,), (3,)]
    # A null in the stored keys must not hide the new ones.
    assert rows(wh.hub_new_keys(source, frame([(1,), (None,)], "k bigint"), "k")) == [(2,), (3,)]


def test_link_new_pairs_compares_both_keys(frame, rows):
    source = frame([(1, 1), (1, 2), (1, 2), (2, 1), (None, 1), (1, None)], "l bigint, r bigint")
    stored = frame([(1, 1)], "l bigint, r bigint")
    assert rows(wh.link_new_pairs(source, stored, "l", "r")) == [(1, 2), (2, 1)]


SAT = "k bigint, v string, from_time timestamp"
SEEN = "k bigint, v string, created_at timestamp"


def test_sat_new_values_takes_latest_time_and_skips_known_values(frame, rows):
    source = frame([(1, "a", T1), (1, "a", T3), (1, "b", T2), (2, "c", T1), (3, None, T1)], SEEN)
    stored = frame([(1, "b", T1)], SAT)
    found = wh.sat_new_values(source, stored, "k", "v")
    assert [(r.k, r.v, r.from_time.day) for r in found.orderBy("k").collect()] == [(1, "a", 3), (2, "c", 1)]
    # Going back to an earlier value is not a new row.
    assert wh.sat_new_values(frame([(1, "b", T3)], SEEN), stored, "k", "v").count() == 0


def test_sat_new_versions_needs_an_earlier_stored_time(frame):
    source = frame([(1, "a", T1), (1, "a", T2), (1, "a", T3), (2, "a", T1), (1, "b", T1)], SEEN)
    stored = frame([(1, "a", T2)], SAT)
    found = wh.sat_new_versions(source, stored, "k", "v").collect()
    assert {(r.k, r.v, r.from_time.day) for r in found} == {(1, "a", 1), (1, "a", 2), (2, "a", 1), (1, "b", 1)}


def test_dim_values_are_numbered_on_in_order(spark, frame):
    dim = frame([(4, "b")], "id bigint, v string")
    source = frame([(v,) for v in ["c", "a", "b", "c", None, "d"]], "v string")
    found = wh.dim_new_values(source, dim, "v", "id").orderBy("id")
    assert [tuple(r) for r in found.collect()] == [(5, "a"), (6, "c"), (7, "d")]
    assert wh.dim_new_values(source, dim.union(found), "v", "id").count() == 0


def test_dim_numbers_have_no_gaps_over_many_partitions(spark, frame):
    source = spark.range(5000).selectExpr("printf('%06d', id) AS v")
    numbered = wh.dim_new_values(source, frame([], "id bigint, v string"), "v", "id")
    assert numbered.where("id <> cast(v AS bigint) + 1").count() == 0
    assert numbered.count() == 5000


def test_dim_new_rows_compares_the_value_only(frame, rows):
    source = frame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, "c")], "id bigint, v string")
    dim = frame([(9, "b")], "id bigint, v string")
    assert rows(wh.dim_new_rows(source, dim, "v", "id")) == [(1, "a"), (2, "a")]


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def contents(spark, database):
    return {s.name: sorted(map(tuple, spark.table(f"{database}.{s.name}").drop("from_time").collect())) for s in SPECS}


def test_load_is_incremental_and_repeatable(spark, frame, database):
    tables.create_warehouse(spark, database, SPECS)
    tables.create_warehouse(spark, database, SPECS)
    first = typed(frame, (1, "Push", 10, "ann", 20, "r", T1), (2, "Push", 10, "ann", 20, "r", T2))
    second = typed(frame, (3, "Watch", 10, "anna", 21, "s", T3), (2, "Push", 10, "ann", 20, "r", T2))
    for source in (first, first, second, second):
        tables.load_warehouse(source, database, SPECS)
    assert contents(spark, database) == {
        "hub_event": [(1,), (2,), (3,)],
        "hub_actor": [(10,)],
        "hub_repo": [(20,), (21,)],
        "sat_event_type": [(1, "Push"), (2, "Push"), (3, "Watch")],
        "sat_actor_name": [(10, "ann"), (10, "anna")],
        "sat_repo_name": [(20, "r"), (21, "s")],
        "link_event_actor": [(1, 10), (2, 10), (3, 10)],
        "link_event_repo": [(1, 20), (2, 20), (3, 21)],
    }
    tables.truncate_table(spark, f"{database}.link_event_repo")
    assert spark.table(f"{database}.link_event_repo").count() == 0
    tables.load_warehouse(first, database, SPECS)
    assert spark.table(f"{database}.link_event_repo").count() == 2
    tables.drop_warehouse(spark, database, SPECS)
    tables.drop_warehouse(spark, database, SPECS)
    assert spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").count() == 0


def test_stored_side_of_a_load_is_not_shuffled(spark, frame, database):
    spec = next(s for s in SPECS if s.name == "link_event_actor")
    tables.create_warehouse(spark, database, [spec], buckets=16)
    source = typed(frame, *[(i, "Push", i % 7, "ann", 20, "r", T1) for i in range(200)])
    tables.load_warehouse(source, database, [spec])
    delta = wh.new_rows(source, spark.table(f"{database}.{spec.name}"), spec)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = delta._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = plan.index("LeftAnti")
    stored = plan[plan.index("+- Sort", join) :]
    assert "Bucketed: true" in plan and "Exchange" not in stored.split("Bucketed: true")[0].splitlines()[-3]


def test_ten_loads_leave_few_files_and_no_shuffle(spark, frame, rows, database):
    spec = next(s for s in SPECS if s.name == "sat_actor_name")
    table = f"{database}.{spec.name}"
    tables.create_warehouse(spark, database, [spec], buckets=16)
    expected = set()
    for load in range(10):
        source = typed(frame, *[(i, "Push", i, f"n{load}", 20, "r", T1) for i in range(load, load + 40)])
        expected |= {(i, f"n{load}") for i in range(load, load + 40)}
        held = spark.table(table).inputFiles()
        tables.load_warehouse(source, database, [spec], most_files=2)
        assert max(tables.files_per_bucket(spark, table).values()) <= 2
        assert all(Path(file.removeprefix("file:")).exists() for file in held)  # for readers that go on
    assert {tuple(r)[:2] for r in spark.table(table).collect()} == expected and spark.table(table).count() == 400
    tables.load_warehouse(source, database, [spec])
    assert spark.table(table).count() == 400
    assert_stored_side_in_place(spark, wh.new_rows(source, spark.table(table), spec))


def assert_stored_side_in_place(spark, delta):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = delta._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = plan[plan.index("+- Sort", plan.index("LeftAnti")) :]
    assert "Bucketed: true" in plan and "Exchange" not in stored.split("Bucketed: true")[0].splitlines()[-3]


def test_packing_gives_a_grown_table_more_buckets(spark, frame, rows, database):
    spec = next(s for s in SPECS if s.name == "link_event_actor")
    table = f"{database}.{spec.name}"
    tables.create_warehouse(spark, database, [spec], buckets=8)
    source = typed(frame, *[(i, "Push", i % 7, "ann", 20, "r", T1) for i in range(500)])
    tables.load_warehouse(source, database, [spec])
    stored = rows(spark.table(table))
    tables.pack_table(spark, table, spec, bucket_bytes=tables.stored_bytes(spark, table) // 20)
    assert tables.bucket_count(spark, table) == 32 and rows(spark.table(table)) == stored
    assert tables.fitting_buckets(spark, 0) == 8
    assert_stored_side_in_place(spark, wh.new_rows(source, spark.table(table), spec))
    tables.load_warehouse(typed(frame, (900, "Push", 3, "ann", 20, "r", T1)), database, [spec])
    assert spark.table(table).count() == 501
    for _ in range(2):
        tables.pack_table(spark, table, spec)
    assert spark.table(table).count() == 501 and set(tables.files_per_bucket(spark, table).values()) == {1}
    tables.truncate_table(spark, table)
    assert spark.table(table).count() == 0
    tables.load_warehouse(source, database, [spec])
    assert rows(spark.table(table)) == stored
    assert spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").count() == 1
