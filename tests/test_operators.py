"""Operator-level tests on hand-made rows."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion import seed
from medallion.functions import count_where, hours_between, safe_percent
from medallion.operators import audit, registry
from medallion.operators.latest import latest_per_key, latest_per_key_window
from medallion.operators.silver import (
    advance_marks,
    incremental_slice,
    next_marks,
    validate_load_type,
    with_bronze_audit,
    with_silver_audit,
)
from medallion.operators.upsert import DuplicateKeyError, split_keys, upsert_frames

KV = "k int, v string"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- upsert ------------------------------------------------------------------------------------


def test_upsert_updates_matched_and_inserts_new(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], KV)
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], KV)
    out = upsert_frames(target, updates, "k")
    # null keys never match: both null-key rows stay
    assert rows(out) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "m")], key=repr)


def test_upsert_composite_key_text(spark):
    assert split_keys("shipment_id, item_id") == ["shipment_id", "item_id"]
    with pytest.raises(ValueError):
        split_keys("")
    t = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, v string")
    u = spark.createDataFrame([(1, 2, "Y"), (2, 1, "z")], "a int, b int, v string")
    assert rows(upsert_frames(t, u, "a,b")) == [(1, 1, "x"), (1, 2, "Y"), (2, 1, "z")]


def test_upsert_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a", 0)], "k int, v string, ts int")
    u = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, ts int")
    assert rows(upsert_frames(t, u, ["k"], order=["ts"])) == [(1, "new", 2)]
    with pytest.raises(DuplicateKeyError):
        upsert_frames(t, u, ["k"], strict=True)


def test_upsert_preserves_named_columns(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, born int")
    u = spark.createDataFrame([(2, "B", 99), (3, "C", 99)], "k int, v string, born int")
    assert rows(upsert_frames(t, u, "k", preserve=["born"])) == [(1, "a", 10), (2, "B", 20), (3, "C", 99)]


def test_upsert_missing_key_column(spark):
    t = spark.createDataFrame([(1, "a")], KV)
    with pytest.raises(ValueError):
        upsert_frames(t, t, ["nope"])


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.text("abc", max_size=2)), max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=keyed, updates=keyed)
def test_upsert_properties(spark, target, updates):
    # unique update keys (the MERGE contract); target may repeat keys
    seen, upd = set(), []
    for k, v in updates:
        if k is None or k not in seen:
            upd.append((k, v))
            seen.add(k)
    t = spark.createDataFrame(target, KV)
    u = spark.createDataFrame(upd, KV)
    once = upsert_frames(t, u, "k")
    twice = upsert_frames(once, u.filter(F.col("k").isNotNull()), "k")
    got = rows(once)
    # idempotent for keyed updates
    assert rows(twice) == got
    # model: drop matched target rows, add all update rows
    ukeys = {k for k, _ in upd if k is not None}
    model = [r for r in target if r[0] is None or r[0] not in ukeys] + upd
    assert got == sorted(model, key=repr)
    # keys = union of keys
    assert {r[0] for r in got if r[0] is not None} == {k for k, _ in target + upd if k is not None}


# ---- latest per key ------------------------------------------------------------------------


def test_latest_per_key_nulls_last_and_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "n"), (1, datetime(2024, 1, 1), 1, "a"), (1, datetime(2024, 1, 1), 2, "b"), (2, None, 1, "z")],
        "k int, t timestamp, id int, p string",
    )
    got = rows(latest_per_key(df, ["k"], ["t", "id"]), "k", "id", "p")
    assert got == [(1, 2, "b"), (2, 1, "z")]
    assert got == rows(latest_per_key_window(df, ["k"], ["t", "id"]), "k", "id", "p")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 50)), min_size=1, max_size=15, unique_by=lambda r: r[2]))
def test_latest_per_key_equals_window(spark, data):
    df = spark.createDataFrame(data, "k int, t int, id int")
    assert rows(latest_per_key(df, ["k"], ["t", "id"])) == rows(latest_per_key_window(df, ["k"], ["t", "id"]))


# ---- expressions ---------------------------------------------------------------------------


def test_hours_truncate_toward_zero(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 2, 0, 59)), (datetime(2024, 1, 1, 1, 30), datetime(2024, 1, 1, 0, 0))],
        "a timestamp, b timestamp",
    )
    assert [r[0] for r in df.select(hours_between("a", "b")).collect()] == [24, -1]


def test_safe_percent_and_count_where(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "g int, s string")
    out = df.groupBy("g").agg(count_where(F.col("s") == "x").alias("n"), F.count("s").alias("d"))
    got = {r["g"]: (r["n"], r["p"]) for r in out.select("g", "n", safe_percent("n", "d").alias("p")).collect()}
    assert got[1][0] == 1 and float(got[1][1]) == 50.0
    assert got[2] == (0, None)  # null row counts 0; division by zero -> null


# ---- registry ------------------------------------------------------------------------------


def test_seed_counts(spark):
    f = registry.seed_frames(spark)
    got = rows(registry.metadata_counts(f["tables"], f["table_parameters"], f["table_watermarks"]))
    assert got == [("table_parameters", 110), ("table_watermarks", 28), ("tables", 51)]
    assert f["schemas"].count() == 13


def test_plan_tables(spark):
    f = registry.seed_frames(spark)
    blob = registry.plan_tables(f["tables"], "BLOB").collect()
    assert len(blob) == 13
    assert [r["load_order"] for r in blob] == sorted(r["load_order"] for r in blob)
    assert registry.plan_tables(f["tables"], "SqlServer").count() == 28
    with pytest.raises(ValueError):
        registry.plan_tables(f["tables"], "")


def test_table_params_and_latest_wins(spark):
    f = registry.seed_frames(spark)
    assert registry.table_params_dict(f["table_parameters"], 15) == {
        "load_type": "MERGE",
        "primary_key": "shipment_id,item_id",
        "watermark_column": "updated_date",
    }
    assert registry.table_params_dict(f["table_parameters"], 1)["watermark_column"] is None
    with pytest.raises(ValueError):
        registry.table_params(f["table_parameters"], 0)
    p = spark.createDataFrame(
        [(7, "load_type", "FULL", datetime(2024, 1, 1)), (7, "load_type", "MERGE", datetime(2024, 1, 2))],
        "table_id int, parameter_name string, parameter_value string, created_at timestamp",
    )
    assert registry.table_params_dict(p, 7)["load_type"] == "MERGE"


def test_load_types_match_registry():
    lt = {r[0]: r[2] for r in seed.parameter_rows() if r[1] == "load_type"}
    assert sorted(k for k, v in lt.items() if v == "APPEND") == [12, 16, 23, 24, 31, 32]
    assert sum(v == "MERGE" for v in lt.values()) == 22
    assert sum(v == "FULL" for v in lt.values()) == 13


def test_schema_registry(spark):
    f = registry.seed_frames(spark)
    sch = registry.schema_from_json(registry.latest_schema(f["schemas"], "study_master"))
    assert [x.name for x in sch.fields][:3] == ["study_id", "study_name", "phase"]
    assert sch["start_date"].dataType.typeName() == "date" and all(x.nullable for x in sch.fields)
    odd = registry.schema_from_json(json.dumps([{"name": "x", "type": "decimal"}]))
    assert odd["x"].dataType.typeName() == "string"
    with pytest.raises(ValueError):
        registry.latest_schema(f["schemas"], "subject")
    v = spark.createDataFrame(
        [("t", 1, "[1]", True), ("t", 3, "[3]", False), ("t", 2, "[2]", True)],
        "table_name string, schema_version int, schema_json string, active_flag boolean",
    )
    assert registry.latest_schema(v, "t") == "[2]"
    assert rows(registry.latest_schemas(v)) == [("t", 2, "[2]")]


def test_registry_check_flags_keys_outside_schema(spark):
    f = registry.seed_frames(spark)
    problems = registry.registry_check(f["tables"], f["table_parameters"], f["schemas"])
    assert "visit_schedule: key visit_code not in schema" in problems
    assert "visit_activity_plan: key visit_activity_plan_id not in schema" in problems
    assert len(problems) == 2


# ---- silver operators ----------------------------------------------------------------------


def test_incremental_slice(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, None)], "id int, ts timestamp"
    )
    assert rows(incremental_slice(df, "MERGE", "ts", "2024-01-01 00:00:00"), "id") == [(2,)]
    assert incremental_slice(df, "FULL", "ts", "2024-01-01 00:00:00").count() == 3
    assert incremental_slice(df, "APPEND", "ts", None).count() == 3
    for bad in ("UPSERT", None):
        with pytest.raises(ValueError):
            validate_load_type(bad)


def test_null_mark_rows(spark):
    from medallion.operators.silver import null_mark_rows

    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, None)], "id int, ts timestamp")
    assert [r["id"] for r in null_mark_rows(df, "ts").collect()] == [2]


def test_audit_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    b = with_bronze_audit(df).first()
    assert b["source_file_name"] is None and b["insert_timestamp"] is not None
    s = with_silver_audit(df, datetime(2024, 1, 1)).first()
    assert s["insert_timestamp"] == s["update_timestamp"] == datetime(2024, 1, 1)


def test_advance_marks_keeps_mark_on_empty_slice(spark):
    marks = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")], "table_id int, last_watermark_value string")
    sl = spark.createDataFrame([(1, datetime(2024, 2, 1)), (1, datetime(2024, 3, 1))], "table_id int, ts timestamp")
    got = rows(advance_marks(marks, next_marks(sl, "table_id", "ts")))
    assert got == [(1, "2024-03-01 00:00:00"), (2, "2024-01-01 00:00:00")]


# ---- run audit -----------------------------------------------------------------------------

RUNS = "run_id bigint, table_id int, layer string, start_time timestamp, end_time timestamp, status string, number_of_records bigint, error_message string"


def test_run_begin_end_status(spark):
    runs = spark.createDataFrame([], RUNS)
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    begins = spark.createDataFrame([(1, 5, "Bronze", t0), (1, 6, "Bronze", t0)], "run_id bigint, table_id int, layer string, start_time timestamp")
    runs = audit.apply_begin(runs, begins)
    assert {r["status"] for r in runs.collect()} == {audit.INPROGRESS}
    ends = spark.createDataFrame(
        [(1, 5, t1, "SUCCESS", 10, None), (9, 9, t1, "SUCCESS", 1, None)],
        "run_id bigint, table_id int, end_time timestamp, status string, number_of_records bigint, error_message string",
    )
    runs = audit.apply_end(runs, ends)  # (9, 9) has no begin: not inserted
    got = {(r["table_id"]): (r["status"], r["number_of_records"], r["layer"]) for r in runs.collect()}
    assert got == {5: ("SUCCESS", 10, "Bronze"), 6: ("INPROGRESS", None, "Bronze")}
    # INPROGRESS counts as failed
    assert audit.run_status_of(runs, 1) == {"run_id": 1, "total_tables": 2, "failed_tables": 1, "overall_status": "FAILED"}
    # zero rows: SUCCESS
    assert audit.run_status_of(runs, 42)["overall_status"] == "SUCCESS"
    # a null status is not counted as failed
    nulls = spark.createDataFrame([(2, 1, "Silver", t0, None, None, None, None)], RUNS)
    assert audit.run_status_of(nulls, 2)["failed_tables"] == 0
    # a new begin for the same key resets the row
    again = audit.apply_begin(runs, spark.createDataFrame([(1, 5, "Silver", t1)], "run_id bigint, table_id int, layer string, start_time timestamp"))
    r = again.filter("table_id = 5").first()
    assert (r["status"], r["end_time"], r["number_of_records"], r["layer"]) == ("INPROGRESS", None, None, "Silver")


def test_run_rows_of_a_log(spark):
    t = [datetime(2024, 1, 1, 0, k) for k in range(9)]
    log = [
        (1, 5, "Bronze", "begin", t[0], 1, None, None, None), (1, 5, None, "end", t[1], 2, "FAILED", 3, "boom"), (1, 5, "Silver", "join", t[2], 3, None, None, None),
        (1, 6, "Bronze", "begin", t[0], 1, None, None, None), (1, 6, None, "end", t[1], 2, "SUCCESS", 3, None), (1, 6, "Bronze", "begin", t[2], 3, None, None, None),
        (2, 5, "Silver", "join", t[3], 4, None, None, None), (2, 5, "Silver", "join", t[4], 5, None, None, None), (2, 5, None, "end", t[4], 6, "SUCCESS", 8, None),
        (3, 5, None, "end", t[5], 7, "SUCCESS", 1, None), (None, 7, "Bronze", "begin", t[6], 8, None, None, None),
        (4, 5, "Bronze", "begin", t[7], 9, None, None, None), (4, 5, None, "end", t[7], 10, "FAILED", 0, "x"), (4, 5, None, "end", t[8], 11, "SUCCESS", 5, None),
    ]
    got = {(r["run_id"], r["table_id"]): tuple(r)[2:] for r in audit.run_rows(spark.createDataFrame(log, audit.LOG_SCHEMA)).collect()}
    assert got == {
        (1, 5): ("Bronze", t[0], t[1], "FAILED", 3, "boom"),  # a silver step joins the row and leaves it
        (1, 6): ("Bronze", t[2], None, "INPROGRESS", None, None),  # begun again: end, count and error are cleared
        (2, 5): ("Silver", t[3], t[4], "SUCCESS", 8, None),
        (None, 7): ("Bronze", t[6], None, "INPROGRESS", None, None),  # run 3 ended without a beginning: no row
        (4, 5): ("Bronze", t[7], t[8], "SUCCESS", 5, None),
    }


def test_jdbc_read_in_one_task_has_to_be_asked_for(spark):
    from medallion.sources.jdbc import jdbc_read

    with pytest.raises(ValueError, match="one_task"):
        jdbc_read(spark, "jdbc:x", "lims.result")


def test_fold_events_equals_begin_and_end_upserts(spark):
    from medallion.operators import audit

    t = lambda h: datetime(2024, 1, 1, h)
    events = [(1, 1, t(1), "SUCCESS", 5, None), (1, 1, t(3), "RUNNING", 6, None), (1, 2, t(1), "RUNNING", 7, None)]
    events += [(2, 1, t(2), "SUCCESS", 8, None), (2, 1, t(2), "FAILED", 9, "x"), (2, 1, t(4), "FAILED", 3, "y")]
    ev = spark.createDataFrame(events, "run_id long, table_id int, time timestamp, status string, number_of_records long, error_message string")
    ev = ev.withColumn("layer", F.lit("Silver"))
    schema = "run_id long, table_id int, layer string, start_time timestamp, end_time timestamp, status string, number_of_records long, error_message string"
    begun = audit.apply_begin(spark.createDataFrame([], schema), ev.withColumnRenamed("time", "start_time"))
    want = audit.apply_end(begun, ev.withColumnRenamed("time", "end_time").filter("status IN ('SUCCESS', 'FAILED')"))
    assert sorted(map(repr, audit.fold_events(ev).collect())) == sorted(map(repr, want.collect()))


def test_jdbc_options():
    from medallion.sources.jdbc import jdbc_options, source_table_name

    o = jdbc_options("jdbc:x", "lims.result", {"user": "u"}, "result_id", 1, 1000, 8)
    assert (o["dbtable"], o["user"], o["partitionColumn"], o["numPartitions"], o["fetchsize"]) == (
        "lims.result", "u", "result_id", "8", "10000",
    )
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
    assert source_table_name("biobank", "freezer") == "biobank.freezer"
    assert source_table_name(None, "freezer") == "freezer"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["load_type", "primary_key", "other"]), st.one_of(st.none(), st.sampled_from(["A", "B", "C"])), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=8))
def test_table_params_dict_equals_pivot(spark, rows_):
    p = spark.createDataFrame(
        [(1, n, v, None if t is None else datetime(2024, 1, 1 + t)) for n, v, t in rows_],
        "table_id int, parameter_name string, parameter_value string, created_at timestamp",
    )
    pivot = registry.table_params(p, 1).first().asDict()
    pivot.pop("table_id")
    assert registry.table_params_dict(p, 1) == pivot
