"""End to end through the seeded registry: CSV landing + bounded source -> bronze ->
silver (FULL / MERGE / composite MERGE) -> gold -> run report (SURVEY §5 items 4 and 6)."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from medallion.operators import audit
from medallion.operators.silver import incremental_slice
from medallion.plans.lakehouse import Lakehouse
from medallion.session import scratch_dir
from medallion.sources.store import BUCKETS, bucket_column

STUDY_HEADER = "study_id,study_name,phase,therapeutic_area,start_date,end_date,status,region,protocol_version"
SUBJECT = "subject_id string, study_id string, enrollment_status string, enrollment_date date, updated_at timestamp"
ITEM = "shipment_id string, item_id string, qty int, updated_date timestamp"


def land(folder: str, name: str, lines: list[str]) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def reader(df):
    return lambda load_type, mark_col, last: incremental_slice(df, load_type, mark_col, last)


@pytest.fixture(scope="module")
def lh(spark):
    root = scratch_dir(spark, "pipeline-test")
    house = Lakehouse(spark, root, namespace="t" + os.path.basename(root).replace("-", "")[-10:])
    house.setup()
    return house


def test_file_ingest_exactly_new_files(spark, lh):
    folder = f"{lh.landing_root}/study_master"
    land(folder, "a.csv", [STUDY_HEADER, "S1,Alpha,I,Onc,2024-01-01,,Active,EU,v1", "S2,Beta,II,Card,2024-02-01,,Active,US,v1"])
    first = lh.dispatch(1, run_id=1)
    assert first.records == 2
    assert lh.dispatch(1, run_id=2).records == 0  # rerun: nothing new
    land(folder, "b.csv", [STUDY_HEADER, "S3,Gamma,III,Onc,not-a-date,,Active,EU,v2"])
    assert lh.dispatch(1, run_id=3).records == 1  # only the new file
    bronze = lh.store.read("bronze", "study_master")
    got = {r["study_id"]: r for r in bronze.collect()}
    assert set(got) == {"S1", "S2", "S3"}
    assert got["S1"]["start_date"] == date(2024, 1, 1) and got["S1"]["_rescued_data"] is None
    assert got["S3"]["start_date"] is None and "not-a-date" in got["S3"]["_rescued_data"]
    assert got["S3"]["source_file_name"].endswith("b.csv")
    # empty landing folder runs clean
    os.makedirs(f"{lh.landing_root}/site_master", exist_ok=True)
    assert lh.dispatch(2, run_id=3).records == 0


def test_silver_full_then_gold(spark, lh):
    lh.load_silver(1, run_id=3, as_of=datetime(2030, 1, 1))
    silver = lh.store.read("silver", "study_master")
    assert silver.count() == 3 and "update_timestamp" in silver.columns and "source_file_name" in silver.columns
    lh.load_silver(1, run_id=4)  # FULL replaces, never adds
    assert lh.store.read("silver", "study_master").count() == 3
    # re-delivered snapshots: take only the last landed file
    lh.load_silver(1, run_id=4, snapshot="latest_file")
    assert [r["study_id"] for r in lh.store.read("silver", "study_master").collect()] == ["S3"]
    lh.load_silver(1, run_id=4)
    assert lh.store.read("silver", "study_master").count() == 3


def test_bounded_merge_with_watermark(spark, lh):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    src = spark.createDataFrame(
        [("P1", "S1", "Enrolled", date(2024, 1, 5), t1), ("P2", "S1", "Screen Failed", date(2024, 1, 6), t1), ("P3", "S9", "Enrolled", None, None)],
        SUBJECT,
    )
    assert lh.dispatch(5, run_id=3, readers={"subject": reader(src)}).records == 2  # null mark never loaded
    first_at, second_at = datetime(2030, 1, 1), datetime(2030, 1, 2)
    lh.load_silver(5, run_id=3, as_of=first_at)
    assert lh.last_mark(5) == "2024-01-01 00:00:00.000000Z"
    src2 = spark.createDataFrame(
        [("P1", "S1", "Completed", date(2024, 1, 5), t1), ("P2", "S1", "Withdrawn", date(2024, 1, 6), t2), ("P4", "S2", "Enrolled", date(2024, 2, 2), t2)],
        SUBJECT,
    )
    # only rows after the mark reach bronze; P1 at the mark is not reloaded (strict >)
    assert lh.dispatch(5, run_id=4, readers={"subject": reader(src2)}).records == 2
    rec = lh.load_silver(5, run_id=4, as_of=second_at, preserve_insert_timestamp=True, report_null_marks=True)
    assert rec.info["null_mark_rows"] == 0  # P3's null-mark row never reached bronze (the reader's filter)
    silver = {r["subject_id"]: r for r in lh.store.read("silver", "subject").collect()}
    got = {k: r["enrollment_status"] for k, r in silver.items()}
    assert got == {"P1": "Enrolled", "P2": "Withdrawn", "P4": "Enrolled"}
    # updated row keeps its first insert time; a new row gets the load time
    assert (silver["P2"]["insert_timestamp"], silver["P2"]["update_timestamp"]) == (first_at, second_at)
    assert silver["P4"]["insert_timestamp"] == second_at
    assert lh.store.buckets("silver", "subject") == (bucket_column(["subject_id"], BUCKETS), BUCKETS)
    assert lh.last_mark(5) == "2024-02-01 00:00:00.000000Z"
    counts = lh.build_gold(["study_enrollment_summary"], as_of=datetime(2030, 1, 1))
    assert counts == {"study_enrollment_summary": 3}
    gold = {r["study_id"]: r for r in lh.store.read("gold", "study_enrollment_summary").collect()}
    assert (gold["S1"]["total_subjects"], gold["S1"]["enrolled_subjects"], gold["S3"]["total_subjects"]) == (2, 1, 0)


def test_composite_key_merge(spark, lh):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    first = spark.createDataFrame([("H1", "1", 5, t1), ("H1", "2", 6, t1)], ITEM)
    lh.dispatch(15, run_id=5, readers={"shipment_item": reader(first)})
    lh.load_silver(15, run_id=5)
    second = spark.createDataFrame([("H1", "2", 60, t2), ("H2", "1", 1, t2)], ITEM)
    lh.dispatch(15, run_id=6, readers={"shipment_item": reader(second)})
    lh.load_silver(15, run_id=6)
    got = sorted((r["shipment_id"], r["item_id"], r["qty"]) for r in lh.store.read("silver", "shipment_item").collect())
    assert got == [("H1", "1", 5), ("H1", "2", 60), ("H2", "1", 1)]


AUDIT_TRAIL = "audit_id string, change_datetime timestamp, note string"


def test_append_guard_after_lost_mark_update(spark, lh):
    t1 = datetime(2024, 3, 1)
    rows = spark.createDataFrame([("A1", t1, "x"), ("A2", t1, "y")], AUDIT_TRAIL)
    lh.dispatch(12, run_id=8, readers={"audit_trail": reader(rows)})
    lh.load_silver(12, run_id=8)
    assert lh.store.read("silver", "audit_trail").count() == 2
    # the mark update is lost: the next run sees the same bronze rows again
    lh.advance_mark(12, 8, "1900-01-01 00:00:00")
    lh.load_silver(12, run_id=9, append_guard=True)
    assert lh.store.read("silver", "audit_trail").count() == 2
    lh.advance_mark(12, 9, "1900-01-01 00:00:00")
    lh.load_silver(12, run_id=10)  # unguarded APPEND repeats them (the reference's behaviour)
    assert lh.store.read("silver", "audit_trail").count() == 4


def test_errors_are_recorded(spark, lh):
    with pytest.raises(ValueError, match="Unsupported source_system"):
        lh.register(9100, "odd", "ftp", {"load_type": "FULL"})
        lh.dispatch(9100, run_id=7)
    # unknown load type: rejected up front (the reference only failed once silver existed)
    lh.register(9101, "odd_load", "sqlserver", {"load_type": "UPSERT", "primary_key": "k"})
    rows = spark.createDataFrame([(1,)], "k int")
    lh.dispatch(9101, run_id=7, readers={"odd_load": lambda *a: rows})
    with pytest.raises(ValueError, match="Unsupported load_type"):
        lh.load_silver(9101, run_id=7)
    run = lh.meta("pipeline_runs").filter((F.col("run_id") == 7) & (F.col("table_id") == 9101)).first()
    assert run["status"] == audit.FAILED and "Unsupported load_type" in run["error_message"]
    # a registered table without parameter rows: the run still ends FAILED, not INPROGRESS
    lh.register(9102, "no_params", "sqlserver", {})
    with pytest.raises(ValueError, match="no parameters"):
        lh.load_silver(9102, run_id=7)
    run = lh.meta("pipeline_runs").filter((F.col("run_id") == 7) & (F.col("table_id") == 9102)).first()
    assert run["status"] == audit.FAILED


def test_run_report(spark, lh):
    summary = lh.summary(4)
    assert summary.columns[:3] == ["Run_ID", "Table_ID", "Table_Name"]
    names = {r["Table_Name"]: r["Status"] for r in summary.collect()}
    assert names == {"study_master": "SUCCESS", "subject": "SUCCESS"}
    assert lh.status(4)["overall_status"] == "SUCCESS"
    assert lh.status(7)["overall_status"] == "FAILED"
    # bronze-only runs stay INPROGRESS until silver ends them (site_master in run 3)
    assert lh.status(3)["failed_tables"] >= 1


def test_failed_runs_are_recorded(spark, lh):
    lh._put("tables", lh.meta("tables").filter("table_id = 1").withColumn("table_id", F.lit(990)).withColumn("source_system", F.lit("tape")), table_id=990)
    for table_id in (990, 991):  # an unsupported source, an unknown table
        with pytest.raises(ValueError):
            lh.dispatch(table_id, run_id=90)
    runs = {r["table_id"]: r for r in lh.meta("pipeline_runs").filter("run_id = 90").collect()}
    assert {r["status"] for r in runs.values()} == {"FAILED"} and len(runs) == 2
    assert "tape" in runs[990]["error_message"] and all(r["number_of_records"] == 0 for r in runs.values())



def test_error_text_is_whole_and_start_is_kept(spark, lh):
    with pytest.raises(RuntimeError), lh.audited(91, 1, "Bronze"):
        raise RuntimeError("x" * 9000)
    row = lh.meta("pipeline_runs").filter("run_id = 91").first()
    assert len(row["error_message"]) == 9000
    with lh.audited(91, 1, "Silver"):
        pass
    again = lh.meta("pipeline_runs").filter("run_id = 91").first()
    assert (again["start_time"], again["status"]) == (row["start_time"], "SUCCESS")


def test_upsert_without_order_keeps_one_row_per_key_and_rejects_new_columns(spark):
    from medallion.operators.upsert import upsert_frames

    target = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (2, "d")], "k int, v string")
    assert sorted(map(tuple, upsert_frames(target, updates, ["k"]).collect())) == [(1, "c"), (2, "d")]
    with pytest.raises(ValueError):
        upsert_frames(target, updates.withColumn("w", F.lit(1)), ["k"])


def test_mark_reads_back_in_another_zone(spark):
    from medallion.operators.silver import incremental_slice, max_mark

    df = spark.sql("SELECT timestamp'2024-01-01 11:00:00' + make_dt_interval(0, k) AS at FROM (SELECT explode(sequence(0, 2)) AS k)")
    mark = df.filter("hour(at) = 11").agg(max_mark(df, "at")).first()[0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert incremental_slice(df, "APPEND", "at", mark).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_layer_reset_starts_over(spark):
    lh = Lakehouse(spark, scratch_dir(spark, "reset"), namespace="resetlayers")
    lh.setup()
    with pytest.raises(ValueError):
        lh.setup(layers=True)
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    for db in ("bronze", "silver", "gold"):
        lh.store.replace(db, "t", rows)
    lh.store.append("bronze", "t", rows)
    lh.setup(reset=True, layers=True)
    assert not any(lh.store.exists(db, "t") for db in ("bronze", "silver", "gold"))
    assert lh.meta("tables").count() == 51
    lh.store.append("bronze", "t", rows)
    assert lh.store.read("bronze", "t").count() == 1


def house(spark, name):
    lh = Lakehouse(spark, scratch_dir(spark, name), namespace="h" + os.urandom(5).hex())
    lh.setup(seed=False)
    return lh


def run_row(lh, run_id, table_id):
    row = lh.meta("pipeline_runs").filter((F.col("run_id") == run_id) & (F.col("table_id") == table_id)).first()
    return row and row.asDict()


def test_retried_run_starts_over_in_bronze_only(spark):
    lh = house(spark, "retry")
    with pytest.raises(RuntimeError), lh.audited(1, 5, "Bronze"):
        raise RuntimeError("first")
    failed = run_row(lh, 1, 5)
    assert failed["status"] == "FAILED" and failed["error_message"] == "first"
    with lh.audited(1, 5, "Silver", end_on_success=False):
        assert run_row(lh, 1, 5) == failed  # a silver step leaves an existing row alone
    with lh.audited(1, 5, "Bronze") as rec:
        running = run_row(lh, 1, 5)
        assert (running["status"], running["end_time"], running["number_of_records"], running["error_message"]) == ("INPROGRESS", None, None, None)
        rec.records = 4
    assert (run_row(lh, 1, 5)["status"], run_row(lh, 1, 5)["number_of_records"]) == ("SUCCESS", 4)


@pytest.mark.parametrize("load_type", ["FULL", "APPEND"])
def test_failed_write_reports_the_slice(spark, monkeypatch, load_type):
    lh = house(spark, "failed-write")
    rows = spark.createDataFrame([(k, datetime(2024, 1, 1 + k)) for k in range(7)], "k int, at timestamp")
    lh.register(70, "t", "sqlserver", {"load_type": load_type, "primary_key": "k", "watermark_column": "at" if load_type == "APPEND" else None})
    lh.dispatch(70, 1, readers={"t": reader(rows)})
    lh.load_silver(70, 1)
    lh.advance_mark(70, 1, "2024-01-03 12:00:00")

    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(lh.store, "replace", broken)
    monkeypatch.setattr(lh.store, "append", broken)
    with pytest.raises(OSError):
        lh.load_silver(70, 2)
    assert (run_row(lh, 2, 70)["status"], run_row(lh, 2, 70)["number_of_records"]) == ("FAILED", 7 if load_type == "FULL" else 4)


def test_tables_load_at_the_same_time(spark):
    from concurrent.futures import ThreadPoolExecutor

    lh = house(spark, "concurrent")
    source = {k: spark.createDataFrame([(i, k) for i in range(20 + k)], "id int, v int") for k in (81, 82, 83)}

    def load(k):
        lh.register(k, f"t{k}", "sqlserver", {"load_type": "MERGE", "primary_key": "id", "watermark_column": "v"}, initial_mark="0")
        lh.dispatch(k, 1, readers={f"t{k}": reader(source[k])})
        lh.load_silver(k, 1)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, source))
    runs = {r["table_id"]: (r["status"], r["number_of_records"]) for r in lh.meta("pipeline_runs").collect()}
    assert runs == {k: ("SUCCESS", 20 + k) for k in source}
    assert {k: lh.last_mark(k) for k in source} == {k: str(k) for k in source}
    assert lh.meta("tables").count() == 3


def files_under(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")}


def test_metadata_write_touches_one_partition(spark):
    lh = house(spark, "partitions")
    for k in (11, 12):
        lh.register(k, f"t{k}", "sqlserver", {"load_type": "APPEND", "primary_key": "id", "watermark_column": "v"}, schema_json="[]")
    root = lh.store.table_dir("metadata", "")
    before = files_under(root)
    lh.register(12, "t12", "blob", {"load_type": "FULL"}, schema_json="[]")
    lh.run_begin(1, 12, "Bronze", datetime(2024, 1, 1))
    changed = before ^ files_under(root)
    assert changed and all("/table_id=12/" in f or "/table_name=t12/" in f for f in changed)
    assert {r["table_id"]: r["source_system"] for r in lh.meta("tables").collect()} == {11: "sqlserver", 12: "blob"}
    assert lh.params(12)["load_type"] == "FULL" and lh.params(12).get("primary_key") is None
    assert len(files_under(lh.folders["run_log"].path)) == 1
    for k in range(3):
        lh.run_end(1, 12, "SUCCESS", k, None)
    assert len(files_under(lh.folders["run_log"].path)) == 4  # one small file an event, however long the history


def test_silver_survives_a_failed_catalog_call(spark, monkeypatch):
    """A FULL load with a new schema whose CREATE fails: the rows of the last good load stay, the next load succeeds."""
    lh = house(spark, "swap")
    source = {"rows": spark.createDataFrame([(k, "a") for k in range(60)], "k int, v string")}
    lh.register(60, "t", "sqlserver", {"load_type": "FULL", "primary_key": "k"})
    lh.dispatch(60, 1, readers={"t": lambda *a: source["rows"]})
    lh.load_silver(60, 1)
    lh.store.replace("bronze", "t", lh.store.read("bronze", "t").withColumn("extra", F.lit(1)))
    real, calls = lh.store._create, []

    def failing(database, table, *rest):
        calls.append(table)
        if len(calls) <= how_often:
            raise RuntimeError("catalog is away")
        return real(database, table, *rest)

    for how_often in (1, 2):  # only the swap fails; putting the old entry back fails too
        calls.clear()
        monkeypatch.setattr(lh.store, "_create", failing)
        with pytest.raises(RuntimeError, match="catalog is away"):
            lh.load_silver(60, 1 + how_often)
        monkeypatch.setattr(lh.store, "_create", real)
        assert lh.store.read("silver", "t").count() == 60 and run_row(lh, 1 + how_often, 60)["status"] == "FAILED"
    lh.load_silver(60, 9)
    silver = lh.store.read("silver", "t")
    assert silver.count() == 60 and "extra" in silver.columns
