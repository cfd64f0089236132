"""Operator queries over the test tables, one callable per key.

Each callable takes ``(spark, sf_dir)``, reads whole test tables and returns a
DataFrame. Queries that exercise storage (streams, bronze and silver loads,
run audit) write to a fresh folder under the session's checkpoint directory
and a catalog namespace of their own, then return the resulting table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions import count_where, hours_between, safe_percent
from medallion.operators import audit, registry
from medallion.operators.latest import latest_per_key
from medallion.operators.silver import advance_marks, incremental_slice, next_marks
from medallion.plans.lakehouse import Lakehouse
from medallion.plans.registry_views import (
    customer_registry,
    event_parameters,
    order_parameters,
    order_schemas,
    run_events,
    supplier_watermarks,
)
from medallion.plans.silver_views import load
from medallion.session import scratch_dir
from medallion.sources.csv import RESCUE_COLUMN, csv_batch
from medallion.sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the test mappings.
EVENT_TYPES = ("view", "signup", "click", "error", "purchase")
PLAN_SOURCE_SYSTEM = "Building"
WATERMARK_MARK = "1998-01-01 00:00:00"
ADVANCE_SLICE_MARK = "2001-01-01 00:00:00"
SPLIT_DATE = "1999-01-01 00:00:00"
UPDATE_FROM = "1998-01-01 00:00:00"
UPDATED_AT = "2002-01-01 00:00:00"
RESCUE_SEGMENT = "MACHINERY"
AUDIT_COLUMNS = ("insert_timestamp", "update_timestamp", "source_file_name")


def _namespace() -> str:
    return "q" + uuid.uuid4().hex[:12]


def _lakehouse(spark: SparkSession, name: str) -> Lakehouse:
    lh = Lakehouse(spark, scratch_dir(spark, name), namespace=_namespace())
    lh.setup(seed=False)
    return lh


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


# ---- expressions and small operators --------------------------------------------------------


def latest_row_per_key(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(load(spark, d, "events"), ["user_id"], ["ts", "event_id"])


def hours_between_query(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        hours_between("o_orderdate", "l_shipdate").alias("ship_hours"),
    )


def safe_percent_query(spark: SparkSession, d: str) -> DataFrame:
    """orders LEFT JOIN lineitem, per order: lines, returned lines, returned share (null when no lines).

    lineitem is reduced per order key before the join (partial aggregation on
    the mappers), and duplicate order rows are counted, so the result equals
    grouping the joined rows.
    """
    per_order = (
        load(spark, d, "lineitem")
        .filter(F.col("l_orderkey").isNotNull())
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("_lines"), count_where(F.col("l_returnflag") == "R").alias("_returned"))
    )
    orders = load(spark, d, "orders").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("_copies"))
    j = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    lines = F.coalesce(F.col("_lines"), F.lit(0)) * F.col("_copies")
    returned = F.coalesce(F.col("_returned"), F.lit(0)) * F.col("_copies")
    return j.select(
        "o_orderkey",
        lines.alias("line_count"),
        returned.alias("returned_lines"),
        safe_percent(returned, lines).alias("returned_percent"),
    )


# ---- registry ---------------------------------------------------------------------------------


def table_plan(spark: SparkSession, d: str) -> DataFrame:
    return registry.plan_tables(customer_registry(spark, d), PLAN_SOURCE_SYSTEM)


def table_params(spark: SparkSession, d: str) -> DataFrame:
    return registry.table_params(event_parameters(spark, d), names=EVENT_TYPES)


def load_type_listing(spark: SparkSession, d: str) -> DataFrame:
    return registry.load_type_listing(customer_registry(spark, d), order_parameters(spark, d))


def schema_latest(spark: SparkSession, d: str) -> DataFrame:
    return registry.latest_schemas(order_schemas(spark, d))


def metadata_counts(spark: SparkSession, d: str) -> DataFrame:
    return registry.metadata_counts(customer_registry(spark, d), event_parameters(spark, d), supplier_watermarks(spark, d))


# ---- sources ------------------------------------------------------------------------------------

CUSTOMER_SCHEMA = [
    ("c_custkey", "integer"),
    ("c_name", "string"),
    ("c_nationkey", "integer"),
    ("c_acctbal", "string"),
    ("c_mktsegment", "string"),
]


def _customer_landing(spark: SparkSession, d: str, lh: Lakehouse, corrupt: bool) -> str:
    """Write customer as CSV files (one per input partition) into a landing folder."""
    customer = load(spark, d, "customer")
    if corrupt:
        # Rows of one segment get a non-integer nation key (misfit field -> rescue column).
        customer = customer.withColumn(
            "c_nationkey",
            F.when(F.col("c_mktsegment") == RESCUE_SEGMENT, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).otherwise(
                F.col("c_nationkey").cast("string")
            ),
        )
    path = f"{lh.root}/landing/customer"
    customer.select(*[c for c, _ in CUSTOMER_SCHEMA]).write.option("header", True).csv(path)
    return path


def _ingest_customer(spark: SparkSession, d: str, corrupt: bool, **params: str) -> tuple[Lakehouse, DataFrame]:
    lh = _lakehouse(spark, "bronze-stream")
    path = _customer_landing(spark, d, lh, corrupt)
    schema = json.dumps([{"name": n, "type": t} for n, t in CUSTOMER_SCHEMA])
    lh.register(9001, "customer", "blob", {"load_type": "FULL", "primary_key": "c_custkey", **params}, source_path=path, schema_json=schema)
    first = lh.dispatch(9001, run_id=1)
    again = lh.dispatch(9001, run_id=2)
    if again.records != 0:
        raise RuntimeError(f"rerun without new files ingested {again.records} rows")
    if first.records is None:
        raise RuntimeError("first ingest reported no row count")
    return lh, lh.store.read("bronze", "customer")


def bronze_file_stream(spark: SparkSession, d: str) -> DataFrame:
    _, bronze = _ingest_customer(spark, d, corrupt=False)
    return bronze.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


def bronze_rescued_rows(spark: SparkSession, d: str) -> DataFrame:
    _, bronze = _ingest_customer(spark, d, corrupt=True)
    return bronze.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_nationkey",
        F.col(RESCUE_COLUMN).isNotNull().alias("rescued"),
    )


def bronze_rescued_fields(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a misfit field keep their other fields; the rescue column holds just that field."""
    _, bronze = _ingest_customer(spark, d, corrupt=True, rescue="fields")
    return bronze.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment", F.col(RESCUE_COLUMN).alias("rescued"))


def _supplier_csv(spark: SparkSession, d: str, header: bool) -> DataFrame:
    path = scratch_dir(spark, "csv-batch") + "/supplier"
    load(spark, d, "supplier").write.option("header", header).csv(path)
    return csv_batch(spark, path, header=header)


def csv_batch_header(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_csv(spark, d, header=True)


def csv_batch_no_header(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_csv(spark, d, header=False)


def _orders_reader(spark: SparkSession, d: str):
    orders = load(spark, d, "orders")
    return lambda load_type, mark_col, last: incremental_slice(orders, load_type, mark_col, last)


def bronze_bounded_full(spark: SparkSession, d: str) -> DataFrame:
    """Bounded source (the JDBC path's reader contract) -> bronze, FULL: the whole table."""
    lh = _lakehouse(spark, "bronze-full")
    lh.register(9002, "orders", "sqlserver", {"load_type": "FULL", "primary_key": "o_orderkey"})
    lh.dispatch(9002, run_id=1, readers={"orders": _orders_reader(spark, d)})
    return _without_audit(lh.store.read("bronze", "orders"))


def bronze_bounded_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Bounded source -> bronze, APPEND with a stored mark: only rows after the mark."""
    lh = _lakehouse(spark, "bronze-incr")
    lh.register(
        9003, "orders", "sqlserver",
        {"load_type": "APPEND", "primary_key": "o_orderkey", "watermark_column": "o_orderdate"},
        initial_mark=WATERMARK_MARK,
    )
    lh.dispatch(9003, run_id=1, readers={"orders": _orders_reader(spark, d)})
    return _without_audit(lh.store.read("bronze", "orders"))


# ---- bronze -> silver -----------------------------------------------------------------------------


def watermark_filter(spark: SparkSession, d: str) -> DataFrame:
    return incremental_slice(load(spark, d, "orders"), "APPEND", "o_orderdate", WATERMARK_MARK)


def watermark_advance(spark: SparkSession, d: str) -> DataFrame:
    """Marks per customer: start at the first order date; advanced to the max of the slice after
    a later mark; customers without slice rows keep their mark."""
    orders = load(spark, d, "orders")
    old = orders.groupBy("o_custkey").agg(F.min("o_orderdate").cast("string").alias("last_watermark_value"))
    sl = incremental_slice(orders, "APPEND", "o_orderdate", ADVANCE_SLICE_MARK)
    return advance_marks(old, next_marks(sl, "o_custkey", "o_orderdate"), "o_custkey")


def _orders_silver(spark: SparkSession, d: str, name: str, params: dict, runs: list) -> DataFrame:
    """Register orders, then per run: bounded source -> bronze, bronze -> silver."""
    lh = _lakehouse(spark, name)
    lh.register(9004, "orders", "sqlserver", params)
    for run_id, source in enumerate(runs, start=1):
        reader = (lambda src: lambda lt, mc, last: incremental_slice(src, lt, mc, last))(source)
        lh.dispatch(9004, run_id=run_id, readers={"orders": reader})
        lh.load_silver(9004, run_id=run_id)
    for r in lh.meta("pipeline_runs").filter(F.col("status") != audit.SUCCESS).collect():
        raise RuntimeError(f"run {r['run_id']} ended {r['status']}: {r['error_message']}")
    return _without_audit(lh.store.read("silver", "orders"))


def silver_first_load(spark: SparkSession, d: str) -> DataFrame:
    params = {"load_type": "MERGE", "primary_key": "o_orderkey", "watermark_column": "o_orderdate"}
    return _orders_silver(spark, d, "silver-first", params, [load(spark, d, "orders")])


def silver_full(spark: SparkSession, d: str) -> DataFrame:
    """FULL twice over the same bronze slice: the second load replaces, it does not add."""
    orders = load(spark, d, "orders")
    params = {"load_type": "FULL", "primary_key": "o_orderkey"}
    lh = _lakehouse(spark, "silver-full")
    lh.register(9004, "orders", "sqlserver", params)
    lh.dispatch(9004, run_id=1, readers={"orders": lambda lt, mc, last: orders})
    lh.load_silver(9004, run_id=1)
    lh.load_silver(9004, run_id=2)
    return _without_audit(lh.store.read("silver", "orders"))


def silver_append(spark: SparkSession, d: str) -> DataFrame:
    """Two incremental runs: the source first holds orders before the split date, then all.
    The second run brings only rows after the mark, so silver ends with every order once."""
    orders = load(spark, d, "orders")
    params = {"load_type": "APPEND", "primary_key": "o_orderkey", "watermark_column": "o_orderdate"}
    early = orders.filter(F.col("o_orderdate") < _ts(SPLIT_DATE))
    return _orders_silver(spark, d, "silver-append", params, [early, orders])


def silver_merge(spark: SparkSession, d: str) -> DataFrame:
    """Run 1 loads orders before the split date; run 2 re-delivers every order from
    UPDATE_FROM on with a changed price and a later ``updated_at``: matched keys are
    updated, new keys inserted, older rows kept."""
    orders = load(spark, d, "orders")
    early = orders.filter(F.col("o_orderdate") < _ts(SPLIT_DATE)).withColumn("updated_at", F.col("o_orderdate"))
    changed = orders.filter(F.col("o_orderdate") >= _ts(UPDATE_FROM)).withColumns(
        {"o_totalprice": F.col("o_totalprice") + F.lit(1.0), "updated_at": _ts(UPDATED_AT)}
    )
    params = {"load_type": "MERGE", "primary_key": "o_orderkey", "watermark_column": "updated_at"}
    return _orders_silver(spark, d, "silver-merge", params, [early, changed])


def silver_merge_no_mark(spark: SparkSession, d: str) -> DataFrame:
    """MERGE without a mark column, twice over one bronze table: every order line is a source row for its order,
    and one row per order stays (the greatest in its other columns)."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lh = _lakehouse(spark, "silver-no-mark")
    lh.register(9005, "order_line", "sqlserver", {"load_type": "MERGE", "primary_key": "l_orderkey"})
    lh.dispatch(9005, run_id=1, readers={"order_line": lambda lt, mc, last: lines})
    lh.load_silver(9005, run_id=1)
    lh.load_silver(9005, run_id=2)
    return _without_audit(lh.store.read("silver", "order_line"))


def silver_zoned_mark(spark: SparkSession, d: str) -> DataFrame:
    """APPEND on a zoned mark with the session in another time zone for the second run: no row is lost or repeated."""
    instant = F.timestamp_seconds(F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)"))  # the same in any zone
    dated = load(spark, d, "orders")
    orders, early = (x.select("o_orderkey", instant.alias("ordered_at")) for x in (dated, dated.filter(F.col("o_orderdate") < _ts(SPLIT_DATE))))
    lh = _lakehouse(spark, "silver-zoned")
    lh.register(9006, "orders", "sqlserver", {"load_type": "APPEND", "primary_key": "o_orderkey", "watermark_column": "ordered_at"})
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for run_id, (source, tz) in enumerate(((early, zone), (orders, "Asia/Tokyo")), start=1):
            spark.conf.set("spark.sql.session.timeZone", tz)
            lh.dispatch(9006, run_id=run_id, readers={"orders": (lambda src: lambda lt, mc, last: incremental_slice(src, lt, mc, last))(source)})
            lh.load_silver(9006, run_id=run_id)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return lh.store.read("silver", "orders").select("o_orderkey", F.unix_seconds("ordered_at").alias("ordered_at"))


def silver_file_lineage(spark: SparkSession, d: str) -> DataFrame:
    """CSV files -> bronze -> silver: rows by the landing folder that ``source_file_name`` names, in silver."""
    lh, _ = _ingest_customer(spark, d, corrupt=False)
    lh.load_silver(9001, run_id=3)
    folder = F.regexp_extract("source_file_name", "/landing/([^/]+)/[^/]+[.]csv$", 1)
    return lh.store.read("silver", "customer").groupBy(folder.alias("landing_folder")).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("insert_timestamp").isNull() | F.col("update_timestamp").isNull()).alias("unstamped")
    )


LINE_KEY = "l_orderkey,l_linenumber,l_partkey,l_suppkey"


def silver_merge_composite(spark: SparkSession, d: str) -> DataFrame:
    """MERGE on a comma-separated composite registry key through the table store."""
    lines = load(spark, d, "lineitem")
    store = TableStore(spark, scratch_dir(spark, "merge-composite"), namespace=_namespace())
    base = lines.filter(F.col("l_shipdate") < _ts(SPLIT_DATE))
    updates = lines.filter(F.col("l_shipdate") >= _ts(UPDATE_FROM)).withColumn("l_quantity", F.col("l_quantity") + F.lit(1.0))
    store.replace("silver", "lineitem", base)
    store.upsert("silver", "lineitem", updates, LINE_KEY, bucketed=True)
    return store.read("silver", "lineitem")


# ---- run audit --------------------------------------------------------------------------------------

def _runs_plan(spark: SparkSession, d: str) -> DataFrame:
    """Every event begins its (run, table) row; SUCCESS / FAILED events end it."""
    error = F.when(F.col("status") == audit.FAILED, F.col("props")).alias("error_message")
    counted = F.col("event_id").alias("number_of_records")
    layer = F.lit("Silver").alias("layer")
    return audit.fold_events(run_events(spark, d).select("run_id", "table_id", layer, F.col("ts").alias("time"), "status", counted, error))


def audit_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """Events as the pipeline logs them, folded from its stored log: a running (or unknown) status is a bronze step
    that begins the row anew, SUCCESS or FAILED a silver step that joins the row and ends it."""
    lh = _lakehouse(spark, "audit")
    ended = F.col("status").isin(audit.SUCCESS, audit.FAILED)
    ev = run_events(spark, d).withColumn("done", F.coalesce(ended, F.lit(False)))
    at = [F.col("ts").alias("time"), F.col("event_id").alias("seq")]
    nothing = [F.lit(None).cast("string").alias("status"), F.lit(None).cast("bigint").alias("number_of_records"), F.lit(None).cast("string").alias("error_message")]
    layer = F.when(F.col("done"), "Silver").otherwise("Bronze").alias("layer")
    kind = F.when(F.col("done"), audit.begin_kind("Silver")).otherwise(audit.begin_kind("Bronze")).alias("kind")
    begins = ev.select("run_id", "table_id", layer, kind, *at, *nothing)
    error = F.when(F.col("status") == audit.FAILED, F.col("props")).alias("error_message")
    ends = ev.filter("done").select(
        "run_id", "table_id", F.lit(None).cast("string").alias("layer"), F.lit(audit.END).alias("kind"), *at, "status", F.col("event_id").alias("number_of_records"), error
    )
    lh.log_runs(begins.unionByName(ends))
    rows = lh.meta("pipeline_runs")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


def run_history(spark: SparkSession, d: str) -> DataFrame:
    return audit.run_history(_runs_plan(spark, d))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.run_summary(_runs_plan(spark, d), customer_registry(spark, d))


def run_status(spark: SparkSession, d: str) -> DataFrame:
    return audit.run_status(_runs_plan(spark, d))


OPERATOR_QUERIES: dict[str, Query] = {
    "latest_row_per_key": latest_row_per_key,
    "hours_between": hours_between_query,
    "safe_percent": safe_percent_query,
    "table_plan": table_plan,
    "table_params": table_params,
    "load_type_listing": load_type_listing,
    "schema_latest": schema_latest,
    "metadata_counts": metadata_counts,
    "bronze_file_stream": bronze_file_stream,
    "bronze_rescued_rows": bronze_rescued_rows,
    "bronze_rescued_fields": bronze_rescued_fields,
    "csv_batch_header": csv_batch_header,
    "csv_batch_no_header": csv_batch_no_header,
    "bronze_bounded_full": bronze_bounded_full,
    "bronze_bounded_incremental": bronze_bounded_incremental,
    "watermark_filter": watermark_filter,
    "watermark_advance": watermark_advance,
    "silver_first_load": silver_first_load,
    "silver_full": silver_full,
    "silver_append": silver_append,
    "silver_merge": silver_merge,
    "silver_merge_composite": silver_merge_composite,
    "silver_merge_no_mark": silver_merge_no_mark,
    "silver_zoned_mark": silver_zoned_mark,
    "silver_file_lineage": silver_file_lineage,
    "audit_lifecycle": audit_lifecycle,
    "run_history": run_history,
    "run_summary": run_summary,
    "run_status": run_status,
}

