"""Registry-, run- and key-value-shaped views over the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.plans.silver_views import load

# Fixed values for the test mapping of events to run rows.
EVENT_STATUS = {"error": "FAILED", "signup": "INPROGRESS", "view": None}
REGISTRY_SIZE = 51


def customer_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as ``tables``: active = positive balance, source_system = segment, load_order = nation."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("table_id"),
        F.col("c_name").alias("table_name"),
        F.col("c_mktsegment").alias("source_system"),
        (F.col("c_acctbal") > 0).alias("active_flag"),
        F.col("c_nationkey").alias("load_order"),
    )


def event_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as key-value parameter rows: table_id = user, name = event type, value = value, created_at = ts."""
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("table_id"),
        F.col("event_type").alias("parameter_name"),
        F.col("value").alias("parameter_value"),
        F.col("ts").alias("created_at"),
    )


def order_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as schema versions: table = customer, version = order key, active unless status F."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("table_name"),
        F.col("o_orderkey").alias("schema_version"),
        F.col("o_orderpriority").alias("schema_json"),
        (F.col("o_orderstatus") != "F").alias("active_flag"),
    )


def order_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as parameter rows; urgent orders carry the ``load_type`` parameter."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("table_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "load_type").otherwise("other").alias("parameter_name"),
        F.col("o_orderstatus").alias("parameter_value"),
    )


def supplier_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("table_id"), F.col("s_name").alias("last_watermark_value")
    )


def event_status() -> F.Column:
    et = F.col("event_type")
    expr = None
    for k, v in EVENT_STATUS.items():
        expr = (F.when(et == k, F.lit(v)) if expr is None else expr.when(et == k, F.lit(v)))
    return expr.otherwise(F.lit("SUCCESS"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as run-audit events: run_id = user, table_id = event_id % 51 + 1."""
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        (F.col("event_id") % REGISTRY_SIZE + 1).cast("int").alias("table_id"),
        F.col("event_id"),
        F.col("ts"),
        event_status().alias("status"),
        F.col("props"),
    )
