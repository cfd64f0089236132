"""Silver-shaped views over the driver's test tables (TPC-H-like parquet).

The reference ships no data; these mappings give every mart realistic input
whose size grows with the scale factor. The same mappings exist as DuckDB SQL
in ``__spark_entry__.oracle_sql`` so results can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_id(prefix: str = "") -> F.Column:
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
    )


def study_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    customer, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    k = F.col("n_nationkey")
    study_master = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        k.alias("study_id"),
        F.col("n_name").alias("study_name"),
        F.when(k % 3 == 0, "I").when(k % 3 == 1, "II").otherwise("III").alias("phase"),
        F.when(k % 2 == 0, "Oncology").otherwise("Cardiology").alias("therapeutic_area"),
        F.col("r_name").alias("region"),
        F.lit("v1").alias("protocol_version"),
    )
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("o_first"))
    seg = F.col("c_mktsegment")
    subject = customer.join(first, customer.c_custkey == first.o_custkey, "left").select(
        F.col("c_custkey").alias("subject_id"),
        F.col("c_nationkey").alias("study_id"),
        F.when(seg == "AUTOMOBILE", "Enrolled")
        .when(seg == "BUILDING", "Screen Failed")
        .when(seg == "FURNITURE", "Withdrawn")
        .when(seg == "HOUSEHOLD", "Completed")
        .otherwise("Screening")
        .alias("enrollment_status"),
        F.col("o_first").cast("date").alias("enrollment_date"),
    )
    return {"study_master": study_master, "subject": subject}


def lab_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation, customer = load(spark, sf_dir, "nation"), load(spark, sf_dir, "customer")
    orders, lineitem = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    lims_sample = nation.select(
        F.col("n_nationkey").alias("sample_id"),
        F.col("n_regionkey").alias("lab_id"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("received_datetime"),
    )
    accession = customer.select(F.col("c_custkey").alias("accession_id"), F.col("c_nationkey").alias("sample_id"))
    analysis = orders.select(F.col("o_orderkey").alias("analysis_id"), F.col("o_custkey").alias("accession_id"))
    result = lineitem.select(
        _line_id().alias("result_id"),
        F.col("l_orderkey").alias("analysis_id"),
        F.when(F.col("l_linestatus") == "F", "Final").otherwise("Preliminary").alias("result_status"),
        F.when(F.col("l_returnflag") == "R", "YES").otherwise("NO").alias("abnormal_flag"),
        F.when(F.col("l_returnflag") == "A", "YES").otherwise("NO").alias("critical_flag"),
        F.col("l_shipdate").alias("result_datetime"),
    )
    return {"lims_sample": lims_sample, "accession": accession, "analysis": analysis, "result": result}


def shipment_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lineitem = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    shipment_header = orders.select(
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_orderpriority").alias("shipment_type"),
        F.col("o_orderstatus").alias("plant_code"),
        F.lit("A").alias("source_location"),
        F.lit("B").alias("destination_location"),
        (F.col("o_custkey") % 7).alias("carrier_id"),
        F.col("o_orderkey").cast("string").alias("tracking_number"),
        F.col("o_orderdate").alias("shipment_datetime"),
    )
    shipment_item = lineitem.select(F.col("l_orderkey").alias("shipment_id"), F.col("l_linenumber").alias("item_id"))
    delivery_header = orders.filter(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").alias("shipment_id"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 72, F.col("o_orderdate")).alias("actual_delivery_datetime"),
    )
    return {"shipment_header": shipment_header, "shipment_item": shipment_item, "delivery_header": delivery_header}


def freezer_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    region, nation = load(spark, sf_dir, "region"), load(spark, sf_dir, "nation")
    supplier, lineitem = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "lineitem")
    freezer = region.select(
        F.col("r_regionkey").alias("freezer_id"),
        F.col("r_name").alias("freezer_name"),
        F.lit("ULT").alias("freezer_type"),
        F.col("r_name").alias("location"),
    )
    rack = nation.select(F.col("n_nationkey").alias("rack_id"), (F.col("n_nationkey") % 5).alias("freezer_id"))
    storage_box = supplier.select(F.col("s_suppkey").alias("box_id"), (F.col("s_suppkey") % 25).alias("rack_id"))
    storage_position = lineitem.select(
        _line_id().alias("position_id"),
        F.col("l_suppkey").alias("box_id"),
        F.when(F.col("l_partkey") % 100 < 65 + 8 * (F.col("l_suppkey") % 5), "Yes").otherwise("No").alias("is_occupied"),
    )
    return {"freezer": freezer, "rack": rack, "storage_box": storage_box, "storage_position": storage_position}


def tracking_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lineitem, events = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "events")
    lims_sample = orders.select(
        F.col("o_orderkey").alias("sample_id"),
        F.concat_ws("-", F.lit("BC"), F.col("o_orderkey").cast("string")).alias("sample_barcode"),
        F.col("o_custkey").alias("subject_id"),
        F.lit("V1").alias("visit_code"),
        F.lit("Serum").alias("sample_type"),
        F.col("o_orderdate").alias("collection_datetime"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderdate")).alias("received_datetime"),
        F.when(F.col("o_orderstatus") == "F", "Rejected")
        .when(F.col("o_orderstatus") == "P", "Lost")
        .otherwise("Stored")
        .alias("sample_status"),
        (F.col("o_custkey") % 5).alias("lab_id"),
    )
    accession = lineitem.select(
        _line_id().alias("accession_id"),
        F.col("l_orderkey").alias("sample_id"),
        F.col("l_shipdate").alias("accession_datetime"),
        F.col("l_linestatus").alias("accession_status"),
    )
    location = events.select(
        F.col("event_id").alias("location_event_id"),
        F.col("user_id").alias("sample_id"),
        "event_type",
        F.col("ts").alias("event_datetime"),
        F.col("props").alias("storage_location"),
    )
    return {"lims_sample": lims_sample, "accession": accession, "lims_sample_location": location}


SILVER_FOR_MART = {
    "study_enrollment_summary": study_silver,
    "lab_performance": lab_silver,
    "shipment_sla_summary": shipment_silver,
    "freezer_utilization_summary": freezer_silver,
    "sample_tracking_summary": tracking_silver,
}
