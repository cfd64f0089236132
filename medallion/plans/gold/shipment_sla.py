"""Gold: shipment_sla_summary — one row per shipment header attributes + delivery time.

shipment_header LEFT JOIN shipment_item, LEFT JOIN delivery_header (both on
shipment_id), grouped by the 8 header columns and actual_delivery_datetime.
The delivery join is an inner join plus the headers without delivery, so a hot
shipment can be split by AQE's skew handling.
The item count depends only on shipment_id, so items are aggregated once per
shipment (single COUNT(DISTINCT), map-side partial) and joined to the distinct
(header, delivery time) groups; the item fan-out is never materialised.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import hours_between
from medallion.plans.gold.common import need, stamp

NAME = "shipment_sla_summary"
HEADER_COLS = [
    "shipment_id",
    "shipment_type",
    "plant_code",
    "source_location",
    "destination_location",
    "carrier_id",
    "tracking_number",
    "shipment_datetime",
]
# SLA and category limits in whole hours.
SLA_HOURS = 48
FAST_HOURS = 24
NORMAL_FROM, NORMAL_TO = 25, 48


def sla_status(delivered: Column, hours: Column) -> Column:
    return (
        F.when(delivered.isNull(), F.lit("IN_TRANSIT"))
        .when(hours <= SLA_HOURS, F.lit("WITHIN_SLA"))
        .otherwise(F.lit("SLA_BREACHED"))
    )


def performance_category(hours: Column) -> Column:
    """<= 24 FAST; 25..48 NORMAL; else (also no delivery yet) DELAYED."""
    return (
        F.when(hours <= FAST_HOURS, F.lit("FAST_DELIVERY"))
        .when(hours.between(NORMAL_FROM, NORMAL_TO), F.lit("NORMAL_DELIVERY"))
        .otherwise(F.lit("DELAYED_DELIVERY"))
    )


def build(silver: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> DataFrame:
    header, item, delivery = need(silver, "shipment_header", "shipment_item", "delivery_header")
    deliveries = (
        delivery.filter(F.col("shipment_id").isNotNull()).select("shipment_id", "actual_delivery_datetime").distinct()
    )
    headers = header.select(*HEADER_COLS)
    # deliveries are distinct per shipment and time, so one left join is enough; the
    # skew-join rule splits a shipment with very many header rows
    groups = headers.join(deliveries, "shipment_id", "left").distinct()
    items = (
        item.filter(F.col("shipment_id").isNotNull())
        .groupBy("shipment_id")
        .agg(F.countDistinct("item_id").alias("total_items"))
    )
    j = groups.join(items, "shipment_id", "left")
    delivered = F.col("actual_delivery_datetime")
    hours = hours_between("shipment_datetime", delivered)
    return j.select(
        *HEADER_COLS,
        "actual_delivery_datetime",
        F.coalesce(F.col("total_items"), F.lit(0)).alias("total_items"),
        F.round(hours, 2).alias("delivery_duration_hours"),
        sla_status(delivered, hours).alias("sla_status"),
        performance_category(hours).alias("shipment_performance_category"),
        stamp(as_of).alias("gold_insert_timestamp"),
    )
