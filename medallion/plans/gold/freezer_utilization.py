"""Gold: freezer_utilization_summary — one row per freezer (4 attributes).

freezer -> rack -> storage_box -> storage_position, all left joins. Racks and
boxes are reduced to path counts per freezer_id (see operators.rollup); the
position table is read once, joined to the box-level paths and aggregated per
freezer_id with a single COUNT(DISTINCT position_id).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import safe_percent, weighted_count_where
from medallion.operators.rollup import W, descend, distinct_nodes, fold_stats, live, root_paths
from medallion.plans.gold.common import need, stamp

NAME = "freezer_utilization_summary"
FREEZER_COLS = ["freezer_id", "freezer_name", "freezer_type", "location"]
# Occupancy flag spellings (case-sensitive) and status limits.
OCCUPIED, AVAILABLE = "Yes", "No"
CRITICAL_AT = 90
HIGH_FROM, HIGH_TO = 70, 89


def utilization_status(util: Column) -> Column:
    """>= 90 CRITICAL; BETWEEN 70 AND 89 HIGH_UTILIZATION; else NORMAL (89 < u < 90 is NORMAL)."""
    return (
        F.when(util >= CRITICAL_AT, F.lit("CRITICAL"))
        .when(util.between(HIGH_FROM, HIGH_TO), F.lit("HIGH_UTILIZATION"))
        .otherwise(F.lit("NORMAL"))
    )


def per_freezer_stats(silver: Mapping[str, DataFrame]) -> DataFrame:
    rack, box, position = need(silver, "rack", "storage_box", "storage_position")
    key = ["freezer_id"]
    racks = root_paths(rack.filter(F.col("freezer_id").isNotNull()), key, "rack_id")
    boxes = descend(racks, key, "rack_id", box, "rack_id", "box_id")
    pos = position.select("box_id", "position_id", "is_occupied").filter(F.col("box_id").isNotNull())
    leaf = (
        live(boxes, key, "box_id", "box_id")
        .join(pos, "box_id")
        .groupBy("freezer_id")
        .agg(
            F.countDistinct("position_id").alias("total_positions"),
            weighted_count_where(F.col("is_occupied") == OCCUPIED, W).alias("_occupied"),
            weighted_count_where(F.col("is_occupied") == AVAILABLE, W).alias("_available"),
        )
    )
    upper = distinct_nodes([(racks, "rack_id", "total_racks"), (boxes, "box_id", "total_boxes")], key)
    return fold_stats([upper, leaf], key)


def build(silver: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> DataFrame:
    (freezer,) = need(silver, "freezer")
    groups = freezer.groupBy(*FREEZER_COLS).agg(F.count(F.lit(1)).alias("_copies"))
    j = groups.join(per_freezer_stats(silver), "freezer_id", "left")

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    occupied = zero("_occupied") * F.col("_copies")
    positions = zero("total_positions")
    util = safe_percent(occupied, positions)
    return j.select(
        *FREEZER_COLS,
        zero("total_racks").alias("total_racks"),
        zero("total_boxes").alias("total_boxes"),
        positions.alias("total_positions"),
        occupied.alias("occupied_positions"),
        (zero("_available") * F.col("_copies")).alias("available_positions"),
        util.alias("utilization_percent"),
        utilization_status(util).alias("utilization_status"),
        stamp(as_of).alias("gold_insert_timestamp"),
    )
