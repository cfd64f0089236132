"""Gold: sample_tracking_summary — one row per lims_sample row.

Latest accession and latest location event per sample (newest time first,
nulls last; ties by id, then the other columns) joined to every sample. The
"latest" step is a hash aggregate with map-side partial reduction instead of a
window sort (operators.latest), so a sample with a huge event history is
reduced on the mappers.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.latest import latest_per_key
from medallion.plans.gold.common import need, stamp

NAME = "sample_tracking_summary"
SAMPLE_COLS = [
    "sample_id",
    "sample_barcode",
    "subject_id",
    "visit_code",
    "sample_type",
    "collection_datetime",
    "received_datetime",
    "sample_status",
    "lab_id",
]
# sample_status spellings that decide the tracking status.
REJECTED, LOST = "Rejected", "Lost"


def tracking_status(received: Column, accession_id: Column, sample_status: Column) -> Column:
    """Ordered branches: not received, not accessioned, rejected, lost, tracked."""
    return (
        F.when(received.isNull(), F.lit("NOT_RECEIVED"))
        .when(accession_id.isNull(), F.lit("RECEIVED_NOT_ACCESSIONED"))
        .when(sample_status == REJECTED, F.lit("REJECTED"))
        .when(sample_status == LOST, F.lit("LOST"))
        .otherwise(F.lit("TRACKED"))
    )


def latest_accession(accession: DataFrame) -> DataFrame:
    return latest_per_key(
        accession,
        ["sample_id"],
        ["accession_datetime", "accession_id"],
        ["sample_id", "accession_id", "accession_datetime", "accession_status"],
        drop_null_keys=True,
    )


def latest_location(location: DataFrame) -> DataFrame:
    return latest_per_key(
        location,
        ["sample_id"],
        ["event_datetime", "location_event_id"],
        ["sample_id", "event_datetime", "location_event_id", "event_type", "storage_location"],
        drop_null_keys=True,
    )


def build(silver: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> DataFrame:
    sample, accession, location = need(silver, "lims_sample", "accession", "lims_sample_location")
    acc = latest_accession(accession)
    loc = latest_location(location).select(
        "sample_id",
        "storage_location",
        F.col("event_type").alias("latest_location_event"),
        F.col("event_datetime").alias("latest_location_event_time"),
    )
    j = sample.select(*SAMPLE_COLS).join(acc, "sample_id", "left").join(loc, "sample_id", "left")
    return j.select(
        *SAMPLE_COLS,
        "accession_id",
        "accession_datetime",
        "accession_status",
        "storage_location",
        "latest_location_event",
        "latest_location_event_time",
        tracking_status(F.col("received_datetime"), F.col("accession_id"), F.col("sample_status")).alias(
            "sample_tracking_status"
        ),
        stamp(as_of).alias("gold_insert_timestamp"),
    )
