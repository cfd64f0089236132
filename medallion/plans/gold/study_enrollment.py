"""Gold: study_enrollment_summary — one row per study (6 attributes).

study_master LEFT JOIN subject ON study_id, grouped by the study attributes.
Every study row with a given study_id reaches the same subjects, so subject
stats are computed once per study_id (one aggregate over the big subject table,
a single COUNT(DISTINCT) -> no Expand) and scaled by the number of identical
study rows in the group.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import count_where, safe_percent
from medallion.plans.gold.common import need, stamp

NAME = "study_enrollment_summary"
STUDY_COLS = ["study_id", "study_name", "phase", "therapeutic_area", "region", "protocol_version"]
# enrollment_status spellings the mart counts.
ENROLLED, SCREEN_FAILED, WITHDRAWN, COMPLETED = "Enrolled", "Screen Failed", "Withdrawn", "Completed"


def build(silver: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> DataFrame:
    study, subject = need(silver, "study_master", "subject")
    groups = study.groupBy(*STUDY_COLS).agg(F.count(F.lit(1)).alias("_copies"))
    status = F.col("enrollment_status")
    per_study = (
        subject.filter(F.col("study_id").isNotNull())
        .groupBy("study_id")
        .agg(
            F.countDistinct("subject_id").alias("_distinct"),
            count_where(status == ENROLLED).alias("_enrolled"),
            count_where(status == SCREEN_FAILED).alias("_failed"),
            count_where(status == WITHDRAWN).alias("_withdrawn"),
            count_where(status == COMPLETED).alias("_completed"),
            F.min("enrollment_date").alias("first_enrollment_date"),
            F.max("enrollment_date").alias("latest_enrollment_date"),
        )
    )
    j = groups.join(per_study, "study_id", "left")

    def scaled(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)) * F.col("_copies")

    total = F.coalesce(F.col("_distinct"), F.lit(0))
    return j.select(
        *STUDY_COLS,
        total.alias("total_subjects"),
        scaled("_enrolled").alias("enrolled_subjects"),
        scaled("_failed").alias("screen_failed_subjects"),
        scaled("_withdrawn").alias("withdrawn_subjects"),
        scaled("_completed").alias("completed_subjects"),
        safe_percent(scaled("_enrolled"), total).alias("enrollment_rate_percent"),
        safe_percent(scaled("_failed"), total).alias("screen_failure_rate_percent"),
        "first_enrollment_date",
        "latest_enrollment_date",
        stamp(as_of).alias("gold_insert_timestamp"),
    )
