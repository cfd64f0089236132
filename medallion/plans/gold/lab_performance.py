"""Gold: lab_performance — one row per lab_id (a null lab is its own group).

lims_sample -> accession -> analysis -> result, all left joins. The upper
levels become path counts keyed by (lab_id, received_datetime, node); the
received time is carried because turnaround is TIMESTAMPDIFF(HOUR) between the
sample's receipt and each result, which does not split into sums. Each table is
read once: the upper levels' distinct counts share one distinct over the stacked
paths, whose exchanges the next level reuses. The results are joined to the
analysis-level paths and aggregated per lab with a single COUNT(DISTINCT result_id).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions import hours_between, weighted_count_where
from medallion.operators.rollup import W, descend, distinct_nodes, fold_stats, live, root_paths
from medallion.plans.gold.common import need, stamp

NAME = "lab_performance"
# result_status / flag spellings the mart counts (case-sensitive).
FINAL, FLAG_YES = "Final", "YES"


def build(silver: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> DataFrame:
    sample, accession, analysis, result = need(silver, "lims_sample", "accession", "analysis", "result")
    lab = ["lab_id"]
    carry = ["lab_id", "received_datetime"]
    samples = root_paths(sample, carry, "sample_id")
    accessions = descend(samples, carry, "sample_id", accession, "sample_id", "accession_id")
    analyses = descend(accessions, carry, "accession_id", analysis, "accession_id", "analysis_id")
    res = result.select("analysis_id", "result_id", "result_status", "abnormal_flag", "critical_flag", "result_datetime")
    hours = F.col("_hours")
    leaf = (
        live(analyses, carry, "analysis_id", "analysis_id")
        .join(res.filter(F.col("analysis_id").isNotNull()), "analysis_id")
        .withColumn("_hours", hours_between("received_datetime", "result_datetime"))
        .groupBy(*lab)
        .agg(
            F.countDistinct("result_id").alias("total_results"),
            weighted_count_where(F.col("result_status") == FINAL, W).alias("final_results"),
            weighted_count_where(F.col("abnormal_flag") == FLAG_YES, W).alias("abnormal_results"),
            weighted_count_where(F.col("critical_flag") == FLAG_YES, W).alias("critical_results"),
            F.sum(hours * F.col(W)).alias("_hours_sum"),
            F.sum(F.when(hours.isNotNull(), F.col(W))).alias("_hours_n"),
            F.min("result_datetime").alias("first_result_datetime"),
            F.max("result_datetime").alias("latest_result_datetime"),
        )
    )
    upper = distinct_nodes(
        [
            (samples, "sample_id", "total_samples"),
            (accessions, "accession_id", "total_accessions"),
            (analyses, "analysis_id", "total_analyses"),
        ],
        lab,
    )
    stats = fold_stats([upper, leaf], lab)

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).alias(c)

    return stats.select(
        "lab_id",
        zero("total_samples"),
        zero("total_accessions"),
        zero("total_analyses"),
        zero("total_results"),
        zero("final_results"),
        zero("abnormal_results"),
        zero("critical_results"),
        F.round(F.col("_hours_sum") / F.col("_hours_n"), 2).alias("avg_turnaround_hours"),
        "first_result_datetime",
        "latest_result_datetime",
        stamp(as_of).alias("gold_insert_timestamp"),
    )
