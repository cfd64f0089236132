"""Physical plan shape: filters reach the Parquet scan, scans read only used columns,
no unconditional broadcast of growing data."""

from __future__ import annotations

import re
from collections import Counter

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for ln in text.splitlines():
        if "FileScan" in ln or "Scan parquet" in ln:
            f = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            r = re.search(r"ReadSchema: struct<(.*)>", ln)
            out.append((f.group(1) if f else "", [c.split(":")[0] for c in r.group(1).split(",")] if r else []))
    return out


def test_watermark_filter_reaches_scan(spark):
    (pushed, _), = scans(E.queries()["watermark_filter"](spark, SF))
    assert "GreaterThan(o_orderdate" in pushed


def test_marts_prune_columns(spark):
    cols = {tuple(sorted(c)) for _, c in scans(E.queries()["gold_study_enrollment_summary"](spark, SF))}
    assert ("o_custkey", "o_orderdate") in cols  # 2 of 6 order columns
    assert ("c_custkey", "c_mktsegment", "c_nationkey") in cols


def test_no_hint_broadcast_in_marts(spark):
    for name in E.queries():
        if name.startswith("gold_"):
            plan = E.queries()[name](spark, SF)._jdf.queryExecution().analyzed().toString()
            assert "broadcast" not in plan.lower(), name


def test_marts_scan_each_table_once(spark):
    """Distinct counts of several levels reuse the exchange of each level's paths."""
    for mart, tables in {
        "gold_lab_performance": ("nation", "customer", "orders", "lineitem"),
        "gold_freezer_utilization_summary": ("region", "nation", "supplier", "lineitem"),
    }.items():
        df = E.queries()[mart](spark, SF)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        read = Counter(re.findall(r"FileScan.*/(\w+)\.parquet", final))
        assert read == dict.fromkeys(tables, 1), (mart, read)
