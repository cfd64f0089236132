"""Gold marts on hand-made rows: edge rules of SURVEY §2B, and the pre-aggregated
(path-count) plans checked against row-by-row Python models on random small inputs
with duplicate and null keys."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.plans.gold import MARTS

AS_OF = datetime(2030, 1, 1)
T0 = datetime(2024, 1, 1)
PROP = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def norm(v):
    if v is None:
        return None
    if hasattr(v, "as_tuple") or isinstance(v, float):
        return round(float(v), 6)
    return v


def table(df, cols=None):
    cols = cols or sorted(c for c in df.columns if c != "gold_insert_timestamp")
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def build(spark, name, frames):
    silver = {k: spark.createDataFrame(v[0], v[1]) for k, v in frames.items()}
    return MARTS[name].build(silver, AS_OF)


def rows_of(frames, name):
    data, schema = frames[name]
    names = [c.split()[0] for c in schema.split(", ")]
    return [dict(zip(names, r, strict=True)) for r in data]


def grow(paths, children, key):
    """Each path with each child of the same key; a path without children stays as it is."""
    out = []
    for path in paths:
        mine = [c for c in children if c[key] is not None and c[key] == path.get(key)]
        out += [path | c for c in mine] or [path]
    return out


def grouped(paths, names):
    groups = defaultdict(list)
    for path in paths:
        groups[tuple(path.get(n) for n in names)].append(path)
    return [(dict(zip(names, k, strict=True)), g) for k, g in groups.items()]


def values(group, name):
    return [v for v in (path.get(name) for path in group) if v is not None]


def kinds(group, name):
    return len(set(values(group, name)))


def places(x):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def percent(part, whole):
    return places(100 * part / whole) if whole else None


def whole_hours(start, end):
    return None if start is None or end is None else int((end - start).total_seconds() / 3600)


def model_table(rows):
    return sorted((tuple(norm(r[c]) for c in sorted(r)) for r in rows), key=repr)


ids = st.one_of(st.none(), st.integers(0, 3))
flag = st.sampled_from(["Yes", "No", "yes", None])
hours = st.one_of(st.none(), st.integers(-3, 80))


def ts(h):
    return None if h is None else T0 + timedelta(hours=h, minutes=30)


# ---- freezer utilization -------------------------------------------------------------------

FREEZER = "freezer_id int, freezer_name string, freezer_type string, location string"
RACK = "rack_id int, freezer_id int"
BOX = "box_id int, rack_id int"
POSITION = "position_id int, box_id int, is_occupied string"

def freezer_model(frames):
    paths = rows_of(frames, "freezer")
    for name, key in (("rack", "freezer_id"), ("storage_box", "rack_id"), ("storage_position", "box_id")):
        paths = grow(paths, rows_of(frames, name), key)
    for freezer, group in grouped(paths, ["freezer_id", "freezer_name", "freezer_type", "location"]):
        marks, positions = values(group, "is_occupied"), kinds(group, "position_id")
        share = percent(marks.count("Yes"), positions)
        status = "NORMAL"
        if share is not None and share >= 90:
            status = "CRITICAL"
        elif share is not None and 70 <= share <= 89:
            status = "HIGH_UTILIZATION"
        yield freezer | {
            "total_racks": kinds(group, "rack_id"), "total_boxes": kinds(group, "box_id"), "total_positions": positions,
            "occupied_positions": marks.count("Yes"), "available_positions": marks.count("No"),
            "utilization_percent": share, "utilization_status": status,
        }


@PROP
@given(
    freezers=st.lists(st.tuples(ids, st.sampled_from(["A", "B"])), min_size=1, max_size=4),
    racks=st.lists(st.tuples(ids, ids), max_size=6),
    boxes=st.lists(st.tuples(ids, ids), max_size=6),
    positions=st.lists(st.tuples(st.integers(0, 6), ids, flag), max_size=12),
)
def test_freezer_equals_brute_force(spark, freezers, racks, boxes, positions):
    frames = {
        "freezer": ([(f, n, "ULT", "L") for f, n in freezers], FREEZER),
        "rack": (racks, RACK),
        "storage_box": (boxes, BOX),
        "storage_position": (positions, POSITION),
    }
    got = build(spark, "freezer_utilization_summary", frames)
    assert table(got) == model_table(freezer_model(frames))


def test_freezer_boundaries_89_and_69_99(spark):
    # 89 % -> HIGH (BETWEEN 70 AND 89 includes 89); 6999 of 10000 = 69.99 % -> NORMAL
    positions = [(i, 1, "Yes" if i < 89 else "No") for i in range(100)]
    positions += [(1000 + i, 2, "Yes" if i < 6999 else "No") for i in range(10000)]
    frames = {
        "freezer": ([(1, "a", "t", "l"), (2, "b", "t", "l")], FREEZER),
        "rack": ([(1, 1), (2, 2)], RACK),
        "storage_box": ([(1, 1), (2, 2)], BOX),
        "storage_position": (positions, POSITION),
    }
    got = {r["freezer_id"]: r for r in build(spark, "freezer_utilization_summary", frames).collect()}
    assert (float(got[1]["utilization_percent"]), got[1]["utilization_status"]) == (89.0, "HIGH_UTILIZATION")
    assert (float(got[2]["utilization_percent"]), got[2]["utilization_status"]) == (69.99, "NORMAL")


def test_freezer_thresholds(spark):
    # 179/200 = 89.5 % falls in the 89..90 gap -> NORMAL; 180/200 = 90 % -> CRITICAL; 140/200 -> HIGH
    positions = []
    for box, occupied in ((1, 179), (2, 180), (3, 140)):
        positions += [(box * 1000 + i, box, "Yes" if i < occupied else "No") for i in range(200)]
    frames = {
        "freezer": ([(1, "a", "t", "l"), (2, "b", "t", "l"), (3, "c", "t", "l"), (4, "empty", "t", "l")], FREEZER),
        "rack": ([(1, 1), (2, 2), (3, 3)], RACK),
        "storage_box": ([(1, 1), (2, 2), (3, 3)], BOX),
        "storage_position": (positions, POSITION),
    }
    got = {r["freezer_id"]: r for r in build(spark, "freezer_utilization_summary", frames).collect()}
    assert (float(got[1]["utilization_percent"]), got[1]["utilization_status"]) == (89.5, "NORMAL")
    assert got[2]["utilization_status"] == "CRITICAL"
    assert got[3]["utilization_status"] == "HIGH_UTILIZATION"
    e = got[4]
    assert (e["total_racks"], e["total_positions"], e["occupied_positions"], e["utilization_percent"], e["utilization_status"]) == (
        0, 0, 0, None, "NORMAL",
    )


# ---- lab performance -----------------------------------------------------------------------

SAMPLE = "sample_id int, lab_id int, received_datetime timestamp"
ACCESSION = "accession_id int, sample_id int"
ANALYSIS = "analysis_id int, accession_id int"
RESULT = "result_id int, analysis_id int, result_status string, abnormal_flag string, critical_flag string, result_datetime timestamp"

def lab_model(frames):
    paths = rows_of(frames, "lims_sample")
    for name, key in (("accession", "sample_id"), ("analysis", "accession_id"), ("result", "analysis_id")):
        paths = grow(paths, rows_of(frames, name), key)
    for lab, group in grouped(paths, ["lab_id"]):
        times = values(group, "result_datetime")
        waits = [h for h in (whole_hours(p.get("received_datetime"), p.get("result_datetime")) for p in group) if h is not None]
        yield lab | {
            "total_samples": kinds(group, "sample_id"), "total_accessions": kinds(group, "accession_id"),
            "total_analyses": kinds(group, "analysis_id"), "total_results": kinds(group, "result_id"),
            "final_results": values(group, "result_status").count("Final"),
            "abnormal_results": values(group, "abnormal_flag").count("YES"),
            "critical_results": values(group, "critical_flag").count("YES"),
            "avg_turnaround_hours": places(sum(waits) / len(waits)) if waits else None,
            "first_result_datetime": min(times, default=None), "latest_result_datetime": max(times, default=None),
        }


@PROP
@given(
    samples=st.lists(st.tuples(ids, ids, hours), min_size=1, max_size=5),
    accessions=st.lists(st.tuples(ids, ids), max_size=6),
    analyses=st.lists(st.tuples(ids, ids), max_size=6),
    results=st.lists(
        st.tuples(st.integers(0, 8), ids, st.sampled_from(["Final", "final", None]), st.sampled_from(["YES", "NO"]), st.sampled_from(["YES", None]), hours),
        max_size=10,
    ),
)
def test_lab_equals_brute_force(spark, samples, accessions, analyses, results):
    frames = {
        "lims_sample": ([(s, lab, ts(h)) for s, lab, h in samples], SAMPLE),
        "accession": (accessions, ACCESSION),
        "analysis": (analyses, ANALYSIS),
        "result": ([(i, a, st_, ab, cr, ts(h)) for i, a, st_, ab, cr, h in results], RESULT),
    }
    got = build(spark, "lab_performance", frames)
    assert table(got) == model_table(lab_model(frames))


# ---- study enrollment ----------------------------------------------------------------------

STUDY = "study_id int, study_name string, phase string, therapeutic_area string, region string, protocol_version string"
SUBJECT = "subject_id int, study_id int, enrollment_status string, enrollment_date date"
STATUSES = ["Enrolled", "Screen Failed", "Withdrawn", "Completed", "enrolled", None]

def study_model(frames):
    paths = grow(rows_of(frames, "study_master"), rows_of(frames, "subject"), "study_id")
    for study, group in grouped(paths, [c.split()[0] for c in STUDY.split(", ")]):
        people, states, days = kinds(group, "subject_id"), values(group, "enrollment_status"), values(group, "enrollment_date")
        yield study | {
            "total_subjects": people, "enrolled_subjects": states.count("Enrolled"),
            "screen_failed_subjects": states.count("Screen Failed"), "withdrawn_subjects": states.count("Withdrawn"),
            "completed_subjects": states.count("Completed"),
            "enrollment_rate_percent": percent(states.count("Enrolled"), people),
            "screen_failure_rate_percent": percent(states.count("Screen Failed"), people),
            "first_enrollment_date": min(days, default=None), "latest_enrollment_date": max(days, default=None),
        }


@PROP
@given(
    studies=st.lists(st.tuples(ids, st.sampled_from(["x", "y"])), min_size=1, max_size=5),
    subjects=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), ids, st.sampled_from(STATUSES), st.integers(0, 9)), max_size=12),
)
def test_study_equals_brute_force(spark, studies, subjects):
    frames = {
        "study_master": ([(s, n, "I", "Onc", "EU", "v1") for s, n in studies], STUDY),
        "subject": ([(i, s, e, (T0 + timedelta(days=d)).date()) for i, s, e, d in subjects], SUBJECT),
    }
    got = build(spark, "study_enrollment_summary", frames)
    assert table(got) == model_table(study_model(frames))


def test_study_percent_can_pass_100_and_empty_study(spark):
    frames = {
        "study_master": ([(1, "a", "I", "Onc", "EU", "v1"), (2, "b", "I", "Onc", "EU", "v1")], STUDY),
        # subject 7 appears twice: sums count rows, the denominator counts subjects
        "subject": ([(7, 1, "Enrolled", None), (7, 1, "Enrolled", None)], SUBJECT),
    }
    got = {r["study_id"]: r for r in build(spark, "study_enrollment_summary", frames).collect()}
    assert (got[1]["total_subjects"], got[1]["enrolled_subjects"], float(got[1]["enrollment_rate_percent"])) == (1, 2, 200.0)
    assert (got[2]["total_subjects"], got[2]["enrolled_subjects"], got[2]["enrollment_rate_percent"]) == (0, 0, None)


# ---- shipment SLA --------------------------------------------------------------------------

HEADER = (
    "shipment_id int, shipment_type string, plant_code string, source_location string, destination_location string, "
    "carrier_id int, tracking_number string, shipment_datetime timestamp"
)
ITEM = "shipment_id int, item_id int"
DELIVERY = "shipment_id int, actual_delivery_datetime timestamp"


def test_shipment_sla_rules(spark):
    h = lambda i: (i, "t", "p", "A", "B", 1, str(i), T0)
    frames = {
        "shipment_header": ([h(1), h(2), h(3), h(4), h(5)], HEADER),
        "shipment_item": ([(1, 1), (1, 1), (1, 2), (2, 1)], ITEM),
        "delivery_header": (
            [
                (1, T0 + timedelta(hours=24, minutes=59)),  # 24 h -> FAST, WITHIN
                (2, T0 + timedelta(hours=48, minutes=59)),  # 48 h -> NORMAL, WITHIN
                (3, T0 + timedelta(hours=49)),  # 49 h -> DELAYED, BREACHED
                (4, T0 - timedelta(hours=1, minutes=30)),  # -1 h -> FAST
                (4, T0 + timedelta(hours=30)),  # second delivery -> second row
            ],
            DELIVERY,
        ),
    }
    got = {
        (r["shipment_id"], r["delivery_duration_hours"]): (r["total_items"], r["sla_status"], r["shipment_performance_category"])
        for r in build(spark, "shipment_sla_summary", frames).collect()
    }
    assert got == {
        (1, 24): (2, "WITHIN_SLA", "FAST_DELIVERY"),
        (2, 48): (1, "WITHIN_SLA", "NORMAL_DELIVERY"),
        (3, 49): (0, "SLA_BREACHED", "DELAYED_DELIVERY"),
        (4, -1): (0, "WITHIN_SLA", "FAST_DELIVERY"),
        (4, 30): (0, "WITHIN_SLA", "NORMAL_DELIVERY"),
        (5, None): (0, "IN_TRANSIT", "DELAYED_DELIVERY"),
    }


# ---- sample tracking -----------------------------------------------------------------------

TRACK_SAMPLE = (
    "sample_id int, sample_barcode string, subject_id int, visit_code string, sample_type string, "
    "collection_datetime timestamp, received_datetime timestamp, sample_status string, lab_id int"
)
TRACK_ACC = "accession_id int, sample_id int, accession_datetime timestamp, accession_status string"
LOCATION = "location_event_id int, sample_id int, event_type string, event_datetime timestamp, storage_location string"


def test_sample_tracking_status_and_latest(spark):
    s = lambda i, rec, status: (i, f"BC{i}", 1, "V1", "Serum", T0, rec, status, 1)
    frames = {
        # not received beats Rejected; not accessioned beats Lost (branch order)
        "lims_sample": ([s(1, None, "Rejected"), s(2, T0, "Lost"), s(3, T0, "Rejected"), s(4, T0, "Lost"), s(5, T0, "Stored")], TRACK_SAMPLE),
        "accession": (
            [
                (10, 1, T0, "A"),
                (30, 3, T0, "A"),
                (40, 4, T0, "A"),
                (50, 5, None, "null-time"),
                (51, 5, T0, "older"),
                (52, 5, T0 + timedelta(hours=1), "newest"),
            ],
            TRACK_ACC,
        ),
        "lims_sample_location": (
            [(1, 5, "IN", T0, "F1"), (2, 5, "MOVE", T0 + timedelta(hours=2), "F2"), (3, 5, "X", None, "F3")],
            LOCATION,
        ),
    }
    got = {r["sample_id"]: r for r in build(spark, "sample_tracking_summary", frames).collect()}
    assert {k: v["sample_tracking_status"] for k, v in got.items()} == {
        1: "NOT_RECEIVED",
        2: "RECEIVED_NOT_ACCESSIONED",
        3: "REJECTED",
        4: "LOST",
        5: "TRACKED",
    }
    assert (got[5]["accession_id"], got[5]["accession_status"]) == (52, "newest")
    assert (got[5]["storage_location"], got[5]["latest_location_event"]) == ("F2", "MOVE")
    assert got[2]["storage_location"] is None


def shipment_model(frames):
    paths = grow(grow(rows_of(frames, "shipment_header"), rows_of(frames, "shipment_item"), "shipment_id"), rows_of(frames, "delivery_header"), "shipment_id")
    for shipment, group in grouped(paths, [*(c.split()[0] for c in HEADER.split(", ")), "actual_delivery_datetime"]):
        took = whole_hours(shipment["shipment_datetime"], shipment["actual_delivery_datetime"])
        sla, speed = "SLA_BREACHED", "DELAYED_DELIVERY"
        if shipment["actual_delivery_datetime"] is None:
            sla = "IN_TRANSIT"
        elif took is not None and took <= 48:
            sla, speed = "WITHIN_SLA", "FAST_DELIVERY" if took <= 24 else "NORMAL_DELIVERY"
        yield shipment | {
            "total_items": kinds(group, "item_id"), "delivery_duration_hours": took,
            "sla_status": sla, "shipment_performance_category": speed,
        }


@PROP
@given(
    headers=st.lists(st.tuples(ids, st.sampled_from(["x", "y"]), hours), min_size=1, max_size=5),
    items=st.lists(st.tuples(ids, st.one_of(st.none(), st.integers(0, 4))), max_size=8),
    deliveries=st.lists(st.tuples(ids, hours), max_size=6),
)
def test_shipment_equals_brute_force(spark, headers, items, deliveries):
    frames = {
        "shipment_header": ([(i, t, "p", "A", "B", 1, "n", ts(h)) for i, t, h in headers], HEADER),
        "shipment_item": (items, ITEM),
        "delivery_header": ([(i, ts(h)) for i, h in deliveries], DELIVERY),
    }
    got = build(spark, "shipment_sla_summary", frames)
    assert table(got) == model_table(shipment_model(frames))
