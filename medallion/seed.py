"""Registry seed: the metadata rows the pipeline is configured with.

Fixed values (must equal the reference's configuration for the same tables to
load the same way), stated in the reference's order. Parameter rows, watermark
rows and schema JSON are produced from them by rule.
"""

from __future__ import annotations

import json

# ---- Fixed values: file tables (CTMS landing folders) ------------------------
# (table_id, table_name, load_order, primary_key); all load_type FULL.
FILE_TABLES = [
    (1, "study_master", 1, "study_id"),
    (2, "site_master", 3, "site_id"),
    (3, "visit_schedule", 6, "visit_code"),
    (4, "sample_plan", 9, "sample_plan_id"),
    (33, "consent_master", 13, "consent_id"),
    (34, "investigator_master", 5, "investigator_id"),
    (35, "protocol_version", 2, "protocol_version_id"),
    (36, "sample_type_master_ctms", 8, "sample_type_id"),
    (37, "study_enrollment_plan", 12, "enrollment_plan_id"),
    (38, "study_site_map", 4, "study_site_map_id"),
    (39, "test_plan", 10, "test_plan_id"),
    (40, "treatment_arm", 11, "treatment_arm_id"),
    (41, "visit_activity_plan", 7, "visit_activity_plan_id"),
]

# ---- Fixed values: database tables --------------------------------------------
# (table_id, table_name, source_schema, load_order, load_type, primary_key, watermark_column)
DB_TABLES = [
    (5, "subject", "clinical_data", 5, "MERGE", "subject_id", "updated_at"),
    (6, "visit", "clinical_data", 6, "MERGE", "visit_id", "created_at"),
    (7, "form_instance", "clinical_data", 7, "MERGE", "form_instance_id", "updated_at"),
    (8, "field_data", "clinical_data", 7, "MERGE", "field_data_id", "updated_at"),
    (9, "lab_data", "clinical_data", 7, "MERGE", "lab_record_id", "updated_date"),
    (10, "form_definition", "clinical_metadata", 5, "MERGE", "form_id", "updated_at"),
    (11, "field_definition", "clinical_metadata", 6, "MERGE", "field_id", "updated_at"),
    (12, "audit_trail", "audit", 5, "APPEND", "audit_id", "change_datetime"),
    (13, "carrier_master", "sap_logistics", 8, "MERGE", "carrier_id", "updated_date"),
    (14, "shipment_header", "sap_logistics", 9, "MERGE", "shipment_id", "updated_date"),
    (15, "shipment_item", "sap_logistics", 10, "MERGE", "shipment_id,item_id", "updated_date"),
    (16, "shipment_status", "sap_logistics", 10, "APPEND", "status_id", "status_datetime"),
    (17, "delivery_header", "sap_logistics", 10, "MERGE", "delivery_id", "updated_date"),
    (18, "delivery_item", "sap_logistics", 11, "MERGE", "delivery_id,item_id", "updated_date"),
    (19, "lims_sample", "lims", 11, "MERGE", "sample_id", "updated_date"),
    (20, "accession", "lims", 12, "MERGE", "accession_id", "updated_date"),
    (21, "analysis", "lims", 13, "MERGE", "analysis_id", "updated_date"),
    (22, "result", "lims", 14, "MERGE", "result_id", "updated_date"),
    (23, "result_audit", "lims", 15, "APPEND", "audit_id", "change_datetime"),
    (24, "lims_sample_location", "lims", 12, "APPEND", "location_event_id", "event_datetime"),
    (25, "sample", "biobank", 19, "MERGE", "sample_id", "updated_date"),
    (26, "freezer", "biobank", 15, "MERGE", "freezer_id", "created_date"),
    (27, "rack", "biobank", 16, "MERGE", "rack_id", "created_date"),
    (28, "storage_box", "biobank", 17, "MERGE", "box_id", "created_date"),
    (29, "storage_position", "biobank", 18, "MERGE", "position_id", "created_date"),
    (30, "sample_location", "biobank", 20, "MERGE", "sample_id", "last_updated"),
    (31, "storage_history", "biobank", 21, "APPEND", "history_id", "event_datetime"),
    (32, "freezer_temperature", "biobank", 16, "APPEND", "temperature_id", "recorded_datetime"),
]

# ---- Fixed values: gold tables (ids 100..109, load_order = id) ----------------
# Only the first five of these are built anywhere; the rest are registered names.
GOLD_TABLES = [
    "sample_tracking_summary",
    "lab_performance",
    "shipment_sla_summary",
    "study_enrollment_summary",
    "adverse_event_summary",
    "site_performance_summary",
    "freezer_utilization_summary",
    "sample_rejection_summary",
    "lab_abnormal_result_summary",
    "shipment_temperature_excursion_summary",
]

# Starting high-water mark of every incremental table.
INITIAL_WATERMARK = "1900-01-01 00:00:00"

# ---- Fixed values: registered file schemas (version 1, active) ---------------
FILE_SCHEMAS = {
    "study_master": [
        ("study_id", "string"), ("study_name", "string"), ("phase", "string"), ("therapeutic_area", "string"),
        ("start_date", "date"), ("end_date", "date"), ("status", "string"), ("region", "string"),
        ("protocol_version", "string"),
    ],
    "site_master": [
        ("site_id", "string"), ("site_name", "string"), ("country", "string"), ("city", "string"),
        ("region", "string"), ("site_status", "string"), ("principal_investigator", "string"),
    ],
    "visit_schedule": [
        ("visit_id", "string"), ("study_id", "string"), ("visit_name", "string"), ("visit_day", "integer"),
        ("window_start_day", "integer"), ("window_end_day", "integer"),
    ],
    "sample_plan": [
        ("sample_plan_id", "string"), ("study_id", "string"), ("visit_id", "string"), ("sample_type", "string"),
        ("planned_quantity", "integer"), ("collection_timepoint", "string"),
    ],
    "test_plan": [
        ("test_plan_id", "string"), ("study_id", "string"), ("sample_type", "string"), ("test_name", "string"),
        ("lab_vendor", "string"), ("priority", "string"),
    ],
    "protocol_version": [
        ("protocol_version_id", "string"), ("study_id", "string"), ("protocol_version", "string"),
        ("effective_date", "date"), ("approval_status", "string"),
    ],
    "treatment_arm": [
        ("treatment_arm_id", "string"), ("study_id", "string"), ("arm_name", "string"), ("arm_type", "string"),
        ("dosage", "string"),
    ],
    "visit_activity_plan": [
        ("activity_id", "string"), ("visit_id", "string"), ("activity_name", "string"), ("activity_type", "string"),
        ("mandatory_flag", "string"),
    ],
    "study_site_map": [
        ("study_site_map_id", "string"), ("study_id", "string"), ("site_id", "string"),
        ("site_activation_date", "date"), ("site_status", "string"),
    ],
    "study_enrollment_plan": [
        ("enrollment_plan_id", "string"), ("study_id", "string"), ("site_id", "string"),
        ("planned_subject_count", "integer"), ("planned_enrollment_date", "date"),
    ],
    "investigator_master": [
        ("investigator_id", "string"), ("investigator_name", "string"), ("specialization", "string"),
        ("country", "string"), ("email", "string"),
    ],
    "consent_master": [
        ("consent_id", "string"), ("study_id", "string"), ("consent_version", "string"),
        ("effective_date", "date"), ("consent_status", "string"),
    ],
    "sample_type_master_ctms": [
        ("sample_type_id", "string"), ("sample_type_name", "string"), ("container_type", "string"),
        ("storage_temperature", "string"), ("processing_requirement", "string"),
    ],
}


# ---- Rows built from the fixed values -------------------------------------------
TABLE_COLUMNS = [
    "table_id", "table_name", "source_system", "source_schema", "source_table", "source_path",
    "target_layer", "bronze_schema", "silver_schema", "gold_schema", "active_flag", "load_order",
]


def table_rows(landing_root: str = "landing") -> list[tuple]:
    """51 registry rows: 13 file tables, 28 database tables, 10 gold tables."""
    rows = []
    for tid, name, order, _pk in FILE_TABLES:
        rows.append((tid, name, "blob", None, None, f"{landing_root}/{name}/", "bronze", "bronze", "silver", None, True, order))
    for tid, name, schema, order, *_ in DB_TABLES:
        rows.append((tid, name, "sqlserver", schema, name, None, "bronze", "bronze", "silver", None, True, order))
    for i, name in enumerate(GOLD_TABLES):
        rows.append((100 + i, name, "SILVER", None, None, None, "gold", None, "silver", "gold", True, 100 + i))
    return rows


def parameter_rows() -> list[tuple]:
    """110 key-value rows: (table_id, parameter_name, parameter_value)."""
    rows = []
    for tid, _name, _order, pk in FILE_TABLES:
        rows += [(tid, "load_type", "FULL"), (tid, "primary_key", pk)]
    for tid, _name, _schema, _order, load_type, pk, mark in DB_TABLES:
        rows += [(tid, "load_type", load_type), (tid, "primary_key", pk), (tid, "watermark_column", mark)]
    return rows


def watermark_rows() -> list[tuple]:
    """28 rows: (table_id, last_watermark_value, last_run_id) for every table with a mark column."""
    return [(tid, INITIAL_WATERMARK, None) for tid, *_rest in DB_TABLES]


def schema_json(fields: list[tuple[str, str]]) -> str:
    return json.dumps([{"name": n, "type": t} for n, t in fields])


def schema_rows() -> list[tuple]:
    """(table_name, schema_version, schema_json, active_flag) for the 13 file tables."""
    return [(name, 1, schema_json(fields), True) for name, fields in FILE_SCHEMAS.items()]
