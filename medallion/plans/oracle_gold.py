"""DuckDB SQL for the test-table silver views and the five marts (the oracle side).

Each measure is a filtered count over the rows that have it, taken per parent key and
looked up from the parent; parent keys are unique in the test tables. Duplicate and null keys are
checked by the row-by-row models in the tests.
"""

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

STUDY_VIEWS = """
study_master AS (
  SELECT n_nationkey AS study_id, n_name AS study_name,
    CASE n_nationkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'II' ELSE 'III' END AS phase,
    CASE n_nationkey % 2 WHEN 0 THEN 'Oncology' ELSE 'Cardiology' END AS therapeutic_area,
    r_name AS region, 'v1' AS protocol_version
  FROM nation JOIN region ON n_regionkey = r_regionkey),
subject AS (
  SELECT c_custkey AS subject_id, c_nationkey AS study_id,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Enrolled' WHEN 'BUILDING' THEN 'Screen Failed'
      WHEN 'FURNITURE' THEN 'Withdrawn' WHEN 'HOUSEHOLD' THEN 'Completed' ELSE 'Screening' END AS enrollment_status,
    CAST(o_first AS DATE) AS enrollment_date
  FROM customer LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS o_first FROM orders GROUP BY o_custkey) f
    ON c_custkey = o_custkey)"""

STUDY = f"""
WITH {STUDY_VIEWS},
per_study AS (
  SELECT study_id, COUNT(DISTINCT subject_id) AS people,
    COUNT(*) FILTER (enrollment_status = 'Enrolled') AS enrolled,
    COUNT(*) FILTER (enrollment_status = 'Screen Failed') AS failed,
    COUNT(*) FILTER (enrollment_status = 'Withdrawn') AS withdrawn,
    COUNT(*) FILTER (enrollment_status = 'Completed') AS completed,
    MIN(enrollment_date) AS first_enrollment_date, MAX(enrollment_date) AS latest_enrollment_date
  FROM subject GROUP BY study_id)
SELECT study_master.*, first_enrollment_date, latest_enrollment_date,
  COALESCE(people, 0) AS total_subjects, COALESCE(enrolled, 0) AS enrolled_subjects,
  COALESCE(failed, 0) AS screen_failed_subjects, COALESCE(withdrawn, 0) AS withdrawn_subjects,
  COALESCE(completed, 0) AS completed_subjects,
  CAST(ROUND(100.0 * enrolled / people, 2) AS DOUBLE) AS enrollment_rate_percent,
  CAST(ROUND(100.0 * failed / people, 2) AS DOUBLE) AS screen_failure_rate_percent
FROM study_master LEFT JOIN per_study USING (study_id)
"""

LAB_VIEWS = f"""
lab_sample AS (SELECT n_nationkey AS sample_id, n_regionkey AS lab_id,
  CAST('1995-01-01 00:00:00' AS TIMESTAMP) AS received_datetime FROM nation),
lab_accession AS (SELECT c_custkey AS accession_id, c_nationkey AS sample_id FROM customer),
analysis AS (SELECT o_orderkey AS analysis_id, o_custkey AS accession_id FROM orders),
result AS (SELECT {LINE_ID} AS result_id, l_orderkey AS analysis_id,
  CASE l_linestatus WHEN 'F' THEN 'Final' ELSE 'Preliminary' END AS result_status,
  CASE l_returnflag WHEN 'R' THEN 'YES' ELSE 'NO' END AS abnormal_flag,
  CASE l_returnflag WHEN 'A' THEN 'YES' ELSE 'NO' END AS critical_flag,
  l_shipdate AS result_datetime FROM lineitem)"""

LAB = f"""
WITH {LAB_VIEWS},
received AS (SELECT sample_id, lab_id, received_datetime, accession_id FROM lab_sample JOIN lab_accession USING (sample_id)),
analysed AS (SELECT lab_id, received_datetime, analysis_id FROM received JOIN analysis USING (accession_id)),
measured AS (
  SELECT lab_id, COUNT(DISTINCT result_id) AS results,
    COUNT(*) FILTER (result_status = 'Final') AS final_results,
    COUNT(*) FILTER (abnormal_flag = 'YES') AS abnormal_results,
    COUNT(*) FILTER (critical_flag = 'YES') AS critical_results,
    CAST(ROUND(AVG(date_sub('hour', received_datetime, result_datetime)), 2) AS DOUBLE) AS avg_turnaround_hours,
    MIN(result_datetime) AS first_result_datetime, MAX(result_datetime) AS latest_result_datetime
  FROM analysed JOIN result USING (analysis_id) GROUP BY lab_id)
SELECT labs.lab_id, labs.total_samples,
  (SELECT COUNT(DISTINCT accession_id) FROM received WHERE received.lab_id = labs.lab_id) AS total_accessions,
  (SELECT COUNT(DISTINCT analysis_id) FROM analysed WHERE analysed.lab_id = labs.lab_id) AS total_analyses,
  COALESCE(results, 0) AS total_results, COALESCE(final_results, 0) AS final_results,
  COALESCE(abnormal_results, 0) AS abnormal_results, COALESCE(critical_results, 0) AS critical_results,
  avg_turnaround_hours, first_result_datetime, latest_result_datetime
FROM (SELECT lab_id, COUNT(DISTINCT sample_id) AS total_samples FROM lab_sample GROUP BY lab_id) labs
LEFT JOIN measured USING (lab_id)
"""

SHIPMENT_VIEWS = """
shipment_header AS (SELECT o_orderkey AS shipment_id, o_orderpriority AS shipment_type, o_orderstatus AS plant_code,
  'A' AS source_location, 'B' AS destination_location, o_custkey % 7 AS carrier_id,
  CAST(o_orderkey AS VARCHAR) AS tracking_number, o_orderdate AS shipment_datetime FROM orders),
shipment_item AS (SELECT l_orderkey AS shipment_id, l_linenumber AS item_id FROM lineitem),
delivery_header AS (SELECT o_orderkey AS shipment_id,
  o_orderdate + (o_orderkey % 72) * INTERVAL '1' HOUR AS actual_delivery_datetime FROM orders WHERE o_orderstatus <> 'O')"""

SHIPMENT = f"""
WITH {SHIPMENT_VIEWS},
contents AS (SELECT shipment_id, COUNT(DISTINCT item_id) AS items FROM shipment_item GROUP BY shipment_id),
timed AS (
  SELECT shipment_header.*, actual_delivery_datetime,
    date_sub('hour', shipment_datetime, actual_delivery_datetime) AS delivery_duration_hours
  FROM shipment_header LEFT JOIN delivery_header USING (shipment_id))
SELECT timed.*, COALESCE(items, 0) AS total_items,
  CASE WHEN delivery_duration_hours IS NULL THEN 'IN_TRANSIT' WHEN delivery_duration_hours <= 48 THEN 'WITHIN_SLA' ELSE 'SLA_BREACHED' END AS sla_status,
  IF(delivery_duration_hours <= 48, IF(delivery_duration_hours <= 24, 'FAST_DELIVERY', 'NORMAL_DELIVERY'), 'DELAYED_DELIVERY')
    AS shipment_performance_category
FROM timed LEFT JOIN contents USING (shipment_id)
"""

FREEZER_VIEWS = f"""
freezer AS (SELECT r_regionkey AS freezer_id, r_name AS freezer_name, 'ULT' AS freezer_type, r_name AS location FROM region),
rack AS (SELECT n_nationkey AS rack_id, n_nationkey % 5 AS freezer_id FROM nation),
storage_box AS (SELECT s_suppkey AS box_id, s_suppkey % 25 AS rack_id FROM supplier),
storage_position AS (SELECT {LINE_ID} AS position_id, l_suppkey AS box_id,
  CASE WHEN l_partkey % 100 < 65 + 8 * (l_suppkey % 5) THEN 'Yes' ELSE 'No' END AS is_occupied FROM lineitem)"""

FREEZER = f"""
WITH {FREEZER_VIEWS},
shelved AS (SELECT freezer_id, rack_id, box_id FROM rack LEFT JOIN storage_box USING (rack_id)),
held AS (
  SELECT freezer_id, COUNT(DISTINCT position_id) AS positions,
    COUNT(*) FILTER (is_occupied = 'Yes') AS taken, COUNT(*) FILTER (is_occupied = 'No') AS open,
    ROUND(100.0 * taken / positions, 2) AS share
  FROM shelved JOIN storage_position USING (box_id) GROUP BY freezer_id),
stored AS (SELECT freezer_id, COUNT(DISTINCT rack_id) AS racks, COUNT(DISTINCT box_id) AS boxes FROM shelved GROUP BY freezer_id)
SELECT freezer.*, COALESCE(racks, 0) AS total_racks, COALESCE(boxes, 0) AS total_boxes, COALESCE(positions, 0) AS total_positions,
  COALESCE(taken, 0) AS occupied_positions, COALESCE(open, 0) AS available_positions, CAST(share AS DOUBLE) AS utilization_percent,
  IF(share >= 90, 'CRITICAL', IF(share >= 70 AND share <= 89, 'HIGH_UTILIZATION', 'NORMAL')) AS utilization_status
FROM freezer LEFT JOIN stored USING (freezer_id) LEFT JOIN held USING (freezer_id)
"""

TRACKING_VIEWS = f"""
lims_sample AS (SELECT o_orderkey AS sample_id, concat_ws('-', 'BC', o_orderkey) AS sample_barcode, o_custkey AS subject_id,
  'V1' AS visit_code, 'Serum' AS sample_type, o_orderdate AS collection_datetime,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS received_datetime,
  CASE o_orderstatus WHEN 'F' THEN 'Rejected' WHEN 'P' THEN 'Lost' ELSE 'Stored' END AS sample_status,
  o_custkey % 5 AS lab_id FROM orders),
accession AS (SELECT {LINE_ID} AS accession_id, l_orderkey AS sample_id,
  l_shipdate AS accession_datetime, l_linestatus AS accession_status FROM lineitem),
lims_sample_location AS (SELECT event_id AS location_event_id, user_id AS sample_id, event_type,
  ts AS event_datetime, props AS storage_location FROM events)"""

TRACKING = f"""
WITH {TRACKING_VIEWS},
seen AS (
  SELECT DISTINCT ON (sample_id) sample_id, storage_location, event_type AS latest_location_event,
    event_datetime AS latest_location_event_time
  FROM lims_sample_location
  ORDER BY sample_id, event_datetime DESC NULLS LAST, location_event_id DESC NULLS LAST, event_type DESC NULLS LAST,
    storage_location DESC NULLS LAST),
booked AS (
  SELECT DISTINCT ON (sample_id) * FROM accession
  ORDER BY sample_id, accession_datetime DESC NULLS LAST, accession_id DESC NULLS LAST, accession_status DESC NULLS LAST),
closed(sample_status, label) AS (VALUES ('Rejected', 'REJECTED'), ('Lost', 'LOST'))
SELECT lims_sample.*, accession_id, accession_datetime, accession_status, storage_location, latest_location_event,
  latest_location_event_time,
  IF(received_datetime IS NULL, 'NOT_RECEIVED', IF(accession_id IS NULL, 'RECEIVED_NOT_ACCESSIONED', COALESCE(label, 'TRACKED')))
    AS sample_tracking_status
FROM lims_sample LEFT JOIN booked USING (sample_id) LEFT JOIN seen USING (sample_id) LEFT JOIN closed USING (sample_status)
"""

ROW_COUNTS = f"""
WITH g1 AS ({TRACKING}), g2 AS ({LAB}), g3 AS ({SHIPMENT}), g4 AS ({STUDY}), g5 AS ({FREEZER})
SELECT 'sample_tracking_summary' AS table_name, COUNT(*) AS row_count FROM g1
UNION ALL SELECT 'lab_performance', COUNT(*) FROM g2
UNION ALL SELECT 'shipment_sla_summary', COUNT(*) FROM g3
UNION ALL SELECT 'study_enrollment_summary', COUNT(*) FROM g4
UNION ALL SELECT 'freezer_utilization_summary', COUNT(*) FROM g5
"""

GOLD_SQL = {
    "gold_study_enrollment_summary": STUDY,
    "gold_lab_performance": LAB,
    "gold_shipment_sla_summary": SHIPMENT,
    "gold_freezer_utilization_summary": FREEZER,
    "gold_sample_tracking_summary": TRACKING,
    "gold_row_counts": ROW_COUNTS,
}
