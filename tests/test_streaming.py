"""File stream ingest: the same rows landed as one file or as k files give the same
bronze rows; each call takes exactly the files not seen before (SURVEY §5 item 3, 4)."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import types as T

from medallion.session import scratch_dir
from medallion.streaming.file_ingest import ingest_files

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
DATA = [(i, f"n{i}") for i in range(40)]


def land(folder, chunks):
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        with open(os.path.join(folder, f"part-{i:03d}.csv"), "w") as f:
            f.write("id,name\n" + "".join(f"{a},{b}\n" for a, b in chunk))


def ingest(spark, root, name, max_files=None):
    table = f"stream_{os.path.basename(root).replace('-', '_')}_{name}"
    res = ingest_files(spark, f"{root}/{name}", SCHEMA, table, f"{root}/t_{name}", f"{root}/c_{name}", max_files_per_trigger=max_files)
    return res, table


def test_count_covers_batches_whose_progress_the_session_would_forget(spark):
    root = scratch_dir(spark, "stream-progress")
    land(f"{root}/many", [DATA[i : i + 4] for i in range(0, len(DATA), 4)])
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        res, _ = ingest(spark, root, "many", max_files=1)
        assert spark.conf.get(name) == "2"
    finally:
        spark.conf.set(name, before)
    assert (res.rows, res.batches) == (len(DATA), 10)


def bronze_rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("id", "name", "_rescued_data").collect())


def test_k_files_equal_one_file(spark):
    root = scratch_dir(spark, "stream-k")
    land(f"{root}/one", [DATA])
    land(f"{root}/many", [DATA[i : i + 7] for i in range(0, len(DATA), 7)])
    one, t_one = ingest(spark, root, "one")
    many, t_many = ingest(spark, root, "many", max_files=2)  # several micro-batches
    assert one.rows == many.rows == len(DATA)
    assert many.batches > 1
    assert bronze_rows(spark, t_one) == bronze_rows(spark, t_many)
    # every file is named in source_file_name
    files = {r[0].rsplit("/", 1)[-1] for r in spark.table(t_many).select("source_file_name").distinct().collect()}
    assert files == {f"part-{i:03d}.csv" for i in range(6)}
    again, _ = ingest(spark, root, "many")
    assert again.rows == 0


def test_swapped_header_fails_instead_of_shifting(spark):
    root = scratch_dir(spark, "stream-hdr")
    os.makedirs(f"{root}/bad", exist_ok=True)
    with open(f"{root}/bad/x.csv", "w") as f:
        f.write("name,id\nn1,1\n")
    try:
        ingest(spark, root, "bad")
        raised = False
    except Exception:  # noqa: BLE001 - the stream fails on the header check
        raised = True
    assert raised


def test_misfit_rows_are_kept_with_raw_line(spark):
    root = scratch_dir(spark, "stream-misfit")
    os.makedirs(f"{root}/odd", exist_ok=True)
    with open(f"{root}/odd/x.csv", "w") as f:
        f.write("id,name\n1,a\nnot-int,b\n3,c,surplus\n4\n")
    res, table = ingest(spark, root, "odd")
    assert res.rows == 4
    got = {r["name"]: (r["id"], r["_rescued_data"]) for r in spark.table(table).collect()}
    assert got["a"] == (1, None)
    assert got["b"][0] is None and "not-int" in got["b"][1]  # bad value: null + raw line
    assert got["c"][0] == 3 and "surplus" in got["c"][1]  # surplus field: kept + raw line
    assert got[None][0] == 4 and got[None][1] == "4"  # short row: missing field null + raw line


def test_only_misfit_fields_are_rescued(spark):
    root = scratch_dir(spark, "stream-fields")
    os.makedirs(f"{root}/odd", exist_ok=True)
    with open(f"{root}/odd/x.csv", "w") as f:
        f.write('id,on,name\n1,2024-01-02,a\nx1,2024-13-02,"b, q"\n,,\n3,2024-01-03,c,surplus\n4\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("on", T.DateType()), T.StructField("name", T.StringType())])
    table = "fields_" + os.path.basename(root).replace("-", "_")
    assert ingest_files(spark, f"{root}/odd", schema, table, f"{root}/t", f"{root}/c", by_field=True).rows == 5
    got = spark.table(table)
    assert {f.name: f.dataType for f in got.schema.fields if f.name in schema.names} == {f.name: f.dataType for f in schema.fields}
    rows = {(r["id"], r["name"]): (str(r["on"]), json.loads(r["_rescued_data"] or "null")) for r in got.collect()}
    assert rows[1, "a"] == ("2024-01-02", None)
    assert rows[None, 'b, q'] == ("None", {"id": "x1", "on": "2024-13-02"})
    assert rows[None, None] == ("None", None)
    assert rows[3, "c"] == ("2024-01-03", {"_line": "3,2024-01-03,c,surplus"}) and rows[4, None] == ("None", {"_line": "4"})
    assert got.filter("source_file_name IS NULL OR insert_timestamp IS NULL").isEmpty()


def stop_between(root, name, lost_sink):
    """What a driver leaves that dies after the offset log of its last batch and before its commit log, with the batch's
    files in the sink or (``lost_sink``) without the sink's record of them."""
    last = max(os.listdir(f"{root}/c_{name}/offsets"), key=lambda x: int(x) if x.isdigit() else -1)
    os.remove(f"{root}/c_{name}/commits/{last}")
    for crc in (f"{root}/c_{name}/commits/.{last}.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    if lost_sink:
        log = f"{root}/t_{name}/_spark_metadata"
        for f in (f"{log}/{last}", f"{log}/.{last}.crc"):
            if os.path.exists(f):
                os.remove(f)


@pytest.mark.parametrize("lost_sink", [False, True])
def test_restart_between_offset_log_and_commit_log(spark, lost_sink):
    root = scratch_dir(spark, "stream-crash").removeprefix("file:")
    land(f"{root}/f", [DATA[:10], DATA[10:25]])
    _, table = ingest(spark, root, "f")
    land(f"{root}/f", [DATA[:10], DATA[10:25], DATA[25:40]])  # a third file, read by a second batch
    ingest(spark, root, "f")
    stop_between(root, "f", lost_sink)
    ingest(spark, root, "f")  # the batch is planned from its offsets again
    assert sorted((r["id"], r["name"]) for r in spark.table(table).collect()) == sorted(DATA)
    again, _ = ingest(spark, root, "f")
    assert again.rows == 0 and spark.table(table).count() == len(DATA)
