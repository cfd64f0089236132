"""Versioned Parquet store: versions, recovery, upserts of whole buckets."""

from __future__ import annotations

import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.operators.upsert import upsert_frames
from medallion.session import scratch_dir
from medallion.sources.store import TableStore, bucket_column, bucket_of


def new_store(spark):
    return TableStore(spark, scratch_dir(spark, "store-test"), namespace="s" + uuid.uuid4().hex[:10])


def test_replace_keeps_previous_version(spark):
    store = new_store(spark)
    store.replace("silver", "t", spark.range(3))
    # rebuilding a table from a plan that reads it is fine (new directory)
    store.replace("silver", "t", store.read("silver", "t").withColumn("x", F.col("id") * 2))
    assert store.versions("silver", "t") == [1, 2]
    assert sorted(store.read("silver", "t").columns) == ["id", "x"]
    assert store.vacuum("silver", "t", keep=1) == [1]
    assert store.read("silver", "t").count() == 3


def files_by_bucket(store, database="silver", table="t"):
    column, _ = store.buckets(database, table)
    out = {}
    for f in store.read_raw(database, table).inputFiles():
        out.setdefault(int(f.split(f"/{column}=")[1].split("/")[0]), set()).add(f)
    return out


def test_bucketed_upsert_reads_and_writes_only_touched_buckets(spark):
    store = new_store(spark)
    n = 8
    base = spark.range(0, 400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    store.upsert("silver", "t", base, "k", bucketed=True, buckets=n)
    assert store.buckets("silver", "t") == (bucket_column(["k"], n), n) and store.read("silver", "t").columns == ["k", "v"]
    before = files_by_bucket(store)
    # keys of one bucket only, one of them new
    ids = [r[0] for r in spark.range(0, 800).filter(bucket_of(["id"], n) == 0).collect()]
    upd = spark.createDataFrame([(k, "new") for k in ids[:3] + [i for i in ids if i >= 400][:1]], "k bigint, v string")
    store.upsert("silver", "t", upd, "k", bucketed=True)
    after = files_by_bucket(store)
    assert {b for b in after if after[b] != before.get(b)} == {0}
    got = {r["k"]: r["v"] for r in store.read("silver", "t").collect()}
    assert len(got) == 401 and sum(v == "new" for v in got.values()) == 4
    # upserting the same increment again changes nothing
    store.upsert("silver", "t", upd, "k", bucketed=True)
    assert {r["k"]: r["v"] for r in store.read("silver", "t").collect()} == got
    target = store.read_raw("silver", "t").filter(F.col(bucket_column(["k"], n)).isin([0]))
    assert f"PartitionFilters: [isnotnull({bucket_column(['k'], n)}" in target._jdf.queryExecution().executedPlan().toString()


def test_bucketed_upsert_with_narrower_key_type(spark):
    store = new_store(spark)
    store.upsert("silver", "t", spark.range(0, 100).select(F.col("id").alias("k"), F.lit("old").alias("v")), "k", bucketed=True, buckets=8)
    # int keys against a bigint table: same buckets, so the rows are updated, not duplicated
    upd = spark.createDataFrame([(k, "new") for k in range(0, 100, 10)], "k int, v string")
    store.upsert("silver", "t", upd, "k", bucketed=True)
    got = store.read("silver", "t")
    assert got.count() == 100 and got.filter("v = 'new'").count() == 10
    added = spark.createDataFrame([(500, "app")], "k int, v string")
    with pytest.raises(ValueError, match="another key"):
        store.append("silver", "t", added)
    store.append("silver", "t", added, ["k"])
    assert store.read("silver", "t").count() == 101
    store.upsert("silver", "t", spark.createDataFrame([(500, "upd")], "k bigint, v string"), "k", bucketed=True)
    assert store.read("silver", "t").filter("k = 500").collect()[0]["v"] == "upd" and store.read("silver", "t").count() == 101


def test_other_key_rewrites_the_table_in_new_buckets(spark):
    store = new_store(spark)
    rows = spark.createDataFrame([(k, k % 5, "a") for k in range(50)], "k int, g int, v string")
    store.upsert("silver", "t", rows, "k", bucketed=True, buckets=4)
    store.upsert("silver", "t", spark.createDataFrame([(1, 1, "b"), (99, 4, "b")], "k int, g int, v string"), "k,g", bucketed=True, buckets=4)
    got = {(r["k"], r["g"]): r["v"] for r in store.read("silver", "t").collect()}
    assert len(got) == 51 and got[1, 1] == got[99, 4] == "b" and store.buckets("silver", "t")[0] == bucket_column(["k", "g"], 4)


def lost_entry(store):
    """The catalog entry goes, as when a driver dies between DROP and CREATE; the files stay."""
    store.spark.sql(f"DROP TABLE {store.fqn('silver', 't')}")


def test_lost_entry_is_registered_again(spark):
    store = new_store(spark)
    store.replace("silver", "t", spark.range(5))
    store.replace("silver", "t", spark.range(9).withColumn("x", F.lit(1)))
    (spark.range(3)).write.parquet(store.next_path("silver", "t") + "/_temporary/0")  # a version that was never finished
    lost_entry(store)
    assert store.exists("silver", "t") and store.read("silver", "t").count() == 9
    store.upsert("silver", "b", spark.range(40).select(F.col("id").alias("k"), F.lit("x").alias("v")), "k", bucketed=True, buckets=4)
    spark.sql(f"DROP TABLE {store.fqn('silver', 'b')}")
    store.upsert("silver", "b", spark.range(30, 50).select(F.col("id").alias("k"), F.lit("y").alias("v")), "k", bucketed=True)
    assert sorted(map(tuple, store.read("silver", "b").collect())) == [(k, "y" if k >= 30 else "x") for k in range(50)]
    store.drop("silver", "t")
    assert not store.exists("silver", "t")


@pytest.mark.parametrize("step", ["before", "after", "during"])
def test_upsert_survives_a_lost_driver(spark, monkeypatch, step):
    """The upsert stops before its staged buckets are applied, half-way, or before they are deleted."""
    store = new_store(spark)
    base = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    store.upsert("silver", "t", base, "k", bucketed=True, buckets=4)
    upd = spark.range(20, 60).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    with monkeypatch.context() as m:
        if step == "after":
            m.setattr(store, "_delete", lambda path: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            m.setattr(store, "_apply_merge", lambda *a: None if a[1] != "t" or not store._has(f"{store.table_dir(*a)}/_merge/_SUCCESS") else (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.upsert("silver", "t", upd, "k", bucketed=True)
    if step == "during":  # Spark had removed a partition and not yet put the new one there
        store._delete(next(iter(files_by_bucket(store).values())).copy().pop().rsplit("/", 1)[0])
    expected = [(k, "new" if k >= 20 else "old") for k in range(60)]
    assert sorted(map(tuple, store.read("silver", "t").collect())) == expected
    assert not store._has(f"{store.table_dir('silver', 't')}/_merge")
    store.upsert("silver", "t", upd, "k", bucketed=True)
    assert sorted(map(tuple, store.read("silver", "t").collect())) == expected


def test_first_load_whose_write_fails_leaves_no_table(spark):
    store = new_store(spark)
    bad = spark.range(3).withColumn("x", F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        store.append("silver", "t", bad)
    assert not spark.catalog.tableExists(store.qualified("silver", "t"))
    store.append("silver", "t", spark.range(3))
    assert store.read("silver", "t").count() == 3


ROW = "k bigint, v string, ts int"
rounds = st.lists(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 40)), st.sampled_from(["a", "b", "c"]), st.integers(0, 3)), max_size=8),
    min_size=1,
    max_size=3,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(base=st.lists(st.tuples(st.integers(0, 40), st.just("base"), st.just(0)), max_size=10, unique_by=lambda r: r[0]), increments=rounds)
def test_bucketed_upsert_equals_model(spark, base, increments):
    store = new_store(spark)
    model = spark.createDataFrame(base, ROW)
    store.upsert("silver", "t", model, "k", order=["ts"], bucketed=True, buckets=8)
    for inc in increments:
        u = spark.createDataFrame(inc, ROW)
        model = spark.createDataFrame(upsert_frames(model, u, "k", order=["ts"]).collect(), ROW)
        store.upsert("silver", "t", u, "k", order=["ts"], bucketed=True)
        got = sorted((tuple(r) for r in store.read("silver", "t").collect()), key=repr)
        assert got == sorted((tuple(r) for r in model.collect()), key=repr)
