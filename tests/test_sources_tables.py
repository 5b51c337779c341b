import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.sources.files import (IngestError, check_format, check_not_empty, load_mode, read_raw,
                                  split_corrupt)
from strata.sources.quarantine import envelope, file_event
from strata.sources.schema import detect_drift, fill_missing, normalise_columns
from strata.sources.tables import TableStore
from strata.streaming.incremental import incremental_batch, read_watermark, save_watermark


def _local(path):
    p = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(p, exist_ok=True)
    return p


def _write(dirpath, name, text):
    p = os.path.join(_local(dirpath), name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_ragged_csv_rows_captured(spark, scratch):
    p = _write(scratch, "raw.csv", 'Name,Age\nx,1\ny,2,3\nz\n"q,4\n')
    good, bad = split_corrupt(read_raw(spark, p))
    assert [tuple(r) for r in good.collect()] == [("x", "1")]
    assert bad.count() == 3 and good.count() == 1     # counting works on both sides


def test_malformed_json_line(spark, scratch):
    p = _write(scratch, "raw.json", '{"Name":"x","Age":1}\n{"Name":\n')
    good, bad = split_corrupt(read_raw(spark, p))
    assert good.count() == 1 and bad.count() == 1
    env = envelope(bad, "bronze", "parse_error", p).first()
    assert env.reason == "parse_error" and '"_corrupt_record"' in env.row_json


def test_format_and_empty_guards(spark, scratch):
    logged = []
    with pytest.raises(IngestError):
        check_format(_write(scratch, "notes.txt", "hello"), on_reject=lambda p, r: logged.append(r))
    assert logged == ["cannot ingest 'txt' files"]
    p = _write(scratch, "header_only.csv", "Name,Age\n")
    with pytest.raises(IngestError):
        check_not_empty(read_raw(spark, p), p, on_reject=lambda p, r: logged.append(r))
    assert logged[-1] == "no data rows"
    assert file_event(spark, "bronze", p, "Empty file").first().reason == "Empty file"


def test_name_collision_fails(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="get the same name"):
        normalise_columns(df)


def test_drift_fill_and_normalise(spark):
    df = spark.createDataFrame([("n", "1", "x")], "Name string, `Blood Type` string, Extra string")
    new, missing = detect_drift(df, ["Name", "Blood Type", "Age"])
    assert new == ["Extra"] and missing == ["Age"]
    out = normalise_columns(fill_missing(df, missing))
    assert out.columns == ["name", "blood_type", "extra", "age"]


def test_csv_folder_with_another_column_order_is_refused(spark, scratch):
    _write(scratch + "/mixed", "a.csv", "k,v\na,1\n")
    _write(scratch + "/mixed", "b.csv", "v,k\n2,b\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, scratch + "/mixed", "csv").collect()


def test_table_appends_and_deletes(spark, scratch):
    st = TableStore(spark, scratch + "/tables")
    df = spark.range(10).withColumn("src", F.when(F.col("id") < 5, "a").otherwise("demo"))
    st.publish(df, "t")
    st.append(spark.range(10, 12).withColumn("new_col", F.lit("x")), "t")
    assert set(st.read("t").columns) == {"id", "src", "new_col"}
    other = TableStore(spark, scratch + "/tables")
    assert other.read("t").count() == 12
    st.delete_where("t", F.col("src") == "demo")       # null src rows are kept
    assert st.read("t").count() == 7 and other.read("t").count() == 7
    assert load_mode(None, "f.csv") == "first_load"
    assert load_mode(st.read("t").withColumn("source_file", F.lit("f.csv")), "f.csv") == "update"


def test_old_folders_go(spark, scratch):
    st = TableStore(spark, scratch + "/gone")
    for n in (3, 4, 5, 6):
        st.publish(spark.range(n), "t")
    d = st.root.removeprefix("file:") + "/t"
    assert len([x for x in os.listdir(d) if x.startswith("seg=")]) == 2      # the table and the one before
    assert st.read("t").count() == 6


@pytest.mark.parametrize("change", ["delete", "compact", "cluster", "append"])
def test_partitioning_is_kept(spark, scratch, change):
    from strata.operators.layout import cluster_by
    st = TableStore(spark, scratch + "/parts")
    df = spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("year"))
    st.publish(df.repartition(4), "t", partition_by=["year"])
    before = st._entry("t")["folders"]
    want = 90
    if change == "delete":
        st.delete_where("t", F.col("id").isin(1, 4, 7))
        want = 87
        assert len(set(before) & set(st._entry("t")["folders"])) == 2        # partitions without hits stay
    elif change == "append":
        st.append(df.filter("year = 1"), "t")
        want = 120
    elif change == "compact":
        st.append(df.filter("year = 1"), "t")
        st.compact("t")
        want = 120
        assert len(st._entry("t")["folders"]) == 3
    else:
        st.rewrite("t", lambda x, files: cluster_by(x, ["id"], files))
    out = st.read("t")
    assert out.count() == want and st.partition_by("t") == ["year"]
    plan = out.filter("year = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_clusters_split_equal_prefixes_and_equal_keys(spark, scratch):
    from strata.operators.layout import cluster_by
    df = spark.range(20_000).select(F.format_string("Customer#%09d", "id").alias("name"), F.lit("x").alias("same"),
                                    F.when(F.col("id") == 0, 1e12).otherwise(F.col("id").cast("double")).alias("x"))
    for cols in (["name"], ["same"], ["x"], ["name", "x"]):
        sizes = [r["count"] for r in cluster_by(df, cols, 8).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 6 and max(sizes) < 8_000


def test_quarantine_replaces_a_repeated_batch(spark, scratch):
    from strata.sources.quarantine import quarantine, read_quarantine
    assert read_quarantine(spark, scratch).count() == 0
    rows = envelope(spark.range(3), "bronze", "odd", "f.csv", "b/1")
    for _ in range(2):
        quarantine(rows, scratch, "b/1", "parse")
    quarantine(envelope(spark.range(3), "bronze", "odd", "f.csv", "b2"), scratch, "b2", "parse")
    assert sorted(r["batch_id"] for r in read_quarantine(spark, scratch).collect()) == ["b/1"] * 3 + ["b2"] * 3


def test_watermark_empty_batch_keeps_mark(spark, scratch):
    path = scratch + "/wm"
    assert read_watermark(spark, path) is None
    ev = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3)], "ts timestamp_ntz")
    save_watermark(ev.limit(0), "ts", path)
    assert incremental_batch(ev, "ts", read_watermark(spark, path)).count() == 3
    save_watermark(ev, "ts", path)
    assert read_watermark(spark, path).first()["mark"] == dt.datetime(2024, 1, 3)
    empty = incremental_batch(ev, "ts", read_watermark(spark, path))
    assert empty.count() == 0
    save_watermark(empty, "ts", path)
    assert read_watermark(spark, path).first()["mark"] == dt.datetime(2024, 1, 3)
    assert incremental_batch(ev, "ts", read_watermark(spark, path, "other scope")).count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_watermark_does_not_depend_on_time_zones(spark, scratch, kind, monkeypatch):
    import time
    rows = [("2024-03-10 01:30:00",), ("2024-03-10 02:30:00",), ("2024-03-10 03:30:00",)]
    ev = spark.createDataFrame(rows, "t string").select(F.col("t").cast(kind).alias("ts"))
    for i, (save_tz, read_tz) in enumerate([("America/New_York", "UTC"), ("Asia/Tokyo", "UTC"), ("UTC", "America/New_York")]):
        path = f"{scratch}/wm{i}"
        monkeypatch.setenv("TZ", save_tz)
        time.tzset()
        save_watermark(ev.orderBy("ts").limit(2), "ts", path)
        monkeypatch.setenv("TZ", read_tz)
        time.tzset()
        assert incremental_batch(ev, "ts", read_watermark(spark, path)).count() == 1
    monkeypatch.undo()
    time.tzset()


def test_merge_into_rewrites_only_touched_partitions(spark, scratch):
    from strata.operators.upsert import upsert
    from strata.sources.tables import merge_into
    st = TableStore(spark, scratch + "/merge")
    part = (F.col("k") % 4).cast("int")
    base = spark.range(40).select(F.col("id").alias("k"), F.lit("v0").alias("v"))
    merge_into(st, "t", base, lambda old, new: upsert(old, new, ["k"]), part)
    before = st._entry("t")["folders"]
    assert len(before) == 4
    batch = spark.createDataFrame([(1, "v1"), (5, "v1"), (101, "new")], "k long, v string")  # all k%4 == 1
    merge_into(st, "t", batch, lambda old, new: upsert(old, new, ["k"]), part)
    assert len(set(before) & set(st._entry("t")["folders"])) == 3            # three partitions carried over untouched
    got = sorted((r.k, r.v) for r in st.read("t").collect())
    want = sorted([(k, "v0") for k in range(40) if k not in (1, 5)] + [(1, "v1"), (5, "v1"), (101, "new")])
    assert got == want and st.read("t").columns == ["k", "v"]


def test_checkpoint_folder_is_only_made_for_a_local_master():
    from strata.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(*_):
                return None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
