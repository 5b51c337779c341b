import pytest
from pyspark.sql import functions as F

from strata.operators.metric_state import MetricState
from strata.operators.quality import quality_metrics
from strata.operators.upsert import upsert
from strata.plans.layers import LOAD_LOG, BronzeSpec, bronze
from strata.sources.files import content_digest
from strata.sources.quarantine import read_quarantine
from strata.sources.tables import TableStore, merge_files, merge_into

ROWS = "k int, v int, cur boolean"


def history(spark, n, shift=0):
    return spark.range(n).select(
        (F.col("id") + shift).cast("int").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("int").alias("v"),
        (F.col("id") % 4 != 0).alias("cur"))


def test_state_equals_a_full_scan_and_reads_what_changed(spark, scratch):
    st = TableStore(spark, scratch + "/state")
    opts = dict(null_cols=["v"], range_rules={"big": F.col("v") > 50}, mask_cols=["v", "cur"])
    state = MetricState(st, "t", ["k"], current=F.col("cur"), **opts)
    part = (F.col("k") % 8).cast("int")

    def merge(old, new):
        return old.unionByName(new) if old is not None else new         # repeats keys

    def same():
        table = st.read("t")
        want = quality_metrics(table, processed=table.limit(3), quarantined=table.limit(2), keys=["k"], current=F.col("cur"), **opts)
        got = state.report(table.limit(3), table.limit(2))
        assert set(got.columns) == set(want.columns)
        assert got.select(*want.columns).first() == want.first()

    merge_into(st, "t", history(spark, 100), merge, part)
    assert sorted(state.refresh()) == [str(i) for i in range(8)] and state.refresh() == []
    same()
    merge_into(st, "t", history(spark, 40).filter("k % 8 in (2, 5)"), merge, part)
    assert sorted(state.refresh()) == ["2", "5"]
    same()
    merge_into(st, "t", spark.createDataFrame([(None, 1, True), (None, None, True)], ROWS), merge, part)
    assert state.refresh() == ["__HIVE_DEFAULT_PARTITION__"]
    same()
    merge_into(st, "t", history(spark, 30).filter("k % 8 = 1"), merge, part)     # never refreshed after this load ...
    merge_into(st, "t", history(spark, 30).filter("k % 8 = 6"), merge, part)
    same()                                                                       # ... the report mends that
    st.publish(history(spark, 10), "t")
    same()                                                                       # not partitioned any more


def test_state_of_an_empty_table(spark, scratch):
    st = TableStore(spark, scratch + "/none")
    st.publish(spark.createDataFrame([], ROWS), "t")
    r = MetricState(st, "t", ["k"], null_cols=["v"]).report().first()
    assert (r["final"], r["distinct_keys"], r["avg_null_pct"], r["dup_pct"]) == (0, 0, 0.0, 0.0)


def files(st, name):
    return {x.rsplit("/", 1)[1] for f in st._entry(name)["folders"] for x in st._files(f)}


def test_merge_files_rewrites_only_files_with_a_key(spark, scratch):
    st = TableStore(spark, scratch + "/files")
    base = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"))
    merge_files(st, "t", base.repartitionByRange(10, "k"), ["k"], None)
    st.publish(base.repartitionByRange(10, "k"), "t")
    before = files(st, "t")
    batch = spark.createDataFrame([(5, 7), (950, 8), (4000, 9)], "k int, v int")
    for _ in range(2):                                     # the second time changes no row
        merge_files(st, "t", batch, ["k"], lambda old, new: upsert(old, new, ["k"]))
        rows = {r["k"]: r["v"] for r in st.read("t").collect()}
        assert len(rows) == 1001 == st.read("t").count()
        assert {k: v for k, v in rows.items() if v} == {5: 7, 950: 8, 4000: 9}
    assert len(before & files(st, "t")) == 8
    more = spark.createDataFrame([(None, 1, "x"), (6, 2, "y")], "k int, v int, w string")
    for _ in range(2):                                     # null keys meet, new columns come in
        merge_files(st, "t", more, ["k"], lambda old, new: upsert(old, new, ["k"]))
    out = st.read("t")
    assert out.count() == 1002 and out.filter("k is null").count() == 1 and out.filter("w = 'y'").count() == 1
    st.append(spark.createDataFrame([(7000, 1, "z")], "k int, v int, w string"), "t")
    st.delete_where("t", F.col("k") == 5)
    assert st.read("t").count() == 1002
    merge_files(st, "t", batch.filter("false"), ["k"], lambda old, new: upsert(old, new, ["k"]))
    assert st.read("t").count() == 1002


def test_merge_files_finds_rows_whose_key_is_far_from_the_layout(spark, scratch):
    st = TableStore(spark, scratch + "/far")
    base = spark.range(400).select((F.col("id") * 37 % 401).cast("int").alias("k"), F.col("id").alias("v"))
    st.publish(base.repartition(6), "t")
    batch = base.filter("k % 10 = 3").withColumn("v", F.lit(-1).cast("long"))
    merge_files(st, "t", batch, ["k"], lambda old, new: upsert(old, new, ["k"]))
    assert {(r["k"], r["v"]) for r in st.read("t").collect()} == {(r["k"], -1 if r["k"] % 10 == 3 else r["v"]) for r in base.collect()}


def csv(spark, path, rows):
    spark.createDataFrame(rows, "a string, b string").coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def test_loads_may_be_repeated(spark, scratch, monkeypatch):
    st, path = TableStore(spark, scratch + "/loads"), scratch + "/in/one"
    spec = BronzeSpec(expected=["a", "b"], keys=["a"], on_seen="once")
    csv(spark, path, [("1", "x"), ("2", "y")])
    assert bronze(spark, st, path, spec, "b1", "csv")["mode"] == "first_load"
    before = st._entry("bronze")
    assert bronze(spark, st, path, spec, "b2", "csv")["mode"] == "repeated"
    assert st._entry("bronze") == before
    other = BronzeSpec(expected=["a", "b"], keys=["a"], on_seen="skip", table="other")
    assert bronze(spark, st, path, other, "b2", "csv")["mode"] == "first_load"      # another table has not seen the file
    assert bronze(spark, st, path, other, "b2", "csv")["mode"] == "skipped"
    # the rows are switched in, then the load ends before its log row
    csv(spark, path, [("1", "z"), ("2", "y")])
    append = st.append
    monkeypatch.setattr(st, "append", lambda df, name, **kw: (_ for _ in ()).throw(OSError("lost")) if name == LOAD_LOG else append(df, name, **kw))
    with pytest.raises(OSError, match="lost"):
        bronze(spark, st, path, spec, "b3", "csv")
    monkeypatch.undo()
    state = st._entry("bronze")
    assert bronze(spark, st, path, spec, "b4", "csv")["mode"] == "repeated" and st._entry("bronze") == state
    assert {(r["a"], r["b"], r["batch_id"]) for r in st.read("bronze").collect()} == {("1", "z", "b3"), ("2", "y", "b3")}
    # content that comes back is a change again
    csv(spark, path, [("1", "x"), ("2", "y")])
    assert bronze(spark, st, path, spec, "b5", "csv")["mode"] == "update"
    assert {r["b"] for r in st.read("bronze").collect()} == {"x", "y"}


def test_rejects_of_a_failed_load_are_kept_once(spark, scratch, monkeypatch):
    st, path = TableStore(spark, scratch + "/rejects"), scratch + "/bad.csv"
    spark.createDataFrame([("a,b",), ("1,x",), ("2,y,z,extra",)], "t string").coalesce(1).write.text(path)
    spec = BronzeSpec(expected=["a", "b"], keys=["a"])
    publish = TableStore.publish
    monkeypatch.setattr(TableStore, "publish", lambda self, df, name, **kw: (_ for _ in ()).throw(OSError("lost")) if name == "bronze" else publish(self, df, name, **kw))
    with pytest.raises(OSError):
        bronze(spark, st, path, spec, None, "csv")
    assert read_quarantine(spark, st.root).count() == 0
    monkeypatch.undo()
    for _ in range(2):
        bronze(spark, st, path, spec, None, "csv")
    assert read_quarantine(spark, st.root).count() == 1


def test_content_digest(spark):
    one = spark.createDataFrame([("1", None), ("2", "y"), ("2", "y")], "a string, b string")
    same = content_digest(one.repartition(3))
    assert content_digest(one) == same
    for other in (one.dropDuplicates(), one.union(one), one.withColumnRenamed("a", "c"), one.fillna(""), one.select("b", "a")):
        assert content_digest(other) != same
