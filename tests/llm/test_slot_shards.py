import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import slot_shards as ss
from tests.llm.conftest import clashing

SF = "/root/testdata/sf0.001"


def run(spark, docs, tmp, shards=ss.SHARDS):
    rec = ss.records(docs)
    size, rows = ss.slot_totals(rec)
    kept = ss.SlotMaps(spark, tmp).save(shards, ss.map_for(shards), size, rows)
    return ss.placed(rec, kept).collect()


def check(rows, docs):
    want = collections.Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    places, shards, sizes = collections.defaultdict(list), collections.defaultdict(set), collections.Counter()
    for r in rows:
        places[r["shard"]].append(r["slot"])
        shards[r["doc_id"]].add(r["shard"])
        sizes[r["virtual_slot"]] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(s) == 1 for s in shards.values())
    assert all(r["slot_bytes"] == sizes[r["virtual_slot"]] for r in rows)


def test_odd_rows(spark, odd_docs, scratch):
    check(run(spark, clashing(odd_docs), scratch), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])


def test_query_and_law(spark):
    rows = ss.op13_slot_shards(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(rows, [tuple(r) for r in docs])
    assert {r["law"] for r in rows} == {"key"} and all(0 <= r["shard"] < 24 for r in rows)
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in ss.op13_slot_shards(spark, SF).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


def test_id_and_shard_count_decide(spark, scratch):
    """The same ids among other records keep their shards."""
    rows = [(i, "a" * i, "en", "a", i) for i in range(300)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    one = run(spark, spark.createDataFrame(rows, schema), scratch + "/one")
    two = run(spark, spark.createDataFrame(rows[:20] + [(9000 + i, "b" * 4000, "en", "a", 0) for i in range(50)], schema), scratch + "/two")
    a = {r["doc_id"]: r["shard"] for r in one}
    assert all(a[r["doc_id"]] == r["shard"] for r in two if r["doc_id"] < 300)


def test_hot_id_is_cut_into_parts(spark, scratch, monkeypatch):
    monkeypatch.setattr(ss, "COPIES", 7)
    monkeypatch.setattr(ss, "RANGE_ROWS", 2)
    rows = [(5, "hot", "en", "a", 3)] * 500 + [(None, f"t{i}", "en", "a", 3) for i in range(300)] + [(i, "x", "en", "a", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    check(run(spark, df, scratch), [(r[0], r[1]) for r in rows])


def test_growth_moves_only_into_the_new_shard():
    last = ss.first_map()
    for new in range(1, 40):
        now = ss.grow(last, new)
        moved = now != last
        assert set(now[moved]) == {new} and moved.sum() == ss.SLOTS // (new + 1)
        count = np.bincount(now, minlength=new + 1)
        assert count.max() - count.min() <= 1 + (new + 1) // 2 and count.min() > 0
        last = now


def test_rebalance_by_bytes():
    rng = np.random.default_rng(1)
    size = (rng.pareto(1.5, ss.SLOTS) * 1000).astype(np.int64) + 1
    before = ss.map_for(24)
    after = ss.rebalance(before, size)
    load = np.bincount(after, size, 24)
    assert load.max() <= 1.02 * load.mean() or size.max() > load.mean()
    assert (after != before).mean() < 0.25           # most slots stay
    assert (ss.rebalance(after, size) == after).all()
    assert (ss.rebalance(ss.first_map(), size) == 0).all()


def test_versions_are_kept_and_records_written(spark, scratch, odd_docs):
    maps = ss.SlotMaps(spark, scratch + "/maps")
    none = np.zeros(ss.SLOTS, np.int64)
    one = maps.save(3, ss.map_for(3), none, none)
    maps.save(4, ss.map_for(4), none, none)
    with pytest.raises(Exception, match="(?i)already exists"):
        maps.save(3, ss.map_for(3), none, none)
    ss.write_shards(odd_docs, one, scratch + "/shards")
    back = spark.read.parquet(scratch + "/shards")
    assert back.count() == odd_docs.count() and set(odd_docs.columns) < set(back.columns)
    assert back.filter(F.col("shard") > 2).isEmpty()
    assert maps.load(4).agg(F.max("shard")).head()[0] == 3


def test_empty(spark, no_docs, scratch):
    assert run(spark, no_docs, scratch) == []
