"""What the jobs of a silver run read of the batch."""
from pyspark.sql import functions as F

import strata.plans.layers as layers
from strata.plans.layers import bronze, silver
from strata.plans.presets import HEALTHCARE_BRONZE, HEALTHCARE_SILVER
from strata.sources.quarantine import read_quarantine
from strata.sources.tables import TableStore

HEADER = ("Name,Age,Gender,Blood Type,Medical Condition,Date of Admission,Doctor,Hospital,"
          "Insurance Provider,Billing Amount,Room Number,Admission Type,Discharge Date,Medication,Test Results")
LINE = "P{i},4{i},Female,B-,Asthma,{day},Dr Cy Fox,Mercy,Aetna,1200,401,Elective,2019-03-22,Insulin,Normal"


def test_statistics_read_columns_of_the_staged_batch(spark, scratch, monkeypatch):
    """Imputation statistics and the rejected rows come from column files, not from
    checkpoints of whole rows; the run gives every row once."""
    d = scratch[len("file:"):] if scratch.startswith("file:") else scratch
    import os
    os.makedirs(d, exist_ok=True)
    lines = [LINE.format(i=i, day="2019-02-30" if i == 3 else f"2019-03-1{i}") for i in range(6)]
    path = os.path.join(d, "a.csv")
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER, *lines, lines[0]]) + "\n")
    plans = []
    impute = layers.impute

    def seen(df, *a, **kw):
        plans.append(df.select("medication").agg(F.count("medication"))._jdf.queryExecution().executedPlan().toString())
        return impute(df, *a, **kw)
    monkeypatch.setattr(layers, "impute", seen)
    store = TableStore(spark, scratch + "/lake")
    bronze(spark, store, path, HEALTHCARE_BRONZE, batch_id="b")
    run = silver(spark, store, HEALTHCARE_SILVER, batch_id="b")
    assert "ReadSchema: struct<medication:string>" in plans[0] and "ExistingRDD" not in plans[0]
    assert store.read("bronze").count() == 6
    assert sorted(r["name"] for r in store.read("silver").collect()) == ["P0", "P1", "P2", "P4", "P5"]
    assert read_quarantine(spark, store.root).filter("reason = 'critical_null'").count() == 1
    assert run["report"].first()["final"] == 5
    assert store.read("silver").select("silver_ts").distinct().count() == 1
