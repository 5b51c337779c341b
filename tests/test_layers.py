"""Two admissions batches through bronze, silver and gold."""
import os

from pyspark.sql import functions as F

from strata.plans.layers import bronze, gold, silver
from strata.plans.presets import HEALTHCARE_BRONZE, HEALTHCARE_GOLD, HEALTHCARE_SILVER
from strata.sources.quarantine import read_quarantine
from strata.sources.tables import TableStore

HEADER = ("Name,Age,Gender,Blood Type,Medical Condition,Date of Admission,Doctor,Hospital,"
          "Insurance Provider,Billing Amount,Room Number,Admission Type,Discharge Date,Medication,Test Results")
BATCH1 = [
    "cHaRlEs rOdGeRs,45,male,A+,cancer,2019-01-05,dr ann lee,General,Aetna,1200.5,101,emergency,2019-01-09,Insulin,normal",
    "Charles Rodgers,45,Male,A+,Cancer,2019-01-05,Dr Ann Lee,General,Aetna,1200.5,101,Emergency,2019-01-09,Insulin,Normal",
    "Maria Diaz,999,Female,O-,,2019-02-01,Dr Bo Chan,General,No Insurance,-50,202,Urgent,2019-02-03,Insulin,",
    "Tom Hill,30,Male,AB+,Asthma,2019-02-30,Dr Bo Chan,Mercy,Cigna,900,303,Elective,2019-03-01,Inhaler,Abnormal",
    "Ann Ray,61,Female,B-,Diabetes,2019-03-10,Dr Cy Fox,Mercy,,3100,,Elective,2019-03-12,Insulin,Normal",
    "Zed Null,,,,,,,,,,,,,,",
    "Bad,Row",
]
BATCH2 = [
    "Ann Ray,61,Female,B-,Diabetes,2019-03-10,Dr Cy Fox,Mercy,Aetna,3100,401,Elective,2019-03-12,Insulin,Normal",
    "Charles Rodgers,45,Male,A+,Obesity,2019-01-05,Dr Ann Lee,General,Aetna,1200.5,101,Emergency,2019-01-09,Insulin,Normal",
    "Lee Park,70,Male,O+,Hypertension,2019-04-01,Dr Cy Fox,General,Medicare,22000,12,Urgent,2019-04-06,Lisinopril,Inconclusive",
]


def _csv(scratch, name, lines):
    d = scratch[len("file:"):] if scratch.startswith("file:") else scratch
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w") as fh:
        fh.write("\n".join([HEADER] + lines) + "\n")
    return p


def test_bronze_partitioned_merge_matches_full_rewrite(spark, scratch):
    import dataclasses
    part = HEALTHCARE_BRONZE
    full, local = TableStore(spark, scratch + "/full"), TableStore(spark, scratch + "/part")
    for i, lines in enumerate([BATCH1, BATCH2]):
        p = _csv(scratch, f"pb{i}.csv", lines)
        bronze(spark, full, p, dataclasses.replace(HEALTHCARE_BRONZE, partition=None), batch_id="b")
        bronze(spark, local, p, part, batch_id="b")
    cols = [c for c in full.read("bronze").columns if c not in ("ingested_at", "source_file")]
    a = sorted(map(tuple, full.read("bronze").select(cols).collect()), key=str)
    b = sorted(map(tuple, local.read("bronze").select(cols).collect()), key=str)
    assert a == b


def test_two_batches_end_to_end(spark, scratch):
    store = TableStore(spark, scratch + "/lake")
    p1 = _csv(scratch, "batch1.csv", BATCH1)
    s = bronze(spark, store, p1, HEALTHCARE_BRONZE, batch_id="b1")
    assert s["mode"] == "first_load"
    assert read_quarantine(spark, store.root).filter("reason = 'parse_error'").count() == 1   # "Bad,Row"
    assert store.read("bronze").count() == 6        # both Charles rows keep distinct raw keys here
    r1 = silver(spark, store, HEALTHCARE_SILVER, batch_id="b1")
    sv = store.read("silver")
    names = sorted(r.name for r in sv.collect())
    assert names.count("Charles Rodgers") == 1      # case variants collapse before dedup
    maria = sv.filter("name = 'Maria Diaz'").first()
    assert maria.age is None and maria._is_restricted and maria.billing_amount >= 0
    assert sv.filter("name = 'Tom Hill'").count() == 0        # impossible date -> critical -> quarantine
    assert read_quarantine(spark, store.root).filter("reason = 'critical_null'").count() == 1
    assert r1["report"].first().score <= 100
    # second batch: Ann gets insurance (type 1), Charles changes condition (type 2), Lee is new
    p2 = _csv(scratch, "batch2.csv", BATCH2)
    bronze(spark, store, p2, HEALTHCARE_BRONZE, batch_id="b2")
    silver(spark, store, HEALTHCARE_SILVER, batch_id="b2")
    sv = store.read("silver")
    cur = {r.name: r for r in sv.filter("_is_current").collect()}
    assert cur["Ann Ray"].insurance_provider == "Aetna"
    assert cur["Charles Rodgers"].medical_condition == "Obesity"
    assert sv.filter("name = 'Charles Rodgers' AND NOT _is_current").count() == 1
    assert "Lee Park" in cur
    # re-running silver with no new bronze rows changes nothing
    v = store._entry("silver")
    assert silver(spark, store, HEALTHCARE_SILVER)["rows"] == 0 and store._entry("silver") == v
    out = gold(spark, store, HEALTHCARE_GOLD)
    fact = out["fact_patient_visits"]
    assert fact.count() == sv.filter("_is_current").count()            # no fan-out
    assert fact.join(out["dim_patient"], "patient_sk", "left_anti").count() == 0
    assert out["vw_fact_patient_visits_public"].filter(F.col("etl_ts").isNull()).count() == 0
    assert "doctor_name" not in out["dim_doctor"].columns               # raw PII stays out of gold
    summary = spark.sql("SELECT * FROM vw_gold_condition_summary").collect()
    assert sum(r.total_visits for r in summary) == fact.count()


def test_failed_gate_publishes_nothing_and_keeps_the_mark(spark, scratch):
    import dataclasses

    import pytest
    from pyspark.sql import functions as F
    from strata.streaming.incremental import read_watermark
    store = TableStore(spark, scratch + "/gate")
    bronze(spark, store, _csv(scratch, "g1.csv", BATCH1), HEALTHCARE_BRONZE, batch_id="b1")
    strict = dataclasses.replace(HEALTHCARE_SILVER, gate_rules={
        **HEALTHCARE_SILVER.gate_rules, "always_fails": lambda: F.lit(True)})
    with pytest.raises(ValueError, match="always_fails"):
        silver(spark, store, strict, batch_id="b1")
    assert not store.exists("silver")
    scope = "admission_type=All"
    assert read_watermark(spark, f"{store.root}/_watermarks/silver", scope) is None
    assert read_quarantine(spark, store.root).filter("stage = 'silver'").count() == 0
    silver(spark, store, HEALTHCARE_SILVER, batch_id="b1")      # the same batch then loads
    assert store.exists("silver")
    assert read_watermark(spark, f"{store.root}/_watermarks/silver", scope).first()["mark"].year > 2000
    assert read_quarantine(spark, store.root).filter("stage = 'silver'").count() > 0


def test_reloading_the_same_file_changes_no_silver_rows(spark, scratch):
    store = TableStore(spark, scratch + "/again")
    p = _csv(scratch, "same.csv", BATCH1)
    bronze(spark, store, p, HEALTHCARE_BRONZE, batch_id="b1")
    silver(spark, store, HEALTHCARE_SILVER, batch_id="b1")
    volatile = {"ingested_at", "ingestion_date", "batch_id", "silver_ts", "_eff_start", "_eff_end"}
    cols = [c for c in store.read("silver").columns if c not in volatile]
    before = sorted(map(tuple, store.read("silver").select(cols).collect()), key=str)
    s = bronze(spark, store, p, HEALTHCARE_BRONZE, batch_id="b2")
    assert s["mode"] == "update"                       # the file was seen before
    assert store.read("bronze").count() == 6           # upsert, not append
    silver(spark, store, HEALTHCARE_SILVER, batch_id="b2")
    after = sorted(map(tuple, store.read("silver").select(cols).collect()), key=str)
    assert before == after


def test_a_current_version_wins_over_a_closed_one(spark, scratch):
    """Two visits share patient, condition and start; one is closed by a second
    batch: its fact still finds the current version of the other."""
    base = "Ann Ray,61,Female,B-,{c},2019-03-{d},Dr Cy Fox,Mercy,Aetna,1200,401,Elective,2019-03-22,Insulin,Normal"
    store = TableStore(spark, scratch + "/versions")
    for i, lines in enumerate([[base.format(c="Asthma", d=10), base.format(c="Asthma", d=11)], [base.format(c="Cancer", d=10)]]):
        bronze(spark, store, _csv(scratch, f"v{i}.csv", lines), HEALTHCARE_BRONZE, batch_id=f"b{i}")
        silver(spark, store, HEALTHCARE_SILVER, batch_id=f"b{i}")
    out = gold(spark, store, HEALTHCARE_GOLD)
    rows = {r.medical_condition: r for r in out["vw_gold_condition_summary"].collect()}
    assert {c: (r.total_visits, r.total_revenue) for c, r in rows.items()} == {"Asthma": (1, 1200.0), "Cancer": (1, 1200.0)}


def test_report_covers_all_null_columns(spark, scratch):
    """Ages all null: a tenth of the report's cells, penalty 20 of 100 (grade B is 80)."""
    line = "P{i},,Female,B-,Asthma,2019-03-10,Dr Cy Fox,Mercy,Aetna,1200,401,Elective,2019-03-22,Insulin,Normal"
    store = TableStore(spark, scratch + "/nulls")
    bronze(spark, store, _csv(scratch, "n.csv", [line.format(i=i) for i in range(5)]), HEALTHCARE_BRONZE, batch_id="b")
    r = silver(spark, store, HEALTHCARE_SILVER, batch_id="b")["report"].first()
    assert (r.avg_null_pct, r.score, r.grade) == (10.0, 80.0, "B")
