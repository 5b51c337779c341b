"""An admissions-shaped raw file derived from the driver tables, so the full
bronze -> silver -> gold flow of the source pipeline runs on data that grows
with them.  Visit = order, patient = customer, hospital = nation; defects are
functions of the order key, as in :mod:`strata.plans.dirty`."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .presets import BLOOD_TYPES

# fixed values: mapping of order status / priority onto admissions categories
STATUS_CONDITION = {"F": "Cancer", "O": "Diabetes", "P": "Asthma"}
STATUS_MEDICATION = {"F": "Paracetamol", "O": "Insulin", "P": "Inhaler"}
PRIORITY_ADMISSION = {"1-URGENT": "Urgent", "2-HIGH": "Emergency", "3-MEDIUM": "Elective",
                      "4-NOT SPECIFIED": "Elective", "5-LOW": "Elective"}
PRIORITY_RESULT = {"1-URGENT": "Abnormal", "2-HIGH": "Abnormal", "3-MEDIUM": "Normal",
                   "4-NOT SPECIFIED": "Inconclusive", "5-LOW": "Normal"}


def _lookup(mapping: dict, col: str):
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col(col)]


def admissions_raw(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "left") \
              .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
    adm = F.to_date("o_orderdate")
    dis = F.date_add(adm, (k % 14).cast("int"))
    blood = F.array(*[F.lit(b) for b in BLOOD_TYPES])[(F.col("c_custkey") % 8).cast("int")]
    cond = _lookup(STATUS_CONDITION, "o_orderstatus")
    return o.select(
        F.when(k % 7 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("Name"),
        ((F.col("c_custkey") % 130) - 5).cast("string").alias("Age"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("Female")).alias("Gender"),
        F.when(k % 29 == 0, F.lower(blood)).otherwise(blood).alias("Blood Type"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 19 == 0, F.lower(cond)).otherwise(cond)
         .alias("Medical Condition"),
        F.when(k % 23 == 0, F.date_format(adm, "yyyy/MM/dd")).otherwise(F.date_format(adm, "yyyy-MM-dd"))
         .alias("Date of Admission"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("dr s"), (k % 50).cast("string")))
         .alias("Doctor"),
        F.col("n_name").alias("Hospital"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("No Insurance"))
         .when(k % 11 == 0, F.lit(""))
         .otherwise(F.initcap("c_mktsegment")).alias("Insurance Provider"),
        F.when(k % 31 == 0, F.lit("n/a"))
         .when(k % 37 == 0, (-F.col("o_totalprice")).cast("string"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("Billing Amount"),
        F.when(k % 41 == 0, F.lit(None)).otherwise((k % 500).cast("string")).alias("Room Number"),
        _lookup(PRIORITY_ADMISSION, "o_orderpriority").alias("Admission Type"),
        F.date_format(dis, "yyyy-MM-dd").alias("Discharge Date"),
        F.when(k % 43 == 0, F.lit(None)).otherwise(_lookup(STATUS_MEDICATION, "o_orderstatus"))
         .alias("Medication"),
        _lookup(PRIORITY_RESULT, "o_orderpriority").alias("Test Results"),
    )


def run_layers(spark: SparkSession, orders, customer, nation, root: str, upto: str = "gold") -> dict:
    """Write the raw file, then bronze -> silver -> gold (or stop after
    ``upto``) into a store at ``root``."""
    from ..sources.tables import TableStore
    from .layers import bronze, gold, silver
    from .presets import HEALTHCARE_BRONZE, HEALTHCARE_GOLD, HEALTHCARE_SILVER
    raw_path = f"{root}/landing/admissions.csv"
    admissions_raw(orders, customer, nation).write.option("header", "true").csv(raw_path)
    store = TableStore(spark, f"{root}/lake")
    out = {"store": store, "bronze": bronze(spark, store, raw_path, HEALTHCARE_BRONZE, batch_id="b1")}
    if upto in ("silver", "gold"):
        out["silver"] = silver(spark, store, HEALTHCARE_SILVER, batch_id="b1", enforce=False)
    if upto == "gold":
        out["gold"] = gold(spark, store, HEALTHCARE_GOLD)
    return out
