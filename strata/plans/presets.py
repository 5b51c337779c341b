"""Layer specs: the hospital-admissions layout of the source pipeline, and the
same runs mapped onto the driver's orders tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import band, day_diff
from ..operators.impute import Rule
from ..operators.star import group_summary, money_avg, money_sum
from .layers import BronzeSpec, DimSpec, GoldSpec, SilverSpec

# ---------------------------------------------------------------------------
# fixed values: the admissions layout, category whitelists, imputation
# defaults, band bounds/labels and restricted values of the source pipeline
ADMISSION_COLUMNS = [
    "Name", "Age", "Gender", "Blood Type", "Medical Condition", "Date of Admission", "Doctor",
    "Hospital", "Insurance Provider", "Billing Amount", "Room Number", "Admission Type",
    "Discharge Date", "Medication", "Test Results",
]
ADMISSION_KEYS = ["name", "date_of_admission", "hospital"]
CONDITIONS = ["Cancer", "Arthritis", "Diabetes", "Asthma", "Hypertension", "Obesity"]
ADMISSION_TYPES = ["Emergency", "Urgent", "Elective"]
TEST_RESULTS = ["Normal", "Abnormal", "Inconclusive"]
GENDERS = ["Male", "Female"]
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
AGE_BOUNDS, AGE_LABELS = [18, 40, 60, 80], ["Paediatric", "Young Adult", "Middle Aged", "Senior", "Elderly"]
BILLING_BOUNDS, BILLING_LABELS = [10000, 30000], ["Low", "Medium", "High"]
RESTRICTED_VALUES = ["No Insurance"]
DEFAULT_CONDITION = "Unknown Condition"
DEFAULT_BILLING = 10000.0
DEFAULT_INSURANCE = "Unknown"
DEFAULT_TEST_RESULT = "Normal"
DEFAULT_DOCTOR = "Dr. Unknown"
DEFAULT_MEDICATION = "Not Prescribed"
DEFAULT_ROOM = 100
CRITICAL = ["medical_condition", "date_of_admission", "billing_amount", "admission_type"]
REPORT_NULL_COLS = ["medical_condition", "date_of_admission", "billing_amount", "admission_type",
                    "insurance_provider", "test_results", "doctor", "medication", "age", "room_number"]
DEMO_SOURCE = "schema_evo_demo"
PATIENT_KEY = ["name_masked", "medical_condition", "_eff_start"]
PATIENT_ATTRS = ["age", "age_group", "gender", "blood_type", "insurance_provider", "_eff_end", "_is_current"]
FACT_KEY = ["name_masked", "hospital", "date_of_admission"]
FACT_COLS = ["date_of_admission", "discharge_date", "admission_type", "medication", "test_results",
             "billing_amount", "room_number", "length_of_stay", "billing_category", "admission_year",
             "admission_month", "_is_restricted", "silver_ts"]
# ---------------------------------------------------------------------------


def _raw_month():
    """yyyymm of the raw admission date, whatever stands between its numbers
    (0 without one): loads touch few months."""
    digits = F.substring(F.regexp_replace("date_of_admission", "[^0-9]", ""), 1, 6)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


HEALTHCARE_BRONZE = BronzeSpec(expected=ADMISSION_COLUMNS, keys=ADMISSION_KEYS, partition=_raw_month)

HEALTHCARE_SILVER = SilverSpec(
    keys=ADMISSION_KEYS,
    null_cols=[c.lower().replace(" ", "_") for c in ADMISSION_COLUMNS],
    types={"age": "int", "billing_amount": "double", "room_number": "int"},
    ranges={"age": (0, 120, False), "billing_amount": (0, None, True)},
    dates={"date_of_admission": "yyyy-MM-dd", "discharge_date": "yyyy-MM-dd"},
    title=["name", "doctor"],
    categories={"medical_condition": (CONDITIONS, "initcap"), "admission_type": (ADMISSION_TYPES, "initcap"),
                "test_results": (TEST_RESULTS, "initcap"), "gender": (GENDERS, "initcap"),
                "blood_type": (BLOOD_TYPES, None)},
    # condition first: later rules group by it
    rules=[Rule("medical_condition", ["medication"], "mode", DEFAULT_CONDITION),
           Rule("billing_amount", ["medical_condition", "admission_type"], "median", DEFAULT_BILLING),
           Rule("insurance_provider", ["hospital", "admission_type"], "mode", DEFAULT_INSURANCE),
           Rule("test_results", ["medical_condition"], "mode", DEFAULT_TEST_RESULT),
           Rule("doctor", ["hospital"], "mode", DEFAULT_DOCTOR),
           Rule("medication", ["medical_condition"], "mode", DEFAULT_MEDICATION),
           Rule("room_number", ["admission_type"], "median", DEFAULT_ROOM)],
    critical=CRITICAL,
    derive={
        "length_of_stay": lambda: day_diff("discharge_date", "date_of_admission"),
        "age_group": lambda: band("age", AGE_BOUNDS, AGE_LABELS),
        "billing_category": lambda: band("billing_amount", BILLING_BOUNDS, BILLING_LABELS),
        "admission_year": lambda: F.year("date_of_admission"),
        "admission_month": lambda: F.month("date_of_admission"),
        "silver_ts": lambda: F.current_timestamp(),
    },
    masks={"name": "name_masked", "doctor": "doctor_masked"},
    restricted=("insurance_provider", RESTRICTED_VALUES),
    scd_start=None,  # load date; the admission date is part of the key
    tracked=["medical_condition"], type1=["insurance_provider"], touch=["silver_ts"],
    slice_col="admission_type",
    # admission month is part of the key: a batch of recent admissions
    # rewrites only recent months of the history table
    partition=lambda: F.coalesce(F.date_format("date_of_admission", "yyyyMM").cast("int"), F.lit(0)),
    gate_not_null=CRITICAL,
    report_null_cols=REPORT_NULL_COLS,
    exclude_sources=(DEMO_SOURCE,),
    gate_rules={"no_negative_billing": lambda: F.col("billing_amount") < 0,
                "ages_valid": lambda: (F.col("age") <= 0) | (F.col("age") > 120)},
    report_ranges={"age": lambda: (F.col("age") <= 0) | (F.col("age") > 120),
                   "billing": lambda: F.col("billing_amount") < 0},
)


def _condition_summary(fact, tables):
    dim = tables["dim_patient"].filter(F.col("_is_current")).select("patient_sk", "medical_condition")
    return group_summary(fact.join(dim, "patient_sk", "left"), ["medical_condition", "admission_type"], {
        "total_visits": F.count(F.lit(1)), "avg_billing": money_avg("billing_amount"),
        "avg_los": money_avg("length_of_stay"), "total_revenue": money_sum("billing_amount"),
        "unique_patients": F.countDistinct("patient_sk")})


def _monthly_trend(fact, tables):
    return group_summary(fact, ["admission_year", "admission_month", "admission_type"], {
        "total_admissions": F.count(F.lit(1)), "avg_billing": money_avg("billing_amount"),
        "avg_los": money_avg("length_of_stay"),
        "abnormal_count": F.sum(F.when(F.col("test_results") == "Abnormal", 1).otherwise(0))})


HEALTHCARE_GOLD = GoldSpec(
    # visits can share (patient, condition, start): a current version wins over a closed one
    dims=[DimSpec("dim_patient", PATIENT_KEY, PATIENT_ATTRS, "patient_sk", rename={"name_masked": "patient_id"},
                  history=True, order=["_is_current"]),
          DimSpec("dim_doctor", ["doctor_masked"], [], "doctor_sk", rename={"doctor_masked": "doctor_id"}),
          DimSpec("dim_hospital", ["hospital"], [], "hospital_sk")],
    fact_name="fact_patient_visits",
    fact_cols=FACT_COLS,
    fact_rename={"silver_ts": "etl_ts"},
    fact_key=FACT_KEY,
    partition_by=["admission_year"],
    marts={"gold_condition_summary": _condition_summary, "gold_monthly_trend": _monthly_trend},
    summary_view=("gold_condition_summary", "medical_condition"),
)
