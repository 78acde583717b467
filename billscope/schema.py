"""Column contracts of the tables the engine reads and writes.

Inside the engine columns are snake_case and money that is summed is whole cents in a bigint.
Names with spaces and decimal amounts exist only at the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 2)

# The encounter file's header, in file order.
ENCOUNTER_FILE = T.StructType(
    [
        T.StructField("Name", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Blood Type", T.StringType()),
        T.StructField("Medical Condition", T.StringType()),
        T.StructField("Date of Admission", T.DateType()),
        T.StructField("Doctor", T.StringType()),
        T.StructField("Hospital", T.StringType()),
        T.StructField("Insurance Provider", T.StringType()),
        T.StructField("Billing Amount", AMOUNT),
        T.StructField("Room Number", T.IntegerType()),
        T.StructField("Admission Type", T.StringType()),
        T.StructField("Discharge Date", T.DateType()),
        T.StructField("Medication", T.StringType()),
        T.StructField("Test Results", T.StringType()),
    ]
)

# Limits of the stored tables.
NAME_LENGTH = 60
MESSAGE_LENGTH = 40
CATEGORY_LENGTH = 20
STORED_AMOUNT_DIGITS = 7

# Number of segments and seed of the fit, labels and the quantiles that separate them.
SEGMENT_COUNT = 9
SEGMENT_SEED = 42
SEGMENT_LABELS = ("Very Low", "Low", "Moderate", "High", "Very High")
SEGMENT_QUANTILES = (0.2, 0.4, 0.6, 0.8)

BILL_KEYS = ("medical_condition", "hospital", "insurance_provider", "admission_type")
DAILY_KEYS = (*BILL_KEYS, "discharge_date")
MONTH_KEYS = ("medical_condition", "hospital", "discharge_month")
QUARTER_KEYS = ("medical_condition", "hospital", "insurance_provider", "quarter")
BILLING_COLUMNS = (*BILL_KEYS, "billing_amount", "discharge_date")

# Columns of the stored tables.
ADMISSION = T.StructType(
    [
        T.StructField("medical_condition", T.StringType()),
        T.StructField("hospital", T.StringType()),
        T.StructField("insurance_provider", T.StringType()),
        T.StructField("average_bill_amount", AMOUNT),
        T.StructField("admission_type", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("discharge_date", T.DateType()),
        T.StructField("bill_cents", T.LongType()),
        T.StructField("bill_count", T.LongType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

# A line of an encounter file with an unreadable cell, kept beside the rejected rows.
RAW_LINE = "raw_line"
LOADS = T.StructType([*ADMISSION.fields, T.StructField(RAW_LINE, T.StringType())])

SEGMENT = T.StructType(
    [
        T.StructField("medical_condition", T.StringType()),
        T.StructField("hospital", T.StringType()),
        T.StructField("insurance_provider", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("avg_bill_amount", AMOUNT),
        T.StructField("bill_cat", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("last_loaded", T.DateType()),
        T.StructField("row_count", T.LongType()),
        # The table's pointer after the run, or the batch of a stream; not shown in reports.
        T.StructField("version", T.LongType()),
    ]
)

# Longest text per stored column, for tables whose strings are bounded.
TEXT_LENGTHS = {
    "medical_condition": NAME_LENGTH,
    "hospital": NAME_LENGTH,
    "insurance_provider": NAME_LENGTH,
    "admission_type": NAME_LENGTH,
    "message": MESSAGE_LENGTH,
    "bill_cat": CATEGORY_LENGTH,
}


def internal_name(public: str) -> str:
    return public.lower().replace(" ", "_")


def public_name(internal: str) -> str:
    return internal.replace("_", " ").title()


def to_internal_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: internal_name(name) for name in df.columns})


def to_public_names(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rename to the headed form people read: ``bill_cat`` becomes ``Bill Cat``."""
    return df.withColumnsRenamed({name: public_name(name) for name in columns or df.columns})


def text_column_types(df: DataFrame) -> str:
    """Bounded text columns as DDL, for tables created through JDBC."""
    return ", ".join(
        f"`{name}` VARCHAR({TEXT_LENGTHS[internal_name(name)]})"
        for name in df.columns
        if internal_name(name) in TEXT_LENGTHS
    )
