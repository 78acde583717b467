"""Encounter files: headed CSV with a fixed, typed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema
from billscope.functions import money

CORRUPT = "_corrupt_record"


def read_encounters(
    spark: SparkSession, path: str | list[str], keep_corrupt: bool = False, **options: str
) -> DataFrame:
    """Typed scan; a cell that cannot be read is NULL. ``options`` are further ones of Spark's CSV reader.

    ``keep_corrupt`` adds the raw text of lines with such cells. Only cells of the columns a query uses are
    converted, so only those can be found unreadable.
    """
    columns = schema.ENCOUNTER_FILE
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    if keep_corrupt:
        columns = T.StructType([*columns.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return schema.to_internal_names(reader.schema(columns).csv(path))


def stream_encounters(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """Encounter files as they arrive in ``folder``, so many per batch."""
    reader = spark.readStream.option("header", True).option("maxFilesPerTrigger", files_per_batch)
    return schema.to_internal_names(reader.schema(schema.ENCOUNTER_FILE).csv(folder))


def unreadable_rows(encounters: DataFrame) -> DataFrame:
    """Lines with at least one unreadable cell: the cells that could be read, and the raw text."""
    return (
        encounters.filter(F.col(CORRUPT).isNotNull())
        .withColumnRenamed(CORRUPT, schema.RAW_LINE)
        .withColumn("reject_reason", F.lit("unreadable"))
    )


def billing_columns(encounters: DataFrame) -> DataFrame:
    """The columns billing needs, the amount in cents; everything else is pruned from the scan.

    Encounters read with ``keep_corrupt`` also give the text of lines in which one of these cells is unreadable.
    """
    cents = money.cents(F.col("billing_amount")).alias("bill_cents")
    text = [F.col(CORRUPT).alias(schema.RAW_LINE)] if CORRUPT in encounters.columns else []
    return encounters.select(*schema.BILL_KEYS, "discharge_date", cents, *text)
