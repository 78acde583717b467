"""Billing encounters and run events derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import money


LINE_COLUMNS = ("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bill_rows(
    lines: DataFrame, orders: DataFrame, customers: DataFrame, suppliers: DataFrame, merge: bool = True
) -> DataFrame:
    """One bill per order line, in the columns of ``billing_columns``.

    Orders grow with their lines, so with ``merge`` these two are never broadcast, which also spreads the work
    behind the join over all cores. Some lines of many may be the smaller side; Catalyst decides then. Customers
    and suppliers are broadcast only where Catalyst finds their files small enough. AQE splits an order, customer or supplier with very many lines.
    """
    payers = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", "o_orderpriority", "c_mktsegment"
    )
    return (
        lines.join(payers.hint("merge") if merge else payers, lines.l_orderkey == payers.o_orderkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .select(
            F.col("o_orderpriority").alias("medical_condition"),
            F.col("s_name").alias("hospital"),
            F.col("c_mktsegment").alias("insurance_provider"),
            F.col("l_returnflag").alias("admission_type"),
            F.col("l_shipdate").cast("date").alias("discharge_date"),
            money.cents_of_double(F.col("l_extendedprice")).alias("bill_cents"),
        )
    )


def order_bills(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Bills of the order tables in ``folder``, of all order lines unless some are given."""
    return bill_rows(
        _table(spark, folder, "lineitem") if lines is None else lines,
        _table(spark, folder, "orders"),
        _table(spark, folder, "customer"),
        _table(spark, folder, "supplier"),
        merge=lines is None,
    )


def order_encounters(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of an encounter file, those without a counterpart in the order tables NULL."""
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    customers = _table(spark, folder, "customer")
    suppliers = _table(spark, folder, "supplier")
    parts = _table(spark, folder, "part")
    known = {
        "Name": F.col("c_name"),
        "Medical Condition": F.col("o_orderpriority"),
        "Date of Admission": F.col("o_orderdate").cast("date"),
        "Doctor": F.col("p_name"),
        "Hospital": F.col("s_name"),
        "Insurance Provider": F.col("c_mktsegment"),
        "Billing Amount": money.amount(money.cents_of_double(F.col("l_extendedprice"))),
        "Admission Type": F.col("l_returnflag"),
        "Discharge Date": F.col("l_shipdate").cast("date"),
        "Medication": F.col("p_type"),
    }
    joined = (
        lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
        .join(customers, orders.o_custkey == customers.c_custkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
    )
    return joined.select(
        *[
            known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.ENCOUNTER_FILE.fields
        ]
    )


def ledger_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run-ledger rows; a purchase stands for a load that reached its day."""
    return _table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("stage"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "purchase", F.col("ts").cast("date")).alias("last_loaded"),
    )
