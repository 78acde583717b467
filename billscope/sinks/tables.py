"""Writing tables: bulk append, full replace and idempotent loads.

Replaced tables, loads and reports change by a pointer (``billscope.versions``): a write that fails changes nothing,
and a reader sees one version.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema, versions
from billscope.functions import calendar
from billscope.operators import quality

#: The load of rejected rows that no date places.
OPEN = "open"
# How published CSV is written and read; a reader adds ``multiLine`` where texts may hold line ends.
CSV = {"escape": '"', "quoteAll": "true", "emptyValue": "", "nullValue": "\\N"}


def jdbc_write_options(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    connections: int = 16,
) -> dict[str, str]:
    """Options of a JDBC write: batched inserts over a bounded number of connections.

    With ``truncate`` a replace keeps the table and its column types; a new table gets bounded text columns.
    """
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}
    options |= {"truncate": "true"}
    if types := schema.text_column_types(df):
        options["createTableColumnTypes"] = types
    return options | dict(properties or {})


def _observed(df: DataFrame, name: str, sort_by: str | None) -> tuple[DataFrame, Any]:
    return quality.observe_counts(df.sortWithinPartitions(sort_by) if sort_by else df, name)


def _to_jdbc(df: DataFrame, location: str, mode: str, sort_by: str | None, jdbc: Mapping) -> int:
    rows, seen = _observed(df, f"{mode}_jdbc", sort_by)
    if "message" in rows.columns:  # the only text no rule bounds
        rows = rows.withColumn("message", F.left("message", F.lit(schema.MESSAGE_LENGTH)))
    rows.write.format("jdbc").options(**jdbc_write_options(df, location, **jdbc)).mode(mode).save()
    return seen.get["rows"]


def append(df: DataFrame, location: str, kind: str = "parquet", sort_by: str | None = None, **jdbc) -> int:
    """Bulk append; returns the number of rows, counted while they are written."""
    if kind == "jdbc":
        return _to_jdbc(df, location, "append", sort_by, jdbc)
    rows, seen = _observed(df, f"append_{kind}", sort_by)
    before = versions.current(df.sparkSession, location)
    folder = versions.new_folder()
    rows.write.mode("append").format(kind).save(location if before is None else f"{location}/{folder}")
    if before is not None:
        versions.commit(df.sparkSession, location, [*before.folders, folder], before)
    return seen.get["rows"]


def replace(
    df: DataFrame,
    location: str,
    kind: str = "parquet",
    sort_by: str | None = None,
    guard: Callable[[], None] | None = None,
    options: Mapping[str, str] | None = None,
    **jdbc,
) -> int:
    """Replace the whole table; returns the number of rows.

    The new version is written beside the one that stands, which stays the table until ``guard`` (a lease's check) has
    passed and the pointer names the new one. JDBC truncates and writes, so a failed replace there is repeated.
    """
    if kind == "jdbc":
        return _to_jdbc(df, location, "overwrite", sort_by, jdbc)
    spark, folder = df.sparkSession, versions.new_folder()
    before = versions.current(spark, location)
    rows, seen = _observed(df, f"replace_{kind}", sort_by)
    rows.write.format(kind).options(**(options or {})).save(f"{location}/{folder}")
    if guard:
        guard()
    versions.commit(spark, location, [folder], before)
    return seen.get["rows"]


def create_if_missing(spark: SparkSession, location: str, columns: T.StructType) -> DataFrame:
    """The parquet table at ``location``, created empty if there is none."""
    spark.createDataFrame([], columns).write.mode("ignore").parquet(location)
    return spark.read.schema(columns).parquet(location)


def write_load(
    checked: DataFrame,
    location: str,
    load_from: str,
    placed: Column | None = None,
    afresh: bool = False,
    guard: Callable[[], None] | None = None,
) -> dict[str, Any]:
    """Write one load of checked admission rows; returns rows loaded and rejected and the highest date loaded.

    Accepted and rejected rows go into one table in one commit, apart by the partition ``outcome``. The load
    itself is a partition named after where it starts, so repeating a load replaces it. Rows that are not
    ``placed`` make the load ``open``, which is replaced by every load; only unreadable lines of earlier files
    stay in it. The pointer then names the loads that make up the table: with ``afresh`` this one only, which must
    not be empty.

    Rebalancing gathers a month into few files and splits a month that is too large for one task.
    """
    spark = checked.sparkSession
    if schema.RAW_LINE not in checked.columns:
        checked = checked.withColumn(schema.RAW_LINE, F.lit(None))
    placed = checked.select(
        *[F.col(field.name).cast(field.dataType) for field in schema.LOADS.fields],
        F.when(F.col("reject_reason").isNull(), "loaded").otherwise("rejected").alias("outcome"),
        calendar.month_start(F.col("discharge_date")).alias("discharge_month"),
        (F.lit(load_from) if placed is None else F.when(placed, load_from).otherwise(OPEN)).alias("load_from"),
    )
    folders = ["load_from", "outcome", "discharge_month"]
    loaded = F.col("outcome") == "loaded"
    placed = placed.hint("rebalance", *folders[1:]).sortWithinPartitions(*folders, "discharge_date")
    placed, seen = quality.observe_counts(
        placed,
        "load",
        loaded=F.count_if(loaded),
        last_loaded=F.max(F.when(loaded, F.col("discharge_date"))),
        unreadable=F.coalesce(F.sum(F.when(F.col(schema.RAW_LINE).isNotNull(), F.col("bill_count"))), F.lit(0)),
    )
    before, folder = versions.current(spark, location), versions.new_folder()
    standing = [] if before is None or afresh else before.folders
    placed.write.partitionBy(*folders).parquet(f"{location}/{folder}")
    counts = seen.get
    if afresh and not counts["rows"]:
        raise quality.NoRowsError("no rows in encounters")
    opened = [path for path in standing if path.endswith(f"/load_from={OPEN}")]
    if opened:
        _keep_lines(spark, location, opened, folder, folders)
    kept = [path for path in standing if path not in opened and not path.endswith(f"/load_from={load_from}")]
    if guard:
        guard()
    now = versions.commit(spark, location, [*kept, *versions.subfolders(spark, location, folder)], before)
    return {
        "loaded": counts["loaded"],
        "rejected": counts["rows"] - counts["loaded"],
        "unreadable": counts["unreadable"],
        "last_loaded": counts["last_loaded"],
        "version": now.number,
    }


def _keep_lines(spark: SparkSession, location: str, opened: list[str], folder: str, folders: list[str]) -> None:
    """Write again the unreadable lines of the open load that this load hasn't met."""
    partitions = [T.StructField(name, T.StringType()) for name in folders[:2]] + [T.StructField(folders[2], T.DateType())]
    columns = T.StructType([*schema.LOADS.fields, *partitions])

    def lines(paths: list[str]) -> DataFrame:
        rows = versions.read(spark, location, columns, pointer=versions.Pointer(0, paths))
        return rows.filter(F.col(schema.RAW_LINE).isNotNull())

    again = lines([path for path in versions.subfolders(spark, location, folder) if path.endswith(f"={OPEN}")])
    kept = lines(opened).dropDuplicates().join(again.select(schema.RAW_LINE), schema.RAW_LINE, "left_anti")
    kept = kept.select(*schema.LOADS.names, *folders)
    kept.write.mode("append").partitionBy(*folders).parquet(f"{location}/{folder}")


def publish(report: DataFrame, location: str, kind: str = "csv") -> int:
    """Replace a report by a headed table that other tools can read, in the folder the pointer names.

    In CSV every value is quoted, a quote is doubled, and ``\\N`` is a missing value.
    """
    return replace(report, location, kind, options={"header": "true", **(CSV if kind == "csv" else {})})


def read_published(
    spark: SparkSession, location: str, columns: T.StructType | None = None, kind: str = "csv", **options: str
) -> DataFrame:
    """A published report; ``multiLine="true"`` where its texts may hold line ends."""
    own = {"header": "true", **(CSV if kind == "csv" else {}), **options}
    return versions.read(spark, location, columns, kind, **own)
