"""Stored tables: parquet folders and JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema, versions


#: PostgreSQL's hash of a text.
HASH_OF = "CAST(hashtext({column}) AS bigint)"


def jdbc_read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    single_task: bool = False,
) -> dict[str, str]:
    """Options of a JDBC scan.

    Give a table, quoted if its name needs it, or a query. The scan runs as ``partitions`` range queries over the
    bounds of the partition column; rows outside the bounds go to the end ranges. ``single_task`` reads a small
    table whole in one task instead.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    # Spark forbids the `query` option together with a partition column, an aliased subselect is allowed.
    options = {"url": url, "dbtable": table or f"({query}) source_query", "fetchsize": str(fetch_size)}
    options.update(properties or {})
    if single_task == bool(partition_column):
        raise ValueError("give either a partition column or single_task")
    if partition_column:
        if bounds is None or not partitions:
            raise ValueError("a partition column needs bounds and a number of partitions")
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = map(str, bounds)
        options["numPartitions"] = str(partitions)
    return options


def bounds_query(column: str, table: str | None = None, query: str | None = None) -> str:
    """Least and greatest value of a column, found by the source itself."""
    source = table or f"({query}) source_query"
    return f"SELECT min({column}) AS low, max({column}) AS high FROM {source}"


def source_bounds(
    spark: SparkSession, url: str, column: str, table: str | None = None, query: str | None = None, **options
) -> tuple[str, str] | None:
    """The bounds of a partition column as the source has them now; None where it has no value."""
    asked = jdbc_read_options(url, query=bounds_query(column, table, query), single_task=True, **options)
    row = spark.read.format("jdbc").options(**asked).load().first()
    return None if row is None or row[0] is None else (str(row[0]), str(row[1]))


def hash_predicates(column: str, partitions: int, hash_of: str = HASH_OF) -> list[str]:
    """Conditions that deal a source's rows into ``partitions`` by a hash of a text key.

    Each row meets exactly one, a row without a key the first. ``hash_of`` is the source's own function from the
    column to a whole number, of any sign.
    """
    if partitions < 1:
        raise ValueError("there must be a partition at least")
    value = hash_of.format(column=column)
    part = f"MOD(MOD({value}, {partitions}) + {partitions}, {partitions})"
    first, *others = [f"{part} = {n}" for n in range(partitions)]
    return [f"{first} OR {column} IS NULL", *others]


def read_table(
    spark: SparkSession,
    location: str,
    kind: str = "parquet",
    columns: T.StructType | None = None,
    **jdbc,
) -> DataFrame:
    """A stored table: ``location`` is a folder for parquet, a URL for ``kind="jdbc"``.

    A folder with a pointer (``billscope.versions``) is read as that names it. A JDBC scan runs in parts: by ranges of
    a ``partition_column`` between ``bounds``, which the source is asked for where there are none, or by the hash of a
    text key (``hash_column``, ``partitions`` and, for other sources than PostgreSQL, ``hash_of``).
    """
    if kind != "jdbc":
        return versions.read(spark, location, columns, kind)
    jdbc = dict(jdbc)
    if key := jdbc.pop("hash_column", None):
        conditions = hash_predicates(key, jdbc.pop("partitions"), jdbc.pop("hash_of", HASH_OF))
        options = jdbc_read_options(location, single_task=True, **jdbc)
        table = options.pop("dbtable")
        return spark.read.jdbc(options.pop("url"), table, predicates=conditions, properties=options)
    if jdbc.get("partition_column") and jdbc.get("bounds") is None:
        source = {name: jdbc[name] for name in ("table", "query", "properties") if name in jdbc}
        jdbc["bounds"] = source_bounds(spark, location, jdbc["partition_column"], **source)
        if jdbc["bounds"] is None:  # no row has a value: one task reads what there is
            del jdbc["partition_column"], jdbc["bounds"]
            jdbc.pop("partitions", None)
            jdbc["single_task"] = True
    return spark.read.format("jdbc").options(**jdbc_read_options(location, **jdbc)).load()


def read_loads(spark: SparkSession, location: str) -> DataFrame:
    """All rows of the admission table, stored and rejected, with its partition columns."""
    partition_columns = [
        T.StructField("load_from", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("discharge_month", T.DateType()),
    ]
    return read_table(spark, location, columns=T.StructType([*schema.LOADS.fields, *partition_columns]))


def read_admissions(spark: SparkSession, location: str) -> DataFrame:
    """Accepted admission rows; the outcome is a partition, so rejected files are never opened."""
    loaded = read_loads(spark, location).filter(F.col("outcome") == "loaded")
    return loaded.drop("outcome", "reject_reason", schema.RAW_LINE)


def read_quarantine(spark: SparkSession, location: str) -> DataFrame:
    """Rejected rows, and the lines with unreadable cells with their text."""
    return read_loads(spark, location).filter(F.col("outcome") == "rejected").drop("outcome")
