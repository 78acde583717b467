from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billscope import schema
from billscope.sinks import append, create_if_missing, replace
from billscope.sinks.tables import jdbc_write_options
from billscope.sources import billing_columns, read_encounters, read_table, unreadable_rows
from billscope.sources.tables import hash_predicates, jdbc_read_options

HEADER = ",".join(schema.ENCOUNTER_FILE.names)


def line(name="Ann", age="40", hospital="North", amount="10.00", discharged="2020-01-02"):
    return f"{name},{age},F,A+,Flu,2020-01-01,Dr X,{hospital},Acme,{amount},12,Urgent,{discharged},Pill,Normal"


@pytest.fixture
def csv(tmp_path):
    lines = [
        HEADER,
        line(amount="18856.281305978155"),
        line(amount="10.005"),
        line(amount="-108.515"),
        line(amount="123456.789"),
        line(amount=""),
        line(amount="abc"),
        line(discharged="2019-13-40"),
        line(name='"O\'Neil, a"', hospital="St Mary's"),
        line(hospital=""),
        line(age="old"),
    ]
    path = tmp_path / "encounters.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_typed_scan_of_edge_rows(spark, csv):
    rows = read_encounters(spark, csv).collect()
    amounts = [row.billing_amount for row in rows]
    assert amounts == [
        Decimal("18856.28"),
        Decimal("10.01"),
        Decimal("-108.52"),
        Decimal("123456.79"),
        None,
        None,
        *[Decimal("10.00")] * 4,
    ]
    assert rows[6].discharge_date is None
    assert (rows[7].name, rows[7].hospital) == ("O'Neil, a", "St Mary's")
    assert rows[8].hospital is None
    assert rows[9].age is None and rows[9].billing_amount == Decimal("10.00")


def test_unreadable_lines_keep_their_text(spark, csv):
    rows = unreadable_rows(read_encounters(spark, csv, keep_corrupt=True)).collect()
    assert len(rows) == 3
    assert {row.reject_reason for row in rows} == {"unreadable"}
    assert all(any(bad in row.raw_line for bad in ("abc", "2019-13-40", "old")) for row in rows)


def test_billing_columns_prune_the_scan(spark, csv):
    bills = billing_columns(read_encounters(spark, csv))
    plan = bills._jdf.queryExecution().executedPlan().toString()
    assert "Billing Amount" in plan and "Doctor" not in plan.split("ReadSchema")[1]
    assert bills.agg(F.sum("bill_cents")).first()[0] == 1885628 + 1001 - 10852 + 12345679 + 4000
    plan = billing_columns(read_encounters(spark, csv, keep_corrupt=True))._jdf.queryExecution().executedPlan()
    assert "Doctor" not in plan.toString().split("ReadSchema")[1]


def test_reader_options(spark, tmp_path):
    path = tmp_path / "published.csv"
    path.write_text(f'{HEADER}\n{line(name=chr(34) + "a " + chr(34) * 2 + "b" + chr(34) * 2 + chr(10) + "c" + chr(34))}\n')
    row = read_encounters(spark, str(path), escape='"', multiLine="true").first()
    assert row.name == 'a "b"\nc'


def test_parquet_append_and_replace(spark, folder):
    frame = spark.createDataFrame([(date(2020, 1, 2), 1), (date(2020, 1, 1), 2)], "day date, n int")
    location = f"{folder}/t"
    assert append(frame, location, sort_by="day") == 2
    assert append(frame, location) == 2
    assert read_table(spark, location, columns=frame.schema).count() == 4
    assert replace(frame.limit(1), location) == 1
    assert read_table(spark, location).count() == 1


def test_create_if_missing_keeps_what_is_there(spark, folder):
    location = f"{folder}/segments"
    assert create_if_missing(spark, location, schema.SEGMENT).count() == 0
    append(spark.createDataFrame([("a", "b", "c", 1, Decimal("2.00"), "Low")], schema.SEGMENT), location)
    assert create_if_missing(spark, location, schema.SEGMENT).count() == 1


def test_jdbc_read_options():
    url = "jdbc:postgresql://host/db"
    assert jdbc_read_options(url, '"Cat Bill Amount"', single_task=True)["dbtable"] == '"Cat Bill Amount"'
    options = jdbc_read_options(
        url,
        query="SELECT hospital FROM admission",
        properties={"user": "u"},
        partition_column="discharge_date",
        bounds=("2019-01-01", "2024-12-31"),
        partitions=64,
    )
    assert options["dbtable"] == "(SELECT hospital FROM admission) source_query"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("2019-01-01", "2024-12-31", "64")
    assert options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_read_options(url, single_task=True)
    with pytest.raises(ValueError, match="single_task"):
        jdbc_read_options(url, "t")
    with pytest.raises(ValueError):
        jdbc_read_options(url, "t", partition_column="id")


def test_hash_predicates_deal_every_row_once(spark):
    """Evaluated by Spark itself, whose hash has both signs; a NULL key is in the first part."""
    keys = [*(f"h{n}" for n in range(200)), None, ""]
    frame = spark.createDataFrame([(key,) for key in keys], "hospital string")
    parts = hash_predicates("hospital", 7, "hash({column})")
    assert len(parts) == 7 and "hashtext(hospital)" in hash_predicates("hospital", 2)[1]
    met = frame.select("hospital", *[F.expr(f"coalesce({part}, false)").cast("int").alias(f"p{n}") for n, part in enumerate(parts)])
    rows = met.collect()
    assert all(sum(row[1:]) == 1 for row in rows) and next(row for row in rows if row.hospital is None).p0 == 1
    assert all(sum(row[n] for row in rows) > 10 for n in range(1, 8))
    with pytest.raises(ValueError):
        hash_predicates("hospital", 0)


def test_bounds_come_from_the_source(spark, monkeypatch):
    asked = []

    class Reader:
        def __init__(self, bounds):
            self.bounds, self.own = bounds, {}

        def format(self, kind):
            self.own = {}
            return self

        def options(self, **options):
            self.own = options
            return self

        def load(self):
            asked.append(self.own)
            return self

        def first(self):
            return self.bounds

        def jdbc(self, url, table, predicates, properties):
            asked.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
            return self

    class Session:
        def __init__(self, bounds):
            self.read = Reader(bounds)

    how = dict(kind="jdbc", partition_column="discharge_date", partitions=8, properties={"user": "u"})
    read_table(Session((date(2020, 1, 1), date(2021, 1, 1))), "jdbc:x", table="admission", **how)
    assert "SELECT min(discharge_date) AS low, max(discharge_date) AS high FROM admission" in asked[0]["dbtable"]
    assert "partitionColumn" not in asked[0] and asked[0]["user"] == "u"
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("2020-01-01", "2021-01-01", "8")
    read_table(Session((None, None)), "jdbc:x", query="SELECT 1", **how)
    assert "FROM (SELECT 1) source_query" in asked[2]["dbtable"] and "partitionColumn" not in asked[3]
    read_table(Session(None), "jdbc:x", kind="jdbc", table="admission", hash_column="hospital", partitions=3)
    assert len(asked[4]["predicates"]) == 3 and asked[4]["dbtable"] == "admission" and asked[4]["fetchsize"] == "10000"


def test_jdbc_write_options(spark):
    frame = spark.createDataFrame([], schema.SEGMENT)
    options = jdbc_write_options(frame, "jdbc:postgresql://host/db", "segments", {"batchsize": "5"}, connections=4)
    assert options["truncate"] == "true" and options["numPartitions"] == "4" and options["batchsize"] == "5"
    assert "`bill_cat` VARCHAR(20)" in options["createTableColumnTypes"]
