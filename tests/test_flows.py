from __future__ import annotations

import math
import os
import random
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from billscope import schema, versions
from billscope.functions import money
from billscope.operators import aggregates, ledger, lloyd, quality, segment, sketches
from billscope.operators.reports import runs
from billscope.plans import ingest, quarters, queries, report, segmentation
from billscope.sinks import append, append_event, lease, open_ledger, publish, read_published, replace
from billscope.sources import (
    billing_columns,
    read_admissions,
    read_encounters,
    read_quarantine,
    read_table,
    stream_encounters,
)
from billscope.streaming import increments
from billscope.work import checkpoint, materialise

BILLS = (
    "medical_condition string, hospital string, insurance_provider string, admission_type string, "
    "discharge_date date, bill_cents bigint"
)


def make_bills(spark, count=900, seed=5, years=(2020, 2021)):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        # A third of all bills are from one hospital.
        hospital = "North" if rng.random() < 1 / 3 else f"h{rng.randrange(12)}"
        day = date(rng.choice(years), 1 + rng.randrange(12), 1 + rng.randrange(28))
        cents = None if rng.random() < 0.02 else rng.randrange(100, 10_200_000)
        rows.append((f"c{rng.randrange(3)}", hospital, f"p{rng.randrange(3)}", "Urgent", day, cents))
    rows.append(("c0", None, "p0", "Urgent", date(years[0], 1, 1), 100))
    rows.append(("c0", "x" * 61, "p0", "Urgent", date(years[0], 1, 1), 100))
    rows.append(("c0", "North", "p0", "Urgent", None, 100))
    return spark.createDataFrame(rows, BILLS)


def rows_of(frame):
    names = sorted(set(frame.columns) - {"load_from", "discharge_month", schema.RAW_LINE})
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=str)


def expected_rows(bills):
    daily = aggregates.daily_average_bill(bills).withColumn("quarter", F.quarter("discharge_date"))
    return quality.split_valid(daily)


@pytest.fixture
def tables(folder):
    return f"{folder}/admission", f"{folder}/status"


def test_first_load_then_nothing_new(spark, tables):
    bills = make_bills(spark)
    first = ingest.ingest(spark, bills, *tables, "r1", default_start=None)
    valid, rejected = expected_rows(bills)
    assert (first.loaded, first.rejected) == (valid.count(), rejected.count())
    assert first.last_loaded == valid.agg(F.max("discharge_date")).first()[0]
    assert rows_of(read_admissions(spark, tables[0])) == rows_of(valid)
    assert rows_of(read_quarantine(spark, tables[0])) == rows_of(rejected)
    second = ingest.ingest(spark, bills, *tables, "r2", count_late=True)
    assert second.loaded == 0 and second.late == bills.filter("discharge_date is not null").count()
    assert rows_of(read_admissions(spark, tables[0])) == rows_of(valid)
    log = open_ledger(spark, tables[1]).orderBy("id").collect()
    assert [(e.id, e.status) for e in log] == [
        ("r1-0001", "started"),
        ("r1-0002", "finished"),
        ("r2-0001", "started"),
        ("r2-0002", "finished"),
    ]
    assert [e.row_count for e in log] == [None, first.loaded, None, 0]


def test_load_without_a_ledger_replaces_all_loads(spark, folder):
    bills = make_bills(spark)
    ingest.ingest(spark, bills.filter("year(discharge_date) = 2020"), f"{folder}/t", f"{folder}/old", "r1", None)
    ingest.ingest(spark, bills, f"{folder}/t", f"{folder}/old", "r2")
    ingest.ingest(spark, bills, f"{folder}/t", f"{folder}/new", "r3", default_start=None)
    table = read_admissions(spark, f"{folder}/t")
    assert rows_of(table) == rows_of(expected_rows(bills)[0])
    assert [r.load_from for r in table.select("load_from").distinct().collect()] == ["start"]


def test_ledger_event(spark, folder):
    at = datetime(2024, 5, 1, 12, 30, tzinfo=timezone.utc)
    open_ledger(spark, folder + "/status")
    append_event(spark, folder + "/status", "r", 7, "ingest", "failed", "x" * 99, date(2024, 3, 1), 5, at)
    (event,) = runs(open_ledger(spark, folder + "/status")).collect()
    assert tuple(event) == ("r-0007", "ingest", "failed", "x" * 99, "2024-05-01 12:30:00", "2024-03-01", 5)


def test_two_loads_make_the_table_of_one(spark, tables):
    bills = make_bills(spark)
    ingest.ingest(spark, bills.filter(F.col("discharge_date") < "2020-09-17"), *tables, "r1", default_start=None)
    ingest.ingest(spark, bills, *tables, "r2")
    assert rows_of(read_admissions(spark, tables[0])) == rows_of(expected_rows(bills)[0])


def test_default_start_and_step(spark, tables):
    bills = make_bills(spark)
    result = ingest.ingest(spark, bills, *tables, "r1", default_start=date(2020, 5, 8), boundary="step")
    assert result.load_from == "2020-05-08"
    assert read_admissions(spark, tables[0]).agg(F.min("discharge_date")).first()[0] >= date(2020, 6, 8)


def test_run_that_broke_off_is_repeated(spark, tables, monkeypatch):
    bills = make_bills(spark)
    ingest.ingest(spark, bills.filter(F.col("discharge_date") < "2021-01-01"), *tables, "r1", default_start=None)
    real = ingest.append_event

    def lost(*args, **kwargs):
        if kwargs["status"] == "finished":
            raise RuntimeError("driver lost")
        real(*args, **kwargs)

    monkeypatch.setattr(ingest, "append_event", lost)
    with pytest.raises(RuntimeError):
        ingest.ingest(spark, bills, *tables, "r2")
    monkeypatch.undo()
    ingest.ingest(spark, bills, *tables, "r3")
    assert rows_of(read_admissions(spark, tables[0])) == rows_of(expected_rows(bills)[0])


def test_empty_first_load_fails_and_is_recorded(spark, tables):
    with pytest.raises(quality.NoRowsError):
        ingest.ingest(spark, spark.createDataFrame([], BILLS), *tables, "r1")
    assert [e.status for e in open_ledger(spark, tables[1]).orderBy("id").collect()] == ["started", "failed"]


def test_empty_load_keeps_the_table(spark, tables, folder):
    ingest.ingest(spark, make_bills(spark), *tables, "r1", default_start=None)
    before = rows_of(read_admissions(spark, tables[0]))
    with pytest.raises(quality.NoRowsError):
        ingest.ingest(spark, spark.createDataFrame([], BILLS), tables[0], f"{folder}/other", "r1")
    assert rows_of(read_admissions(spark, tables[0])) == before


def test_odd_bills_stop_no_load(spark, tables):
    """Large amounts, undated bills and future dates are rejected once, and later loads go on."""
    day = date(2020, 1, 1)
    odd = [
        ("a", "h", "p", "t", day, 10**14),
        ("a", "h", "p", "u", None, 100),
        ("a", "h", "p", "v", date(9999, 12, 31), 100),
        ("a", "h", "p", "w", day, 100),
    ]
    for run, extra in enumerate(([], [("a", "h", "p", "x", date(2021, 1, 1), 100)], [("a", "h", "p", "y", date(2022, 1, 1), 100)])):
        odd += extra
        result = ingest.ingest(spark, spark.createDataFrame(odd, BILLS), *tables, f"r{run}", default_start=None)
        assert (result.loaded, result.rejected) == (1, 3 if run == 0 else 2)
    rejected = read_quarantine(spark, tables[0]).orderBy("reject_reason").collect()
    assert [r.reject_reason for r in rejected] == ["amount_range", "date_null", "date_range"]
    assert read_admissions(spark, tables[0]).count() == 3


def test_failure_text_is_kept_whole(spark, tables):
    with pytest.raises(quality.NoRowsError):
        ingest.ingest(spark, spark.createDataFrame([], BILLS), *tables, "r1")
    event = open_ledger(spark, tables[1]).filter("status = 'failed'").first()
    assert event.message == "NoRowsError: no rows in encounters"


def test_published_csv_round_trip(spark, folder):
    rows = [('say "x"', 1), ("two\nlines", 2), ("", 3), (None, 4), ("a,b\\", 5)]
    frame = spark.createDataFrame(rows, "name string, n int")
    publish(frame, f"{folder}/report")
    back = read_published(spark, f"{folder}/report", frame.schema, multiLine="true")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == rows


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def written_bytes(spark, folder, batches, monkeypatch):
    """Rows that unordered batches of equal size write, their own and those of runs they take in."""
    rows, real = [], versions.commit

    def seen(spark, location, folders, before, number, rows_of=rows, **notes):
        old = set(before.folders) if before else set()
        rows_of.append(sum(count for path, count in notes["rows"].items() if path not in old))
        return real(spark, location, folders, before, number, **notes)

    monkeypatch.setattr(versions, "commit", seen)
    for batch in range(batches):
        day = F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 28).cast("int"))
        own = spark.range(64, numPartitions=1).select(
            *[F.lit(k).alias(k) for k in ("medical_condition", "insurance_provider", "admission_type")],
            F.concat(F.lit(f"h{batch}-"), F.col("id")).alias("hospital"),
            day.alias("discharge_date"),
            F.lit(100).cast("bigint").alias("bill_cents"),
        )
        increments.fold_batch(own, batch, folder)
    monkeypatch.undo()
    return sum(rows)


def test_increments_write_n_log_n(spark, folder, monkeypatch, few_partitions):
    """Ten and forty batches of one month: what is written grows with the logarithm, and few runs are left."""
    wrote = {n: written_bytes(spark, f"{folder}/{n}", n, monkeypatch) / (64 * n) for n in (10, 40)}
    assert wrote[10] <= 1 + math.log2(10) and wrote[40] <= 1 + math.log2(40)
    assert wrote[40] - wrote[10] <= 2  # twice the doublings of a fourfold input
    for n in (10, 40):
        assert len(versions.current(spark, f"{folder}/{n}").folders) <= math.log2(n) + 1
        assert increments.read_days(spark, f"{folder}/{n}").count() == 64 * n
        kept = {path.parent.name + "/" + path.name for path in Path(f"{folder}/{n}").glob("version=*/discharge_month=*")}
        assert len(kept) <= 2 * (math.log2(n) + 1)


def test_batches_of_any_size_with_repeats_make_the_batch_table(spark, folder, few_partitions):
    """Unordered batches of very unequal size, each repeated at times after its first try was committed."""
    rng, bills = random.Random(8), make_bills(spark, 400).cache()
    cuts = [0, *sorted(rng.sample(range(100), 6)), 100]
    part = F.pmod(F.xxhash64("hospital", "discharge_date", "bill_cents", "medical_condition"), F.lit(100))
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        for _ in range(rng.choice((1, 2, 3))):
            increments.fold_batch(bills.filter((part >= low) & (part < high)), batch, folder)
    valid, rejected = expected_rows(bills)
    days = increments.read_days(spark, folder)
    assert rows_of(days.filter("reject_reason is null").drop("reject_reason")) == rows_of(valid)
    assert rows_of(days.filter("reject_reason is not null")) == rows_of(rejected)
    noted = versions.current(spark, folder).notes["rows"]
    for month in {path.rsplit("/", 1)[1] for path in noted}:
        sizes = [noted[path].bit_length() for path in versions.current(spark, folder).folders if path.endswith(month)]
        assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes)  # runs shrink by powers of two


def test_sums_of_a_batch_are_not_grouped_again(spark, folder, monkeypatch):
    """A batch's sums are one row a key: days and months come from them without a second roll-up."""
    monkeypatch.setattr(aggregates, "roll_up", lambda *args: pytest.fail("grouped again"))
    bills = make_bills(spark, 200)
    for batch in range(2):
        increments.fold_batch(bills, batch, folder)
    monkeypatch.undo()
    twice = expected_rows(bills.unionAll(bills))[0]
    days = increments.read_days(spark, folder)
    assert rows_of(days.filter("reject_reason is null").drop("reject_reason")) == rows_of(twice)
    pointer = versions.current(spark, folder)
    counted = {path: spark.read.parquet(f"{folder}/{path}").count() for path in pointer.folders}
    assert counted == pointer.notes["rows"]
    assert increments.fold_batch(bills.limit(0), 2, folder) is None and versions.current(spark, folder) == pointer


def test_untouched_months_are_not_written(spark, folder):
    for batch in range(6):
        bills = [("a", "h", "p", "t", date(2020, 1 + batch % 2, 1 + batch), 100 * batch)]
        increments.fold_batch(spark.createDataFrame(bills, BILLS), batch, folder)
    last, before = (versions.current(spark, folder, below=n).folders for n in (6, 5))
    assert {path for path in before if path.endswith("=2020-01-01")} <= set(last)
    assert increments.read_days(spark, folder).count() == 6


def test_future_bills_of_a_stream_are_rejected(spark, folder):
    bills = [("a", "h", "p", "t", day, 100) for day in (date(2020, 1, 1), date(9999, 1, 1), None)]
    assert increments.fold_batch(spark.createDataFrame(bills, BILLS), 0, folder) == date(2020, 1, 1)
    reasons = {row.discharge_date: row.reject_reason for row in increments.read_days(spark, folder).collect()}
    assert reasons == {date(2020, 1, 1): None, date(9999, 1, 1): "date_range", None: "date_null"}
    assert increments.fold_batch(spark.createDataFrame(bills, BILLS), 1, folder, date(2019, 1, 1)) is None


def test_stream_begun_anew_makes_the_table_anew(spark, folder):
    one = lambda cents: spark.createDataFrame([("c", "h", "p", "a", date(2020, 3, 4), cents)], BILLS)
    for batch in range(3):
        increments.fold_batch(one(100), batch, folder)
    increments.fold_batch(one(300), 0, folder)
    assert [(r.bill_cents, r.bill_count) for r in increments.read_days(spark, folder).collect()] == [(300, 1)]


def test_batch_events_outlive_a_lost_run(spark, tables, folder, monkeypatch):
    landing, home = f"{folder}/landing", f"{folder}/increments"
    make_bills(spark, 200).write.parquet(landing)
    run = lambda name: increments.run_available(
        spark.readStream.schema(BILLS).parquet(landing), home, f"{home}/checkpoint", None, tables[1], name
    )
    real = increments.append_event

    def lost(spark, location, run_id, sequence, *args, **kwargs):
        if sequence == 2:
            raise RuntimeError("driver lost")
        real(spark, location, run_id, sequence, *args, **kwargs)

    monkeypatch.setattr(increments, "append_event", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        run("r1")
    monkeypatch.undo()
    last = expected_rows(make_bills(spark, 200))[0].agg(F.max("discharge_date")).first()[0]
    assert ledger.last_loaded(open_ledger(spark, tables[1])).first()[0] == last
    run("r2")
    events = {row.id: row for row in open_ledger(spark, tables[1]).collect()}
    assert events["r2-0002"].last_loaded == last and events["r2-0002"].message == "0 batches"
    assert sorted(events) == ["r1-0001", "r2-0001", "r2-0002", "stream-batch-0000000000"]
    run("r3")
    assert open_ledger(spark, tables[1]).filter("id = 'r3-0002'").first().last_loaded is None


# Tables by pointer


FAILS = "CASE WHEN hospital = 'h1' THEN raise_error('task lost') ELSE hospital END"


def test_failed_replace_changes_nothing(spark, folder):
    rows = spark.createDataFrame([(f"h{k}", k) for k in range(5)], "hospital string, n int")
    replace(rows, f"{folder}/t")
    for change in (replace, publish, append):
        with pytest.raises(Exception, match="task lost"):
            change(rows.withColumn("hospital", F.expr(FAILS)), f"{folder}/t")
        assert read_table(spark, f"{folder}/t").count() == 5
    assert replace(rows.limit(2), f"{folder}/t") == 2 == read_table(spark, f"{folder}/t").count()


def test_failed_jobs_leave_their_tables(spark, tables, folder, monkeypatch):
    segments, out = f"{folder}/segments", f"{folder}/out"
    bills = make_bills(spark)
    ingest.ingest(spark, bills, *tables, "r1", default_start=None)
    segmentation.rebuild_segments(spark, *tables, segments, "s1", date(2022, 1, 5), k=4)
    report.publish_reports(spark, tables[0], segments, tables[1], out)

    def state():
        return rows_of(read_admissions(spark, tables[0])), rows_of(read_table(spark, segments)), rows_of(read_published(spark, f"{out}/segments"))

    before = state()
    later = bills.withColumn("discharge_date", F.date_add("discharge_date", 4000)).filter("discharge_date is not null")
    with pytest.raises(Exception, match="task lost"):
        ingest.ingest(spark, later.withColumn("hospital", F.raise_error(F.lit("task lost"))), *tables, "r2", as_of=date(2050, 1, 1))
    real = segmentation.segment_bills
    broken = lambda *a, **o: real(*a, **o).withColumn("bill_cat", F.raise_error(F.lit("task lost")))
    monkeypatch.setattr(segmentation, "segment_bills", broken)
    append_event(spark, tables[1], "r3", 2, "ingest", "finished")
    with pytest.raises(Exception, match="task lost"):
        segmentation.rebuild_segments(spark, *tables, segments, "s2", date(2022, 1, 5), k=4)
    monkeypatch.undo()
    told = report.publish_reports(spark, tables[0], read_table(spark, segments).withColumn("bill_cat", F.raise_error(F.lit("task lost")).cast("string")), tables[1], out)
    assert "task lost" in told["segments"] and told["admissions"] == len(before[0])
    assert state() == before
    assert {e.stage: e.status for e in ledger.latest(open_ledger(spark, tables[1])).collect()}["segment"] == "failed"


def test_a_read_sees_one_version(spark, tables, monkeypatch):
    """Between a load's write and its commit the old rows are read, afterwards the new ones, never both."""
    bills = make_bills(spark)
    ingest.ingest(spark, bills, *tables, "r1", default_start=None)
    before, real, during = rows_of(read_admissions(spark, tables[0])), versions.commit, []
    began_earlier = read_admissions(spark, tables[0])

    def watched(*args, **kwargs):
        during.append(rows_of(read_admissions(spark, tables[0])))
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, "commit", watched)
    other = bills.filter("bill_cents % 2 = 0")
    ingest.ingest(spark, other, tables[0], tables[1] + "-new", "r2", default_start=None)
    assert during == [before] and rows_of(began_earlier) == before
    assert rows_of(read_admissions(spark, tables[0])) == rows_of(expected_rows(other)[0])


def test_old_versions_go_with_a_later_change(spark, folder):
    rows = spark.range(3)
    for _ in range(4):
        replace(rows, f"{folder}/t")
    assert len(list(Path(f"{folder}/t").glob("version=*"))) == 2
    orphan = Path(f"{folder}/t/version=lost")
    orphan.mkdir()
    replace(rows, f"{folder}/t")
    assert orphan.exists()
    versions.tidy(spark, f"{folder}/t", versions.current(spark, f"{folder}/t").number, orphan_hours=-1)
    assert not orphan.exists() and read_table(spark, f"{folder}/t").count() == 3


def test_second_writer_is_refused(spark, folder):
    replace(spark.range(3), f"{folder}/t")
    before = versions.current(spark, f"{folder}/t")
    replace(spark.range(4), f"{folder}/t")
    with pytest.raises(versions.ChangedMeanwhile):
        versions.commit(spark, f"{folder}/t", before.folders, before)
    assert read_table(spark, f"{folder}/t").count() == 4


def test_pointer_whose_writer_died_is_passed_over(spark, folder):
    replace(spark.range(3), f"{folder}/t")
    lost = Path(folder) / "t" / versions.POINTERS / "0000000002"
    lost.write_text('{"folders": [')
    assert read_table(spark, f"{folder}/t").count() == 3
    with pytest.raises(versions.ChangedMeanwhile):  # it may still be being written
        replace(spark.range(4), f"{folder}/t")
    os.utime(lost, (0, 0))
    assert replace(spark.range(4), f"{folder}/t") == 4 == read_table(spark, f"{folder}/t").count()


# Leases


def test_a_second_run_is_refused(spark, tables, monkeypatch):
    bills, real, seen = make_bills(spark, 100), ingest.write_load, []

    def meanwhile(*args, **kwargs):
        if not seen:
            seen.append(True)
            with pytest.raises(lease.LeaseHeld, match="r1"):
                ingest.ingest(spark, bills, *tables, "r2", default_start=None)
        return real(*args, **kwargs)

    monkeypatch.setattr(ingest, "write_load", meanwhile)
    ingest.ingest(spark, bills, *tables, "r1", default_start=None)
    monkeypatch.undo()
    events = [(e.id, e.status) for e in open_ledger(spark, tables[1]).orderBy("id").collect()]
    assert events == [("r1-0001", "started"), ("r1-0002", "finished"), ("r2-0001", "refused")]
    assert ingest.ingest(spark, bills, *tables, "r3").loaded == 0


def test_a_dead_lease_ends(spark, tables):
    dead = lease.take(spark, tables[1], "ingest", "dead", hours=1e-7)
    ingest.ingest(spark, make_bills(spark, 100), *tables, "r1", default_start=None)
    with pytest.raises(lease.LeaseLost):
        dead.check()
    lease.take(spark, tables[1], "ingest", "living")
    with pytest.raises(lease.LeaseHeld, match="living"):
        ingest.ingest(spark, make_bills(spark, 100), *tables, "r2")
    with lease.held(spark, tables[1], "segment", "other stage"):
        pass


def test_a_run_that_lost_its_lease_commits_nothing(spark, tables, monkeypatch):
    bills, real = make_bills(spark, 100), ingest.write_load
    ingest.ingest(spark, bills.filter("year(discharge_date) = 2020"), *tables, "r1", default_start=None)
    before = rows_of(read_admissions(spark, tables[0]))

    def overtaken(*args, **kwargs):
        lease.take(spark, tables[1], "ingest", "second")
        return real(*args, **kwargs)

    monkeypatch.setattr(ingest, "write_load", overtaken)
    with pytest.raises(lease.LeaseLost):
        ingest.ingest(spark, bills, *tables, "r2", lease_hours=0)
    assert rows_of(read_admissions(spark, tables[0])) == before


def test_admissions_skip_rejected_files(spark, tables):
    ingest.ingest(spark, make_bills(spark), *tables, "r1", default_start=None)
    plan = read_admissions(spark, tables[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


def test_unreadable_lines_are_kept(spark, tables, folder):
    """One quarantine for rejected rows and unreadable lines; those of other files outlast later loads, once each."""
    header = ",".join(schema.ENCOUNTER_FILE.names)
    good = "Ann,40,F,A+,Flu,2020-01-01,Dr X,North,Acme,10.00,12,Urgent,2020-01-02,Pill,Normal"

    def load(run, *lines):
        path = Path(folder) / f"{run}.csv"
        path.write_text("\n".join([header, *lines]) + "\n")
        bills = billing_columns(read_encounters(spark, str(path), keep_corrupt=True))
        return ingest.ingest(spark, bills, *tables, run, None)

    undated = good.replace("2020-01-02", "2020-13-02")
    first = load("r1", good, good.replace("10.00", "abc"), good.replace("10.00", "abc"), undated)
    assert (first.loaded, first.unreadable) == (1, 3)
    later = [line.replace("2020-01-02", "2020-02-03").replace("10.00", "20.00") for line in (good, undated)]
    second = load("r2", later[0], later[1], later[0].replace("20.00", "x"))
    assert (second.loaded, second.unreadable) == (1, 2)
    for _ in range(2):
        rows = read_quarantine(spark, tables[0]).filter("reject_reason = 'unreadable'").collect()
        lines = {row.raw_line: row.bill_count for row in rows}
        assert len(rows) == len(lines) == 4 and sorted(lines.values()) == [1, 1, 1, 2]
        assert {undated, later[1]} <= set(lines)
        load("r3", undated)
    assert read_admissions(spark, tables[0]).agg(F.sum("bill_cents")).first()[0] == 3000
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    told = open_ledger(spark, tables[1]).filter("id = 'r1-0002'").first().message
    assert told == f"1 loaded, 3 rejected, 3 lines unreadable, {partitions} shuffle partitions, 0 late"


# Segmentation


def test_files_of_unreadable_lines_are_packed(spark, folder, monkeypatch):
    days = (date(1997, 1, 1), date(1999, 1, 1))
    rows = [(f"n{n}", "c", day, "h", "p", Decimal(cents) / 100, "t") for day in days for n, cents in enumerate((101, 250))]
    names = ("Name", "Medical Condition", "Discharge Date", "Hospital", "Insurance Provider", "Billing Amount", "Admission Type")
    kinds = ("string", "string", "date", "string", "string", "decimal(18,2)", "string")
    lines = spark.createDataFrame(rows, ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds, strict=True)))
    known = [F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.ENCOUNTER_FILE]
    monkeypatch.setattr(queries, "order_encounters", lambda *args: lines.select(*known))
    monkeypatch.setattr(queries, "new_path", lambda spark, name: f"{folder}/{name}")
    found = queries.ingest_unreadable(spark, folder).collect()
    assert sorted(row.discharge_date for row in found) == [str(day) for day in days]
    files = [path.name for run in "12" for path in Path(f"{folder}/unreadable/{run}").glob("part-*")]
    assert len(files) >= 2 and all(name.endswith(".csv.gz") for name in files)


@pytest.fixture(scope="module")
def quarter_rows(spark):
    bills = make_bills(spark, 3000)
    return segmentation.quarter_averages(ingest.admission_rows(bills, None).filter("reject_reason is null"))


def test_every_row_goes_to_its_nearest_centre(spark, quarter_rows):
    vectors = segment.features(segmentation.feature_rows(quarter_rows))
    fitted = segment.fit(vectors, k=5)
    centers = fitted.centers()
    assert len(centers) == 5 and [c[0] for c in centers] == sorted(c[0] for c in centers)
    for row in segment.score(fitted, vectors).collect():
        point = [float(row[name]) for name in segment.FEATURES]
        distances = [sum((a - b) ** 2 for a, b in zip(point, center)) for center in centers]
        assert distances[row.prediction] <= min(distances) * (1 + 1e-9)


def test_segments_do_not_depend_on_layout(spark, quarter_rows):
    layouts = [quarter_rows, quarter_rows.repartition(5), quarter_rows.coalesce(1).orderBy(F.rand(1))]
    results = [
        {tuple(r) for r in segmentation.cluster(materialise(layout, "layout"), solver="library", partitions=4).collect()}
        for layout in layouts
    ]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("rows", (100, 50_001, 100_001))
def test_fit_partitions_do_not_follow_the_rows(spark, rows, monkeypatch):
    seen = []
    real = segment.checkpoint
    monkeypatch.setattr(segment, "checkpoint", lambda df: seen.append(df.rdd.getNumPartitions()) or real(df))
    vectors = spark.range(rows).select(
        *[F.lit(name).alias(name) for name in schema.QUARTER_KEYS[:3]],
        F.lit(1).alias("quarter"),
        F.col("id").cast("double").alias(segment.AMOUNT),
    )
    segment.fit(segment.features(vectors, [segment.AMOUNT]), k=2)
    assert seen == [segment.FIT_PARTITIONS]


def test_segments_do_not_depend_on_the_cluster(spark, quarter_rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for partitions in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append({tuple(r) for r in segmentation.cluster(quarter_rows, solver="library").collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_segments_equal_those_of_the_library_steps(spark, quarter_rows):
    """String indexers, assembler and KMeans from the library, on rows in the same place."""
    ours = {tuple(r)[:-1]: r.prediction for r in segmentation.cluster(quarter_rows, solver="library", partitions=4).collect()}
    keys = schema.QUARTER_KEYS
    placed = checkpoint(quarter_rows.repartition(4, *keys).sortWithinPartitions(*keys))
    names = {"hospital": "hospital_index", "insurance_provider": "insurance_index"}
    for column, index in names.items():
        placed = StringIndexer(inputCol=column, outputCol=index).fit(quarter_rows).transform(placed)
    vectors = VectorAssembler(inputCols=list(segment.FEATURES), outputCol="features").transform(placed)
    theirs = KMeans(k=9, seed=42).fit(vectors).transform(vectors).select(*quarter_rows.columns, "prediction")
    pairs = {(ours[tuple(r)[:-1]], r.prediction) for r in theirs.collect()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) == 9


def test_averages_equal_decimal_averages(spark):
    """Cents and integer rounding give what rounded decimal averages give."""
    bills = make_bills(spark, 4000).filter("bill_cents < 10000000 or bill_cents is null")
    amount = bills.withColumn("amount", money.amount(F.col("bill_cents")).cast("decimal(7,2)"))
    day = amount.groupBy(*schema.DAILY_KEYS).agg(F.round(F.avg("amount"), 2).alias("mean"))
    quarter = (
        day.dropna(subset=["mean", "hospital", "discharge_date"])
        .groupBy("medical_condition", "hospital", "insurance_provider", F.quarter("discharge_date").alias("quarter"))
        .agg(F.round(F.avg(F.col("mean").cast("decimal(9,2)")), 2).alias("mean"))
    )
    daily = aggregates.daily_average_bill(bills).withColumn("quarter", F.quarter("discharge_date"))
    ours = aggregates.quarterly_average_bill(quality.drop_incomplete(daily))
    as_text = lambda df, name: sorted((*map(str, r[:4]), f"{r[name]:.2f}") for r in df.collect())
    assert as_text(ours, "avg_bill_amount") == as_text(quarter, "mean")


@pytest.fixture(scope="module")
def feature_table(quarter_rows):
    return materialise(segmentation.feature_rows(quarter_rows), "features")


@pytest.mark.parametrize("scale", (False, True))
def test_rounds_do_not_depend_on_partitions(spark, feature_table, scale):
    fits, scores = [], []
    for parts in (2, 16, 64):
        placed = materialise(feature_table.repartition(parts).sortWithinPartitions(F.rand(parts)), "placed")
        fits.append(lloyd.fit(placed, scale=scale))
        scores.append({tuple(r) for r in lloyd.score(fits[-1], placed).collect()})
    assert fits[0] == fits[1] == fits[2] and scores[0] == scores[1] == scores[2]
    assert len(fits[0].points) == 9 and list(fits[0].points) == sorted(fits[0].points)


def test_rounds_cost_no_more_than_the_library(spark, feature_table):
    ours = lloyd.cost(lloyd.fit(feature_table), feature_table)
    vectors = segment.features(feature_table).select("features")
    theirs = min(KMeans(k=9, seed=seed).fit(vectors).summary.trainingCost for seed in (42, 1))
    assert ours <= 1.02 * theirs


def test_rounds_run_the_same_code(spark):
    """No round's points are constants of its plan; ties go to the first point and a missing feature to none."""
    rows = spark.createDataFrame([(0.0, 1.0), (5.0, 1.0), (10.0, 1.0), (None, 1.0)], "a double, b double")
    near = lloyd._with_centre(rows, ("a", "b"), [(0.0, 1.0), (10.0, 1.0), (10.0, 1.0)], (1.0, 0.5))
    assert [row.centre for row in near.orderBy(F.col("a").asc_nulls_last()).collect()] == [0, 0, 1, None]
    points = [(123.25, 1.0), (7.5, 2.0)]
    plan = lloyd._with_centre(rows, ("a", "b"), points, (1.0, 1.0))._jdf.queryExecution().optimizedPlan().toString()
    assert "123.25" not in plan and "7.5" not in plan


def test_rounds_read_numbers_alone(spark, feature_table, monkeypatch):
    """The rounds' work table has no texts and decimals, and is gone after the fit."""
    tables, real = [], lloyd.materialise
    monkeypatch.setattr(lloyd, "materialise", lambda *args, **options: tables.append(real(*args, **options)) or tables[-1])
    assert lloyd.fit(feature_table).rounds
    assert {kind for _, kind in tables[0].dtypes} == {"double", "bigint"}
    assert not Path(tables[0].inputFiles()[0].removeprefix("file:")).exists()


def test_rows_get_their_segment_once(spark, quarter_rows):
    """What follows reads the segment's number and works no distance out again."""
    plan = segmentation.cluster(quarter_rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" not in plan and "prediction" in plan


def test_rounds_with_few_rows(spark, feature_table):
    few = feature_table.orderBy(*schema.QUARTER_KEYS).limit(3)
    assert len(lloyd.fit(few).points) <= 3 and lloyd.score(lloyd.fit(few), few).count() == 3
    same = feature_table.withColumns({name: F.lit(1.0) for name in lloyd.FEATURES})
    for scale in (False, True):
        assert len(lloyd.fit(same, scale=scale).points) == 1
    assert lloyd.fit(feature_table.limit(0)).points == ()
    with pytest.raises(ValueError, match="missing"):
        lloyd.fit(feature_table.withColumn("hospital_index", F.lit(None).cast("double")))


def test_sketches_merge(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 7).alias("part"), (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100).cast("decimal(18,2)").alias("amount")
    )
    stored = materialise(sketches.quantile_sketches(rows.unionByName(rows.select("part", F.lit(None).alias("amount"))), "amount", ["part"]), "s")
    assert stored.count() == 7 and stored.agg(F.sum("amounts")).first()[0] == 40_000
    probabilities = (0.01, 0.2, 0.5, 0.99)
    edges = sketches.merged_edges(stored, probabilities).first().edges
    for probability, edge in zip(probabilities, edges, strict=True):
        assert abs(rows.filter(F.col("amount") <= edge).count() / 40_000 - probability) <= 0.01
    assert sketches.merged_edges(stored.limit(0)).first().edges is None


@pytest.mark.parametrize("with_year", (False, True))
def test_only_touched_quarters_are_read(spark, tables, folder, with_year):
    """Two loads with a refresh after each make what one from scratch does, from files of touched quarters."""
    bills, how = make_bills(spark), dict(with_year=with_year)
    early, table = bills.filter("discharge_date < '2021-02-01'"), f"{folder}/quarters"
    ingest.ingest(spark, early, *tables, "r1", default_start=None)
    everything = {(q, y) if with_year else (q,) for q in (1, 2, 3, 4) for y in (2020,)} | ({(1, 2021)} if with_year else set())
    assert quarters.refresh(spark, tables[0], table, **how) == everything
    assert quarters.refresh(spark, tables[0], table, **how) == set()
    first = versions.current(spark, table).folders
    ingest.ingest(spark, bills.filter("discharge_date < '2021-06-01'"), *tables, "r2")
    due = quarters._rows_of(read_admissions(spark, tables[0]), {(1, 2021), (2, 2021)} if with_year else {(1,), (2,)}, with_year)
    plan = due._jdf.queryExecution().executedPlan().toString()
    assert "quarter(discharge_month" in plan.split("PartitionFilters: [")[1].split("]")[0]  # other months' files stay closed
    junk = [path for path in Path(tables[0]).glob("**/*.parquet") if "discharge_month=2020-07-01" in str(path) and "=loaded" in str(path)]
    saved = {path: path.read_bytes() for path in junk}
    for path in junk:
        path.write_bytes(b"not a table")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert quarters.refresh(spark, tables[0], table, **how) == ({(1, 2021), (2, 2021)} if with_year else {(1,), (2,)})
    assert junk and all(path.read_bytes() == b"not a table" for path in junk)
    for path, data in saved.items():
        path.write_bytes(data)
    now = versions.current(spark, table).folders
    kept = {"quarter=3", "quarter=4"} | ({"quarter=2"} if with_year else set())
    assert {path for path in first if path.split("/")[1] in kept} <= set(now)
    scratch = quarters.refresh(spark, tables[0], f"{folder}/scratch", **how)
    assert len(scratch) == len(now)
    assert rows_of(quarters.read_quarters(spark, table)) == rows_of(quarters.read_quarters(spark, f"{folder}/scratch"))
    labelled = [segmentation.segment_stored(spark, tables[0], t, exact=True, k=4, **how) for t in (table, f"{folder}/scratch")]
    assert rows_of(labelled[0]) == rows_of(labelled[1])
    quarters.refresh(spark, tables[0], table, method="weighted", **how)
    assert versions.current(spark, table).notes["how"]["method"] == "weighted"


def test_a_load_made_anew_touches_its_quarters(spark, tables, folder):
    bills, table = make_bills(spark), f"{folder}/quarters"
    ingest.ingest(spark, bills, *tables, "r1", default_start=None)
    quarters.refresh(spark, tables[0], table)
    summer = bills.filter("quarter(discharge_date) = 3")
    ingest.ingest(spark, summer, tables[0], f"{folder}/other", "r2", default_start=None)
    assert quarters.refresh(spark, tables[0], table) == {(1,), (2,), (3,), (4,)}
    assert {r.quarter for r in quarters.read_quarters(spark, table).collect()} == {3}


def test_scaled_features(spark, quarter_rows):
    scored = segmentation.cluster(quarter_rows, k=4, scale=True)
    assert scored.count() == quarter_rows.count()
    assert {r.prediction for r in scored.select("prediction").distinct().collect()} <= set(range(4))


def test_labels_rise_with_the_segment_mean(spark, quarter_rows):
    scored = segmentation.cluster(quarter_rows)
    labelled = segment.label_segments(segment.profile(scored), segment.quantile_edges(scored)).orderBy("segment_mean")
    order = [schema.SEGMENT_LABELS.index(r.bill_cat) for r in labelled.collect()]
    assert order == sorted(order)


def test_three_labels_and_year(spark):
    rows = ingest.admission_rows(make_bills(spark), None)
    out = segmentation.segment_bills(
        rows, k=4, with_year=True, labels=("Low", "Medium", "High"), probabilities=(0.33, 0.66)
    )
    assert "year" in out.columns and {r.bill_cat for r in out.collect()} <= {"Low", "Medium", "High"}


def test_rebuild_waits_for_the_load_and_the_quarter(spark, tables, folder):
    segments = f"{folder}/segments"
    run = lambda number, day, **options: segmentation.rebuild_segments(
        spark, *tables, segments, f"s{number}", day, k=4, **options
    )
    assert run(1, date(2022, 1, 5)) is None
    ingest.ingest(spark, make_bills(spark), *tables, "r1", default_start=None)
    rows = run(2, date(2022, 1, 5))
    assert rows and read_table(spark, segments).count() == rows
    assert run(3, date(2022, 3, 5), only_when_due=True) is None
    assert run(4, date(2022, 4, 5), only_when_due=True) == rows
    assert read_table(spark, segments).count() == rows
    # The date of a segment run is no loaded date.
    assert ingest.ingest(spark, make_bills(spark, years=(2021, 2022)), *tables, "r2").loaded > 0


def test_reports(spark, tables, folder):
    out = f"{folder}/reports"
    ingest.ingest(spark, make_bills(spark), *tables, "r1", default_start=None)
    early = report.publish_reports(spark, tables[0], f"{folder}/segments", tables[1], out)
    assert "PATH_NOT_FOUND" in early["segments"] and early["runs"] == 2
    segmentation.rebuild_segments(spark, *tables, f"{folder}/segments", "s1", date(2022, 1, 5), k=4)
    done = report.publish_reports(spark, tables[0], f"{folder}/segments", tables[1], out)
    assert done["admissions"] == read_admissions(spark, tables[0]).count() and done["runs"] == 4
    shown = read_published(spark, f"{out}/segments")
    assert shown.columns == [
        "Medical Condition",
        "Hospital",
        "Insurance Provider",
        "Quarter",
        "Avg Bill Amount",
        "Bill Cat",
    ]
    assert shown.count() == done["segments"]


# Streams


def test_arrivals_make_the_batch_table(spark, folder):
    bills = make_bills(spark).cache()
    landing, table, checkpoint = f"{folder}/landing", f"{folder}/table", f"{folder}/checkpoint"
    part = F.pmod(F.xxhash64("hospital", "discharge_date", "bill_cents"), F.lit(3))
    for arrival in range(3):
        bills.filter(part == arrival).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(BILLS).parquet(landing)
        increments.run_available(stream, table, checkpoint, lambda batch: batch.select("*"))
    increments.run_available(spark.readStream.schema(BILLS).parquet(landing), table, checkpoint)
    days = increments.read_days(spark, table)
    valid, rejected = expected_rows(bills)
    assert rows_of(days.filter("reject_reason is null").drop("reject_reason")) == rows_of(valid)
    assert rows_of(days.filter("reject_reason is not null")) == rows_of(rejected)


def test_encounter_files_arrive(spark, folder):
    header = ",".join(schema.ENCOUNTER_FILE.names)
    landing = Path(folder) / "landing"
    landing.mkdir()

    def arrive(number, *amounts):
        rows = [f"Ann,40,F,A+,Flu,2020-01-01,Dr X,North,Acme,{a},12,Urgent,2020-01-02,Pill,Normal" for a in amounts]
        (landing / f"{number}.csv").write_text("\n".join([header, *rows]) + "\n")

    def run():
        stream = stream_encounters(spark, str(landing), files_per_batch=1)
        increments.run_available(billing_columns(stream), f"{folder}/table", f"{folder}/checkpoint")
        (row,) = increments.read_days(spark, f"{folder}/table").collect()
        return row.average_bill_amount, row.bill_count

    arrive(1, "10.00", "abc")
    arrive(2, "20.01")
    assert run() == (Decimal("15.01"), 2)
    arrive(3)
    arrive(4, "0.00")
    assert run() == (Decimal("10.00"), 3)
    assert run() == (Decimal("10.00"), 3)


def test_stream_runs_are_recorded(spark, tables, folder):
    landing, home = f"{folder}/landing", f"{folder}/increments"
    bills = make_bills(spark, 200)
    bills.write.parquet(landing)
    run = lambda name: increments.run_available(
        spark.readStream.schema(BILLS).parquet(landing), home, f"{home}/checkpoint", None, tables[1], name
    )
    segment_days = lambda name: segmentation.rebuild_segments(
        spark,
        increments.read_accepted(spark, home),
        tables[1],
        f"{folder}/segments",
        name,
        date(2022, 1, 5),
        k=4,
        upstream=increments.STAGE,
    )
    run("r1")
    last = expected_rows(bills)[0].agg(F.max("discharge_date")).first()[0]
    events = {row.id: row for row in open_ledger(spark, tables[1]).collect()}
    assert events["r1-0002"].last_loaded == last and events["r1-0002"].message == "1 batches"
    assert segment_days("s1") == read_table(spark, f"{folder}/segments").count() > 0
    published = report.publish_reports(
        spark, increments.read_accepted(spark, home), f"{folder}/segments", tables[1], f"{folder}/reports"
    )
    assert published["admissions"] == increments.read_accepted(spark, home).count()
    run("r2")
    assert open_ledger(spark, tables[1]).filter("id = 'r2-0002'").first().last_loaded is None
    with pytest.raises(Exception, match="NO_SUCH"):
        increments.run_available(
            spark.readStream.schema(BILLS).parquet(landing).select("*", F.lit(1).alias("x")),
            f"{folder}/other",
            f"{folder}/other/checkpoint",
            lambda batch: batch.select(F.raise_error(F.lit("NO_SUCH"))),
            tables[1],
            "r3",
        )
    assert open_ledger(spark, tables[1]).filter("id = 'r3-0002'").first().status == "failed"
    assert segment_days("s2") is None


def test_repeated_batch_replaces_itself(spark, folder):
    bills = make_bills(spark, 200)
    half = F.col("discharge_date") < "2021-01-01"
    increments.fold_batch(bills.filter(half), 0, folder)
    increments.fold_batch(bills.filter(~half), 1, folder)
    increments.fold_batch(bills.filter(~half), 1, folder)
    dated = expected_rows(bills.filter(F.col("discharge_date").isNotNull()))[0]
    got = increments.read_days(spark, folder).filter("reject_reason is null").drop("reject_reason")
    assert rows_of(got) == rows_of(dated)


def test_late_bill_reaches_its_day(spark, folder):
    day = date(2020, 3, 4)
    one = lambda cents: spark.createDataFrame([("c", "h", "p", "a", day, cents)], BILLS)
    increments.fold_batch(one(100), 0, folder)
    increments.fold_batch(one(300), 1, folder)
    row = increments.read_days(spark, folder).first()
    assert (row.average_bill_amount, row.bill_count) == (Decimal("2.00"), 2)
