from __future__ import annotations

import random

import pytest

from billscope import schema
from billscope.__main__ import main
from billscope.sources import read_table
from billscope.streaming import increments


@pytest.fixture(autouse=True)
def own_partitions(spark):
    """Jobs size the session's shuffles; other tests keep theirs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def landing(tmp_path):
    rng = random.Random(2)
    folder = tmp_path / "landing"
    folder.mkdir()
    lines = [",".join(schema.ENCOUNTER_FILE.names)]
    for n in range(400):
        keys = f"c{n % 3}", f"h{n % 11}", f"p{n % 4}"
        amount = "abc" if n % 100 == 0 else f"{rng.randrange(100, 9_000_000) / 100:.2f}"
        day = f"2021-{1 + n % 12:02d}-{1 + n % 28:02d}"
        lines.append(f"Ann,40,F,A+,{keys[0]},{day},Dr X,{keys[1]},{keys[2]},{amount},12,Urgent,{day},Pill,Normal")
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_jobs_from_the_command_line(spark, landing, folder):
    home = f"{folder}/home"
    loaded = main(["ingest", "--home", home, "--encounters", landing, "--cores", "4"], spark)
    assert loaded["unreadable"] == 4 and loaded["loaded"] + loaded["rejected"] > 0
    rows = main(["segment", "--home", home, "--as-of", "2022-01-03"], spark)["rows"]
    assert rows > 0
    assert main(["segment", "--home", home, "--as-of", "2022-02-03", "--only-when-due"], spark)["rows"] is None
    assert main(["report", "--home", home, "--kind", "json"], spark) == {
        "segments": rows,
        "admissions": loaded["loaded"],
        "runs": 4,
    }
    assert main(["ingest", "--home", home, "--encounters", landing], spark)["loaded"] == 0
    main(["stream", "--home", home, "--encounters", landing], spark)
    days = increments.read_days(spark, f"{home}/increments").filter("reject_reason is null")
    assert days.count() == loaded["loaded"]
    segment = ["segment", "--home", home, "--as-of", "2022-02-03", "--source", "stream"]
    assert main([*segment, "--labels", "low,high", "--probabilities", "0.5"], spark)["rows"] == rows
    assert {row.bill_cat for row in read_table(spark, f"{home}/segments").collect()} == {"low", "high"}
    published = main(["report", "--home", home, "--kind", "json", "--source", "stream"], spark)
    assert published["admissions"] == loaded["loaded"]


def test_a_job_must_be_named(spark):
    with pytest.raises(SystemExit):
        main([], spark)
