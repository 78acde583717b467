"""One run at a time: a lease that a run takes before it reads the ledger and checks before it commits.

Leases are numbered files beside the ledger, created only if there is none of their number. The highest one holds until
it is released or its time is over, so a run that died blocks no longer than that; should it still live, its check
fails once another run has taken the next number.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from billscope.work import delete, file_system

FOLDER, RELEASED = "_lease", ".released"
HOURS = 24.0


class LeaseHeld(RuntimeError):
    """Raised where another run holds the lease."""


class LeaseLost(RuntimeError):
    """Raised where a run's lease is over and another run has taken it."""


def _names(spark: SparkSession, folder: str) -> dict[str, float]:
    """Files of a folder and when they were written, in seconds."""
    files, path = file_system(spark, folder)
    found = files.listStatus(path) if files.exists(path) else []
    return {file.getPath().getName(): file.getModificationTime() / 1000 for file in found}


def _create(spark: SparkSession, location: str, text: str) -> bool:
    """Whether the file is new; another's stays as it is."""
    files, path = file_system(spark, location)
    try:
        stream = files.create(path, False)
    except Exception:
        if files.exists(path):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def _told(spark: SparkSession, location: str) -> dict | None:
    """Run and end of a lease; None where its writer died before it told them."""
    files, path = file_system(spark, location)
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


@dataclass(frozen=True)
class Lease:
    spark: SparkSession
    folder: str
    number: int
    until: float

    def check(self) -> None:
        """Fail if another run has taken over; call it before what must not be done twice."""
        if max(int(name) for name in _names(self.spark, self.folder) if name.isdigit()) != self.number:
            raise LeaseLost(f"another run has taken {self.folder}")

    def release(self) -> None:
        _create(self.spark, f"{self.folder}/{self.number:010d}{RELEASED}", "\n")


def take(spark: SparkSession, ledger_location: str, stage: str, run_id: str, hours: float = HOURS) -> Lease:
    folder, now = f"{ledger_location}/{FOLDER}/{stage}", time.time()
    names = _names(spark, folder)
    number = max([int(name) for name in names if name.isdigit()], default=0)
    if number and f"{number:010d}{RELEASED}" not in names:
        told = _told(spark, f"{folder}/{number:010d}")
        until = told["until"] if told else names[f"{number:010d}"] + hours * 3600
        if until > now:
            raise LeaseHeld(f"{stage} is being run by {told['run_id'] if told else 'another run'}")
    lease = Lease(spark, folder, number + 1, now + hours * 3600)
    text = json.dumps({"run_id": run_id, "until": lease.until}) + "\n"
    if not _create(spark, f"{folder}/{lease.number:010d}", text):
        raise LeaseHeld(f"{stage} has just been started by another run")
    for name in names:
        if int(name.removesuffix(RELEASED)) < number:
            delete(spark, f"{folder}/{name}")
    return lease


@contextmanager
def held(spark: SparkSession, ledger_location: str, stage: str, run_id: str, hours: float = HOURS) -> Iterator[Lease]:
    """Hold the stage's lease; it is released on the way out, whatever happened."""
    lease = take(spark, ledger_location, stage, run_id, hours)
    try:
        yield lease
    finally:
        lease.release()
