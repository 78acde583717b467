"""Tables that change by a pointer.

A change is written into a folder of its own below the table and counts once a pointer names it: a small numbered file
that is created only if there is none of its number, with the folders that make up the table. A write that fails
leaves the table as it was, a reader sees the folders of one pointer, and of two writers that began from the same
pointer the second is refused. Folders of the pointer before stay for readers that began earlier; what only older
pointers name goes with a later change.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from billscope.work import delete, file_system

POINTERS, VERSION = "_current", "version"
#: Folders that no pointer ever named, left by writes that failed, are removed after this time.
ORPHAN_HOURS = 48
#: A pointer that isn't complete may still be being written for so long; an older one is a dead writer's.
PENDING_SECONDS = 60


class ChangedMeanwhile(RuntimeError):
    """Raised where another writer changed a table first."""


@dataclass(frozen=True)
class Pointer:
    number: int
    folders: list[str]
    notes: dict[str, Any] = field(default_factory=dict)


def new_folder() -> str:
    return f"{VERSION}={uuid.uuid4().hex}"


def _numbers(spark: SparkSession, location: str) -> dict[int, float]:
    """Numbers of the pointers, rising, and when each was written, in seconds."""
    files, path = file_system(spark, f"{location}/{POINTERS}")
    found = files.listStatus(path) if files.exists(path) else []
    times = {file.getPath().getName(): file.getModificationTime() / 1000 for file in found}
    return {int(name): times[name] for name in sorted(times) if name.isdigit()}


def _read(spark: SparkSession, location: str, number: int) -> Pointer | None:
    """The pointer of a number; None for one whose writer ended before it was complete."""
    files, path = file_system(spark, f"{location}/{POINTERS}/{number:010d}")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Pointer(number, **json.loads(text)) if text.endswith("\n") else None


def current(spark: SparkSession, location: str, below: int | None = None) -> Pointer | None:
    """The table's latest pointer, or the latest with a number ``below``; None for a table without one."""
    for number in reversed([*_numbers(spark, location)]):
        if below is None or number < below:
            if found := _read(spark, location, number):
                return found
    return None


def commit(
    spark: SparkSession,
    location: str,
    folders: list[str],
    before: Pointer | None,
    number: int | None = None,
    **notes: Any,
) -> Pointer:
    """Make ``folders`` the table, if nobody changed it since ``before``, and tidy up.

    With a ``number``, of a stream's batch, a pointer of that number is replaced: the batch is repeated.
    """
    if number is None:
        known, since = _numbers(spark, location), before.number if before else 0
        for later, written in known.items():
            if later > since and (_read(spark, location, later) or time.time() - written < PENDING_SECONDS):
                raise ChangedMeanwhile(f"{location} was changed by another writer")
    own = number if number is not None else max([*known, 0]) + 1
    files, path = file_system(spark, f"{location}/{POINTERS}/{own:010d}")
    try:
        stream = files.create(path, number is not None)
    except Exception as error:
        if files.exists(path):
            raise ChangedMeanwhile(f"{location} was changed by another writer") from error
        raise
    stream.write((json.dumps({"folders": folders, "notes": notes}) + "\n").encode())
    stream.close()
    tidy(spark, location, own, also_later=number is not None)
    return Pointer(own, folders, notes)


def tidy(
    spark: SparkSession, location: str, newest: int, also_later: bool = False, orphan_hours: float = ORPHAN_HOURS
) -> None:
    """Remove pointers but the ``newest`` and the one before, folders that only they name, and what failed writes left.

    Later pointers are another writer's, or of a stream that has begun anew (``also_later``).
    """
    pointers = {number: _read(spark, location, number) for number in _numbers(spark, location)}
    kept = [number for number, found in pointers.items() if found and number <= newest][-2:]
    held = {folder for n, found in pointers.items() if found and (n in kept or n > newest and not also_later) for folder in found.folders}
    old = [number for number in pointers if number < kept[0] or also_later and number > newest]
    for folder in {f for n in old if pointers[n] for f in pointers[n].folders} - held:
        delete(spark, f"{location}/{folder}")
    files, root = file_system(spark, location)
    latest = (time.time() - orphan_hours * 3600) * 1000
    used = {folder.split("/")[0] for folder in held}
    for file in files.listStatus(root):
        name = file.getPath().getName()
        if name.startswith(f"{VERSION}=") and name not in used and file.getModificationTime() < latest:
            delete(spark, f"{location}/{name}")
    for number in old:
        delete(spark, f"{location}/{POINTERS}/{number:010d}")


def subfolders(spark: SparkSession, location: str, folder: str) -> list[str]:
    """Folders just below ``folder``, named from the table's location."""
    files, path = file_system(spark, f"{location}/{folder}")
    found = files.listStatus(path) if files.exists(path) else []
    return sorted(f"{folder}/{file.getPath().getName()}" for file in found if file.isDirectory())


def read(
    spark: SparkSession,
    location: str,
    columns: T.StructType | None = None,
    kind: str = "parquet",
    pointer: Pointer | None = None,
    **options: str,
) -> DataFrame:
    """The table's rows as the pointer names them; a folder without pointers is read whole."""
    pointer = pointer or current(spark, location)
    reader = spark.read.format(kind).options(**options)
    if pointer is None:
        return (reader if columns is None else reader.schema(columns)).load(location)
    if not pointer.folders:
        if columns is None:
            raise ValueError(f"{location} is empty, so its columns must be given")
        return spark.createDataFrame([], columns)
    if columns is not None:
        reader = reader.schema(T.StructType([*columns.fields, T.StructField(VERSION, T.StringType())]))
    return reader.option("basePath", location).load([f"{location}/{folder}" for folder in pointer.folders]).drop(VERSION)
