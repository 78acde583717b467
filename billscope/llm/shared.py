"""Side files in shared storage: small rows by file and place, which the tasks that read a file look up.

What is found out about a stored document goes back to it without a shuffle of texts: rows (file, place, ...) are dealt
to side files by file and sorted, and a task reads the parts of one side file that hold its own file's rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.work import file_system, materialise, new_path

SIDE_ROWS = 1_000_000  # documents whose rows share a side file
SIDE_BLOCK = 1 << 20  # bytes of a side file that are read at a time


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark takes it for."""
    files, found = file_system(spark, path)
    return files.makeQualified(found).toString()


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a qualified path; a path without a scheme is of this machine."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def located(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """The documents with a number for the file and the place in it that each row is read from.

    Stored Parquet tables have both. Other frames are stored first, also those in which several rows come from one.
    """

    def places(docs: DataFrame) -> tuple[Column, Column]:
        meta = docs.metadataColumn("_metadata")
        return F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("place")

    try:
        rows = docs.select(*places(docs))
        apart = rows.distinct().count() == rows.count()
    except AnalysisException:
        apart = False
    docs = docs if apart else materialise(docs, "documents")
    return docs, *places(docs)


class SideFiles:
    """Rows (file, place, ...) of at most ``documents`` documents, written by Spark and read by file in tasks."""

    def __init__(self, rows: DataFrame, documents: int, name: str):
        self.path = qualified(rows.sparkSession, new_path(rows.sparkSession, name))
        self.sides = -(-documents // SIDE_ROWS) or 1
        side = F.pmod("file", F.lit(self.sides)).cast("int")
        dealt = rows.withColumn("side", side).repartition(self.sides, "side")
        dealt = dealt.sortWithinPartitions("side", "file", "place")
        dealt.write.partitionBy("side").option("parquet.block.size", SIDE_BLOCK).parquet(self.path)

    def of(self, file: int, places: np.ndarray, *columns: str) -> pa.Table | None:
        """Rows of one file from the least to the greatest of some places.

        Only the parts of a side file that may hold them are read, so a task that asks batch by batch holds what belongs
        to a batch, however large its file is.
        """
        store, path = place(f"{self.path}/side={file % self.sides}")
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return None
        held = (pc.field("file") == file) & (pc.field("place") >= int(places.min())) & (pc.field("place") <= int(places.max()))
        wanted = {"columns": [*columns], "filters": held, "partitioning": None}
        return pq.read_table(path, filesystem=store, use_threads=False, pre_buffer=False, **wanted)
