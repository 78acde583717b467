"""The corpus pipeline: documents to packed sequences in five stages, each written and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept:

1. language ID: documents without a language (null or no letter) go;
2. SimHash near-dedup: one document of each group stays, the first by id, null last;
3. benchmark decontamination: documents that hold a window of a benchmark item go;
4. personal data: spans are replaced by their kind, and ``n_chars`` follows the text;
5. best-fit packing: a row per piece of a document with its sequence and place.

All but the last return the columns they were given. Nulls, empty tables, repeated rows and further columns are
handled as the operators state. No SQL expresses the trained and tokenised stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm import decontaminate, language, packing, pii, simhash
from billscope.work import job_folder, new_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_language(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_benchmark_documents),
    ("personal_data", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is a table in shared storage, its work tables go when that is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        with job_folder(spark, name):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
