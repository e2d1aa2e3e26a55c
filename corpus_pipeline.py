"""Documents to packed training sequences in five stages, each reading what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. `run` writes
every stage as Parquet below the shared folder and reads it again as the next one's documents.

Toxic documents go; one document of each SimHash group stays; bytes that repeat earlier text are cut out of the rest, whole
characters at a time; documents that hold a benchmark item go; what is left is packed into sequences.

Defined cases: a null text counts as empty in every stage and stays null until it is packed as its closing id alone; a null id is
a document like others, ranks first among repeated bytes and last in a SimHash group; rows that repeat id and text are one
document for the SimHash and byte stages; labels without a document are not used; empty tables give no rows. Further columns are
kept by the first four stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import table
from tallyspark.llm.decontam import drop_contaminated
from tallyspark.llm.packing import pack_documents, tokenizer_path
from tallyspark.llm.registry import query
from tallyspark.llm.simhash import keep_representatives
from tallyspark.llm.suffix_dedup import remove_repeats
from tallyspark.llm.toxicity import drop_toxic
from tallyspark.session import materialize

#: Segment scores, logistic fits, tokenizers and packing have no SQL; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
