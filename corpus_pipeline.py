"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. Every stage works on all
rows that the one before kept; all but the last return the columns of
``documents``. The stages call the operators of ``stackyard.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackyard.llm.common import documents, saved
from stackyard.llm.decontaminate import without_leaks
from stackyard.llm.lines import dedup_lines
from stackyard.llm.packing import pack_documents
from stackyard.llm.quality import keep_good
from stackyard.llm.queries import MAX_TOKENS, benchmark, tokenizer_path
from stackyard.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat, or nearly repeat, an earlier line go from their texts."""
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_one(docs, shingle=3, radius=2, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_leaks(docs, benchmark(spark, sf_dir))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 2048 ids."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), MAX_TOKENS, end_id=0)


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: No SQL for the tokenizer, the hashes and the packing: the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
