"""The corpus pipeline: documents in, packed token rows out.

Every stage is a function of (spark, docs, sf_dir) that calls one operator of `tablelift.llm` on all
that the stage before has kept; its result is written as Parquet and read back for the next one.
All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import decontam, mixing, neardup, packing, quality
from tablelift.llm.common import table, written

ORACLE_SQL = None  # hashed models, sketches and tokenizers are beyond SQL; tests hold stages against brute force


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    model = quality.train(spark, docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, docs.columns, "__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 80% of its five-word shingles."""
    judged = neardup.near_duplicates(docs, 5, 80)
    dropped = judged.where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(written(dropped, "dropped"), "doc_id", "left_anti").select(*docs.columns)
    return neardup.one_per_id(left)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontam.contained_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(written(found, "contaminated"), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.repeated(mixing.mix(docs), docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed id rows of the mix."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
