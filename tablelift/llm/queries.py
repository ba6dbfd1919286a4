"""The queries of this package and their SQL, added to the library's by `__spark_entry__.py`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import decontam, hard_negatives, html_content, lexical, licences, mixing, neardup, neighbours, packing, quality, repeats, toxicity, url_filter
from tablelift.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


@query("op10_mixing", mixing.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy-balanced mix of all documents."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(spark, docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return predicted(scored, quality.THRESHOLD)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return predicted(scored, toxicity.THRESHOLD)


def predicted(scored: DataFrame, threshold: float) -> DataFrame:
    verdict = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", verdict)


@query("op7_licences")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id rows of all documents."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op5_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over 2-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 2, 80)


@query("op2_decontamination", decontam.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_html_content")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_content.extract(table(spark, sf_dir, "pages"))


@query("op1_repeats")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings, removed from all documents."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op13_url_filter", url_filter.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the listed rules on the URL of every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.listed_rules(spark))


@query("op12_lexical", lexical.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_hard_negatives", hard_negatives.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five hardest negatives of every anchor and positive."""
    return hard_negatives.mine(hard_negatives.quantised(table(spark, sf_dir, "embeddings")))
