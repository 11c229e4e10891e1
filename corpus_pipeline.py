"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``movrec.llm``.

Every stage takes what the one before it kept, written as Parquet and read again.
All but the last return the columns of ``documents``; the last adds ``size``,
``copies`` and ``taken``.

Defined results: null and empty texts go through every stage like other rows
(their quality score decides first; all empty texts are one near-duplicate
group); null ids are kept; rows equal in id and text become one row in the
near-duplicate and mixing stages; columns beyond those of ``documents`` are
carried along unchanged, but columns named as the last stage's are replaced by
them; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.llm import decontaminate, mixing, quality, secrets, simhash
from movrec.llm.common import keep_chosen, table, text_key, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model rejects go."""
    model = quality.fit_quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the least id."""
    return simhash.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is masked in the text; no document goes."""
    return secrets.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with their copies."""
    mixed = mixing.mix(docs.select("doc_id", "source", "text", text_key().alias("_key")), extra=("_key",))
    taken = mixed.filter("copies > 0").groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_text")).agg(
        F.max("size").alias("size"), F.sum("copies").alias("copies"), F.sum("taken").alias("taken")
    )
    return keep_chosen(docs.drop("size", "copies", "taken"), taken)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: a trained classifier and XXH64 fingerprints are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
