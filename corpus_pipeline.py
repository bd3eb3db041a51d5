"""Corpus pipeline over the documents table: toxicity, near-duplicates, benchmark passages,
secrets, packing.

Each stage gets all that its predecessor kept, as Parquet, and its decisions take effect:

* ``toxicity`` drops the documents that score 0.3 or more;
* ``near_dedup`` keeps one document of each group (five-word shingles, similarity 0.8);
* ``decontaminate`` drops the documents that hold a benchmark item;
* ``secrets`` keeps all documents and replaces credentials in their texts;
* ``pack`` returns the sequences: one row per piece of a document.

All but the last return the columns of ``documents``.  Nulls, empty texts and repeated rows go
through as each operator states; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from releasekit.llm import decontaminate, minhash, packing, secrets, toxicity
from releasekit.llm.base import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("decontaminate", drop_benchmark), ("secrets", redact_secrets), ("pack", pack)]

#: SQL can't express a trained classifier, MinHash or best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
