"""A corpus pipeline of the operators in ``ledgerline.llm``: each stage's result is written and read again.

Stages take ``(spark, docs, sf_dir)``; all but the last return rows with the columns of ``documents``.
"""

from __future__ import annotations

from ledgerline.llm import decontaminate, near_dup, packing, pii, quality
from ledgerline.llm.shared import crc_mod, stored


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality classifier accepts; it trains on the labelled ones of ``docs``."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_mod("doc_id", 4) == 2)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates (similarity 0.8 or more) stays."""
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """The documents with personal data masked."""
    return pii.masked(docs)


def sequences(spark, docs, sf_dir):
    """The documents' pieces, packed into sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", sequences),
]

#: The stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
