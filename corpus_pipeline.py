"""From raw documents to packed token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. ``run``
writes each stage's result to the shared folder as Parquet and reads it again for the
next, so lost executors cost one stage at most. All stages but the last return the
columns of ``documents``, whatever others there are and however these are named.

Defined results: a null text is an empty one and is in no danger of being toxic or a leak;
of rows whose texts are null or empty (alike to near_dedup) the one with the smallest
``doc_id`` stays, and so it is with rows that repeat others. Rows without a ``doc_id`` pass
near_dedup as they are. An empty table gives an empty one at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylattice.llm import queries as q
from skylattice.llm.common import read, store
from skylattice.llm.decontaminate import drop_leaks
from skylattice.llm.mixing import mix_sources
from skylattice.llm.packing import pack_tokens
from skylattice.llm.simhash import THREE_BITS, drop_near_duplicates
from skylattice.llm.toxicity import drop_toxic, fit


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, fit(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that op8 links, three-word shingles and at most 3 of 64 bits, one stays."""
    return drop_near_duplicates(docs, THREE_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a row comes once for each epoch it is in."""
    epoch = "_epoch"
    while epoch in docs.columns:
        epoch = f"_{epoch}"
    mixed = mix_sources(
        docs, q.MIX_SHARE, (q.domain(), "lang", "source"), q.MIX_WEIGHTS,
        total_is_share=True, epoch_column=epoch,
    )
    return mixed.drop(epoch)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed matrices of token ids."""
    return pack_tokens(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: No stage but mixing comes near to SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs


QUERIES = {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
