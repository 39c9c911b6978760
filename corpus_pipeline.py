"""From documents to token ids: the stages of a training corpus, one after the other.

Each stage works on all that the one before kept, and its decisions take effect: rows go or
texts change. Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontaminate, pieces, simhash, suffixes, toxicity
from tallyforge.llm.common import kept_table, table
from tallyforge.llm.queries import tokenizer


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one of the smallest id."""
    return simhash.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that an earlier place has are cut out."""
    return suffixes.cut(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; what is little else goes."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded."""
    return pieces.encode(docs, tokenizer())


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("pieces", encoded),
]

#: No SQL can say the fitted and the byte-wise stages; tests/llm holds them against plain
#: Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again: doc_id, n_tokens, ids, decoded.

    Null texts count as empty and have no tokens; rows without doc_id are kept, but for near copies of
    others; of repeated rows one stays, as of any group of near copies. Without labels of both
    kinds no document is toxic, without benchmark items nothing is cut for them; an empty table
    of documents gives no rows. Further columns go through all stages but the last.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
