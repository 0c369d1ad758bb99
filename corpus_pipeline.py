"""The corpus pipeline: documents without toxic ones, near copies and repeated passages, packed.

Each stage takes (spark, docs, sf_dir), does its whole job on all its
predecessor kept and, but for the last, returns the columns of ``documents``.
SQL can express neither the trained classifier nor the packing, so there is no
``ORACLE_SQL``; the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from habita.llm import packing, parity_join, suffix_dedup, toxicity
from habita.llm.common import materialize, spare_name
from habita.session import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold stay, unchanged, columns of any name included.

    A null text is scored like an empty one; each of repeated rows is judged by
    itself; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest ``doc_id`` stays, unchanged.

    Documents without words (null or empty text) have no near copies and stay.
    Rows that repeat a ``doc_id`` and its text count once; rows with a null
    ``doc_id`` stay. Columns may have any name; an empty table stays empty.
    """
    links = parity_join.link_documents(docs)
    kept = links.where("doc_id = component_id").select("doc_id").distinct()
    name = spare_name(docs, "text_hash")
    known = (docs.join(kept, "doc_id", "left_semi").withColumn(name, F.xxhash64("text"))
             .dropDuplicates(["doc_id", name]).select(docs.columns))
    return known.unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out of ``text``; every document stays.

    A null text becomes the empty one; rows with a null ``doc_id`` stay whole,
    rows that share one never cut each other. Columns may have any name and stay
    as they are (``n_chars`` is counted again); an empty table stays empty.
    """
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document with its place.

    A null or empty text is its end id alone; rows with a null or repeated
    ``doc_id`` are documents of their own; other columns are left behind; an
    empty table gives no rows.
    """
    return packing.pack_documents(docs)


STAGES = [("toxicity", reject_toxic), ("ngram_jaccard", one_of_each_group), ("suffix_dedup", cut_repeats), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
