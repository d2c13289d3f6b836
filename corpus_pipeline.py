"""A corpus pipeline over documents.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept: quality rules and language ID
drop rejected documents, near-dedup keeps one document of each group, personal data get pseudonyms, and
what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytoflux.llm import host_rules, language_id, near_dup, packing, pseudonyms
from cytoflux.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that neither their own rules nor their host's verdict rejects.

    A null or empty text has no word and goes; a null host is one host; a null id keeps its row; repeated rows are judged one by
    one; no row in, no row out.
    """
    return host_rules.kept_documents(docs)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the model of their labelled rows does not reject.

    A null text, or one without a letter, goes; a tie goes to the first language by name; repeated rows are judged one by one; without a
    labelled row all texts with a letter stay.
    """
    return language_id.known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the least id.

    Rows with a null id or text stay; rows that repeat id and text count once; rows that share an id but differ in text are documents of
    their own.
    """
    return near_dup.without_near_duplicates(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with pseudonyms in the text.  A null text stays null; equal values get equal pseudonyms in all rows."""
    return pseudonyms.pseudonymise(docs, pseudonyms.TEST_KEY)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their places in sequences.

    A null or empty text is one piece with the end id alone; null or repeated ids keep their rows; pieces of equal length take places in any order.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: SQL expresses neither near-dedup by signatures nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
