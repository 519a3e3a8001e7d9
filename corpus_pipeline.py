"""A training-data pipeline over documents: STAGES in order, each on what its predecessor kept.

Every stage takes rows as they are: null and empty texts, texts of any length, null and repeated ids, equal rows, empty
tables, and further columns of any name, which all but the last stage pass on.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluicebox.llm.common import table, workspace
from sluicebox.llm.mixing import mix_sources
from sluicebox.llm.prefix_join import keep_one_per_component
from sluicebox.llm.repeats import cut_repeats
from sluicebox.llm.toxicity import drop_toxic
from sluicebox.llm.winnowing import drop_contaminated


def filter_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones.

    Rows are judged by their texts alone; a null text counts as empty.  Without labels of both sorts nothing is learnt, and
    all rows are judged alike, by the share of toxic labels.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (Jaccard >= 0.8 of five-word shingles) the one with the least doc_id stays.

    Rows are told apart by doc_id and text: one with another's doc_id, or without any, goes only if its own text is linked.
    Rows without words stay.
    """
    return keep_one_per_component(docs, size=5, percent=80)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier are cut out of the texts; every document stays.

    Earlier means a smaller doc_id (null ids come last), or an earlier place in one text.  Texts without such strings,
    null ones too, are passed on as they are.
    """
    return cut_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose share of benchmark words is too large go, each row by its own text; rows without words stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left; a null text has none, a null source is one of its own."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", filter_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
]

#: The toxicity stage is a trained model, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it kept is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    work = workspace(docs)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = work.stage(docs, name)
    return docs
