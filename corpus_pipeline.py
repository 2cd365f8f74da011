"""A training corpus from the table documents, stage by stage: each stage's rows are written, and the next reads them.

For every stage: null or empty texts and null ids are ordinary rows; repeated rows are rows of their own; an empty table
gives an empty table; texts of any length are taken whole; further columns pass, whatever their names, to the last stage,
which returns its own four. What a stage makes of such rows in particular stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import bpe, decontam, line_dedup, minhash, toxicity
from qaloom.llm.common import settle, settled, sweep, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go (score of 0.5 or more). Without text a document is scored by the end
    token alone; repeated rows score alike; without labels nothing is rejected."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in 10 documents or more go; n_chars follows the text. A null text becomes ''; blank lines stay;
    each of repeated rows counts as a document, a line repeated in one counts once."""
    done = line_dedup.drop_common_lines(docs)
    made = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return done.withColumns(made).select(*docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity of 0.8 or more) stays: that of the least id.
    Texts without words are alike to none, and stay; rows that share the least id all stay; a null id stays only in a
    group without any other id."""
    return minhash.drop_near_duplicates(docs, percent=80, k=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or with a whole shorter item, go. Texts without words stay;
    an empty benchmark removes nothing; of repeated rows all go or none."""
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and text, decoded from the ids. A null or empty text: no ids, and the text ''."""
    ranks = bpe.default_ranks()
    done = bpe.encode(docs.select("doc_id", "text"), ranks, bpe.default_pattern(), back=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", to_tokens),
]
#: No SQL can express the first and third stage; tests/llm holds all five against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of all the others' rows. After each stage, what it left in the shared folder goes."""
    docs, since = table(spark, sf_dir, "documents"), settled()
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        sweep(spark, since, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
