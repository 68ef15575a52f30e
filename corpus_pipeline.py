"""The corpus pipeline: filter, remove near duplicates, redact secrets, mix sources, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``. ``run`` applies them in order; each result is stored as Parquet in the
folder of ``spark.checkpoint.dir`` and read again as the next one's input.

Cases: null texts, empty tables, repeated rows and extra columns are handled as the
operators state. ``near_duplicates`` keeps one row of each group of texts linked by a similarity of
0.8 or more over runs of five words, also of those without an id; documents without words have no duplicates. ``redact_secrets`` keeps ``n_chars`` as it came. ``mix_sources`` repeats
a row for each copy the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airtally.llm import bpe, jaccard, mixing, queries, rules, secrets
from airtally.llm.common import table
from airtally.session import written

#: Words of a shingle, and the least similarity in percent, of near copies; op4's are its contract's.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs, NEAR_WIDTH, NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets replaced in their texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded text, a row for each copy."""
    path = queries.vocabulary_path()
    return bpe.digest(docs, path, bpe.lexicon(docs, path))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("redact_secrets", redact_secrets),
          ("mix_sources", mix_sources), ("encode_text", encode_text)]

#: Trained ratios, near-copy groups and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
