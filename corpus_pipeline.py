"""A corpus pipeline over the training-data operators: five stages, each written as Parquet and read again.

Near-duplicate groups are those of five-word shingles at a similarity of 0.8 or more.  Up to the last stage all return
the columns of ``documents``; mixing repeats rows as often as the mix takes them; the last returns what the token files
hold of each row.

Defined cases, in every stage: a null text counts as empty, and is kept by the first three; a null doc_id is a row like
any other; of repeated rows the second stage keeps one, the others treat each for itself; texts of any length are taken
whole; an empty table gives an empty table; further columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelith.llm import decontaminate, jaccard, mixing, tokens, toxicity
from panelith.llm.common import durable, plainly, shared_dir, table
from panelith.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose restored text is not scored as toxic (score under 0.5)."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id; all rows without words."""
    return jaccard.one_of_each(docs, 5, 80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no item of ``benchmark`` is found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; its files are runs of one output shard each, in that shard's order."""
    return plainly(docs, ("doc_id", "source", "text"), mixing.mixed)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row, read back from the token files (ascending doc_id)."""
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    tokens.write_tokens(docs, path, tokenizer_path("word_bpe_49k.json"))
    return tokens.document_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mixing", mix_sources),
    ("token-ids", write_ids),
]

#: The classifier of the first stage is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
