"""A training corpus from ``documents`` in stages, each written before the next.

``run(spark, sf_dir)`` applies STAGES in order; every stage gets the rows its
predecessor kept, read back from the shared folder, and all but the last return
the columns of ``documents``.

Documents are rows: repeated rows are documents of their own, except that the
near-duplicate stage keeps one row of each group.  NULLs in any column are
passed on; a NULL text has no language and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import free_name, load, saved
from llm.language_id import UNDETERMINED, identify, learnable, train
from llm.mixing import Mix
from llm.packing import pack
from llm.secrets_scan import redact
from llm.simhash import fingerprint_classes, fingerprints


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    model = train(docs, learnable())
    name, score = free_name(docs, "_lang"), free_name(docs, "_score")
    told = identify(docs, model, keep=tuple(docs.columns), name=name, score=score)
    return told.filter(told[name] != UNDETERMINED).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the one of the smallest id, of the smallest
    row number among those.  Rows of one id whose texts are unlike are of
    different groups.  Rows without an id cannot be told apart and stay.

    Only the numbers of the rows that go take part in a join with the texts."""
    row = free_name(docs, "_row")
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    codes = saved(fingerprints(numbered, keep=(row,)), "fingerprints")
    _, groups = fingerprint_classes(codes, ("doc_id", row))
    kept = groups.select(F.col("first")[row].alias(row))
    gone = codes.filter(F.col("doc_id").isNotNull()).select(row).join(kept, row, "left_anti")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced; ``n_chars`` follows the text."""
    clean = redact(docs)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        clean = clean.withColumn("n_chars", changed)
    return clean.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every time a document is drawn, in shards."""
    return Mix(docs).rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences of at most 1024 tokens: one row per piece."""
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicate),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]

# Language models, fingerprint trees and tokens are not for SQL; the stages are
# tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
