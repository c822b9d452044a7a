"""Documents to training sequences: STAGES in order, each over all that the one before it kept.

Every stage takes documents as they come: a null text is an empty one, which no filter drops but as a copy of none; a row
without a doc_id is kept by the near-duplicate stage and like any other elsewhere; repeated rows are decided alike (the
near-duplicate stage keeps them all, as they have one doc_id); other columns are left out; texts of any length are
read whole; an empty table, or one without labels or benchmark items, gives what is left, with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontam, neardup, packing, surrogates, toxicity
from tidemark.llm.common import checkpoint_dir, load, prepare
from tidemark.llm.runs import discard

#: The columns of documents that a stage returns, but the last.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more for toxicity."""
    return toxicity.drop_toxic(docs.select(*COLUMNS), load(prepare(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by similar sets of five-word shingles."""
    prepare(spark)
    return neardup.keep_one(docs.select(*COLUMNS), k=5, share=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item."""
    return decontam.drop_contaminated(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data; n_chars follows the text."""
    out = surrogates.replace_private(docs, surrogates.key_of(prepare(spark)), rest=["lang", "source"])
    return out.select("doc_id", "text", "rest.lang", "rest.source", F.length("text").cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("private_data", replace_private),
    ("packing", pack),
]

#: Not expressible: a trained machine decides, and packing searches.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents. Each stage's result is a table in the shared folder, which goes when the next one is
    there; packing has stored its pieces when it returns."""
    docs, base = load(spark, sf_dir, "documents"), f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        docs._stored_at = f"{base}/{name}"
        if before is not None:
            discard(before)
        before = docs
    out = STAGES[-1][1](spark, docs, sf_dir)
    discard(before)
    return out
