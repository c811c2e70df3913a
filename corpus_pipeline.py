"""A training corpus in five stages: toxic documents out, one document of each
near-duplicate class, shared passages out, sources mixed to their targets, the
rest packed into sequences.

Each stage's result is written as Parquet in the shared folder and read again
as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm import mixing, neardup, packing, suffixes, toxicity
from fieldlake.llm.common import stored, table, workers_find_this

#: a passage of 50 words, at six bytes a word with its blank; grams as long in proportion as op7's
PASSAGE_BYTES, PASSAGE_GRAM = 300, 120
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    labels = table(spark, sf_dir, "labels", "doc_id", *toxicity.CATEGORIES)
    chain = toxicity.train(docs, labels)
    return toxicity.score(docs, chain, list(COLUMNS)).where(~F.col("is_toxic")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    workers_find_this(spark)
    return neardup.keep_one(docs.select(*COLUMNS))


def drop_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages it shares; n_chars follows."""
    workers_find_this(spark)
    # shorter passages have more anchors a byte: half the text behind a run and a part
    d = suffixes.deduplicate(docs, PASSAGE_BYTES, PASSAGE_GRAM, [c for c in COLUMNS if c != "text"],
                             part_bytes=suffixes.PART_BYTES // 2, run_bytes=suffixes.RUN_BYTES // 2)
    return d.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    workers_find_this(spark)
    return mixing.apply_mix(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie."""
    workers_find_this(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_shared_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # toxicity and near duplicates cannot be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
