"""A corpus made ready for training, in five stages over the columns of documents.

Toxic documents go; of each group of near copies one document stays; secrets are masked; sources are mixed to their
target weights, by copies of documents; what is left is encoded. Each stage is written and read again.

Defined cases of all stages: an empty table gives an empty result; columns beyond those of documents are dropped,
whatever their names; null ids are ids like any other, placed last; very long texts are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilespark.llm import bpe, jaccard, mixing, secret_scan, toxicity
from tilespark.llm.common import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go. Repeated rows and equal texts share their fate; null and empty texts have
    the rate of examples without words, and stay; without labels all rows stay."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts stays: that of the least id, then by a hash of the text; repeated rows are a
    group. Rows without words, null texts too, are linked with nothing and all stay."""
    return jaccard.representatives(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in text become a mask, and n_chars follows; all rows stay, null texts as they are."""
    return secret_scan.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row stands as many times, 0 to 3, as its source's target asks for. Rows of one id and source are taken
    together; a null source is a source, placed last; a source without words has no rows left."""
    plan = mixing.thresholds(materialise(mixing.sizes(docs)))
    mixed = mixing.with_copies(docs.select(*COLUMNS), plan)
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids of each row; ids are decoded again and held against the text. A null text has none."""
    return bpe.encode_ids(docs, *bpe.default_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
#: The toxicity stage isn't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
