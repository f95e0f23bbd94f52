"""The training-data pipeline: documents to encoded training rows.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import chunk_dedup, langid, minmax, mixing, piece_encode
from quern.session import checkpoint_dir

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


#: A text is rejected where no language holds this mean share of its words.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or of no clear language, go."""
    model = langid.fit(docs)
    # The id column of the prediction carries the whole row past the model.
    rows = docs.select(F.struct(*DOCUMENT).alias("row"), "text")
    seen = langid.predict(rows, model, id_col="row")
    return seen.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc_id.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return chunk_dedup.keep_last(docs).select(DOCUMENT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays.

    Documents link at a Jaccard of word shingles of ``minmax.LEAST_PERCENT``
    (85) percent or more; below it, from 80 percent too, only through others.
    """
    return minmax.keep_first(docs).select(DOCUMENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, in training order; one read twice stands twice."""
    return mixing.curriculum(docs.select(DOCUMENT))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training rows: the ids of every document, and digests of them and of their decoded text."""
    import public_tokenizers
    rows = piece_encode.encode_table(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return piece_encode.digest(rows, "ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: Language ID and SentencePiece encoding are beyond SQL; the tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
