"""From raw documents to packed training sequences: five stages of the operators in ``gneiss.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gneiss.llm.common import stored
from gneiss.llm.line_dedup import line_dedup
from gneiss.llm.mixing import mixed_documents
from gneiss.llm.packing import pack_documents
from gneiss.llm.simhash import drop_near_duplicates
from gneiss.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go. It is trained on the labelled rows of ``docs``."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks and runs of lines go; ``n_chars`` follows the text where it has changed.

    Documents stay, those of which nothing is left too: they are copies of each other to the next stage.
    """
    own = {c: f"__own_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}
    cut = line_dedup(docs.withColumnsRenamed(own), whole_runs=True)
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    cut = cut.withColumn("n_chars", size).drop("n_lines", "n_removed")
    return cut.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Fingerprints over the set of single words keep copies within few bits, and ten of them
    find what one misses; a link then asks for a similarity of 0.8 of the sets of five-word shingles.
    Copies link through each other.
    """
    return drop_near_duplicates(docs, shingle=1, distinct=True, bits=2, number=10, similarity=0.8, similarity_shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their targets: documents appear as often as the mix takes them, in training order."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens, numbered along the training order.

    The stage before has written its rows in that order; its files tell it.
    """
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(docs, *files, public_tokenizers.PATTERN, in_order=True)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_copies", near_copies), ("mixing", mixing), ("packing", packing)]

#: The stages train models, cluster fingerprints and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
