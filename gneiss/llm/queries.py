"""The queries of this subpackage: each dealt operator on its whole table, with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows if there is such."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their groups at two bits."""
    from gneiss.llm.simhash import near_groups

    groups = near_groups(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: SQL with the words of a text counted, each document's place in its source by hashed id, the
#: target of a source as its level times its weight, stopped at twice its size, and the inverse of its schedule's integral.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT a.source, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighted) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight OR b.cap / b.weight = a.cap / a.weight AND b.rank < a.rank), 0))
      / sum(b.weight) FILTER (b.cap / b.weight > a.cap / a.weight OR b.cap / b.weight = a.cap / a.weight AND b.rank >= a.rank) AS level
  FROM weighted a, weighted b GROUP BY a.source, a.rank, a.cap, a.weight),
goals AS (
  SELECT source, source_size, rank, round(least(cap, (SELECT max(level) FROM levels JOIN weighted w ON levels.source IS NOT DISTINCT FROM w.source WHERE level * w.weight <= w.cap) * weight), 6) AS target
  FROM weighted),
placed AS (
  SELECT doc_id, size, source_size, target, rank, CAST(round(target) AS BIGINT) AS goal,
    CAST(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS place
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
scheduled AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS a, CASE rank % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS b,
    greatest(0, least(size, goal - place)) AS one, greatest(0, least(size, goal - source_size - place)) AS two
  FROM placed),
needs AS (
  SELECT *, CASE WHEN target > 0 THEN least(place / target, 1) ELSE 0 END * (a + b) AS need_one, CASE WHEN target > 0 THEN least((place + source_size) / target, 1) ELSE 0 END * (a + b) AS need_two
  FROM scheduled)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(one + two AS BIGINT) AS taken,
  CASE WHEN one > 0 THEN CASE WHEN a = b THEN need_one / (2 * a) ELSE (sqrt(greatest(a * a + (b - a) * need_one, 0)) - a) / (b - a) END END AS first_position,
  CASE WHEN two > 0 THEN CASE WHEN a = b THEN need_two / (2 * a) ELSE (sqrt(greatest(a * a + (b - a) * need_two, 0)) - a) / (b - a) END END AS second_position
FROM needs
"""


@query(MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and when in training it is read."""
    from gneiss.llm.mixing import curriculum

    return curriculum(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_position", "second_position")


@query()
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, lines removed as part of repeated chunks and runs, and the digest of the rest."""
    from gneiss.llm.line_dedup import line_dedup

    rows = line_dedup(table(spark, sf_dir, "documents"), whole_runs=True)
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    import public_tokenizers
    from gneiss.llm.packing import pack_documents

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)


@query()
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document, words removed as repeated, and the digest of the rest."""
    from gneiss.llm.substring_dedup import substring_dedup

    rows = substring_dedup(table(spark, sf_dir, "documents"), k=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the categories and the verdict for each document."""
    from gneiss.llm.toxicity import score, train

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs.select("doc_id", "text"), train(docs, labels)).drop("text")


@query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of each document by both views and together, and whether it stays."""
    from gneiss.llm.cotraining import score_quality, train

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(docs, train(docs, labels))


@query()
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.98."""
    from gneiss.llm.lattice import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts, with the likeness of both and of the next document."""
    from gneiss.llm.imatch import edit_likeness

    return edit_likeness(table(spark, sf_dir, "documents"))


@query()
def op7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from gneiss.llm.wrappers import main_text

    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in all documents, with corpus-wide counts of id pairs."""
    import public_tokenizers
    from gneiss.llm.alignment import align_tokenizers

    a_file, a_ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return align_tokenizers(table(spark, sf_dir, "documents"), a_file, a_ranks, public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all damaged conversations, and the cheapest edits that repair their structure."""
    from gneiss.llm.conversations import damage, repair

    return repair(damage(table(spark, sf_dir, "conversations")))


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by models of the documents that are not held out."""
    from gneiss.llm.language import identify, remainder

    found = identify(table(spark, sf_dir, "documents"), learn=remainder().isin(0, 1), calibrate=remainder() == 3)
    return found.select("doc_id", (remainder() == 2).alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy", "n_letters")
