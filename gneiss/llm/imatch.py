"""Document fingerprints by I-Match over several randomised lexicons.

The lexicon has the terms whose inverse document frequency, over all documents, lies within a
band. A fingerprint has one hash for each of several random subsets of the lexicon: that of the
document's distinct terms in the subset. The exclusive or of the terms' 64-bit hashes, which differ
from subset to subset, stands for the hash of the sorted terms, since neither depends on the order they
come in. Subsets are drawn apart from each other and thin out by halves, so that some are small enough to
survive an edit whatever the size of the document.

DataFrame functions only. The upper end of the band bounds the lexicon: a term in at least a
share s of the documents is one of at most (mean distinct terms of a document) / s terms,
however many documents there are. Its size is checked, and it is broadcast as long as it holds
``BROADCAST_TERMS`` terms at most; terms of documents are then not shuffled at all, since each
document's are combined in the task that has its text.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from gneiss.llm.common import row_key, shuffle_width, stored

#: The band of ln(documents / documents with the term): terms of 10 % to 0.05 % of all documents.
BAND = (math.log(1 / 0.1), math.log(1 / 0.0005))
BROADCAST_TERMS = 4_000_000
#: Subsets of the lexicon: the number of hash bits that are zero in what it picks, so one in
#: 2^number terms; the sizes that most documents have few terms of come four times.
SUBSETS = [n for n, times in enumerate((1, 1, 2, 4, 4, 4, 4, 4, 4, 4, 2, 2)) for _ in range(times)]
LEAST = -(2**63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: lower-cased runs of letters and digits."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """The hashes of the terms in the band: one column, ``term``."""
    # Outer explodes, since the filter derived from an inner one would compute the terms again.
    counts = docs.select(F.explode_outer(terms(F.col("text"))).alias("term")).where("term IS NOT NULL").groupBy("term").count()
    total = docs.agg(F.count("*").alias("total")).scalar()
    # Rounded, so that a term at the very end of the band isn't lost to the last bit.
    idf = F.round(F.log(total / F.col("count")), 9)
    return counts.where((idf >= round(band[0], 9)) & (idf <= round(band[1], 9))).select("term")


def subset_hash(term: Column, subset: int) -> Column:
    """A 64-bit hash of a term for each subset; it draws the subset, too."""
    return F.xxhash64(term, F.lit(subset))


def signatures(rows: DataFrame, text: str, known: DataFrame) -> DataFrame:
    """The rows, without ``text`` and each once, with ``signature``: an array with a hash or null for each subset.

    A document without terms in the band is told by the first subset's hash, of all its terms.
    """
    rest = [c for c in rows.columns if c != text]
    small = known.count() <= BROADCAST_TERMS
    each = rows.select(*rest, F.explode_outer(terms(F.col(text))).alias("term"))
    each = each.join((F.broadcast(known) if small else known).withColumn("inside", F.lit(True)), "term", "left")

    def drawn(subset: int) -> Column:
        """The term's hash for a subset of the lexicon, null if the term isn't in it."""
        own = subset_hash(F.col("term"), subset)
        return F.when(F.col("inside") & (own.bitwiseAND(F.lit(2 ** SUBSETS[subset] - 1)) == 0), own)

    hashes = [F.bit_xor(drawn(i)).alias(f"__s{i}") for i in range(len(SUBSETS))]
    found = each.groupBy(*rest).agg(F.bit_xor(subset_hash(F.col("term"), 0)).alias("__all"), F.count("term").alias("__n"), *hashes)
    first = F.coalesce("__s0", F.when(F.col("__n") > 0, F.col("__all")))
    return found.select(*rest, F.array(first, *[F.col(f"__s{i}") for i in range(1, len(SUBSETS))]).alias("signature"))


def as_text(signature: Column) -> Column:
    """Sixteen hex digits for each subset, dashes for an empty one."""
    return F.array_join(F.transform(signature, lambda s: F.coalesce(F.lower(F.lpad(F.hex(s), 16, "0")), F.lit("-" * 16))), "")


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets that either document has terms in, the share with equal hashes; 1 if there are none."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct((x.isNotNull() | y.isNotNull()).alias("told"), F.coalesce(x == y, F.lit(False)).alias("same")))
    told = F.size(F.filter(pairs, lambda p: p["told"]))
    same = F.size(F.filter(pairs, lambda p: p["same"]))
    return F.when(told == 0, F.lit(1.0)).otherwise(same / told)


def with_next(rows: DataFrame, *columns: str) -> DataFrame:
    """Add ``next_<column>``: the value in the next row by descending doc_id, after the last the first.

    Null ids come last and ties are ordered by key. Rows are dealt to ranges of ids between
    quantiles. A quantile is some row's id; the rows that have it are sent to the range above
    too, where they stand behind all others, and the largest id to the lowest range. So each
    range finds its successors in itself.
    """
    ranges = min(2048, 2 * shuffle_width(rows))
    steps = [k / ranges for k in range(1, ranges)]
    # At most 2047 quantiles and the largest id come to the driver.
    head = rows.agg(F.percentile_approx("doc_id", steps).alias("ends"), F.max("doc_id").alias("top")).first()
    ends = F.from_json(F.lit(json.dumps(sorted(set(head.ends or [])))), "array<bigint>")
    top = F.lit(LEAST if head.top is None else head.top)
    own = F.coalesce("doc_id", F.lit(LEAST))
    low = F.size(F.filter(ends, lambda e: e < own))
    places = F.array_compact(F.array(
        F.struct(low.alias("range"), F.lit(0).alias("behind")),
        F.when(F.array_contains(ends, own), F.struct((low + 1).alias("range"), F.lit(1).alias("behind"))),
        F.when(own == top, F.struct(F.lit(0).alias("range"), F.lit(2).alias("behind")))))
    dealt = rows.withColumn("__places", places)
    dealt = dealt.select(*rows.columns, F.explode_outer("__places").alias("__place"))
    after = Window.partitionBy("__place.range").orderBy("__place.behind", F.col("doc_id").desc_nulls_last(), "key")
    dealt = dealt.withColumns({f"next_{c}": F.lead(c).over(after) for c in columns})
    return dealt.where("__place.behind = 0").drop("__place")


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("key", row_key())


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, key (number of the row's content) and signature, of each different row.

    A null text is empty. Equal texts have equal signatures, an empty text one of nulls. Null ids
    are documents like others. An empty table gives no rows.
    """
    rows = _rows(docs)
    return signatures(rows, "text", stored(lexicon(rows, band), "lexicon"))


def edit_likeness(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last half (rounded down) replaced by as many first characters of the
    next document, by descending doc_id, or all of them. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. Repeated rows are returned each; the
    next document of one may be the other.
    """
    rows = _rows(docs)
    known = stored(lexicon(rows, band), "lexicon")
    own = stored(signatures(rows, "text", known), "signatures")
    rows = with_next(rows, "text", "key", "doc_id").withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "key", "next_doc_id", "next_key", "n_chars", edited.alias("edited"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = signatures(rows, "edited", known).withColumnRenamed("signature", "edited_signature").alias("e")
    for name, key, doc_id in (("own", "key", "doc_id"), ("next", "next_key", "next_doc_id")):
        other = own.select(F.col("key").alias(f"{name}__k"), F.col("doc_id").alias(f"{name}__id"), F.col("signature").alias(f"{name}_signature"))
        rows = rows.join(other, (F.col(key) == F.col(f"{name}__k")) & F.col(doc_id).eqNullSafe(F.col(f"{name}__id")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own_signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("own_signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("own_signature"), F.col("next_signature")).alias("near_next"))
