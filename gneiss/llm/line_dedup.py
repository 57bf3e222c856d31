"""Remove multi-line chunks that repeat anywhere in the corpus, by content-defined chunking.

There are two ways to cut a text.

*Anchors* (:func:`anchored_chunks`) come from the hash of a line alone: a bit of it says whether a chunk opens
or closes there. On the one scale a line with the bit before a line without it is a chunk, on the other scale a line
without it before one with it, so half of all line pairs are chunks, whatever stands around them, and a passage of n
lines holds none only if all its bits are equal, once in 2^(n-1). Lines at either end of a text up to the first chunk are
one too. Chunks are compared byte by byte (they are grouped by their text). Then equal chunks grow line by line to both
sides, up to the next chunk, as long as the grown piece has stood before: its lines are compared by 128 bits of hashes.

*Minima* (:func:`with_chunks`): a rolling hash covers a line and the one before it, and a line whose rolling hash is below
that of both neighbours ends a chunk. These chunks are larger and end at the borders of a repeated passage only by luck. With
``whole_runs`` every pair of consecutive lines is compared too, by 128 bits of hashes, so that runs are found whole.

Of equal pieces the first in the corpus stays.

DataFrame functions only. Texts are shuffled twice: as chunks to be compared, and as documents
to be cut. Of other lines only hashes and places move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gneiss.llm.common import SALTS, row_key, stored


def with_chunks(docs: DataFrame) -> DataFrame:
    """Add ``__lines`` and ``__chunks``, an array of (start, len), to rows with a text."""
    lined = docs.withColumn("__lines", F.split("text", "\n", -1))
    hashed = lined.withColumn("__hashes", F.transform("__lines", lambda line: F.xxhash64(line)))
    rolled = hashed.withColumn("__rolled", F.transform(
        "__hashes", lambda h, i: F.when(i > 0, F.xxhash64(F.get("__hashes", i - 1), h))))
    last = F.size("__lines") - 1
    inner = F.when(last >= 3, F.sequence(F.lit(1), last - 2)).otherwise(F.array().cast("array<int>"))
    cuts = F.filter(inner, lambda i: (
        F.coalesce(F.get("__rolled", i) < F.get("__rolled", i - 1), F.lit(True)) & (F.get("__rolled", i) <= F.get("__rolled", i + 1))))
    cut = rolled.withColumn("__cuts", cuts)
    ends = F.concat("__cuts", F.array(last))
    starts = F.concat(F.array(F.lit(0)), F.transform("__cuts", lambda c: c + 1))
    spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("len")))
    return cut.withColumn("__chunks", F.when(F.col("__lines").isNotNull(), spans)).drop("__hashes", "__rolled", "__cuts")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """The chunks to remove: doc_id, key (number of the row's content), start, len.

    Of equal chunks the one with the smallest (doc_id, key, start) stays, ids that are null last.
    """
    keyed = docs.select("doc_id", row_key().alias("key"), "text")
    # An outer explode, since the filter derived from an inner one would compute the chunks again.
    chunks = with_chunks(keyed).select("doc_id", "key", "__lines", F.explode_outer("__chunks").alias("c")).where("c.len >= 2")
    chunk = F.array_join(F.slice("__lines", F.col("c.start") + 1, F.col("c.len")), "\n")
    chunks = chunks.select("doc_id", "key", "c.*", chunk.alias("chunk"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "start")
    # Grouping by the chunk itself compares bytes; its digest then names the group. Copies of a
    # chunk are combined before the shuffle.
    groups = chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    groups = groups.select(F.md5("chunk").alias("digest"), "first")
    named = chunks.select("doc_id", "key", "start", "len", F.md5("chunk").alias("digest"))
    # A hot chunk is spread over salts.
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = named.withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"])
    return found.where(place != F.col("first")).select("doc_id", "key", "start", "len")


def _place() -> Column:
    """Where a chunk stands; the order of places tells which of equal ones is the first. Null ids are last."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "start")


def _later(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the groups in ``firsts``, with ``first``; a hot group is spread over salts."""
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)).cast("int")).join(salted, [*keys, "salt"]).drop("salt")


def anchored_chunks(docs: DataFrame) -> DataFrame:
    """Add ``__lines`` and ``__chunks``, an array of (start, len, low, high), to rows with a text.

    A chunk may grow down to line ``low`` and up to line ``high``, next to which other chunks begin.
    """
    lined = docs.withColumn("__lines", F.split("text", "\n", -1))
    bits = lined.withColumn("__bits", F.transform("__lines", lambda line: F.xxhash64(line).bitwiseAND(F.lit(1))))
    last = F.size("__lines") - 1
    inner = F.when(last >= 1, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
    turned = bits.withColumn("__turns", F.filter(inner, lambda i: F.get("__bits", i) != F.get("__bits", i + 1)))
    pairs = F.transform("__turns", lambda at, k: F.struct(
        at.alias("start"), F.lit(2).alias("len"), (F.coalesce(F.get("__turns", k - 1), F.lit(-1)) + 1).alias("low"),
        F.coalesce(F.get("__turns", k + 1), last).alias("high")))

    def end(start: Column, stop: Column) -> Column:
        return F.struct(start.alias("start"), (stop - start + 1).alias("len"), start.alias("low"), stop.alias("high"))

    none = F.size("__turns") == 0
    head, tail = F.coalesce(F.get("__turns", F.lit(0)), last), F.element_at(F.concat(F.array(F.lit(-1)), "__turns"), -1) + 1
    ends = F.array_compact(F.array(F.when(head >= 1, end(F.lit(0), head)), F.when(~none & (last - tail >= 1), end(tail, last))))
    found = turned.withColumn("__chunks", F.when(F.col("__lines").isNotNull(), F.concat(pairs, ends)))
    return found.drop("__bits", "__turns")


def grown_chunks(docs: DataFrame) -> DataFrame:
    """What to remove by anchored chunks: doc_id, key, start and len of chunks and of the lines that they grew by."""
    keyed = docs.select("doc_id", row_key().alias("key"), "text")
    # An outer explode, since the filter derived from an inner one would compute the chunks again.
    chunks = anchored_chunks(keyed).select("doc_id", "key", "__lines", F.explode_outer("__chunks").alias("c")).where("c.len >= 2")
    chunk = F.array_join(F.slice("__lines", F.col("c.start") + 1, F.col("c.len")), "\n")
    end = F.col("c.start") + F.col("c.len")

    def hashes(lines: Column) -> Column:
        return F.transform(lines, lambda line, i: F.struct(F.xxhash64(i, line).alias("a"), F.xxhash64(line, i).alias("b")))

    before = hashes(F.reverse(F.slice("__lines", F.col("c.low") + 1, F.col("c.start") - F.col("c.low"))))
    after = hashes(F.slice("__lines", end + 1, F.col("c.high") - end + 1))
    chunks = chunks.select("doc_id", "key", "c.start", "c.len", chunk.alias("chunk"), before.alias("before"), after.alias("after"))
    # Grouping by the chunk itself compares bytes; its digest then names the group. Copies of a
    # chunk are combined before the shuffle.
    groups = chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1")
    groups = groups.select(F.md5("chunk").alias("digest"), "first")
    found = _later(chunks.withColumn("digest", F.md5("chunk")).drop("chunk"), groups, ["digest"])
    # Repeated rows are one place.
    found = stored(found.dropDuplicates(["doc_id", "key", "start", "len"]), "repeated_chunks")
    gone = found.where(_place() != F.col("first")).select("doc_id", "key", "start", "len")
    # Grown pieces: the chunk and its next lines to one side, named by all of their hashes with their distance.
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(name).alias("lines")) for side, name in ((-1, "before"), (1, "after"))])
    lines = found.select("doc_id", "key", "start", "len", "digest", F.explode(sides).alias("s")).where(F.size("s.lines") > 0)
    lines = lines.select("doc_id", "key", "start", "len", "digest", "s.side", F.posexplode("s.lines").alias("distance", "line"))
    so_far = Window.partitionBy("doc_id", "key", "start", "len", "side").orderBy("distance").rowsBetween(Window.unboundedPreceding, 0)
    grown = lines.select("doc_id", "key", "start", "len", "digest", "side", "distance", *[F.bit_xor(f"line.{c}").over(so_far).alias(c) for c in ("a", "b")])
    piece = ["digest", "side", "distance", "a", "b"]
    firsts = grown.groupBy(*piece).agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1").drop("n")
    more = _later(grown, firsts, piece).where(_place() != F.col("first"))
    at = F.when(F.col("side") > 0, F.col("start") + F.col("len") + F.col("distance")).otherwise(F.col("start") - 1 - F.col("distance"))
    return gone.union(more.select("doc_id", "key", at.alias("start"), F.lit(1).alias("len")))


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """The pairs of consecutive lines to remove: doc_id, key, start and len, which is two.

    Of equal pairs the first stays, as in :func:`repeated_chunks`. A line goes if a pair that
    covers it has stood before, so the first occurrence of every line stays somewhere.
    """
    keyed = docs.select("doc_id", row_key().alias("key"), F.split("text", "\n", -1).alias("lines")).where(F.size("lines") >= 2)
    hashed = keyed.select("doc_id", "key", F.transform("lines", lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))).alias("hashes"))
    twos = F.zip_with(F.slice("hashes", 1, F.size("hashes") - 1), F.slice("hashes", 2, F.size("hashes") - 1), lambda x, y: F.struct(
        F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(x["b"], y["b"]).alias("b")))
    pairs = hashed.select("doc_id", "key", F.posexplode(twos).alias("start", "pair")).select("doc_id", "key", "start", "pair.*")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "start")
    groups = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    # A hot pair is spread over salts.
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = pairs.withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)).cast("int")).join(salted, ["a", "b", "salt"])
    return found.where(place != F.col("first")).select("doc_id", "key", "start", F.lit(2).alias("len"))


def line_dedup(docs: DataFrame, whole_runs: bool = False, grown: bool = False) -> DataFrame:
    """The documents without repeated chunks, with ``n_lines`` and ``n_removed`` added.

    With ``grown`` chunks are those between anchors, grown to both sides, otherwise those between minima. With ``whole_runs``
    every line of a repeated run of two lines or more goes, not only whole chunks.

    Lines are what ``\\n`` separates; what stays is joined by ``\\n`` again. Documents of one line
    stay as they are. A null text stays null with 0 lines, an empty text is one line. Repeated
    rows (equal id and text) are copies of each other that can't be told apart: their chunks
    stay in each of them once. An empty table gives no rows. Other columns are kept, but for ones
    named ``n_lines`` or ``n_removed``, which give way.
    """
    docs = docs.drop("n_lines", "n_removed")
    gone = grown_chunks(docs) if grown else repeated_chunks(docs)
    gone = gone.union(repeated_pairs(docs)) if whole_runs else gone
    gone = gone.distinct().groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "len")).alias("__gone"))
    gone = gone.withColumnsRenamed({"doc_id": "__id", "key": "__k"})
    rows = docs.withColumn("__key", row_key())
    rows = rows.join(gone, rows["__key"].eqNullSafe(gone["__k"]) & rows["doc_id"].eqNullSafe(gone["__id"]), "left")
    rows = rows.withColumn("__lines", F.split("text", "\n", -1))
    numbers = F.flatten(F.transform("__gone", lambda g: F.sequence(g["start"], g["start"] + g["len"] - 1)))
    rows = rows.withColumn("__stay", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), numbers))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n"))
    removed = F.size("__lines") - F.size("__stay")
    return rows.select(
        *[text.alias("text") if c == "text" else rows[c] for c in docs.columns],
        F.greatest(F.coalesce(F.size("__lines"), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"))
