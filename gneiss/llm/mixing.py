"""Mix sources to target weights on a time-varying curriculum.

Each source has a weight schedule over the training time from 0 to 1. Its integral, scaled to
the source's target, is the number of words demanded up to a time; inverting it at a document's
place in its source gives the document's training position. Documents are then range-sorted by
position.

Places within a source are running sums. They are taken in two steps, over hash buckets of a
source and then within a bucket, so a source with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gneiss.llm.common import WORD, row_key

#: Hash buckets of a source: the first three hex digits of a document's order key.
BUCKET_DIGITS = 3

#: Weights of sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)

#: Density of a source's words at the start and at the end of training, by the same rank, repeating.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))


def n_words(text: str | Column = "text") -> Column:
    """The words of a whole text; null counts as none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, key, source and size of each row, with its order in the source: a hash of the id."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return docs.select("doc_id", row_key().alias("key"), "source", n_words().alias("size"), order.alias("order_key"))


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Per source of ``sizes`` (source, source_size): its rank and target.

    The targets are a level times the weight, stopped at ``most`` times the size, where the
    level makes them sum to ``share`` times all sizes. That is what resharing the excess by
    weight comes to. Sources fill up in the order of size by weight, so the level follows from
    running sums. The table has one row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    pick = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(pick, (F.col("rank") % len(weights)).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fills = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumns({
        "full": F.sum("cap").over(fills.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cap"),
        "open": F.sum("weight").over(fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "wanted": F.sum("source_size").over(everything) * F.lit(float(share)),
    })
    ranked = ranked.withColumn("level", (F.col("wanted") - F.col("full")) / F.col("open"))
    reached = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("full", "level"))).over(everything)
    ranked = ranked.withColumn("level", F.coalesce(reached["level"], F.lit(float("inf"))))
    target = F.round(F.least(F.col("cap"), F.col("level") * F.col("weight")), 6)
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Per document row: doc_id, key, size, source_size, target, taken, rank, and its place.

    ``place`` is the number of words of its source before it. A source is read over and over in
    the order of hashed ids until its target is met, to the word; ``taken`` counts the words
    that the mix takes of the document, repeats included, and is at most ``most`` times its size.

    A null text has size 0 and takes 0; null sources are one source; null ids and repeated rows
    are rows like others, and where the order ties, equal rows are interchangeable. An empty
    table gives no rows. Reruns agree.
    """
    rows = sized(docs).withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), share, most, weights)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    starts = starts.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
    starts = starts.select("b.source", "bucket", "bucket_start", "source_size", "target", "rank")
    within = Window.partitionBy("source", "bucket").orderBy("order_key", F.col("doc_id").asc_nulls_last(), "size", "key")
    placed = rows.withColumn("place", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    placed = placed.alias("d").join(
        starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket")))
    placed = placed.select("doc_id", "key", "size", "source_size", "target", "rank", (F.col("place") + F.col("bucket_start")).alias("place"))
    goal = F.round("target").cast("long")
    # Pass p of the source covers the places from p times its size on; the target ends in one of the passes.
    taken = sum((_clamp(goal - p * F.col("source_size") - F.col("place"), F.col("size")) for p in range(int(-(-most // 1)))), F.lit(0))
    return placed.withColumn("taken", taken.cast("long"))


def _clamp(value: Column, most: Column) -> Column:
    return F.greatest(F.lit(0), F.least(value, most))


def position(place: Column, target: Column, rank: Column, schedules: tuple = SCHEDULES) -> Column:
    """The training time, 0 to 1, at which a source has used ``place`` of its ``target`` words.

    A schedule rises or falls in a line from a to b; its integral a t + (b - a) t^2 / 2,
    divided by that at 1, is solved for t.
    """
    pick = (rank % len(schedules)).cast("int")
    a = F.get(F.array(*[F.lit(float(s[0])) for s in schedules]), pick)
    b = F.get(F.array(*[F.lit(float(s[1])) for s in schedules]), pick)
    need = F.when(target > 0, F.least(place / target, F.lit(1.0))).otherwise(0.0) * (a + b)
    slope = b - a
    return F.when(slope == 0, need / (2 * a)).otherwise((F.sqrt(F.greatest(a * a + slope * need, F.lit(0.0))) - a) / slope)


def curriculum(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """The rows of ``mix`` with the training position of each take, range-sorted by the first.

    ``first_position`` and ``second_position`` are when the document is read in the first and second pass of its source, null if
    that pass takes no word of it; rows that are never read come last. ``most`` may be up to two passes.
    """
    plan = mix(docs, share, most, weights)
    goal = F.round("target").cast("long")

    def at(number: int) -> Column:
        reached = F.col("place") + number * F.col("source_size")
        return F.when(_clamp(goal - reached, F.col("size")) > 0, position(reached, F.col("target"), F.col("rank"), schedules))

    placed = plan.withColumns({"first_position": at(0), "second_position": at(1)})
    order = [F.col("first_position").asc_nulls_last(), F.col("key")]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """The documents in training order, whole and as often as the mix takes them, to the nearest time.

    A document appears as often as ``taken / size`` rounds to; texts are not cut. Documents without words take no share and stay out. Columns stay as they are.
    Repeated rows (equal id and text) are taken equally often: as often as all of their words together are, from the least of
    their places on.
    """
    plan = mix(docs, share, most, weights)
    # Rows of one id and text have one source unless their sources differ, and then the least place tells it.
    first = F.min(F.struct("place", "source_size", "target", "rank")).alias("first")
    plan = plan.groupBy("doc_id", "key").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"), first)
    plan = plan.select("doc_id", "key", "size", "taken", "first.*")
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    plan = plan.withColumn("__times", times).where("__times > 0").select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__k"), "__times",
        *[F.col(c).alias(f"__{c}") for c in ("source_size", "place", "target", "rank")])
    keyed = docs.withColumn("__key", row_key())
    rows = keyed.join(plan, keyed["__key"].eqNullSafe(plan["__k"]) & keyed["doc_id"].eqNullSafe(plan["__id"]))
    rows = rows.withColumn("__pass", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
    at = position(F.col("__place") + F.col("__pass") * F.col("__source_size"), F.col("__target"), F.col("__rank"), schedules)
    return rows.withColumn("__position", at).repartitionByRange("__position", "__key").sortWithinPartitions("__position", "__key").select(*docs.columns)
