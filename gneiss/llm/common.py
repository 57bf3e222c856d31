"""What several operators share: the row key, written intermediates and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gneiss.session import scratch_path

#: A word, as the contracts define it: any run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Copies of the small side of a join on a possibly hot key.
SALTS = 8


def row_key() -> Column:
    """A number for the content of a document row; equal rows share it, null ids and texts included."""
    return F.xxhash64("doc_id", "text")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame below the shared checkpoint folder and read it back.

    Cuts the lineage, so that a lost executor costs no recomputation of what came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(df: DataFrame) -> int:
    """The number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted_join(rows: DataFrame, small: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Join on keys that may be hot in ``rows`` and are unique in ``small``.

    The rows of a key are spread over salts by the number ``spread``; the other side is repeated for each.
    """
    repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread_rows = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return spread_rows.join(repeated, [*keys, "__salt"]).drop("__salt")


def _with_least(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with the least node m among u and all its v; a hot u is spread over salts."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least, ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph, by alternating large and small stars.

    ``edges`` has two long columns. Returns (node, component) for every node of an edge; the
    component is its least node. Each round is written to the shared folder, and the rounds
    end when the edges no longer change; no edge reaches the driver.
    """
    a, b = edges.columns
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    current, before = stored(current, "edges"), None
    while True:
        mark = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
        before = mark
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        small = _with_least(large)
        links = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        current = stored(links.where("u <> v").distinct(), "small")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
