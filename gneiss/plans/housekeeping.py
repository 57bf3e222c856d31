"""Files that belong to no table.

A table owns its folder and everything below it: partition folders, its log, files of older versions.
So a folder is compared with the tables by all folders it lies in, never by its own name alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def folder_of(path: Column) -> Column:
    """The folder a file lies in, without a closing slash; an entry that ends in a slash is a folder itself."""
    above = F.when(_slashes(path) > 0, prefix(path, _slashes(path))).otherwise(path)
    return F.when(path.endswith("/"), F.rtrim(path, F.lit("/"))).otherwise(above)


def directories(files: DataFrame) -> DataFrame:
    """Files rolled up to the folder they lie in."""
    return files.groupBy(folder_of(F.col("path")).alias("path_modified")).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes")
    )


def _top(path: Column) -> Column:
    """Scheme and bucket, which are one, or what is before the first slash."""
    return F.regexp_extract(path, "^(?:[^:/]+:/+)?[^/]*", 0)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _scheme(path: Column) -> Column:
    """Whether a path begins with a scheme: its first colon is right before its first slash."""
    return (F.instr(path, ":") > 1) & (F.instr(path, "/") == F.instr(path, ":") + 1)


def _top_slashes(path: Column) -> Column:
    """The slashes of ``_top``; only unusual paths need the pattern."""
    after = F.substring(path, F.instr(path, ":") + 1, F.lit(3))
    return (F.when(~_scheme(path), 0).when(after == "///", _slashes(_top(path)))
            .when(after.startswith("//"), 2).otherwise(F.when(path.isNotNull(), 1)))


def normal(path: Column) -> Column:
    """A folder with single slashes between its parts, and none at the end; most are so already."""
    top = _top(path)
    below = F.substring(path, F.length(top) + 1, F.length(path))
    double = F.length(path) - F.length(F.replace(path, F.lit("//"), F.lit("")))
    bucket = _scheme(path) & (F.instr(path, "://") > 0) & (F.instr(path, "///") == 0)
    plain = ~path.endswith("/") & ((double == 0) | ((double == 2) & bucket))
    return F.when(plain, path).otherwise(F.concat(top, F.rtrim(F.regexp_replace(below, "/+", "/"), F.lit("/"))))


def levels(path: Column) -> Column:
    """Numbers of a normal folder's prefixes: the one of number n ends before the n-th slash. Scheme and bucket are the first."""
    return F.sequence(_top_slashes(path) + 1, _slashes(path) + 1)


def prefix(path: Column, level: Column) -> Column:
    return F.call_function("substring_index", path, F.lit("/"), level)


def prefixes(df: DataFrame, path: str, name: str) -> DataFrame:
    """Each row once for a folder and every folder it lies in, named ``name``."""
    listed = df.withColumn("_normal", normal(F.col(path))).select("*", F.explode(levels(F.col("_normal"))).alias("_level"))
    return listed.withColumn(name, prefix(F.col("_normal"), F.col("_level"))).drop("_normal", "_level")


def known_locations(tables: DataFrame) -> DataFrame:
    """Tables with a location, written without a closing slash."""
    known = tables.filter(F.col("location").isNotNull())
    return known.select(F.rtrim(F.col("location"), F.lit("/")).alias("_home"), "tableName", "location")


def innermost(folders: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Folders with the level, as ``name``, of the innermost of ``places`` (a column ``_place``, no repeats) that holds each, if any.

    Each folder meets places by equality, once for every folder above it that is as deep as some place, of which there
    are as many as its path is deep at most. Its figures go along, so it is neither computed nor joined again.
    """
    deep = places.agg(F.collect_set(_slashes(F.col("_place")) + 1).alias("deep")).scalar()
    wide = folders.withColumn("_normal", normal(F.col("path_modified"))).withColumn("_deep", deep)
    wide = wide.select(*folders.columns, "_normal", F.explode_outer(F.array_intersect(levels(F.col("_normal")), F.col("_deep"))).alias("_level"))
    # A folder too high for any place goes along under a name that no place has, of its own, so that they don't gather.
    place = F.when(F.col("_level").isNull(), F.concat("path_modified", F.lit("/"))).otherwise(prefix(F.col("_normal"), F.col("_level")))
    met = wide.withColumn("_place", place).drop("_normal").join(places.withColumn("_known", F.lit(True)), "_place", "left")
    return met.groupBy("path_modified").agg(
        *[F.max(c).alias(c) for c in folders.columns if c != "path_modified"], F.max(F.when(F.col("_known"), F.col("_level"))).alias(name))


def held(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Every folder with the level of the innermost location that holds it, as ``_home_level``."""
    places = known_locations(tables).select(F.col("_home").alias("_place")).distinct()
    return innermost(directories(files), places, "_home_level")


def table_locations(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Every folder with the table it is stored in, if any; of nested tables the innermost."""
    home = prefix(normal(F.col("path_modified")), F.col("_home_level"))
    # No location ends in a slash, so folders without one meet none and don't gather.
    placed = held(files, tables).withColumn("_home", F.coalesce(home, F.concat("path_modified", F.lit("/")))).drop("_home_level")
    return placed.join(known_locations(tables), "_home", "left").drop("_home")


def find_orphans(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Folders that lie in no table's location."""
    return held(files, tables).filter(F.col("_home_level").isNull()).drop("_home_level")


def orphan_roots(files: DataFrame, tables: DataFrame) -> DataFrame:
    """Orphans rolled up to the outermost folder that holds no table: what may be removed whole.

    Files beside a table, in a folder that leads to its location, are counted under that folder with
    ``whole`` false: the folder itself must stay.
    """
    leading = prefixes(known_locations(tables).select("_home"), "_home", "_place").select("_place").distinct()
    placed = innermost(find_orphans(files, tables), leading, "_kept").withColumn("_normal", normal(F.col("path_modified")))
    own, kept = levels(F.col("_normal")), F.coalesce("_kept", F.lit(0))
    placed = placed.withColumn("whole", F.array_max(own) > kept)
    # The first folder from outside that leads to no table.
    free = prefix(F.col("_normal"), F.greatest(F.get(own, F.lit(0)), kept + 1))
    root = F.when(F.col("whole"), free).otherwise(F.col("path_modified"))
    return placed.groupBy(root.alias("root"), "whole").agg(
        F.count("*").alias("folders"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
