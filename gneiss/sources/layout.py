"""Rows laid out along a Z curve over any number of columns of any ordered type.

Every column is cut into cells of about equal row counts; the interleaved bits of the cell numbers
are a row's place on the curve, and files are stretches of it. All cuts come from one bounded sample, so
that the rows are read twice only: for the sample, of the curve's columns, and to be written. The sample decides
which file a row lies in, and nothing else.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.operators.cuts import place_among

#: Bits of a cell's number; bits of a place on the curve; rows of the sample for each file, and in all.
CELL_BITS, CURVE_BITS = 6, 62
FILE_SAMPLE, MOST_SAMPLED = 64, 65536


def comparable(df: DataFrame, column: str) -> Column:
    """A column as a value that orders alike and that the driver holds exactly: times as numbers."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, T.BooleanType):
        return value.cast("int")
    if isinstance(kind, (T.NumericType, T.StringType, T.BinaryType)):
        return value
    raise ValueError(f"{column} has no order: {kind.simpleString()}")


def _even(values: list, number: int) -> list:
    """``number`` values that cut sorted ones into parts of about equal size."""
    return [values[(i * len(values)) // (number + 1)] for i in range(1, number + 1)] if values else []


def _rank(value):
    """Spark's order: NaN above all numbers."""
    return (isinstance(value, float) and math.isnan(value), value)


def _below(cuts: list, value) -> int:
    return 0 if value is None else bisect_left(cuts, _rank(value), key=_rank)


def interleaved(cells: list[int], bits: int) -> int:
    """The place on the curve: the bits of the cell numbers, those of the highest value first."""
    out = 0
    for bit in range(bits - 1, -1, -1):
        for cell in cells:
            out = out << 1 | (cell >> bit & 1)
    return out


def _interleaved(cells: list[Column], bits: int) -> Column:
    out = F.lit(0).cast("bigint")
    for i, cell in enumerate(cells):
        for bit in range(bits):
            place = bit * len(cells) + len(cells) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("bigint"), place))
    return out


def curve_layout(df: DataFrame, columns, files: int, cell_bits: int = CELL_BITS) -> DataFrame:
    """The rows in ``files`` partitions of about equal size, each a stretch of the curve and sorted along it.

    A place that holds more rows than a file, such as one frequent key, is spread over its share of files by
    a hash of the row. Nulls come first. An empty table stays empty.
    """
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing or not columns:
        raise ValueError(f"columns not in the data: {missing}" if missing else "at least one column is needed")
    bits = max(1, min(cell_bits, CURVE_BITS // len(columns)))
    values = [comparable(df, c) for c in columns]
    sample = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).orderBy(F.rand(7)).limit(min(MOST_SAMPLED, FILE_SAMPLE * files + 4096)).collect()
    cuts = [_even(sorted((r[i] for r in sample if r[i] is not None), key=_rank), (1 << bits) - 1) for i in range(len(columns))]
    places = sorted(interleaved([_below(c, v) for c, v in zip(cuts, r)], bits) for r in sample)
    edges = _even(places, files - 1)

    placed, cells = df, [f"_cell{i}" for i in range(len(columns))]
    for cell, value, own in zip(cells, values, cuts):
        placed = place_among(placed, cell, value, F.array(*map(F.lit, own)), len(own))
    placed = placed.withColumn("_place", _interleaved([F.col(c) for c in cells], bits)).drop(*cells)
    listed = F.array(*[F.lit(e).cast("bigint") for e in edges])
    placed = place_among(placed, "_first", F.col("_place"), listed, len(edges))
    placed = place_among(placed, "_last", F.col("_place"), listed, len(edges), equal=True)
    spread = F.pmod(F.xxhash64(*[c for c, k in df.dtypes if not k.startswith(("map", "variant"))]), F.col("_last") - F.col("_first") + 1)
    placed = placed.withColumn("_file", (F.col("_first") + spread).cast("int")).drop("_first", "_last")
    laid = placed.repartitionById(files, F.col("_file")).sortWithinPartitions("_place", *columns)
    return laid.drop("_place", "_file")


def files_read(spark: SparkSession, path: str, column: str, low, high) -> tuple[int, int]:
    """How many of a folder's files may hold values of a column in a range, by each file's least and greatest, and of how many."""
    rows = spark.read.parquet(path)
    ranges = rows.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("least"), F.max(column).alias("most"))
    hit = (F.col("least") <= F.lit(high)) & (F.col("most") >= F.lit(low))
    got = ranges.agg(F.count_if(hit).alias("hit"), F.count("*").alias("files")).first()
    return got["hit"], got["files"]
