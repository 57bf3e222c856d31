"""Which part of a range a value lies in, for ranges cut at sorted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place_among(df: DataFrame, name: str, value: Column, cuts: Column, number: int, equal: bool = False) -> DataFrame:
    """Add how many of at most ``number`` sorted ``cuts``, an array, lie below a value, or at it too if ``equal``.

    A binary search, one column expression for each halving, so a row is compared about log2(number) times in
    generated code. A null value lies below all cuts.
    """
    df = df.withColumn(name, F.lit(0))
    step = 1 << max(0, number.bit_length() - 1) if number else 0
    while step:
        cut = F.get(cuts, F.col(name) + (step - 1))
        beyond = value >= cut if equal else value > cut
        df = df.withColumn(name, F.when(beyond, F.col(name) + step).otherwise(F.col(name)))
        step //= 2
    return df


def place(value: Column, cuts: Column, number: int) -> Column:
    """The same as one expression, for rows that are sorted next anyway: short to plan, though interpreted."""
    steps = [1 << i for i in reversed(range(max(0, number.bit_length())))]
    halve = lambda at, step: F.when(value > F.get(cuts, at + step - 1), at + step).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)).cast("array<int>"), F.lit(0), halve)
