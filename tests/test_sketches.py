import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gneiss.operators import sketches


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(4)
    data = [(f"2024-01-{rng.randint(1, 12):02d}", rng.choice([None, *range(4000)]), f"v{rng.randint(0, 900)}") for _ in range(30_000)]
    return data, spark.createDataFrame(data, "day STRING, user INT, page STRING").withColumn("day", F.col("day").cast("date")).repartition(5)


@pytest.mark.parametrize("days", [1, 7])
def test_trailing_distinct_is_near_the_exact_count(visits, days):
    data, df = visits
    parts = [sketches.distinct_sketches(df.where(F.col("user") % 3 == k if k < 3 else F.col("user").isNull()), "day", {"users": "user", "pages": "page"}) for k in range(4)]
    stored = sketches.merged_sketches(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "day", ["users", "pages"])
    got = sketches.trailing_distinct(stored, "day", ["users", "pages"], days).collect()
    assert len(got) == 12
    for r in got:
        window = [x for x in data if 0 <= (r.day.day - int(x[0][-2:])) < days]
        for estimate, exact in ((r.users, len({x[1] for x in window} - {None})), (r.pages, len({x[2] for x in window}))):
            assert abs(estimate - exact) <= 3 * 1.04 / 2**7 * exact + 1


def test_days_without_rows_have_no_window(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-05", 2), ("2024-01-05", None)], "day STRING, user INT").withColumn("day", F.col("day").cast("date"))
    got = sketches.trailing_distinct(sketches.distinct_sketches(df, "day", {"users": "user"}), "day", ["users"], 7).collect()
    assert sorted((r.day.day, r.users) for r in got) == [(1, 1), (5, 2)]


@pytest.mark.parametrize("buckets", [4, 64, 1 << 16])
@pytest.mark.parametrize("share", [0.004, 0.05, 0.4])
def test_no_frequent_key_is_missed(spark, rows, buckets, share):
    rng = random.Random(share * buckets)
    data = [(rng.choice(["hot", "hot", None, f"w{rng.randint(0, 20)}", f"k{rng.randint(0, 3000)}", f"k{rng.randint(0, 3000)}"]),) for _ in range(6000)]
    df = spark.createDataFrame(data, "k STRING").repartition(4)
    want = {k: n for k, n in Counter(k for k, in data).items() if n > share * len(data)}
    halves = [sketches.frequency_table(df.where(c), "k", buckets) for c in ("k < 'k2' or k is null", "k >= 'k2'")]
    for table in (None, sketches.merged_frequencies(halves[0].union(halves[1]))):
        got = {r.key: r.record_count for r in sketches.heavy_hitters(df, "k", share, table, buckets).collect()}
        assert got == want
    assert sketches.frequency_table(df, "k", buckets).count() <= 3 * buckets


def test_share_is_checked_and_empty_is_empty(spark):
    df = spark.createDataFrame([], "k STRING")
    assert sketches.heavy_hitters(df, "k", 0.1).count() == 0
    with pytest.raises(ValueError):
        sketches.heavy_hitters(df, "k", 1.0)
