"""Personal data in column metadata: tagging, public access, compliance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import day, ratio, steady_round

# The words that mark a column as personal, in the order that decides its type.
PII_WORDS = ["email", "phone", "ssn", "dob", "address", "name", "credit", "tax", "passport"]

TABLE = ["catalog_name", "schema_name", "table_name"]
COLUMN = [*TABLE, "column_name"]


def tag_pii(columns: DataFrame) -> DataFrame:
    """``is_pii`` by a word anywhere in name or comment, so "filename" and "syntax" count too."""
    words = "|".join(PII_WORDS)
    hit = F.lower("column_name").rlike(words) | F.lower(F.coalesce("comment", F.lit(""))).rlike(words)
    return columns.withColumn("is_pii", F.when(hit, "Yes").otherwise("No"))


def _pii(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("is_pii") == "Yes")


def pii_by_schema(tagged: DataFrame) -> DataFrame:
    return _pii(tagged).groupBy("schema_name").agg(F.count("*").alias("pii_column_count"))


def pii_type_distribution(tagged: DataFrame) -> DataFrame:
    """Personal columns per type; the first word found in the name decides."""
    name = F.lower("column_name")
    kind = F.coalesce(*[F.when(name.contains(w), F.lit(w)) for w in PII_WORDS], F.lit("other"))
    return _pii(tagged).groupBy(kind.alias("pii_type")).agg(F.count("*").alias("column_count"))


def pii_violations(tagged: DataFrame, privileges: DataFrame, distinct_grants: bool = True) -> DataFrame:
    """Personal columns of tables that everyone may read.

    Grants are reduced to one row per table first. With ``distinct_grants=False`` a violation
    also tells the number of public grants of its table, ``public_grants``. ``tagged`` may be a stream.
    """
    public = privileges.filter(F.lower("grantee") == "public").groupBy(*TABLE).agg(F.count("*").alias("public_grants"))
    found = _pii(tagged).join(public, TABLE).select(*COLUMN, F.lit("Public access to PII").alias("violation_type"), "public_grants")
    return found.drop("public_grants") if distinct_grants else found


def pii_kpis(tagged: DataFrame, violations: DataFrame) -> DataFrame:
    """One row over all scanned columns."""
    pii = F.col("is_pii") == "Yes"
    return tagged.join(violations.select(*COLUMN, "violation_type"), COLUMN, "left").agg(
        F.count_distinct("table_name").alias("total_tables_scanned"),
        F.count_distinct(F.when(pii, F.col("table_name"))).alias("tables_with_pii"),
        F.count_if(pii).alias("pii_columns"),
        F.count_distinct("schema_name").alias("total_schemas"),
        F.count("violation_type").alias("total_violations"),
    )


def violation_types(violations: DataFrame) -> DataFrame:
    return violations.groupBy("violation_type").agg(F.count("*").alias("total"))


def violation_trend(violations: DataFrame, as_of=None) -> DataFrame:
    return violation_types(violations).select(day(as_of).alias("snapshot_date"), "violation_type", "total")


def top_violating_tables(violations: DataFrame, n: int = 10) -> DataFrame:
    counts = violations.groupBy("table_name").agg(F.count("*").alias("violation_count"))
    return counts.orderBy(F.col("violation_count").desc(), "table_name").limit(n)


def schema_compliance(tagged: DataFrame, violations: DataFrame) -> DataFrame:
    """Share of personal columns without a violation, per schema."""
    hits = violations.select(*COLUMN, F.lit(1).alias("_hit"))
    counted = _pii(tagged).join(hits, COLUMN, "left").groupBy("schema_name").agg(
        F.count("*").alias("total_pii_columns"), F.count("_hit").alias("violating_columns")
    )
    rate = steady_round(100 * (1 - ratio(F.col("violating_columns"), F.col("total_pii_columns"))))
    return counted.withColumn("compliance_rate", rate)
