"""Column-level reshaping: names, types, nested values, audit columns, schema union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.functions.values import moment


def normalize_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Spaces in column names become underscores, letters lower case unless told otherwise."""
    names = [c.replace(" ", "_") for c in df.columns]
    names = [c.lower() for c in names] if lower else names
    clash = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
    if clash:
        raise ValueError(f"column names collide: {clash}")
    return df.toDF(*names)


def with_audit(df: DataFrame, as_of=None, name: str = "audit_update_ts") -> DataFrame:
    return df.withColumn(name, moment(as_of))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema, in its order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def parse_json_rows(df: DataFrame, column: str, schema: T.StructType | str, keep=()) -> DataFrame:
    """JSON text as typed columns, next to the columns to keep."""
    return df.select(*keep, F.from_json(column, schema).alias("_parsed")).select(*keep, "_parsed.*")


# The fields of a postal document, spelled with spaces as its source does.
PLACES_SCHEMA = (
    "`post code` STRING, country STRING, `country abbreviation` STRING, places ARRAY<STRUCT<"
    "`place name`: STRING, longitude: STRING, latitude: STRING, state: STRING, `state abbreviation`: STRING>>"
)


def flatten_places(df: DataFrame, as_of=None) -> DataFrame:
    """Postal documents as one typed row per place; codes stay text, zeros included."""
    places = df.select(
        F.col("post code").cast("string").alias("post_code"),
        "country",
        F.col("country abbreviation").alias("country_abbreviation"),
        F.inline("places"),
    )
    return with_audit(
        places.select(
            "post_code",
            "country",
            "country_abbreviation",
            F.col("latitude").try_cast("double").alias("latitude"),
            F.col("longitude").try_cast("double").alias("longitude"),
            F.col("place name").alias("place_name"),
            "state",
            F.col("state abbreviation").alias("state_abbreviation"),
        ),
        as_of,
    )


def nested_to_variant(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as VARIANT; other columns stay as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_variant_object(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def quote_id_columns(df: DataFrame) -> DataFrame:
    """Identifier columns as text behind a quote, so that spreadsheets keep their digits."""
    return df.select(
        *[
            F.concat(F.lit("'"), F.col(c).cast("string")).alias(c) if "id" in c.lower() else F.col(c)
            for c in df.columns
        ]
    )


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Union by name over tables whose columns grew with time; missing values are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
