"""The schema of JSON text, found from the text itself and grown from batch to batch.

Every batch is parsed once to VARIANT and its schema aggregated by Spark; the schema that is stored with the
table is widened by it, never narrowed. A path that first appears in a later batch so becomes a column then.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.sources.readers import read_if_any


def discover(df: DataFrame, column: str) -> T.StructType:
    """The schema of all JSON objects in a text column; text that isn't JSON counts as null.

    One aggregation with a partial step, of which the driver gets the result, a type.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("found")).first()["found"]
    return as_struct(found)


def as_struct(variant_schema: str | None) -> T.StructType:
    """A schema as Spark prints it for VARIANT as a type. Types that differ within a path become text."""
    if not variant_schema or not variant_schema.startswith("OBJECT<"):
        return T.StructType()
    plain = re.sub(r"\bVARIANT\b|\bVOID\b", "STRING", variant_schema.replace("OBJECT<", "STRUCT<"))
    return T._parse_datatype_string(plain)


_WIDTH = [T.BooleanType, T.LongType, T.DecimalType, T.DoubleType]


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: more fields, wider numbers, else text."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        own = [T.StructField(f.name, widened(f.dataType, other.pop(f.name)) if f.name in other else f.dataType) for f in a.fields]
        return T.StructType([*own, *[T.StructField(n, t) for n, t in other.items()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if {type(a), type(b)} == {T.LongType, T.DecimalType}:
        kind = a if isinstance(a, T.DecimalType) else b
        whole = max(19, kind.precision - kind.scale)
        return T.DecimalType(whole + kind.scale, kind.scale) if whole + kind.scale <= 38 else T.DoubleType()
    numbers = (T.LongType, T.DecimalType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    return T.StringType()


def evolve_schema(spark: SparkSession, folder: str, found: T.StructType) -> T.StructType:
    """The stored schema widened by a found one; what results is stored if it is new.

    Every version of the schema is a line of JSON of its own, written whole; the one with the greatest number counts.
    """
    stored = read_if_any(spark, "json", folder, "version BIGINT, schema STRING")
    last = None if stored is None else stored.orderBy(F.col("version").desc()).first()
    before = T.StructType.fromJson(json.loads(last["schema"])) if last else T.StructType()
    after = widened(before, found)
    if after != before or last is None:
        row = spark.createDataFrame([((last["version"] + 1) if last else 0, after.json())], "version BIGINT, schema STRING")
        row.coalesce(1).write.mode("append").json(folder)
    return after


def paths(schema: T.StructType, above: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """All paths of a schema down to values that are no objects, with their types."""
    out = []
    for field in schema.fields:
        here = (*above, field.name)
        out += paths(field.dataType, here) if isinstance(field.dataType, T.StructType) else [(here, field.dataType)]
    return out


def typed_columns(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Rows with a column for every path of the schema, named by it with underscores, in place of the text.

    A path a row lacks is null. If two paths give one name, the later one carries its number.
    """
    parsed = df.withColumn("_parsed", F.from_json(column, schema)) if schema.fields else df.withColumn("_parsed", F.lit(None))
    taken, columns = set(df.columns) - {column}, []
    for path, _ in paths(schema):
        name = plain = "_".join(path)
        number = 2
        while name in taken:
            name, number = f"{plain}_{number}", number + 1
        taken.add(name)
        value: Column = F.col("_parsed")
        for part in path:
            value = value.getField(part)
        columns.append(value.alias(name))
    return parsed.select(*[c for c in df.columns if c != column], *columns)
