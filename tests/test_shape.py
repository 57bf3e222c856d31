import pytest
from pyspark.sql import types as T

from gneiss.functions.values import byte_count
from gneiss.operators import shape


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], "`First Name` INT, Year INT")
    assert shape.normalize_names(df).columns == ["first_name", "year"]
    assert shape.normalize_names(df, lower=False).columns == ["First_Name", "Year"]
    with pytest.raises(ValueError, match="collide"):
        shape.normalize_names(spark.createDataFrame([(1, 2)], "`a b` INT, a_b INT"))


def test_flatten_places_keeps_zeros_and_bad_numbers(spark, rows):
    doc = ('{"post code": "00501", "country": "United States", "country abbreviation": "US", "places": ['
           '{"place name": "Holtsville", "longitude": "-73.05", "latitude": "40.81", "state": "New York", "state abbreviation": "NY"},'
           '{"place name": "Elsewhere", "longitude": "x", "latitude": null, "state": "New York", "state abbreviation": "NY"}]}')
    landed = spark.createDataFrame([(doc,), ('{"post code": "1", "places": []}',)], "d STRING")
    flat = shape.flatten_places(shape.parse_json_rows(landed, "d", shape.PLACES_SCHEMA), "2024-01-01")
    assert rows(flat.drop("audit_update_ts")) == [
        ("00501", "United States", "US", 40.81, -73.05, "Holtsville", "New York", "NY"),
        ("00501", "United States", "US", None, None, "Elsewhere", "New York", "NY"),
    ]


def test_conform_orders_and_casts(spark):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    out = shape.conform(spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT"), schema)
    assert [(f.name, f.dataType) for f in out.schema] == [("b", T.StringType()), ("a", T.LongType())]


def test_nested_to_variant(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 1) AS s, array(1) AS l, map('k', 1) AS m")
    kinds = [f.dataType.typeName() for f in shape.nested_to_variant(df).schema]
    assert kinds == ["integer", "variant", "variant", "variant"]


def test_quote_id_columns_keeps_null(spark, rows):
    df = spark.createDataFrame([(7, "x"), (None, "y")], "job_id INT, name STRING")
    assert rows(shape.quote_id_columns(df)) == [("'7", "x"), (None, "y")]


def test_evolve_union(spark, rows):
    old, new = spark.createDataFrame([(1,)], "a INT"), spark.createDataFrame([("x", 2)], "b STRING, a INT")
    assert rows(shape.evolve_union(old, new)) == [(1, None), (2, "x")]


def test_byte_count():
    assert [byte_count(s) for s in ("100k", "2mb", "10g", "77", 5, None)] == [102400, 2097152, 10737418240, 77, 5, None]
    for bad in ("", "mb", "2x", "1.5mb"):
        with pytest.raises(ValueError):
            byte_count(bad)
