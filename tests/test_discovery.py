import json

from pyspark.sql import types as T

from gneiss.sources import discovery


def found(spark, *documents):
    return discovery.discover(spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in documents], "d STRING"), "d")


def test_types_of_paths(spark):
    schema = found(spark, {"a": 1, "b": {"c": "x", "d": None}, "e": [1, 2]}, {"a": 2.5, "b": {"f": True}, "e": []}, "not json", None, "{}")
    kinds = {".".join(p): t.simpleString() for p, t in discovery.paths(schema)}
    assert kinds["b.c"] == "string" and kinds["b.f"] == "boolean" and kinds["e"] == "array<bigint>" and kinds["b.d"] == "string"
    assert kinds["a"].startswith("decimal") or kinds["a"] == "double"


def test_text_without_objects_has_no_paths(spark):
    assert found(spark, None, "x", "3", "[1,2]") == T.StructType() and found(spark) == T.StructType()


def test_schema_grows_and_is_kept(spark, tmp_path):
    folder = str(tmp_path / "schema")
    one = discovery.evolve_schema(spark, folder, found(spark, {"a": 1, "x": {"y": 1}}))
    same = discovery.evolve_schema(spark, folder, found(spark, {"a": 5}))
    assert same == one and spark.read.json(folder).count() == 1
    grown = discovery.evolve_schema(spark, folder, found(spark, {"a": "text", "x": {"z": [{"q": 1.5}]}, "new": True}))
    kinds = {".".join(p): t.simpleString() for p, t in discovery.paths(grown)}
    assert kinds["a"] == "string" and kinds["x.y"] == "bigint" and kinds["x.z"].startswith("array<struct<q:") and kinds["new"] == "boolean"
    assert discovery.evolve_schema(spark, folder, T.StructType()) == grown and spark.read.json(folder).count() == 2


def test_typed_columns(spark, rows):
    documents = [{"a": 1, "x": {"y": 2}}, {"a": None, "x_y": "clash"}, {}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)] + [(9, None), (10, "{broken")], "id INT, d STRING")
    got = discovery.typed_columns(df, "d", discovery.discover(df, "d"))
    assert got.columns == ["id", "a", "x_y", "x_y_2"]
    assert rows(got) == sorted([(0, 1, 2, None), (1, None, None, "clash"), (2, None, None, None), (9, None, None, None), (10, None, None, None)], key=repr)


def test_widening():
    parse = T._parse_datatype_string
    for a, b, want in [("bigint", "double", "double"), ("decimal(3,1)", "decimal(5,4)", "decimal(6,4)"), ("bigint", "decimal(4,2)", "decimal(21,2)"), ("boolean", "bigint", "string"),
                       ("struct<a:bigint>", "struct<b:string>", "struct<a:bigint,b:string>"), ("array<bigint>", "array<double>", "array<double>"), ("struct<a:bigint>", "bigint", "string"),
                       ("decimal(38,0)", "decimal(38,30)", "double")]:
        assert discovery.widened(parse(a), parse(b)).simpleString() == want
