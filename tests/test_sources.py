import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gneiss.plans import ingest
from gneiss.operators.cuts import place_among
from gneiss.sources import catalog, config, layout, readers, tables

RAW = {
    "source_table": "s", "source_incremental_column": "ts", "target": "t", "target_merge_columns": "k, j",
    "target_incremental_column": "ts",
}


def test_config_lists_everything_missing():
    assert config.TableConfig.from_dict(RAW).target_merge_columns == ("k", "j")
    with pytest.raises(config.ConfigError, match="target_merge_columns.*typo"):
        config.TableConfig.from_dict({**{k: v for k, v in RAW.items() if k != "target_merge_columns"}, "typo": 1})
    with pytest.raises(config.ConfigError, match="kind"):
        config.TableConfig.from_dict({**RAW, "kind": "ftp"})
    with pytest.raises(config.ConfigError, match="no configuration"):
        config.lookup({}, "orders")
    assert config.lookup({"orders": {k: v for k, v in RAW.items() if k != "source_table"}}, "orders").source_table == "orders"


def test_cluster_by_and_flags():
    assert config.check_cluster_by(["a"]) == ["a"]
    for bad in ([], "a", None, list("abcde")):
        with pytest.raises(config.ConfigError):
            config.check_cluster_by(bad)
    assert config.parse_flag("True") and not config.parse_flag(False)
    with pytest.raises(config.ConfigError):
        config.parse_flag("1 or __import__('os')")


def test_jdbc_options_are_all_or_nothing(spark):
    readers.jdbc_reader(spark, "jdbc:x:y", "id", 0, 100, 8, user="u")
    with pytest.raises(ValueError):
        readers.jdbc_reader(spark, "jdbc:x:y", partition_column="id")
    with pytest.raises(ValueError):
        readers.jdbc_reader(spark, "jdbc:x:y")
    readers.jdbc_reader(spark, "jdbc:x:y", single_task=True)


def table_config(tmp_path, **more):
    return config.TableConfig.from_dict({
        "source_table": str(tmp_path / "src"), "source_incremental_column": "ts", "target": str(tmp_path / "target"),
        "target_merge_columns": ["k"], "target_incremental_column": "ts", **more,
    })


def put(spark, tmp_path, data):
    spark.createDataFrame(data, "k INT, ts INT, v STRING").write.mode("overwrite").parquet(str(tmp_path / "src"))


def test_ingest_incremental_replay_and_full(spark, rows, tmp_path):
    cfg = table_config(tmp_path)
    put(spark, tmp_path, [(1, 1, "a"), (2, 2, "b")])
    assert rows(ingest.ingest(spark, cfg)) == [(1, 1, "a"), (2, 2, "b")]
    put(spark, tmp_path, [(1, 1, "ignored, older than the mark"), (2, 2, "B"), (3, 3, "c")])
    assert rows(ingest.ingest(spark, cfg, "True")) == [(1, 1, "a"), (2, 2, "B"), (3, 3, "c")]
    put(spark, tmp_path, [(1, 1, "replayed"), (3, 3, "c3")])
    assert rows(ingest.ingest(spark, cfg, cutoff="1", stage_path=str(tmp_path / "stage"))) == [(1, 1, "replayed"), (2, 2, "B"), (3, 3, "c3")]
    assert tables.fold_changes(spark, cfg.target, ["k"], spark.read.parquet(cfg.source_table).schema) == 1
    assert rows(ingest.target_rows(spark, cfg, spark.read.parquet(cfg.source_table).schema)) == [(1, 1, "replayed"), (2, 2, "B"), (3, 3, "c3")]
    put(spark, tmp_path, [(3, 9, "z"), (4, 10, "w")])
    assert rows(ingest.ingest(spark, cfg)) == [(1, 1, "replayed"), (2, 2, "B"), (3, 9, "z"), (4, 10, "w")]
    put(spark, tmp_path, [(5, 1, "x"), (6, 7, "y")])
    with pytest.raises(config.ConfigError):
        ingest.ingest(spark, cfg, False, cutoff="5")
    assert rows(ingest.ingest(spark, cfg, False, cutoff="5", allow_partial_overwrite=True)) == [(6, 7, "y")]
    assert rows(ingest.ingest(spark, table_config(tmp_path, cluster_by=["auto"]), False)) == [(5, 1, "x"), (6, 7, "y")]


def test_ingest_keeps_columns_the_source_has_lost(spark, rows, tmp_path):
    cfg, src = table_config(tmp_path), str(tmp_path / "src")
    put(spark, tmp_path, [(1, 1, "a"), (2, 2, "b")])
    ingest.ingest(spark, cfg)
    spark.createDataFrame([(2, 3), (3, 4)], "k INT, ts INT").write.mode("overwrite").parquet(src)
    assert rows(ingest.ingest(spark, cfg), "k", "ts", "v") == [(1, 1, "a"), (2, 3, "b"), (3, 4, None)]
    spark.createDataFrame([(4, 5, 1.5)], "k INT, ts INT, w DOUBLE").write.mode("overwrite").parquet(src)
    want = [(1, 1, "a", None), (2, 3, "b", None), (3, 4, None, None), (4, 5, None, 1.5)]
    assert rows(ingest.ingest(spark, cfg), "k", "ts", "v", "w") == want
    tables.fold_changes(spark, cfg.target, ["k"])
    assert rows(ingest.target_rows(spark, cfg), "k", "ts", "v", "w") == want


def test_an_interrupted_batch_is_loaded_again(spark, rows, tmp_path):
    cfg = table_config(tmp_path)
    put(spark, tmp_path, [(k, k, "a") for k in range(10)])
    # A load that stopped while its files were published: some rows, the newest among them, and no commit.
    spark.createDataFrame([(0, 0, "a"), (9, 9, "a")], "k INT, ts INT, v STRING").write.parquet(f"{cfg.target}/changes/batch_id=0")
    assert tables.last_batch(spark, cfg.target) == -1 and tables.high_water_mark(spark, cfg.target) is None
    assert len(rows(ingest.ingest(spark, cfg))) == 10


def test_the_mark_is_kept_with_the_commits(spark, rows, tmp_path):
    cfg = table_config(tmp_path)
    for data, mark in (([(1, 1, "a"), (2, 7, "b")], "7"), ([(3, 9, "c")], "9"), ([(4, 3, "late")], "9")):
        put(spark, tmp_path, data)
        ingest.ingest(spark, cfg)
        assert tables.high_water_mark(spark, cfg.target) == mark
    tables.fold_changes(spark, cfg.target, ["k"])
    assert tables.high_water_mark(spark, cfg.target) == "9"
    # Folded batches are not read again: the folder of one may go.
    import shutil
    shutil.rmtree(f"{cfg.target}/changes")
    assert rows(ingest.target_rows(spark, cfg)) == [(1, 1, "a"), (2, 7, "b"), (3, 9, "c")]


def test_ingest_transforms_and_rejects_duplicates(spark, rows, tmp_path):
    put(spark, tmp_path, [(1, 1, "a")])
    assert rows(ingest.ingest(spark, table_config(tmp_path), transform=lambda df: df.withColumn("v", F.upper("v")))) == [(1, 1, "A")]
    put(spark, tmp_path, [(1, 2, "a"), (1, 3, "b")])
    with pytest.raises(ValueError, match="several source rows"):
        ingest.ingest(spark, table_config(tmp_path))


def test_versions_become_visible_by_their_commit(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_version(spark, path) is None
    tables.write_full(spark.range(2), path)
    spark.range(9).write.parquet(f"{path}/version-2")  # an interrupted write
    assert rows(tables.read_version(spark, path)) == [(0,), (1,)]
    assert tables.write_full(spark.range(3), path) == 2
    assert tables.read_version(spark, path).count() == 3 and tables.read_version(spark, path, 1).count() == 2


def test_merged_table_sequence_deletes_and_replay(spark, rows, tmp_path):
    path, schema = str(tmp_path / "m"), spark.createDataFrame([], "k INT, seq INT, v STRING").schema

    def write(batch, data):
        tables.write_changes(spark.createDataFrame(data, "k INT, seq INT, v STRING, _deleted BOOLEAN"), path, batch)

    def merged():
        return rows(tables.read_merged(spark, path, "k", schema, "seq"))

    assert merged() == []
    write(0, [(1, 5, "a", False), (2, 5, "b", False)])
    write(1, [(1, 5, "equal", False), (2, 6, None, True)])
    assert merged() == [(1, 5, "a")]
    write(1, [(1, 5, "equal", False), (2, 6, None, True)])
    assert merged() == [(1, 5, "a")]
    tables.fold_changes(spark, path, "k", schema, "seq")
    write(2, [(2, 5, "late", False), (3, 1, "c", False)])
    assert merged() == [(1, 5, "a"), (3, 1, "c")]
    assert tables.last_batch(spark, path, schema) == 2


def test_schema_grows_and_is_kept(spark, tmp_path):
    data, kept = str(tmp_path / "d"), str(tmp_path / "s")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,x\n")
    first = readers.resolve_schema(spark, data, "csv", kept, header="true", inferSchema="true")
    (tmp_path / "d" / "1.csv").write_text("a,b,c\n1.5,x,2\n")
    second = readers.resolve_schema(spark, data, "csv", kept, header="true", inferSchema="true")
    assert first.simpleString() == "struct<a:int,b:string>" and second.simpleString() == "struct<a:int,b:string,c:int>"
    assert readers.stored_schema(spark, kept) == second
    os.utime(tmp_path / "d" / "1.csv", (0, 0))  # nothing new since the last look
    assert readers.resolve_schema(spark, data, "csv", kept, header="true", inferSchema="true") == second
    with pytest.raises(AnalysisException):
        readers.resolve_schema(spark, str(tmp_path / "none"), "csv", str(tmp_path / "other"))


def test_csv_files_are_read_by_their_own_headers(spark, rows, tmp_path):
    data, kept = tmp_path / "d", str(tmp_path / "s")
    data.mkdir()
    (data / "1.csv").write_text("a,b\n1,x\n")
    (data / "2.csv").write_text("a,c,b\n2,77,y\n")
    (data / "3.csv").write_text("b,d\nz,1.5\n")
    (data / "4.csv").write_text("")
    schema = readers.resolve_schema(spark, str(data), "csv", kept, header="true", inferSchema="true")
    assert {f.name: f.dataType.simpleString() for f in schema} == {"a": "int", "b": "string", "c": "int", "d": "double"}
    got = readers.read_csv_by_header(spark, str(data), schema)
    assert rows(got, "a", "b", "c", "d", "file_name") == [
        (1, "x", None, None, "1.csv"), (2, "y", 77, None, "2.csv"), (None, "z", None, 1.5, "3.csv")]


def test_files_and_layout(spark, rows, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    spark.range(100).repartition(10).write.parquet(small)
    size = tables.stored_bytes(spark, small)
    tables.compact(spark, small, packed, ["id"], size // 2 + 1)
    assert readers.list_files(spark, packed, "*.parquet").count() == 2 and spark.read.parquet(packed).count() == 100
    assert (tables.file_count(0), tables.file_count(10, 10), tables.file_count(11, 10)) == (1, 1, 2)
    tables.write_clustered(spark.range(100), packed, ["auto"], ["id"], files=3)
    spans = readers.with_file_metadata(spark.read.parquet(packed)).groupBy("file_name").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    edges = sorted((r["a"], r["b"]) for r in spans.collect())
    assert len(edges) == 3 and all(x[1] < y[0] for x, y in zip(edges, edges[1:]))
    tables.write_append(spark.range(1), packed)
    assert spark.read.parquet(packed).count() == 101
    tables.export_csv(spark.range(2), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    view = tables.materialize(spark.sql("SELECT DATE '2024-01-01' AS summary_date"), str(tmp_path / "view"))
    assert tables.todays_rows(view, "2024-01-01").count() == 1 and tables.todays_rows(view, "2024-01-02").count() == 0


def test_catalog_scans(spark, rows, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS meta")
    spark.sql(f"CREATE TABLE IF NOT EXISTS meta.people (email STRING COMMENT 'mail', n INT) USING parquet LOCATION '{tmp_path}/people'")
    try:
        assert rows(catalog.columns_metadata(spark, ["meta"]), "schema_name", "table_name", "column_name", "data_type", "comment") == [
            ("meta", "people", "email", "string", "mail"), ("meta", "people", "n", "int", None),
        ]
        found = catalog.table_inventory(spark, "meta").collect()
        assert [(r.tableName, r.provider) for r in found] == [("people", "parquet")] and found[0].location.endswith("/people")
    finally:
        spark.sql("DROP DATABASE meta CASCADE")


def test_read_source_kinds(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src"))
    assert readers.read_source(spark, table_config(tmp_path)).count() == 3
    spark.range(4).createOrReplaceTempView("numbers")
    assert readers.read_source(spark, table_config(tmp_path, kind="table", source_table="numbers")).count() == 4
    by_format = table_config(tmp_path, kind="format", options={"format": "parquet", "path": str(tmp_path / "src")})
    assert readers.read_source(spark, by_format).count() == 3


def test_small_batches_leave_the_stored_version_in_place(spark, plan, tmp_path):
    path, schema = str(tmp_path / "m"), spark.createDataFrame([], "k INT, seq INT").schema
    tables.write_full(spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("seq"), F.lit(False).alias("_deleted")), path)
    tables.write_changes(spark.createDataFrame([(1, 2), (2000, None)], "k INT, seq INT"), path, 0)
    merged = tables.read_merged(spark, path, "k", schema, "seq")
    assert merged.count() == 1001 and merged.filter("seq = 2").count() == 1
    final = tables.read_merged(spark, path, "k", schema, "seq")
    final.collect()
    text = plan(final)
    assert "SortMergeJoin" not in text.split("Initial Plan")[0]


def test_rows_without_a_key_are_all_kept(spark, rows, tmp_path):
    path, schema = str(tmp_path / "m"), spark.createDataFrame([], "k INT, seq INT").schema
    for batch in range(2):
        tables.write_changes(spark.createDataFrame([(None, batch), (1, None if batch == 0 else 5)], "k INT, seq INT"), path, batch)
        tables.fold_changes(spark, path, "k", schema, "seq")
    assert rows(tables.read_merged(spark, path, "k", schema, "seq")) == [(1, 5), (None, 0), (None, 1)]


def test_z_order_narrows_both_columns(spark, tmp_path):
    df = spark.range(10_000).select(
        (F.col("id") % 100).alias("a"), F.timestamp_seconds(F.floor(F.col("id") / 100)).alias("b"), F.lit("x").alias("c")
    )
    tables.zordered(df, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    files = readers.with_file_metadata(spark.read.parquet(str(tmp_path / "z"))).groupBy("file_name").agg(
        (F.max("a") - F.min("a")).alias("da"), (F.max(F.unix_timestamp("b")) - F.min(F.unix_timestamp("b"))).alias("db"), F.count("*").alias("n")
    ).collect()
    assert sum(f.n for f in files) == 10_000 and len(files) == 16
    assert sum(f.da for f in files) / 16 < 50 and sum(f.db for f in files) / 16 < 50
    with pytest.raises(ValueError):
        tables.zordered(df, ["a", "missing"], 2)
    with pytest.raises(ValueError):
        tables.zordered(df.withColumn("m", F.create_map("c", "a")), ["a", "m"], 2)
    assert tables.zordered(df.limit(0), ["a", "b"], 2).count() == 0


def test_z_order_over_text_and_time_spares_files(spark, tmp_path):
    df = spark.range(20_000).select(
        F.format_string("%05d", F.xxhash64("id") % 300).alias("post_code"), F.date_format(F.timestamp_seconds(F.xxhash64("id", F.lit(1)) % 2_000_000), "yyyy-MM-dd'T'HH").alias("startTime"),
        F.timestamp_seconds(F.xxhash64("id", F.lit(2)) % 5_000_000).alias("at"))
    df.repartition(32).write.parquet(str(tmp_path / "before"))
    keys = ["post_code", "startTime", "at"]
    tables.write_optimized(spark.read.parquet(str(tmp_path / "before")), str(tmp_path / "after"), keys, files=32)
    assert spark.read.parquet(str(tmp_path / "after")).exceptAll(df).count() == 0 and spark.read.parquet(str(tmp_path / "after")).count() == 20_000
    for column in keys:
        low, high = spark.read.parquet(str(tmp_path / "before")).orderBy(column).limit(1200).agg(F.min(column), F.max(column)).first()
        assert layout.files_read(spark, str(tmp_path / "before"), column, low, high) == (32, 32)
        hit, files = layout.files_read(spark, str(tmp_path / "after"), column, low, high)
        assert files == 32 and hit <= 20, (column, hit)


def test_a_frequent_key_is_spread_over_files(spark, tmp_path):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                   F.when(F.col("id") % 5 > 0, float("nan")).otherwise(F.col("id") / 7).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"), "id")
    sizes = [r["count"] for r in tables.zordered(df, ["k"], 12).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2.5 * 9_000 / 12
    laid = tables.zordered(df, ["k", "x", "n"], 8)
    assert laid.count() == 9_000 and laid.columns == df.columns


def test_place_among(spark):
    df = spark.createDataFrame([("a",), ("b",), ("bb",), ("z",), (None,)], "v STRING")
    for cuts in ([], ["b"], ["b", "b", "c"], list("bcdefgh")):
        listed = F.array(*map(F.lit, cuts)).cast("array<string>")
        for equal in (False, True):
            got = {r.v: r.n for r in place_among(df, "n", F.col("v"), listed, len(cuts), equal).collect()}
            assert got == {v: 0 if v is None else sum(c <= v if equal else c < v for c in cuts) for v in got}
