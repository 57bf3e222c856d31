from gneiss.plans import housekeeping, pii

COLUMNS = "catalog_name STRING, schema_name STRING, table_name STRING, column_name STRING, data_type STRING, comment STRING"


def tagged(spark):
    data = [("t1", "Email_address", None), ("t1", "filename", None), ("t1", "x", "holds a Phone"), ("t1", "n", ""), ("t2", "syntax", None), ("t2", "phone_email", None)]
    return pii.tag_pii(spark.createDataFrame([("c", "s", t, name, "STRING", note) for t, name, note in data], COLUMNS))


def grants(spark, *data):
    return spark.createDataFrame([("c", "s", t, g) for t, g in data], "catalog_name STRING, schema_name STRING, table_name STRING, grantee STRING")


def test_tags_and_types(spark, rows):
    assert rows(tagged(spark), "column_name", "is_pii") == [
        ("Email_address", "Yes"), ("filename", "Yes"), ("n", "No"), ("phone_email", "Yes"), ("syntax", "Yes"), ("x", "Yes"),
    ]
    assert rows(pii.pii_type_distribution(tagged(spark))) == [("email", 2), ("name", 1), ("other", 1), ("tax", 1)]
    assert rows(pii.pii_by_schema(tagged(spark))) == [("s", 5)]


def test_violations_count_a_table_once(spark, rows):
    access = grants(spark, ("t1", "PUBLIC"), ("t1", "public"), ("t2", "analysts"))
    found = pii.pii_violations(tagged(spark), access)
    assert found.count() == 3 and {r.public_grants for r in pii.pii_violations(tagged(spark), access, distinct_grants=False).collect()} == {2}
    assert rows(pii.pii_kpis(tagged(spark), found)) == [(2, 2, 5, 1, 3)]
    assert rows(pii.schema_compliance(tagged(spark), found)) == [("s", 5, 3, 40.0)]
    assert rows(pii.top_violating_tables(found)) == [("t1", 3)]
    assert rows(pii.violation_trend(found, "2024-01-01"), "violation_type", "total") == rows(pii.violation_types(found))


def test_no_grants(spark, rows):
    found = pii.pii_violations(tagged(spark), grants(spark))
    assert rows(pii.pii_kpis(tagged(spark), found)) == [(2, 2, 5, 1, 0)]
    assert rows(pii.schema_compliance(tagged(spark), found)) == [("s", 5, 0, 100.0)]


def test_orphans_with_and_without_slash(spark, rows):
    files = spark.createDataFrame([("s3://b/a/1", 5), ("s3://b/a/2", 6), ("s3://b/lost/1", 7), ("s3://b/folder/", 0)], "path STRING, size BIGINT")
    tables = spark.createDataFrame([("a", "s3://b/a/"), ("view", None)], "tableName STRING, location STRING")
    assert rows(housekeeping.find_orphans(files, tables)) == [("s3://b/folder", 1, 0), ("s3://b/lost", 1, 7)]
    assert rows(housekeeping.table_locations(files, tables), "path_modified", "tableName") == [("s3://b/a", "a"), ("s3://b/folder", None), ("s3://b/lost", None)]


def test_nothing_below_a_location_is_an_orphan(spark, rows):
    paths = ["s3://b/a/date=1/x.parquet", "s3://b/a/_log/0.json", "s3://b/ab/x", "s3://b/lost/d=1/x", "s3://b/lost/d=2/x", "s3://b/deep/in/t/x", "s3://b/deep/y", "s3://c/x",
             "s3://b/a/inner/k=1/x", "dbfs:/m/t/x", "/local/t/p=1/x", "/local/u/x", "s3://b//twice/x"]
    files = spark.createDataFrame([(p, 1) for p in paths], "path STRING, size BIGINT")
    tables = spark.createDataFrame([("a", "s3://b/a/"), ("inner", "s3://b/a/inner"), ("t", "s3://b/deep/in/t"), ("m", "dbfs:/m/t"), ("l", "/local/t"), ("v", None)], "tableName STRING, location STRING")
    orphans = {r.path_modified for r in housekeeping.find_orphans(files, tables).collect()}
    assert orphans == {"s3://b/ab", "s3://b/lost/d=1", "s3://b/lost/d=2", "s3://b/deep", "s3://c", "/local/u", "s3://b//twice"}
    held = dict(rows(housekeeping.table_locations(files, tables), "path_modified", "tableName"))
    assert held["s3://b/a/date=1"] == "a" and held["s3://b/a/inner/k=1"] == "inner" and held["/local/t/p=1"] == "l" and held["s3://b/ab"] is None
    roots = {r.root: (r.whole, r.folders) for r in housekeeping.orphan_roots(files, tables).collect()}
    assert roots["s3://b/lost"] == (True, 2) and roots["s3://b/deep"] == (False, 1) and roots["s3://c"] == (True, 1) and roots["/local/u"] == (True, 1)
    assert not any(p.startswith(r + "/") for p in ("s3://b/a/date=1", "s3://b/deep/in/t") for r, (whole, _) in roots.items() if whole)


def test_a_listing_is_read_once(spark, tmp_path, plan):
    """Folders take their figures along, so neither orphans nor locations nor roots compute the listing again."""
    spark.createDataFrame([("s3://b/a/x", 1)], "path STRING, size BIGINT").write.parquet(f"{tmp_path}/files")
    files = spark.read.parquet(f"{tmp_path}/files")
    tables = spark.createDataFrame([("a", "s3://b/a/")], "tableName STRING, location STRING")
    for made in (housekeeping.find_orphans, housekeeping.table_locations, housekeeping.orphan_roots):
        assert plan(made(files, tables)).count("FileScan parquet") == 1


def test_folders_meet_locations_only_at_their_depths(spark, rows):
    places = spark.createDataFrame([("s3://b/a/b",), ("s3://b/c/d",)], "_place STRING")
    folders = spark.createDataFrame([("s3://b/a/b/c/d/e/f", 1, 1), ("s3://b", 2, 2), (None, 3, None), ("s3://b/c", 4, 4)], "path_modified STRING, files INT, bytes INT")
    found = housekeeping.innermost(folders, places, "level")
    assert rows(found) == sorted([("s3://b/a/b/c/d/e/f", 1, 1, 5), ("s3://b", 2, 2, None), (None, 3, None, None), ("s3://b/c", 4, 4, None)], key=repr)


def test_folder_with_double_slash_that_leads_to_a_table_stays(spark, rows):
    files = spark.createDataFrame([("s3://b//deep/x", 1), ("s3://b//lost/in/x", 1)], "path STRING, size BIGINT")
    tables = spark.createDataFrame([("t", "s3://b/deep/in/t")], "tableName STRING, location STRING")
    assert rows(housekeeping.orphan_roots(files, tables), "root", "whole") == [("s3://b//deep", False), ("s3://b/lost", True)]
