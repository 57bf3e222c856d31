"""The pipeline over the smallest tables, its stages, components, and the list of queries."""

import random
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gneiss.llm import common
from gneiss.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_stages_work_on_what_their_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stored(stage(spark, before, str(SF)), name)
        assert after.columns == columns and [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
        assert after.join(before, "doc_id", "left_anti").count() == 0
        sizes[name], before = after.count(), after
    assert 0.5 * docs.count() < sizes["toxicity"] < docs.count() and sizes["line_dedup"] == sizes["toxicity"] > sizes["near_copies"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, str(SF))
    assert pieces.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "mixing", "packing"]


def test_stages_on_an_empty_table(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), str(SF)).count() == 0, name


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_a_search(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(i, i + 1) for i in range(2000, 2060)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        queue = [node] if node not in want else []
        while queue:
            at = queue.pop()
            if at not in want:
                want[at] = node
                queue += near[at]
    assert got == want


def test_columns_of_clashing_names_pass_all_stages(spark, odd):
    clashing = odd.withColumnsRenamed({"lang": "n_removed"}).selectExpr("*", "1 AS n_lines", "'x' AS `key`", "2 AS `group`", "'en' AS lang")
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, str(SF)), name)
        assert docs.columns == clashing.columns
    corpus_pipeline.STAGES[-1][1](spark, docs, str(SF)).collect()
