"""The corpus pipeline, the registry, and a repository without this subpackage."""
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline as C
import duckdb
import pytest
from edges import SF001, edge_docs, no_docs  # noqa: F401

import __spark_entry__ as E
from gridspark.llm import decontam, queries
from gridspark.llm.common import stage

REPO = Path(C.__file__).parent
OPS = {1, 2, 3, 4, 5, 6, 7, 8, 9, 10}


def test_registry():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == sorted(OPS)
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_ids"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE[name])
    assert sorted(want.columns) == columns
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    assert got == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall(), key=key)


def write_tables(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no id at all but some words to read")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("which", ["edge_docs", "no_docs"])
def test_stages_on_edge_rows(spark, scratch, request, which):
    docs = request.getfixturevalue(which)
    write_tables(spark, docs, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for name, step in C.STAGES:
        out = stage(step(spark, docs, scratch), name)
        if name != "token_ids":
            assert out.columns == docs.columns
        if name == "benchmark_decontamination" and which == "edge_docs":
            assert out.filter("text like 'no id at all%'").count() == 0 < docs.filter("text like 'no id at all%'").count()
        docs = out
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert (docs.count() > 0) == (which == "edge_docs")


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = [docs]
    for name, step in C.STAGES[:3]:
        kept.append(stage(step(spark, kept[-1], SF001), name))
    n = [d.count() for d in kept]
    assert n[0] > n[1] > n[2] >= n[3] > 0.5 * n[0]
    index = decontam.build_index(spark.read.parquet(f"{SF001}/benchmark.parquet"), "item_id", "text")
    assert decontam.find_contaminated(kept[3], index, "doc_id", "text").count() == 0


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache", ".hypothesis"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [n for n in q if n.startswith('op') or n == 'pipeline'], len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout
    assert "[]" in said and int(said.split()[0]) > 30
