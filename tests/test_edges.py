"""Every registered query over empty tables, and over tables with null rows, repeats, long texts and extra columns."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__

TABLES = ["meetings", "turns", "units", "hyps", "llm_infer", "hotwords", "eval_items", "documents"]
SMALL = "/root/testdata/sf0.001"
CLASH = ["entity", "start_ms", "end_ms", "run", "part", "k", "h", "pos", "slot", "x", "r", "rank", "dirt", "dur_ms", "grp", "key", "rn"]


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("dirty"))
    for t in TABLES:
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        nulls = spark.createDataFrame([tuple(None for _ in df.columns)] * 3, df.schema)
        out = df.unionByName(nulls).unionByName(df.limit(5) if t not in ("documents", "meetings", "eval_items", "hotwords") else df.limit(0))
        if t in ("documents", "turns", "hyps"):
            key = {"documents": "doc_id", "turns": "turn_id", "hyps": "hyp_id"}[t]
            out = out.withColumn("text", F.when(F.col(key) == df.agg(F.max(key)).first()[0], F.repeat(F.concat(F.lit("很长的文字，see it again. "), F.coalesce("text", F.lit(""))), 400)).otherwise(F.col("text")))
        out.withColumns({c: F.lit("clash") for c in CLASH if c not in out.columns}).write.parquet(f"{d}/{t}.parquet")
    return d


NAMES = sorted(__spark_entry__.queries())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    rows = __spark_entry__.queries()[name](spark, empty).collect()
    assert len(rows) == (1 if name == "pass_stats_b" else 0)


@pytest.mark.parametrize("name", NAMES)
def test_dirty_tables(spark, dirty, name):
    assert __spark_entry__.queries()[name](spark, dirty).count() >= 0
