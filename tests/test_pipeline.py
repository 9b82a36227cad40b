import pytest

from turnloom.plans import pipeline
from turnloom.sources.meetings import replace_audits
from turnloom.__main__ import main

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    work = str(tmp_path / "w")
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, SMALL, work, "pass_b")
    with pytest.raises(ValueError):
        pipeline.run(spark, SMALL, work, "nothing")
    assert pipeline.run(spark, SMALL, work) == ["asr", "pass_a", "pass_b", "polish", "stats"]
    draft, final = spark.read.parquet(f"{work}/draft"), spark.read.parquet(f"{work}/final")
    assert draft.count() == final.count() == 300
    assert {r.asr_status for r in final.select("asr_status").distinct().collect()} <= {"final", "empty"}
    before = {r["pass"]: r["n"] for r in spark.read.json(f"{work}/audits").groupBy("pass").count().withColumnRenamed("count", "n").collect()}
    pipeline.run(spark, SMALL, work, "pass_b")
    after = {r["pass"]: r["n"] for r in spark.read.json(f"{work}/audits").groupBy("pass").count().withColumnRenamed("count", "n").collect()}
    assert before == after and before["A"] > 0


def test_stats_merge(spark):
    s = "name string, n int"
    got = pipeline.merge_stats(spark.createDataFrame([("a", 1), ("b", 2)], s), spark.createDataFrame([("b", 3)], s)).collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 3)]


def test_audits_without_rows_change_nothing(spark, tmp_path):
    p = str(tmp_path / "a")
    replace_audits(spark.createDataFrame([("A", 1)], "pass string, x int"), p)
    replace_audits(spark.createDataFrame([], "pass string, x int"), p)
    assert spark.read.json(p).count() == 1


def test_command_line(spark, tmp_path):
    assert main(["batch_summary", SMALL, str(tmp_path / "o"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "o")).count() == 4
