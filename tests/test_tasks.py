"""Queries that once were cut into far more tasks than their tables need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from turnloom.operators import intervals, metrics, passes
from turnloom.plans import queries as q
from turnloom.session import checkpointed

TENTH = "/root/testdata/sf0.1"


def most_tasks(spark, query: str) -> int:
    """Tasks of the largest stage of a query."""
    sc = spark.sparkContext
    sc.setJobGroup(query, query)
    try:
        q.queries()[query](spark, TENTH).write.format("noop").mode("overwrite").save()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    t = sc.statusTracker()
    infos = [t.getStageInfo(k) for j in t.getJobIdsForGroup(query) for k in t.getJobInfo(j).stageIds]
    return max(x.numTasks for x in infos if x is not None)


@pytest.mark.parametrize("query", ["pass_b_sequential", "eval_documents"])
def test_tasks_follow_the_tables(spark, query):
    assert 0 < most_tasks(spark, query) <= 32


def test_range_sort_after_a_join_takes_what_is_read_as_size(spark, tmp_path):
    spark.range(300_000).withColumn("x", F.rand(1)).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    both = t.join(t.select("id", F.col("x").alias("y")), "id", "left").where("id < 1000")
    for df in (both, checkpointed(both)):
        rows = intervals.range_sorted(df, "id", ["x"])
        assert rows.rdd.getNumPartitions() == 4 and rows.count() == 1000
    assert intervals._bytes_read(both) >= 4_000_000


def test_sequential_pass_takes_any_order_of_the_turns(spark):
    """Places with gaps that don't begin with 0, in no order, are as good as any others."""
    texts = ["甲。", "乙？", "丙。", *[f"第{i}句。" for i in range(3, 30)]]
    rows = [("m", 7 + 3 * i, i, x, 100 if i == 4 else 900, False, None) for i, x in enumerate(texts)]
    df = spark.createDataFrame([*rows[::-1], (None, 0, 99, "无？", 900, False, None)], "meeting_id string, pos int, turn_id bigint, text string, dur_ms bigint, overlap boolean, moss string")
    got = {r.turn_id: r.new_text for r in passes.sequential_texts(df, q.cascading_reply).collect()}
    assert got == {0: "甲。", 1: "乙；", **{i: texts[i] if i == 4 else texts[i].replace("。", "；") for i in range(2, 30)}}


def test_aligned_documents_are_rated_as_joined_ones(spark):
    rows = [("m", 0, "abcd", "abcd"), ("m", 1, "abcd", "abxx"), ("m", 2, None, "y"), ("m", 3, "，", ""), ("m", 4, "zz", None), ("n", 0, "q", None), ("o", 0, None, ""), (None, 0, "q", "q")]
    t = spark.createDataFrame(rows, "meeting_id string, pos int, ref string, hyp string")
    doc = lambda c: t.where(f"meeting_id is not null and ('{c}' = 'ref' or hyp is not null)").select("meeting_id", "pos", F.col(c).alias("text"))
    for readings in (False, True):
        got, want = metrics.aligned_report(t.select("meeting_id", "ref", "hyp"), readings), metrics.document_report(doc("ref"), doc("hyp"), readings)
        assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.meeting_id: (r.n_turns, r.n_hyp, r.n_ref, r.mean_cer, r.corpus_cer) for r in metrics.aligned_report(t.drop("pos")).collect()} == {"m": (4, 4, 5, 0.375, 0.25), "n": (0, 0, 1, 0.0, 0.0), "o": (1, 1, 1, 0.0, 0.0)}
