"""Queries that once did less than their whole job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from turnloom.operators import validators
from turnloom.plans import pipeline
from turnloom.plans import queries as q

SMALL = "/root/testdata/sf0.001"


def test_upsert_keeps_every_key(spark, tmp_path):
    keys = spark.read.parquet(f"{SMALL}/hyps.parquet").where("model <> '' and unit_key is not null").select("unit_key", "model").distinct()
    got = q.hyp_upsert(spark, SMALL)
    assert got.count() == keys.count() == got.join(keys, ["unit_key", "model"], "left_semi").count()
    old, new = datetime(2025, 1, 5), datetime(2025, 3, 1)
    rows = [("u1", "tern", "a", old), ("u1", "kestra", "b", None), ("u2", "tern", "c", old), ("u2", "tern", "d", new), ("u2", "moss", "e", old), ("u3", "", "f", new)]
    spark.createDataFrame(rows, "unit_key string, model string, text string, loaded_at timestamp").write.parquet(f"{tmp_path}/hyps.parquet")
    assert {tuple(r) for r in q.hyp_upsert(spark, str(tmp_path)).collect()} == {("u1", "tern", "a", False), ("u1", "kestra", "b", False), ("u2", "tern", "d", True), ("u2", "moss", "e", False)}


def test_polish_cites_every_anchor(spark, tmp_path):
    t, w = str(tmp_path / "t"), str(tmp_path / "w")
    texts = ["温度零", "温度一", "温度二", "温度三", "Linux好", "温度五", "温度六Redis", "温度七", *["好"] * 17, "Kafka", "温度末"]
    asked = {0: ("Windows", "hyp"), 1: ("Linux", "neighbor_draft"), 2: ("Linux", "meeting_draft"), 3: ("Python", "hotword"), 5: ("Oracle", "neighbor_draft"), 6: ("Redis", "neighbor_draft"), 7: ("Kafka", "meeting_draft"), 26: ("Linux", "neighbor_draft")}
    now = datetime(2025, 3, 1)
    units = [(i, "m", f"unit_{i:04d}", [i], now) for i in range(len(texts))] + [(99, "n", "unit_0000", [0], now)]
    spark.createDataFrame(units, "unit_key bigint, meeting_id string, unit_id string, turn_indices array<int>, loaded_at timestamp").write.parquet(f"{t}/units.parquet")
    spark.createDataFrame([(0, "Python", "派森")], "pos int, canon string, alt string").write.parquet(f"{t}/hotwords.parquet")
    final = [("m", i, x) for i, x in enumerate(texts)] + [("n", 0, "Oracle")]
    spark.createDataFrame(final, "meeting_id string, turn_index int, text string").selectExpr("*", "1.0D as dur_s", "'fused' as source", "1.0D as confidence").write.parquet(f"{w}/final")
    spark.createDataFrame([(0, "moss", "Windows零")], "unit_key bigint, model string, text string").write.parquet(f"{w}/hyps")

    def reply(text, evidence):
        edits = F.array().cast(validators.EDIT)
        for i, (out, anchor) in asked.items():
            e = F.array(F.struct(F.lit("温度").alias("span_asr"), F.lit(out).alias("span_out"), F.lit(None).cast("string").alias("tier"), F.lit("codeswitch").alias("kind"), F.lit(anchor).alias("anchor"), evidence.alias("evidence"), F.lit(None).cast("int").alias("start_char"))).cast(validators.EDIT)
            edits = F.when(text == texts[i], e).otherwise(edits)
        return F.struct(text.alias("text"), F.lit("draft").alias("base_model"), edits.alias("edits"), F.lit(False).alias("overlap")).cast(validators.REPLY)

    want = {i: texts[i].replace("温度", out) for i, (out, _) in asked.items() if i not in (5, 6, 7)}
    for judge in (lambda x: reply(x, F.lit("e")), lambda x, h, n, k: reply(x, F.concat_ws("/", h, n, k))):
        pipeline.polish(spark, t, w, judge)
        got = {r.unit_key: r for r in spark.read.parquet(f"{w}/polished").collect()}
        assert {k: r.text for k, r in got.items() if r.path == "llm"} == want and {k for k, r in got.items() if r.path == "fallback"} == {5, 6, 7}
    assert got[0].located[0].evidence == "/".join(["Windows零", " ".join(texts[1:21]), "Python|派森"])
    assert got[26].located[0].evidence == "/".join(["", " ".join(texts[:20]), "Python|派森"])
