"""Sources and sinks of whole runs: folders, stored units and records, documents with metas, clips."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.operators import metrics
from turnloom.sources import audio, batch, meetings, units


def _docs(spark, *raws):
    return spark.createDataFrame([(f"f{i}", r) for i, r in enumerate(raws)], "path string, raw string")


def test_trees(spark, tmp_path):
    for p in ("w/a/x.wav", "w/a/y.wav", "w/b/x.wav", "d/a/x.json", "d/b/z.json"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("{}")
    pairs, skips = batch.discover_trees(spark, str(tmp_path / "w"), str(tmp_path / "d"))
    assert [(r.dataset, r.stem) for r in pairs.collect()] == [("a", "x")] and pairs.first().document.endswith("d/a/x.json")
    assert {(r.dataset, r.stem, r.reason) for r in skips.collect()} == {("a", "y", "missing_mode_c"), ("b", "x", "missing_mode_c")}
    assert batch.discover_trees(spark, str(tmp_path / "w"), str(tmp_path / "d"), ["b"])[1].count() == 1
    with pytest.raises(FileNotFoundError):
        batch.discover_trees(spark, str(tmp_path / "none"), str(tmp_path / "d"))
    many = spark.createDataFrame([("b", "1"), ("a", "2"), ("a", "1")], "dataset string, stem string")
    assert [[tuple(r) for r in batch.first_pairs(many, n).collect()] for n in (2, 0, -1)] == [[("a", "1"), ("a", "2")], [], []] and batch.first_pairs(many, None).count() == 3


def test_bad_documents_are_rows(spark):
    docs = _docs(spark, '{"turns": [{"start": 0, "end": 1, "text": "a"}, 7]}', "[]", "3", '{"turns": 4}', "not json", '{"meta": {}}')
    turns, status = batch.guarded_turns(docs, F.col("path"))
    assert turns.count() == 1 and {r.path: r.error for r in status.collect()} == {"f0": None, "f1": None, "f2": "root is bigint", "f3": "turns is not a list", "f4": "not JSON", "f5": None}
    s = batch.run_summary(status, docs.limit(2)).first()
    assert (s.n_ok, s.n_error, s.n_skip, [e.path for e in s.errors]) == (3, 3, 2, ["f2", "f3", "f4"])
    with pytest.raises(Exception, match="not a turns document"):
        batch.guarded_turns(docs, F.col("path"), fail_fast=True)[0].collect()
    empty = batch.run_summary(status.limit(0), docs.limit(0)).first()
    assert (empty.n_ok, empty.n_error, empty.n_skip) == (0, 0, 0)


def test_units_round_trip(spark):
    rows = [("m", 0, "unit_0000", 0.0, 2.0, "s", [0, 1], 0.5, True, True, False, None, True), ("m", 1, "unit_0001", 3.0, 4.0, "s", [2], 0.0, False, False, True, "too_short", False)]
    u = spark.createDataFrame(rows, "meeting_id string, unit_seq int, unit_id string, start_s double, end_s double, speaker_id string, turn_indices array<int>, overlap_ratio double, contains_overlap boolean, heavy_overlap boolean, skip_asr boolean, skip_reason string, moss_merged boolean")
    out = units.units_json(u, spark.createDataFrame([("m", 5, "nan_or_inf"), ("n", 1, "end_le_start")], "meeting_id string, turn_index int, reason string"))
    docs = {r.meeting_id: json.loads(r.value) for r in out.collect()}
    assert docs["m"]["skipped_invalid_ts"] == [{"index": 5, "reason": "nan_or_inf"}] and docs["n"] == {"units": [], "skipped_invalid_ts": [{"index": 1, "reason": "end_le_start"}]}
    back = units.read_units(out.select(F.col("meeting_id").alias("path"), F.col("value").alias("raw")), F.col("path"))
    assert sorted(map(tuple, back.select(*u.columns).collect())) == sorted(map(tuple, u.collect()))
    bare = units.read_units(_docs(spark, '[{"unit_id": "a"}, 3]', "[]", "5"), F.col("path")).collect()
    assert [(r.unit_id, r.turn_indices, r.skip_asr) for r in bare] == [("a", [], False)]
    meet = spark.createDataFrame([("m",), ("k",)], "meeting_id string")
    got = units.reuse_or_build(back, meet, lambda m: m.withColumns({"unit_seq": F.lit(0), "unit_id": F.lit("new")}))
    assert {(r.meeting_id, r.unit_id) for r in got.collect()} == {("m", "unit_0000"), ("m", "unit_0001"), ("k", "new")}


def test_records_round_trip(spark):
    doc = {"meta": {}, "records": [{"unit_id": "a", "hyps": [{"model": "moss", "text": "old"}]}, {"unit_id": "b", "skipped": True, "reason": "too_short"}, {"unit_id": "a", "turn_indices": [1], "hyps": [{"model": "moss", "text": "x", "lid": "zh", "meta": {"k": "1"}}]}]}
    r = units.read_records(_docs(spark, json.dumps(doc)), F.col("path"))
    got = {x.unit_id: x for x in r.collect()}
    assert got["a"].hyps[0].text == "x" and got["a"].turn_indices == [1] and got["b"].skipped and got["b"].hyps == []
    out = json.loads(units.records_json(r, "asr", ["qwen", "moss"]).first().value)
    assert out["meta"] == {"stage": "asr", "models": ["moss", "qwen"], "count": 2} and [x["unit_id"] for x in out["records"]] == ["a", "b"]
    assert units.read_records(_docs(spark, "[]"), F.col("path")).count() == 0


def test_documents_keep_their_meta(spark):
    docs = _docs(spark, '{"meta": {"room": "4", "stage": "old"}, "turns": [{"start": 0, "end": 1, "text": "a", "speaker_id": "s"}]}')
    t = meetings.turns_of(docs, F.col("path"))
    d = json.loads(meetings.meeting_json(t, "final", meetings.metas_of(docs, F.col("path"))).first().value)
    assert d["meta"] == {"room": "4", "stage": "final"} and d["turns"][0]["text"] == "a"
    grid = t.withColumns({"unit_seq": F.lit(0), "unit_id": F.lit("unit_0000"), "turn_indices": F.array(F.lit(0))})
    m = json.loads(meetings.merged_json(grid, spark.createDataFrame([("f0", 7)], "meeting_id string, n_source_turns int"), "polish").first().value)
    assert m["meta"] == {"stage": "polish", "grid": "asr_units", "n_source_turns": "7"} and m["turns"][0]["turn_indices"] == [0]


def test_clips_are_used_again(spark):
    x = np.sin(np.arange(audio.RATE * 2)).astype(np.float32)
    rec = spark.createDataFrame([("m", bytearray(audio.encode(x, audio.RATE))), ("bad", bytearray(b"no wav"))], "meeting_id string, content binary")
    spans = spark.createDataFrame([("m", "a", 0.0, 0.5), ("m", "b", 0.5, 1.0), ("bad", "c", 0.0, 1.0), ("none", "d", 0.0, 1.0)], "meeting_id string, unit_id string, start_s double, end_s double")
    have = spark.createDataFrame([("m", "a", bytearray(b"kept")), ("m", "b", bytearray(b"")), ("m", "z", bytearray(b"gone"))], "meeting_id string, unit_id string, wav binary")
    got = {r.unit_id: r.wav for r in audio.clips(rec, spans, have).collect()}
    assert got["a"] == b"kept" and len(got["b"]) > 1000 and got["c"] is None and got["d"] is None and len(got) == 4
    assert len({r.unit_id for r in audio.clips(rec, spans).collect() if r.wav}) == 2


def test_long_turns_are_cut_at_quiet_moments(spark):
    x = np.ones(audio.RATE * 40, np.float32) * 0.5
    x[audio.RATE * 18 : audio.RATE * 19] = 0
    rec = spark.createDataFrame([("m", bytearray(audio.encode(x, audio.RATE)))], "meeting_id string, content binary")
    t = spark.createDataFrame([("m", 0, 0.0, 40.0, "long"), ("m", 1, 41.0, 42.0, "short"), ("n", 0, 0.0, 50.0, "no audio")], "meeting_id string, turn_index int, start_s double, end_s double, text string")
    got = sorted((r.meeting_id, r.turn_index, r.piece, round(r.start_s, 1), round(r.end_s, 1), r.text) for r in audio.split_turns(rec, t).collect())
    assert [g[:3] for g in got] == [("m", 0, 0), ("m", 0, 1), ("m", 1, 0), ("n", 0, 0), ("n", 0, 1)] and 18 <= got[0][4] <= 19 and got[3][4] == 25.0 and [g[5] for g in got] == ["long", "", "short", "no audio", ""]


def test_documents_are_compared_place_by_place(spark):
    f = "meeting_id string, pos int, text string"
    ref = spark.createDataFrame([("m", 0, "你好"), ("m", 1, "再见"), ("m", 2, "x"), ("n", 0, "a")], f)
    hyp = spark.createDataFrame([("m", 0, "你号"), ("m", 1, "再见。"), ("k", 0, "b")], f)
    got = {r.meeting_id: r for r in metrics.document_report(ref, hyp).collect()}
    assert (got["m"].n_turns, got["m"].n_hyp, got["m"].n_ref, got["m"].mean_cer, got["m"].corpus_cer) == (2, 2, 3, 0.25, 0.25)
    assert (got["n"].n_turns, got["n"].n_ref, got["k"].n_hyp, got["k"].mean_cer) == (0, 1, 1, 0.0)
    assert {r.meeting_id: r.mean_cer for r in metrics.document_report(ref, ref).collect()} == {"m": 0.0, "n": 0.0}


def test_merged_grid_goes_with_its_units(spark):
    from turnloom.operators import passes, textgrid

    u = spark.createDataFrame([(1, "m", "unit_0000", 0.0, 2.0, "s", [0, 1]), (2, "m", "unit_0001", 3.0, 4.0, "s", [9])], "unit_key bigint, meeting_id string, unit_id string, start_s double, end_s double, speaker_id string, turn_indices array<int>")
    t = spark.createDataFrame([("m", 0, "你好", 1.0, "a", 0.5), ("m", 1, "好的", 1.0, "b", 0.7)], "meeting_id string, turn_index int, text string, dur_s double, source string, confidence double")
    got = {r.unit_id: r for r in textgrid.merged_grid(u, t, whole=True).collect()}
    assert (got["unit_0000"].text, got["unit_0000"].source, got["unit_0000"].start_s, got["unit_0000"].turn_indices) == ("你好好的", "b", 0.0, [0, 1]) and got["unit_0001"].asr_status == "empty"
    grid = textgrid.merged_grid(u, t, whole=True).withColumn("unit_seq", F.substring("unit_id", 6, 4).cast("int"))
    doc = json.loads(meetings.merged_json(grid, t.groupBy("meeting_id").agg(F.count("*").cast("int").alias("n_source_turns")), "merged").first().value)
    assert [x["unit_id"] for x in doc["turns"]] == ["unit_0000", "unit_0001"] and doc["turns"][0]["end"] == 2.0
    terms = spark.createDataFrame([(0, "你好|尼好"), (1, "没有"), (2, "|x")], "pos int, term string")
    assert {tuple(r) for r in passes.recurring(t.select("text").unionByName(spark.createDataFrame([(None,)], "text string")), terms).collect()} == {("你好", True), ("没有", False)}
