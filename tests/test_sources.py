import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.inference import api_base, run_model
from turnloom.sources import audio, hotwords, meetings
from turnloom.streaming.sessions import speaker_sessions


def test_meeting_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meta": {}, "turns": [{"start": 0, "end": 1.5, "speaker_id": "s", "text": "好"}, 7, {"start": 2, "end": 3, "speaker_id": "t"}]}), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps([{"start": 0, "end": 1, "speaker_id": "s", "text": "x", "confidence": 0.5}]), encoding="utf-8")
    t = meetings.turns_of(meetings.read_documents(spark, str(tmp_path)), F.regexp_extract("path", r"([^/]+)\.json$", 1))
    got = {(r.meeting_id, r.turn_index): (r.end_s, r.text, r.source, r.confidence) for r in t.collect()}
    assert got == {("a", 0): (1.5, "好", "fused", 1.0), ("a", 1): (3.0, "", "fused", 1.0), ("b", 0): (1.0, "x", "fused", 0.5)}
    meetings.write_meetings(t, "final", str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).where("meeting_id = 'b'").first().value)["turns"][0]["text"] == "x"


def test_other_roots_are_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"turns": 3}')
    with pytest.raises(Exception, match="not a turns document"):
        meetings.turns_of(meetings.read_documents(spark, str(tmp_path)), F.col("path")).collect()


@pytest.mark.parametrize("content", ["# c\n 甲|乙\n\n丙\n甲|乙\n", '["甲|乙", " ", "丙", "甲|乙"]', '{"hotwords": ["甲|乙", "#x", "丙"]}', '{"words": ["甲|乙", "丙"]}'])
def test_hotwords(spark, tmp_path, content):
    (tmp_path / "h").write_text(content, encoding="utf-8")
    assert [r.term for r in hotwords.read_hotwords(spark, str(tmp_path / "h")).orderBy("pos").collect()] == ["甲|乙", "丙"]


def test_audio_roundtrip_and_split(spark):
    rate = 16_000
    t = np.arange(2 * rate) / rate
    x = (0.5 * np.sin(2 * np.pi * 220 * t)).astype(np.float32)
    x[int(0.9 * rate) : int(1.1 * rate)] = 0
    back = audio.decode(audio.encode(x))
    assert len(back) == len(x) and np.abs(back - x).max() < 1e-3
    cuts = audio.split_spans(x, 0.0, 2.0, 1.0)
    assert 0.7 < cuts[0][1] < 1.3 and all(b - a <= 1.0 for a, b in cuts) and cuts[-1][1] == 2.0
    recs = spark.createDataFrame([("m", bytearray(audio.encode(x))), ("bad", bytearray(b"no"))], "meeting_id string, content binary")
    spans = spark.createDataFrame([("m", "u", 0.5, 1.0), ("bad", "u", 0.0, 1.0)], "meeting_id string, unit_id string, start_s double, end_s double")
    got = audio.crops(recs, spans).collect()
    assert len(got) == 1 and len(audio.decode(bytes(got[0].wav))) == 8000
    assert len(audio.decode(audio.silence(0.1))) == 1600


def test_audit_partitions_are_replaced(spark, tmp_path):
    p = str(tmp_path / "audits")
    meetings.replace_audits(spark.createDataFrame([("A", 1), ("B", 2)], "pass string, x int"), p)
    meetings.replace_audits(spark.createDataFrame([("B", 3)], "pass string, x int"), p)
    assert sorted((r["pass"], r.x) for r in spark.read.json(p).collect()) == [("A", 1), ("B", 3)]


def test_retries_go_in_full_batches(spark):
    def load():
        seen, sizes = {}, []

        def model(prompts):
            sizes.append(len(prompts))
            out = []
            for p in prompts:
                seen[p] = seen.get(p, 0) + 1
                out.append(ValueError("once") if seen[p] == 1 else f"{p}:{sizes}")
            return out

        return model

    jobs = spark.createDataFrame([(i, f"p{i}") for i in range(3)], "k bigint, prompt string").coalesce(1)
    got = run_model(jobs, "k", "prompt", load, batch=3).collect()
    assert {r.attempts for r in got} == {2} and all(r.reply.endswith("[3, 3]") for r in got)
    assert api_base("http://h:1/") == "http://h:1/v1" == api_base("http://h:1/v1")


def test_stream_of_sessions(spark, tmp_path):
    rows = [("m", "a", 0), ("m", "a", 3), ("m", "a", 20), ("m", "b", 1)]
    df = spark.createDataFrame(rows, "meeting_id string, speaker string, t int").withColumn("at", F.timestamp_seconds("t"))
    df.write.parquet(str(tmp_path / "in"))
    want = sorted((r.speaker, r.n_turns) for r in speaker_sessions(df).collect())
    q = speaker_sessions(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("s").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.speaker, r.n_turns) for r in spark.sql("select * from s").collect()) == want == [("a", 1), ("a", 2), ("b", 1)]
