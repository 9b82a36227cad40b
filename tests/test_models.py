"""Models behind the boundary: attempts in rounds, an HTTP endpoint, transcribers, traces, prompts; and the whole pipeline with them."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from turnloom import inference
from turnloom.__main__ import main
from turnloom.operators import passes, prompts, validators
from turnloom.plans import pipeline

SMALL = "/root/testdata/sf0.001"
GOOD = '{"text": "好", "base_model": "moss", "edits": []}'


@pytest.fixture()
def endpoint():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, body, self.headers.get("Authorization")))
            prompt = body["messages"][-1]["content"]
            status, reply = (500, "") if "fail" in prompt else (200, "<think>…</think>```json\n" + GOOD + "\n```")
            out = json.dumps({"choices": [{"message": {"content": reply}}]}).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def test_attempts_go_on_over_what_is_open(spark, tmp_path):
    def load():
        asked = {}

        def model(ps):
            out = []
            for p in ps:
                n = asked[p] = asked.get(p, 0) + 1
                out.append(GOOD if p == "easy" else "no object" if p == "never" else ValueError("down"))
            return out

        return model

    jobs = spark.createDataFrame([(1, "easy", "x"), (2, "never", "x"), (3, "down", "x")], "unit_key bigint, prompt string, reply string")
    got = {r.unit_key: r.tries for r in inference.judged(jobs, "unit_key", load, validators.pass_a_error, str(tmp_path), retries=2).collect()}
    assert [len(got[k]) for k in (1, 2, 3)] == [1, 3, 3] and got[1][0].text == "好" and got[2] == got[3] == [None] * 3
    trace = spark.read.parquet(f"{tmp_path}/trace")
    assert {(r.key, r.n, r.ok) for r in trace.groupBy("key").agg(F.count("*").alias("n"), F.min("ok").alias("ok")).collect()} == {("1", 1, True), ("2", 3, True), ("3", 3, False)}
    assert trace.where("key = '3'").first().error == "down"
    assert inference.judged(jobs.limit(0), "unit_key", load, validators.pass_a_error, str(tmp_path / "e")).count() == 0


def test_long_texts_are_cut_in_the_log_only(spark, tmp_path):
    jobs = spark.createDataFrame([(1, "p" * 20_000)], "unit_key bigint, prompt string")
    inference.judged(jobs, "unit_key", lambda: lambda ps: ["r" * 17_000] * len(ps), validators.pass_a_error, str(tmp_path), retries=0)
    t = spark.read.parquet(f"{tmp_path}/trace").first()
    assert (len(t.user_text), t.user_chars, len(t.response), t.response_chars) == (16_000, 20_000, 16_000, 17_000)


def test_http_judge(endpoint):
    url, seen = endpoint
    model = inference.http_chat(url + "/", "m", "be brief", workers=3, key="k")()
    got = model(["a", "fail", "b"])
    assert got[0] == got[2] and GOOD in got[0] and isinstance(got[1], Exception)
    assert {(p, b["model"], len(b["messages"]), k) for p, b, k in seen} == {("/v1/chat/completions", "m", 2, "Bearer k")}


def test_transcribers(spark):
    clips = spark.createDataFrame([(1, b"aa"), (2, None), (3, b"bad"), (4, b"zh")], "unit_key bigint, wav binary")

    def load():
        return lambda xs: [ValueError("noise") if x == b"bad" else ("好", "zh") if x == b"zh" else f"{len(x)} bytes" for x in xs]

    got = {r.unit_key: (r.text, r.lid, r.error) for r in inference.transcribed(clips, "qwen", load).collect()}
    assert got == {1: ("2 bytes", None, None), 2: (None, None, "no audio"), 3: (None, None, "noise"), 4: ("好", "zh", None)}
    assert {r.text for r in inference.transcribed(clips, "mock", inference.mock_transcriber({b"aa": "hi"})).collect()} == {"hi", None, "3 bytes", "2 bytes"}


def test_prompts(spark):
    h = spark.createDataFrame([([("moss", "采用 {hotwords}"), ("qwen", None)], '["a"]', "n", True, None), (None, None, None, False, False)], "h array<struct<model:string,text:string>>, w string, n string, o boolean, v boolean")
    a, b = (r.p for r in h.select(prompts.judge_prompt(F.col("h"), F.col("w"), F.col("n"), F.col("o"), F.col("v")).alias("p")).collect())
    assert "- moss: 采用 {hotwords} (pinyin: cai yong" in a and "- qwen:  (pinyin: )" in a and 'Hotwords: ["a"]' in a and "Overlap: true\nHeavy overlap: false" in a and '{"text": "...", "base_model"' in a
    assert "Hypotheses:\n(none)\n" in b and "Hotwords: \n" in b
    p = h.select(prompts.polish_prompt(F.lit(3), F.lit("好"), F.col("h"), F.col("w"), F.col("n")).alias("p")).first().p
    assert "Turn 3: 好" in p and "pinyin" not in p


def test_pipeline_with_a_model(spark, tmp_path, endpoint):
    url, seen = endpoint
    work = str(tmp_path / "w")
    judge = pipeline.Judge(inference.http_chat(url, "m"), "m", retries=1, fallback=pipeline.Judge(inference.http_chat(url, "f"), "f", retries=0))
    assert pipeline.run(spark, SMALL, work, "asr", judge) == ["asr"]
    assert pipeline.run(spark, SMALL, work, "llm", judge) == ["pass_a", "pass_b"]
    assert pipeline.run(spark, SMALL, work, "polish", judge) == ["polish"]
    assert {r["pass"] for r in spark.read.parquet(f"{work}/trace").select("pass").distinct().collect()} >= {"A", "B", "polish"} and {b["model"] for _, b, _ in seen} == {"m"}
    a = spark.read.parquet(f"{work}/units_a").where("not skipped_llm")
    assert a.count() > 0 and a.where("text <> '好' and not forced_moss").count() == 0


def test_meetings_without_units_get_them_built(spark, tmp_path):
    t, w = str(tmp_path / "t"), str(tmp_path / "w")
    for name in ("turns", "hyps", "hotwords", "meetings", "documents", "llm_infer"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{t}/{name}.parquet")
    u = spark.read.parquet(f"{SMALL}/units.parquet")
    gone = u.groupBy("meeting_id").count().orderBy("count").first().meeting_id
    u.where(F.col("meeting_id") != gone).write.parquet(f"{t}/units.parquet")
    pipeline.run(spark, t, w, "asr")
    got = spark.read.parquet(f"{w}/units")
    assert got.where(F.col("meeting_id") == gone).count() > 0 and got.where("overlap_ratio < 0 or overlap_ratio > 1").where(F.col("meeting_id") == gone).count() == 0
    assert spark.read.parquet(f"{w}/skipped_invalid").columns == ["meeting_id", "turn_index", "reason"]


def test_command_line_backends(tmp_path, endpoint, spark):
    url, _ = endpoint
    with pytest.raises(SystemExit):
        main(["pipeline", SMALL, str(tmp_path), "--backend", "http"])
    with pytest.raises(SystemExit):
        main(["pipeline", SMALL, str(tmp_path), "--url", url])
    assert main(["pipeline", SMALL, str(tmp_path / "w"), "--stage", "asr", "--backend", "http", "--url", url, "--model", "m", "--fallback-model", "f"]) == 0


def test_fallback_judges_and_audits(spark):
    rows = spark.createDataFrame([(1, "m", "账，号", 900, False, None), (2, "m", "好", 900, False, None), (3, "m", "短", 10, False, None)], "turn_id bigint, meeting_id string, text string, dur_ms bigint, overlap boolean, moss string")
    bad = lambda h, o: F.struct(F.lit("x").alias("text"), F.lit(None).cast("string").alias("base_model"), F.array().cast(validators.EDIT).alias("edits"), o.alias("overlap")).cast(validators.REPLY)
    edit = lambda a, b: F.struct(F.lit(a).alias("span_asr"), F.lit(b).alias("span_out"), F.lit("punct").alias("tier"), *[F.lit(None).cast("string").alias(c) for c in ("kind", "anchor", "evidence")], F.lit(None).cast("int").alias("start_char"))
    good = lambda h, o: F.struct(F.lit("y").alias("text"), F.lit("draft").alias("base_model"), F.array(edit("，", ","), edit("没", "有")).cast(validators.EDIT).alias("edits"), o.alias("overlap")).cast(validators.REPLY)
    done = passes.turn_texts(rows, bad, fallback=good)
    assert {r.turn_id: (r.new_text, r.path, r.fallback_ok) for r in done.collect()} == {1: ("账,号", "llm", True), 2: ("好", None, True), 3: ("短", None, False)}
    assert sorted((r.turn_id, r.span_asr, r.span_out) for r in passes.turn_audits(done).collect()) == [(1, "没", "有"), (1, "，", ",")]
    assert {r.path for r in passes.turn_texts(rows, bad).collect()} == {"fallback", None}
