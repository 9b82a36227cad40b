"""Core operators against fixtures and plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.functions import pinyin, text
from turnloom.operators import context, hyps, metrics, passes, replies, reports, sequences, textgrid, units, validators
from turnloom.session import current_rows


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in _types(cols).items()))
    return df.select(expr.alias("x")).first().x


def _types(cols):
    return {k: "array<string>" if isinstance(v, list) and (not v or isinstance(v[0], str)) else "array<double>" if isinstance(v, list) else "string" for k, v in cols.items()}


def test_current_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", None), (1, "b", 3), (None, "x", 9), (2, None, 1)], "k int, v string, loaded_at int")
    assert sorted(map(tuple, current_rows(df, ["k"], ["v"]).collect())) == [(1, "b"), (2, None)]
    assert current_rows(df.limit(0), ["k"], ["v"]).count() == 0


@pytest.mark.parametrize(
    ("label", "want"),
    [("speaker_3", "speaker_3"), ("Spk_03", "speaker_3"), ("S9", "speaker_9"), ("[speaker_0]", "speaker_0"), ("说话人12", "speaker_12"), ("发言人 4", "speaker_4"), ("SPK-7:", "speaker_7"), ("speaker_０", "speaker_0"), ("N/A", "unknown"), ("", "unknown"), (None, "unknown"), ("?", "unknown"), ("speaker", "unknown")],
)
def test_speaker_label(spark, label, want):
    assert spark.createDataFrame([(label,)], "c string").select(text.speaker_label(F.col("c")).alias("x")).first().x == want


def test_join_texts(spark):
    assert one(spark, textgrid.join_texts(F.col("p")), p=["嗯，你们", "欢", "嗯，主"]) == "嗯，你们。欢。嗯，主"
    assert one(spark, textgrid.join_texts(F.col("p")), p=["嗯。", " ", "主"]) == "嗯。主"
    assert one(spark, textgrid.join_texts(F.col("p")), p=["", "　"]) == ""


def test_stitch(spark):
    assert one(spark, textgrid.stitch_texts(F.col("p")), p=["以前那个温", "度的问题"]) == "以前那个温度的问题"
    assert one(spark, textgrid.stitch_texts(F.col("p")), p=["大家好", "大家好"]) == "大家好"
    assert one(spark, textgrid.stitch_texts(F.col("p")), p=["好的。", "今天好的，开始"]) == "今天好的，开始"
    assert one(spark, textgrid.stitch_texts(F.col("p")), p=["abcdxy", "xyefg"]) == "abcdxyefg"
    assert one(spark, textgrid.collapse_tandem(F.col("s")), s="一二三四一二三四") == "一二三四"
    assert one(spark, textgrid.collapse_tandem(F.col("s")), s="一二三一二三") == "一二三一二三"


def test_distribute(spark):
    d = lambda t, du: one(spark, textgrid.distribute_text(F.col("t"), F.col("d")), t=t, d=du)
    assert d("欢。。嗯，主", [1.0, 1.0]) == ["欢", "嗯，主"]
    got = d("abcdefghij", [1.0, 0.1])
    assert "".join(got) == "abcdefghij" and len(got[0]) == 9
    assert d("整句", [2.0]) == ["整句"]
    assert d("abcde", [1.0, 1.0]) == ["ab", "cde"]  # 2.5 rounds half to even


def test_metrics(spark):
    rows = [("你好世界", "你好，世界。"), ("单框架", "单方接"), ("", "x"), ("", ""), (None, None), ("ab", "abcdefgh")]
    got = [round(r.cer, 6) for r in metrics.cer_rows(spark.createDataFrame(rows, "ref string, hyp string")).collect()]
    assert got == [0.0, 0.666667, 1.0, 0.0, 0.0, 3.0]
    cp = metrics.cer_rows(spark.createDataFrame([("帐号", "账号")], "ref string, hyp string"), readings=True).first()
    assert (cp.cer, cp.cp_cer) == (0.5, 0.25)
    rep = metrics.cer_report(metrics.cer_rows(spark.createDataFrame(rows[:2], "ref string, hyp string"))).first()
    assert (rep.n, rep.corpus_cer) == (2, round(2 / 7, 9))


def test_edits_equal_a_plain_matrix(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(150):
        a = [rnd.choice("一二三四abc，。 ") for _ in range(rnd.randint(0, 40))]
        b = list(a)
        for _ in range(rnd.randint(0, 14)):
            k = rnd.randint(0, len(b))
            b[k : k + rnd.randint(0, 2)] = [rnd.choice("一二五x")] * rnd.randint(0, 2)
        rows.append(("".join(a), "".join(b)))

    def plain(a, b):
        a, b = ([c for c in x if c not in "，。 "] for x in (a, b))
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    got = metrics.cer_rows(spark.createDataFrame(rows, "ref string, hyp string")).collect()
    assert [r.edits for r in got] == [plain(r.ref, r.hyp) for r in got]


@pytest.mark.parametrize(("a", "b", "d"), [("产用", "采用", 1), ("单框架", "单方接", 2), ("奔至", "蹦字", 2), ("帐号", "账号", 0), ("爱情", "娃娃亲", 3), ("abc", "abd", 1), ("", "", 0)])
def test_readings(spark, a, b, d):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(pinyin.reading_distance(F.col("a"), F.col("b")).alias("x")).first().x == d
    assert df.select(pinyin.readings_equal(F.col("a"), F.col("b")).alias("x")).first().x == (d == 0)


def test_to_pinyin(spark):
    assert one(spark, pinyin.to_pinyin(F.col("s")), s="采用 ab") == "cai yong a b"


def _meeting(spark):
    rows = [(0, 0, 2000, "speaker_0"), (1, 500, 1500, "speaker_1"), (2, 3000, 5000, "speaker_0"), (3, 5200, 7000, "speaker_0"), (4, 8000, 8200, "speaker_2"), (5, 10_000, 12_000, "speaker_1")]
    return spark.createDataFrame([("m", i, i, s, e, w) for i, s, e, w in rows], "meeting_id string, turn_id bigint, turn_index int, start_ms bigint, end_ms bigint, speaker string")


def test_units_of_the_six_turn_meeting(spark):
    u = sorted(units.build_units(_meeting(spark)).collect(), key=lambda r: r.unit_seq)
    assert [(r.unit_id, r.turn_indices, r.start_ms, r.end_ms, r.skip_reason) for r in u] == [
        ("unit_0000", [0], 0, 2000, None), ("unit_0001", [1], 500, 1500, None), ("unit_0002", [2, 3], 3000, 7000, None), ("unit_0003", [4], 8000, 8200, "too_short"), ("unit_0004", [5], 10_000, 12_000, None)
    ]


def test_units_equal_a_loop(spark):
    rnd = random.Random(7)
    rows, t = [], 0
    for i in range(300):
        t = max(0, t + rnd.randint(-500, 4000))
        d = rnd.choice([200, 3000, 9000, 70_000])
        rows.append(("hot" if i % 3 else f"m{i % 5}", i, i, t, t + d, f"speaker_{rnd.randint(0, 1)}"))
        t += d // 2
    df = spark.createDataFrame(rows, "meeting_id string, turn_id bigint, turn_index int, start_ms bigint, end_ms bigint, speaker string")
    want = []
    for m in {r[0] for r in rows}:
        pieces = []
        for _, _, i, s, e, w in (r for r in rows if r[0] == m):
            n = 1
            while (e - s) / n > 30_000:
                n *= 2
            pieces += [(s + round((e - s) * k / n), s + round((e - s) * (k + 1) / n), i, w) for k in range(n)]
        cur = None
        for s, e, i, w in sorted(pieces):
            if cur and cur[3] == w and 0 <= s - cur[1] <= 5000 and e - cur[0] <= 30_000:
                cur = (cur[0], e, cur[2] + [i] * (cur[2][-1] != i), w)
            else:
                if cur:
                    want.append((m, cur[0], cur[1], cur[2]))
                cur = (s, e, [i], w)
        want.append((m, cur[0], cur[1], cur[2]))
    got = [(r.meeting_id, r.start_ms, r.end_ms, r.turn_indices) for r in units.build_units(df).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [1, 5])
def test_positions(spark, n):
    rows = [("a" if i % 4 else "b", i) for i in range(50)]
    got = sequences.row_positions(spark.createDataFrame(rows, "e string, o int"), "e", ["o"], "p", n).collect()
    for e in "ab":
        assert [r.p for r in sorted((r for r in got if r.e == e), key=lambda r: r.o)] == list(range(sum(x[0] == e for x in rows)))
    assert sequences.row_positions(spark.createDataFrame([], "e string, o int"), "e", ["o"], "p", n).count() == 0


def test_runs_cross_partitions(spark):
    rows = [("m", i, i // 10) for i in range(60)] + [("n", 100 + i, 5) for i in range(10)]
    df = spark.createDataFrame(rows, "e string, k bigint, v int")
    got = sequences.label_runs(df, "e", ["k"], "k", lambda a, b: a["v"].to_numpy(float) != b["v"].to_numpy(float), "run", 6).collect()
    assert {(r.e, r.v): r.run for r in got} == {("m", v): v * 10 for v in range(6)} | {("n", 5): 100}
    assert len(got) == 70


def test_invalid_reason(spark):
    rows = [(0.0, 1.0), (float("nan"), 1.0), (0.0, float("inf")), (2.0, 1.0), (0.0, 0.005), (None, 1.0)]
    got = [r.x for r in spark.createDataFrame(rows, "a double, b double").select(units.invalid_reason(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [None, "nan_or_inf", "nan_or_inf", "end_le_start", "too_short_invalid", "nan_or_inf"]


def test_leading_turns_stop_at_the_budget(spark):
    df = spark.createDataFrame([("m", i, "x" * n) for i, n in enumerate([10, 9000, 5, 5])], "meeting_id string, pos int, text string")
    got = {r.pos: (r.n_neighbors, r.last_pos) for r in context.leading_turns(df).collect()}
    assert got == {0: (1, 1), 1: (3, 3), 2: (1, 0), 3: (1, 0)}
    assert {r.n_neighbors for r in context.leading_turns(df, k=0).collect()} == {1}


def test_agreement_and_choice(spark):
    h = lambda *x: [(m, t) for m, t in x]
    rows = [(h(("firered", "你好世界"), ("moss", "你好，世界"), ("qwen", "你好世界。")), False), (h(("moss", "产用"), ("qwen", "采用")), True), (h(("firered", ""), ("moss", ""), ("qwen", "好")), True), (h(("moss", None),), False), ([], False)]
    df = spark.createDataFrame(rows, "hyps array<struct<model:string,text:string>>, o boolean")
    got = df.select(hyps.all_agree(F.col("hyps")).alias("a"), hyps.best_hyp(F.col("hyps"), F.col("o"))["model"].alias("b")).collect()
    assert [tuple(r) for r in got] == [(True, "firered"), (False, "moss"), (True, "qwen"), (True, "moss"), (True, None)]


def test_upsert(spark):
    s = "unit_key bigint, model string, text string, loaded_at int"
    got = hyps.upsert(spark.createDataFrame([(1, "qwen", "a", 1), (1, "moss", "b", 1), (1, "", "x", 1)], s), spark.createDataFrame([(1, "qwen", "c", 0)], s)).collect()
    assert sorted(map(tuple, got)) == [(1, "moss", "b", False), (1, "qwen", "c", True)]


def test_model_selection():
    assert hyps.check_models([]) == ("firered", "moss", "qwen") and hyps.check_models([" Moss "]) == ("moss",)
    with pytest.raises(ValueError):
        hyps.check_models(["whisper"])


def _edit(**k):
    return tuple(k.get(f) for f in ("span_asr", "span_out", "tier", "kind", "anchor", "evidence", "start_char"))


def _reply(spark, edits, text="x", base="moss"):
    return spark.createDataFrame([((text, base, edits, False),)], f"r {validators.REPLY}")


@pytest.mark.parametrize(
    ("edit", "error"),
    [
        (_edit(span_asr="模型", span_out="大语言模型", tier="C", anchor="hyp"), "span_local"),
        (_edit(span_asr="产用", span_out="采用", tier="B"), "Tier B requires"),
        (_edit(span_asr="帐号", span_out="账号", tier="B"), None),
        (_edit(span_asr="单方接", span_out="单框架", tier="C"), "Tier C requires anchor"),
        (_edit(span_asr="单方接", span_out="单框架", tier="C", anchor="hotword"), None),
        (_edit(span_asr="单方接", span_out="单框架", tier="C", anchor="world"), "bad Tier C anchor"),
        (_edit(span_asr="爱情", span_out="娃娃亲", tier="C", anchor="hyp"), "Tier C pinyin"),
        (_edit(span_asr="a", span_out="b", tier="Z"), "bad tier"),
        (_edit(span_asr="a", tier="A"), "edit missing"),
    ],
)
def test_pass_a_rules(spark, edit, error):
    got = _reply(spark, [edit]).select(validators.pass_a_error(F.col("r")).alias("e")).first().e
    assert got is None if error is None else got.startswith(error)


def test_pass_b_refuses_tier_a(spark):
    assert _reply(spark, [_edit(span_asr="a", span_out="b", tier="A")]).select(validators.pass_b_error(F.col("r")).alias("e")).first().e == "pass_b_rejects_tier_a"
    assert _reply(spark, [], text=None).select(validators.pass_b_error(F.col("r")).alias("e")).first().e == "missing text or base_model"


@pytest.mark.parametrize(
    ("edit", "error"),
    [
        (_edit(span_asr="二十", span_out="20", kind="itn"), "bad kind 'itn'"),
        (_edit(span_asr="3点", span_out="4点", kind="entity", anchor="hyp", evidence="e"), "number rewrite forbidden"),
        (_edit(span_asr="爱情", span_out="娃娃亲", kind="entity", anchor="neighbor_draft", evidence="e"), None),
        (_edit(span_asr="爱情", span_out="一个娃娃亲", kind="entity", anchor="neighbor_draft", evidence="e"), "cjk substitution exceeds ±2 character slack"),
        (_edit(span_asr="", span_out="x", kind="entity"), "insertions forbidden"),
        (_edit(span_asr="不在", span_out="在此", kind="entity"), "span_asr not in text"),
        (_edit(span_asr="爱情爱情", span_out="爱情", kind="entity"), "repeat collapse forbidden"),
        (_edit(span_asr="爱情", span_out="爱清", kind="punc"), "punc cannot change words"),
        (_edit(span_asr="爱情", span_out="爱情，", kind="punc"), None),
        (_edit(span_asr="gpu", span_out="GPU", kind="codeswitch"), None),
        (_edit(span_asr="gpu", span_out="cpu", kind="codeswitch"), "latin rewrite must keep the same letters"),
        (_edit(span_asr="温度", span_out="Windows", kind="codeswitch", anchor="hyp", evidence="e"), None),
        (_edit(span_asr="温度", span_out="Windows", kind="codeswitch", anchor="hyp"), "missing evidence"),
        (_edit(span_asr="温度", span_out="Windows", kind="codeswitch", anchor="world", evidence="e"), "bad/missing anchor 'world'"),
        (_edit(span_asr="温度", span_out="Linux", kind="codeswitch", anchor="hyp", evidence="e"), "span_out not found in hyp evidence"),
        (_edit(span_asr="gpu", span_out="gpu卡好", kind="codeswitch", anchor="hyp", evidence="e"), "added content forbidden"),
    ],
)
def test_polish_rules(spark, edit, error):
    text_ = "爱情爱情3点温度gpu"
    e = validators.polish_error(F.col("r"), F.lit(text_), F.lit("windows产品 hyp"), F.lit("他家娃娃亲 一个娃娃亲"), F.lit(""))
    assert _reply(spark, [edit]).select(e.alias("e")).first().e == error


def test_polish_apply(spark):
    s = "明天开会用gpu找张三风"
    edits = [_edit(span_asr="gpu", span_out="GPU", kind="codeswitch"), _edit(span_asr="张三风", span_out="张三丰", kind="entity"), _edit(span_asr="用gpu", span_out="x", kind="entity"), _edit(span_asr="没有", span_out="y", kind="entity")]
    df = _reply(spark, edits).withColumn("l", validators.locate_polish(F.lit(s), F.col("r.edits")))
    r = df.select("l", validators.apply_located(F.lit(s), F.col("l")).alias("t")).first()
    assert [(x.start_char, x.end_char) for x in r.l] == [(5, 8), (9, 12)] and r.t == "明天开会用GPU找张三丰"
    s = "用gpu还是gpu"
    df = _reply(spark, [_edit(span_asr="gpu", span_out="GPU", kind="codeswitch", start_char=6)]).withColumn("l", validators.locate_polish(F.lit(s), F.col("r.edits")))
    assert df.select(validators.apply_located(F.lit(s), F.col("l")).alias("t")).first().t == "用gpu还是GPU"


def test_apply_first(spark):
    edits = [_edit(span_asr="奔至", span_out="蹦字"), _edit(span_asr="无", span_out="x"), _edit(span_asr="", span_out="x")]
    assert _reply(spark, edits).select(validators.apply_first(F.lit("系统奔至了奔至"), F.col("r.edits")).alias("t")).first().t == "系统蹦字了奔至"


def test_json_in_replies():
    assert replies.split_reply('<think>a {"x"</think>\n```json\n{"a": "}"}\n```')[0] == '{"a": "}"}'
    assert replies.split_reply('So: {"a": {"b": 1}} end') == ('{"a": {"b": 1}}', "So:", None)
    assert replies.split_reply("none")[2] == replies.split_reply(None)[2] == "no JSON object"
    assert replies.split_reply('{"a": "\\"}')[0] is None


def test_pass_a_decisions(spark):
    h = "array<struct<model:string,text:string>>"
    rows = [(1, [("firered", "大家好。"), ("moss", "大家好")], False), (2, [("firered", "他们采用"), ("moss", "他们产用")], False), (3, [("qwen", "甲"), ("firered", "乙")], True), (4, [], True)]
    got = {r.unit_key: r for r in passes.unit_texts(spark.createDataFrame(rows, f"unit_key bigint, hyps {h}, contains_overlap boolean")).collect()}
    assert (got[1].text, got[1].skipped_llm) == ("大家好。", True)
    assert (got[2].text, got[2].skipped_llm) == ("他们采用", False)
    bad = spark.createDataFrame([(2, (None, None, None, None))], f"unit_key bigint, reply {validators.REPLY}")
    got = {r.unit_key: r for r in passes.unit_texts(spark.createDataFrame(rows[:2], f"unit_key bigint, hyps {h}, contains_overlap boolean"), bad).collect()}
    assert (got[2].fallback, got[2].text, got[2].last_error) == (True, "他们采用", "missing text or base_model")


def test_pass_b_applies_edits_only(spark):
    rows = [(1, "帐号在哪", 900, False, None), (2, "帐号", 100, False, None), (3, "", 900, True, "补上"), (4, "好", 900, True, "坏")]
    df = spark.createDataFrame(rows, "turn_id bigint, text string, dur_ms bigint, overlap boolean, moss string")
    got = {r.turn_id: (r.new_text, r.path) for r in passes.turn_texts(df).collect()}
    assert got == {1: ("账号在哪", "llm"), 2: ("帐号", None), 3: ("", None), 4: ("好", "empty_edits_reject")}
    assert {r.turn_id for r in passes.restore_moss(df).collect() if r.restored} == {3}


def test_sequential_pass_sees_earlier_rewrites(spark):
    rows = [("m", i, i, t, 900, False, None) for i, t in enumerate(["帐号", "二", "三"] + [f"t{i}" for i in range(3, 30)])] + [("n", 0, 100, "帐号", 900, False, None)]
    df = spark.createDataFrame(rows, "meeting_id string, pos int, turn_id bigint, text string, dur_ms bigint, overlap boolean, moss string")

    def replies(hyps_, overlap, near):
        plain = passes.mock_reply(hyps_, overlap)
        edit = F.struct(F.element_at(hyps_, -1)["text"].alias("span_asr"), F.lit("账").alias("span_out"), F.lit("punct").alias("tier"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("anchor"), F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("int").alias("start_char"))
        changed = F.struct(F.lit("x").alias("text"), F.lit("draft").alias("base_model"), F.array(edit).alias("edits"), overlap.alias("overlap")).cast(validators.REPLY)
        return F.when(F.array_contains(near, "账号") & (F.element_at(hyps_, -1)["text"] != "二"), changed).otherwise(plain)

    got = {(r.meeting_id, r.pos): r.new_text for r in passes.sequential_texts(df, replies).collect()}
    assert got[("m", 0)] == "账号" and got[("m", 1)] == "二" and got[("n", 0)] == "账号"
    assert all(got[("m", i)] == "账" for i in range(2, 30))


def test_polish_pass(spark):
    df = spark.createDataFrame([(1, "用gpu跑wifi", "", "", ""), (2, "好", "", "", ""), (3, None, "", "", "")], "k int, text string, cite_hyps string, cite_neighbors string, cite_hotwords string")
    got = {r.k: (r.new_text, r.path) for r in passes.polish_texts(df).collect()}
    assert got == {1: ("用GPU跑Wi-Fi", "llm"), 2: ("好", None), 3: (None, None)}
    other = lambda t: F.struct(F.lit("别的").alias("text"), F.lit("d").alias("base_model"), F.array().cast(validators.EDIT).alias("edits"), F.lit(False).alias("overlap")).cast(validators.REPLY)
    assert {r.path for r in passes.polish_texts(df, other).collect() if r.text} == {"empty_edits_reject"}


def test_aliases(spark):
    hw = spark.createDataFrame([(0, "账号|帐号|大帐号码"), (1, "单框架|单方接"), (2, "词")], "pos int, term string")
    al = passes.parse_aliases(hw)
    assert {(r.alt, r.canon) for r in al.collect()} == {("帐号", "账号"), ("单方接", "单框架")}
    got = passes.rewrite_aliases(spark.createDataFrame([(1, "帐号和单方接"), (2, None)], "turn_id int, text string"), al)
    assert {r.turn_id: r.new_text for r in got.collect()} == {1: "账号和单框架", 2: ""}


def test_reports(spark):
    d = spark.createDataFrame([("m", True, 0, False, False), ("m", False, 2, True, False), ("m", False, 0, False, True)], "meeting_id string, skipped_llm boolean, retries int, fallback boolean, fallback_ok boolean")
    r = reports.unit_pass_stats(d, "meeting_id").first()
    assert (r.n_units, r.skipped_llm, r.approx_retry_rate, r.suggest_raise_temperature) == (3, 1, 1.0, True)
    kept = spark.createDataFrame([("A", 1), ("polish", 2), (None, 3)], "pass string, x int")
    assert sorted(r.x for r in reports.replace_pass(kept, spark.createDataFrame([(9,)], "x int"), "polish").collect()) == [1, 3, 9]


def test_entry_and_names(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and e.entry(spark).count() == 7
    assert np.all([callable(f) for f in q.values()])
