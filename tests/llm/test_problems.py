"""The training-data operators against brute force, round trips and defined edge cases."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm import broken_pairs, consensus, encoding, leaks, one_form, shared_spans, speaker_turns, splitting
from turnloom.llm.queries import queries

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
HYP = "hyp_id bigint, unit_key bigint, model string, text string, loaded_at int, slot string"


# 1. consensus
def _hyps(spark, rows):
    return spark.createDataFrame([(i, u, m, t, 1, "clash") for i, (u, m, t) in enumerate(rows)], HYP)


def test_wording_ignores_form():
    assert consensus.wording("Ｈｅｌｌｏ, the Päivo—审计！") == consensus.wording("hello the Päivo 审计") == ["hello", "the", "päivo", "审", "计"]
    assert consensus.wording("​Оkаy") == ["okay"] and consensus.wording(None) == consensus.wording("。 ") == []


def test_slots_of_three_wordings():
    said = {0: list("审计文件"), 1: list("审记文件"), 2: list("审计的文件"), 3: list("审计文件")}
    pivot, slots = consensus.slots(said)
    assert "".join(pivot) == "审计文件"
    assert [({"".join(v) for v in s.variants}) for s in slots] == [{"计", "记"}, {"", "的"}]
    assert [sorted(m for who in s.voters for m in who) for s in slots] == [[0, 1, 2, 3]] * 2


def test_slots_rebuild_every_wording():
    rnd = random.Random(1)
    for _ in range(300):
        base = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 9))]
        said = {}
        for m in range(rnd.randint(1, 5)):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randint(0, len(w))
                w[k : k + rnd.randint(0, 2)] = [rnd.choice("abcdefgh")] * rnd.randint(0, 2)
            said[m] = w
        pivot, slots = consensus.slots(said)
        for m, w in said.items():
            out, at = [], 0
            for s in slots:
                out += pivot[at : s.a]
                out += next(v for v, who in zip(s.variants, s.voters) if m in who)
                at = s.b
            assert "".join(out + pivot[at:]) == "".join(w)


def test_consensus_prefers_reliable_models_over_copied_errors(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    rows, wrong = [], set()
    for u in range(400):
        truth = [rnd.choice(words) for _ in range(6)]
        bad = None
        for m, p in (("a", 0.05), ("b", 0.1), ("c", 0.15), ("x", 0.5), ("y", 0.5)):
            w = list(truth)
            if m == "y" and bad is not None and rnd.random() < 0.9:
                w = list(bad)
            elif rnd.random() < p:
                w[rnd.randrange(6)] = f"z{rnd.randrange(8)}"
            if m == "x" and w != truth:
                bad = w
            if m in "ab" and rnd.random() < 0.3:
                continue
            if w != truth:
                wrong.add((u, m))
            rows.append((u, m, " ".join(w) + rnd.choice([".", "", " "])))
    rows += [(900, "a", None), (900, "b", " 。"), (901, "a", "only one"), (None, "a", "x"), (5, None, "x")]
    df = _hyps(spark, rows)
    got = {(r.unit_key, r.model) for r in consensus.found_wrong(df).collect()}
    assert len(got & wrong) / len(wrong) > 0.95 and len(got - wrong) < 0.05 * len(wrong)
    rel = {r.model: r for r in consensus.reliability(df).collect()}
    assert rel["y"].copies == "x" and rel["a"].accuracy > rel["c"].accuracy > rel["x"].accuracy
    words = {r.unit_key: r for r in consensus.consensus_wordings(df).collect()}
    assert (words[901].wording, words[901].n_models, words[901].agreement) == ("only one", 1, 1.0)
    assert (words[900].wording, words[900].n_models, words[900].agreement) == ("", 0, None)


def test_consensus_of_nothing(spark):
    df = _hyps(spark, [(1, "a", "x")]).limit(0)
    assert consensus.found_wrong(df).count() == consensus.consensus_wordings(df).count() == consensus.reliability(df).count() == 0


def test_current_hypothesis_counts(spark):
    df = spark.createDataFrame([(0, 1, "a", "old text", 1, ""), (1, 1, "a", "new text", 2, ""), (1, 1, "a", "new text", 2, ""), (2, 1, "b", "new text", 1, ""), (3, 1, "c", "new test", 1, "")], HYP)
    assert {(r.unit_key, r.model) for r in consensus.found_wrong(df).collect()} == {(1, "c")}


# 2. broken pairs
JUDGE = "### Task\nFix only what the sound supports. Keep the length of every changed span. Reply in JSON.\n\n### Inputs\n- moss: We moved the old file.\n- qwen: We moved the cold file.\n\noverlapped: false"
TO_EN, TO_ZH = "Translate the line into English.\n\n会议室满了，我们走吧。", "请把下面的句子翻译成中文。\n\nThe room was full."
MINUTES = "问题： 会上关于云台最后怎么决定的？\nExcerpt: 没有人负责。"


@pytest.mark.parametrize(
    ("kind", "user", "reply", "want"),
    [
        ("judge", JUDGE, None, "empty"), ("judge", JUDGE, " \n　", "empty"), ("judge", JUDGE, "N/A", "empty"), ("judge", JUDGE, "```json\n```", "empty"), ("judge", JUDGE, "{}", "empty"),
        ("judge", JUDGE, "<think>done</think>", "empty"), ("judge", JUDGE, '{"text": "  ", "edits": []}', "empty"), ("judge", JUDGE, "<think>half", "truncated"),
        ("judge", JUDGE, '{"text": "We moved the old file.", "edits": [', "truncated"), ("judge", JUDGE, '{"text": "We moved', "truncated"), ("judge", JUDGE, '```json\n{"text": "We moved the old file."}', "truncated"),
        ("judge", JUDGE, '<think>a {</think>\n```json\n{"text": "We moved the old file.", "edits": []}\n```', None), ("judge", JUDGE, 'Here is the result:\n{"text": "We moved the cold file."}', None),
        ("judge", JUDGE, "I cannot assist with this transcript.", "refusal"), ("judge", JUDGE, '{"text": "抱歉，我无法处理该单元的文本。"}', "refusal"), ("judge", JUDGE, "Lo siento, no puedo ayudar con esto.", "refusal"),
        ("judge", JUDGE, "Fix only what the sound supports. Keep the length of every changed span. Reply in JSON.", "copied_prompt"), ("judge", JUDGE, JUDGE.upper(), "copied_prompt"),
        ("judge", JUDGE, '{"text": "Fix only what the sound supports. Keep the length of every changed span."}', "copied_prompt"),
        ("judge", JUDGE, '{"text": "Wir prüfen den Bericht noch einmal mit der Gruppe."}', "wrong_language"), ("judge", JUDGE, '{"text": "我们把旧文件移走了。"}', "wrong_language"),
        ("judge", JUDGE.replace("We moved the old file.", "I'm sorry, I can't make it at 8:00."), '{"text": "I\'m sorry, I can\'t make it at 8:00."}', None),
        ("translate", TO_EN, "The room was full, let us go.", None), ("translate", TO_EN, "The room was full, let us", "truncated"), ("translate", TO_EN, "会议室满了，我们走吧。", "wrong_language"), ("translate", TO_EN, "> Translate the line into English.", "copied_prompt"),
        ("translate", TO_EN, "La salle est pleine et nous partons.", "wrong_language"), ("translate", TO_ZH, "会议室满了。", None), ("translate", TO_ZH, "The room was full.", "wrong_language"), ("translate", TO_EN, "部屋がいっぱいでした。", "wrong_language"),
        ("translate", TO_EN, "Sorry, I can't make it at 10:00.", None), ("minutes", MINUTES, "关于云台，大家同意没有人负责。", None), ("minutes", MINUTES, "会上关于云台最后怎么决定的？", "copied_prompt"), ("minutes", MINUTES, "The meeting agreed that nobody owned it.", "wrong_language"),
        ("minutes", MINUTES, "关于云台，大家", "truncated"), (None, None, "Fine.", None), ("judge", None, '{"text": "x"}', None),
    ],
)
def test_defects(kind, user, reply, want):
    assert broken_pairs.defect(kind, user, reply) == want


def test_long_replies_are_read_whole():
    assert broken_pairs.defect("translate", TO_EN, "The room was full. " * 3000 + "And then") == "truncated"
    assert broken_pairs.defect("translate", TO_EN, "The room was full. " * 3000) is None


def test_tiling_uses_tokens_once():
    assert broken_pairs.tile(list("abcabc"), list("abc"), 3) == 3 and broken_pairs.tile(list("xabcy"), list("zabc"), 3) == 3 and broken_pairs.tile([], list("abc"), 3) == 0


def test_defect_rows(spark):
    df = spark.createDataFrame([(1, "judge", JUDGE, None), (2, "judge", JUDGE, '{"text": "We moved the old file."}'), (None, "judge", None, None), (3, None, None, None)], "infer_id bigint, pass string, user_text string, response string")
    assert {(r.infer_id, r.defect) for r in broken_pairs.found_defects(df).collect()} == {(1, "empty"), (3, "empty")}
    assert broken_pairs.found_defects(df.limit(0)).count() == 0


# 3. speaker turns
@pytest.mark.parametrize(
    ("speaker", "text", "dirt", "clean"),
    [
        ("speaker_1", "[00:01:03] 行", ["timestamp"], "行"), ("speaker_1", "00:05:19 | 好的。", ["timestamp"], "好的。"), ("speaker_1", "00:32:56.242 --> 00:32:58.242 好。", ["timestamp"], "好。"), ("speaker_1", "<t=12.5>Yes.", ["timestamp"], "Yes."),
        ("speaker_1", "{17s} Yes.", ["timestamp"], "Yes."), ("speaker_1", "抱歉，我14:00没法参加。", [], "抱歉，我14:00没法参加。"), ("speaker_1", "Let us meet at 11:40.", [], "Let us meet at 11:40."),
        ("speaker_1", "嗯", ["filler"], ""), ("speaker_1", "呃…，好的。", ["filler"], "好的。"), ("speaker_1", "额度不够，唔。", ["filler"], "额度不够。"), ("speaker_1", "Um - we moved.", ["filler"], "we moved."), ("speaker_1", "The umpire erred.", [], "The umpire erred."), ("speaker_1", "好啊，对吧。", [], "好啊，对吧。"),
        ("speaker_1", "【笑声】行", ["sound"], "行"), ("speaker_1", "((inaudible)) Yes.", ["sound"], "Yes."), ("speaker_1", "♪ Yes.", ["sound"], "Yes."), ("speaker_1", "**sigh** Yes.", ["sound"], "Yes."), ("speaker_1", "请看第3页（第二版）。", [], "请看第3页（第二版）。"), ("speaker_1", "See it (see slide 12).", [], "See it (see slide 12)."),
        ("Spk_2", "行", ["label"], "行"), ("speaker_02", "行", ["label"], "行"), ("speaker_2", "S2> 行", ["label"], "行"), ("speaker_2", "[00:02] 说话人5：行", ["timestamp", "label"], "行"), ("speaker_2", "说话人标签很好。", [], "说话人标签很好。"), (None, "行", ["label"], "行"),
        ("speaker_1", "еr, yes.", ["filler"], "еr, yes."), ("speaker_1", None, [], ""), ("speaker_1", "", [], ""),
    ],
)
def test_dirt_of_a_line(spark, speaker, text, dirt, clean):
    r = speaker_turns.mark_dirt(spark.createDataFrame([(speaker, text, 1)], "speaker_id string, text string, clean int")).first()
    assert sorted(r.dirt) == sorted(dirt)
    if "е" not in (text or ""):
        assert r.clean_text == clean


@pytest.mark.parametrize("partitions", [1, 4])
def test_turns_merge_across_partitions(spark, partitions):
    rows = [(i, "m" if i < 30 else "n", i, float(i), i + 0.5, "speaker_0" if i % 10 < 7 else "S1", f"t{i}.") for i in range(40)] + [(99, "m", 99, None, 2.0, "speaker_0", "x"), (98, None, 0, 1.0, 2.0, "s", "x"), (97, "m", 97, 3.2, 3.3, "speaker_5", "嗯")]
    df = spark.createDataFrame(rows, "turn_id bigint, meeting_id string, turn_index int, start_s double, end_s double, speaker_id string, text string")
    got = sorted((r.meeting_id, r.start_ms, r.speaker, r.n_turns, r.text) for r in speaker_turns.speaker_turns(df, partitions=partitions).collect())
    assert [g[:4] for g in got] == [("m", 0, "speaker_0", 7), ("m", 7000, "speaker_1", 3), ("m", 10_000, "speaker_0", 7), ("m", 17_000, "speaker_1", 3), ("m", 20_000, "speaker_0", 7), ("m", 27_000, "speaker_1", 3), ("n", 30_000, "speaker_0", 7), ("n", 37_000, "speaker_1", 3)]
    assert got[0][4] == " ".join(f"t{i}." for i in range(7))


# 4. splitting
def test_packing_is_feasible_and_as_natural_as_can_be():
    rnd = random.Random(2)
    for _ in range(400):
        t, turns = 0, []
        for _ in range(rnd.randint(2, 12)):
            d = rnd.randint(500, 22_000)
            turns.append((t, t + d))
            t += d + rnd.choice([0, 100, 299, 300, 900, 3000])
        pauses = [(a[1], b[0]) for a, b in zip(turns, turns[1:]) if b[0] - a[1] >= 300]
        start, end = turns[0][0], turns[-1][1]
        ps = splitting.pack_span(start, end, pauses, 30_000, 1000)
        assert ps[0][0] == start and ps[-1][1] == end and all(0 < b - a <= 30_000 for a, b, _ in ps)
        assert all(b[0] == a[1] - 1000 for a, b in zip(ps, ps[1:]))
        assert all(any(x <= b <= y for x, y in pauses) for _, b, nat in ps[:-1] if nat)
        at, ok = start, True
        while end - at > 30_000:
            reach = [min(b, at + 30_000) for a, b in pauses if a <= at + 30_000 and min(b, at + 30_000) - 1000 > at]
            if not reach:
                ok = False
                break
            at = max(reach) - 1000
        assert all(p[2] for p in ps) == ok


def test_text_pieces(spark):
    t = "# One\n" + "A sentence here. " * 30 + "\n\n" + "第二段。" * 100 + "\n" + "x" * 700
    df = spark.createDataFrame([(1, t, 5), (2, "", 1), (3, None, 1), (4, "short", 1), (None, "x", 1)], "doc_id bigint, text string, piece int")
    got = {}
    for r in splitting.split_texts(df, limit=200, overlap=20).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {1, 4}
    ps = sorted(got[1], key=lambda r: r.piece)
    assert all(len(p.piece_text) <= 200 and p.piece_text == t[p.start : p.end] for p in ps) and all(b.start == a.end - 20 for a, b in zip(ps, ps[1:])) and ps[-1].end == len(t)
    assert {p.level for p in ps} >= {1, 2, 4} or {p.level for p in ps} >= {2, 4}
    with pytest.raises(ValueError):
        splitting.split_texts(df, limit=10, overlap=5)


@pytest.mark.parametrize(("reason", "kept"), [(None, True), ("", True), ("  ", True), ("too_long", True), ("TOO LONG", True), ("over_cap", True), ("exceeds 30s", True), ("duration > max", True), ("超长", True), ("too_short", False), ("corrupt_audio", False), ("no_speech", False), ("静音", False), ("withdrawn", False)])
def test_reasons(spark, reason, kept):
    units = spark.createDataFrame([(1, "m", [0, 1, 7], reason)], "unit_key bigint, meeting_id string, turn_indices array<int>, skip_reason string")
    turns = spark.createDataFrame([("m", 0, 0.0, 20.0), ("m", 1, 20.5, 41.0), ("m", 7, None, 99.0)], "meeting_id string, turn_index int, start_s double, end_s double")
    assert [tuple(r) for r in splitting.found_long_units(units, turns).collect()] == ([(1, "natural")] if kept else [])


# 5. one form
@pytest.mark.parametrize(
    ("text", "want"),
    [("Ｒｉｇｈｔ１", "Right1"), ("Vélin", "Vélin"), ("한솔", "한솔"), ("可​以­", "可以"), ("a b c d", "a b c d"), ("ﬁrst", "first"), ("Оkаy", "Okay"), ("⼀起不", "一起不"), ("デルマ", "デルマ"), ("Прoект", "Проект"), ("q̣̇ q̣̇", "q̣̇ q̣̇"), ("x̧́é", "x̧́é")],
)
def test_one_form(spark, text, want):
    df = spark.createDataFrame([("t", 1, text, "x")], "tbl string, row_id bigint, text string, seg string")
    assert [r.one_form for r in one_form.one_form_changes(df).collect()] == [want]
    again = spark.createDataFrame([("t", 1, want)], "tbl string, row_id bigint, text string")
    assert one_form.one_form_changes(again).count() == 0


@pytest.mark.parametrize("text", ["。，（）", "Проект 样机", "λίμα", "👩‍💻 ok", "行 ✔️", "1️⃣", "Façade Köra", "デルマ 한솔라", "", None, "plain", "СХЕМА"])
def test_no_case(spark, text):
    df = spark.createDataFrame([("t", 1, text)], "tbl string, row_id bigint, text string")
    assert one_form.one_form_changes(df).count() == 0 and [r.one_form for r in one_form.one_form(df).collect()] == [text]


def test_one_form_equals_the_standard_on_accents(spark):
    rnd = random.Random(3)
    marks = "̸゙̧̣̀́̂̈ᅡᆨ"
    base = "aeiouAcnﾊかガ가ᄀ"
    texts = sorted({"".join(rnd.choice(base) + "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 3))) for _ in range(3)) for _ in range(150)})
    df = spark.createDataFrame([("t", i, x) for i, x in enumerate(texts)], "tbl string, row_id bigint, text string")
    got = {r.row_id: r.one_form for r in one_form.one_form(df).collect()}
    bad = [(ascii(x), ascii(got[i])) for i, x in enumerate(texts) if unicodedata.normalize("NFC", unicodedata.normalize("NFD", got[i])) != unicodedata.normalize("NFC", unicodedata.normalize("NFKD", x).replace("ᅠ", ""))]
    assert not bad, bad[:3]


def test_look_alike_rows(spark):
    turns = spark.createDataFrame([(1, "ａ"), (1, "ａ"), (1, "b"), (2, "c"), (None, "ａ")], "turn_id bigint, text string")
    hyps = spark.createDataFrame([(1, "Yeѕ"), (3, None)], "hyp_id bigint, text string")
    assert sorted(map(tuple, one_form.found_look_alikes(turns, hyps).collect())) == [("hyps", 1), ("turns", 1)]


# 7. encoding
def test_ids_equal_the_library_and_decode(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(TOKENIZER)
    lib.encode_special_tokens = True
    rnd = random.Random(4)
    parts = ["a", "aa", "aaa", " ", "  ", "\n", "\t", "'ll", "'S", "é", "漢字", "的的的", "の魔", "👩‍💻", "<|endoftext|>", "0123", "Ж", "…", "　", "​", "hello world", "ﬁ", "\U0001f642"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(400)] + ["a" * 5000, " " * 999, "龘靐齉爩" * 200, "", None]
    df = spark.createDataFrame([(i, t, [0]) for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>")
    got = {r.doc_id: r.ids for r in encoding.encode_texts(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == lib.encode(t or "", add_special_tokens=False).ids, ascii(t)[:80]
        assert lib.decode(got[i]) == (t or "")
    assert encoding.encode_texts(df.limit(0)).count() == 0


def test_forgetting_pieces_changes_nothing(monkeypatch):
    coder = encoding.Encoder(encoding.load_merges(TOKENIZER))
    whole, n = coder.encode(["one two three 一二三"] * 3)
    monkeypatch.setattr(encoding, "CACHE_PIECES", 0)
    again, m = coder.encode(["one two three 一二三"] * 3)
    assert np.array_equal(whole, again) and np.array_equal(n, m)


# 8. leaks
@pytest.fixture(scope="module")
def leak_tables(spark):
    rnd = random.Random(6)
    names = [a + b for a in ("Bra", "Cle", "Dru", "Fen", "Gor", "Hul", "Jos", "Kip") for b in ("mond", "thar", "wick", "sel", "nix", "pol", "rast")]
    zh = [a + b + c for a in "汐澜枫禾" for b in "东南丙丁" for c in "港码图"]

    def en():
        a, b = rnd.sample(names, 2)
        return f"The {a} ferry owes {b} harbour {rnd.randint(1, 999)} crowns and {rnd.randint(1, 999)} barrels of lamp oil."

    def cn():
        a, b = rnd.sample(zh, 2)
        return f"渡船{a}欠{b}港{rnd.randint(1, 999)}个银币和{rnd.randint(1, 999)}桶灯油，利息另算{rnd.randint(1, 999)}文。"

    items = [(i, f() + f()) for i, f in enumerate([en] * 30 + [cn] * 30)]
    noise = lambda: "We moved the old file to room 12 and nobody owned it. 会议室满了，没有人负责。"
    docs, want = [], set()
    for i, ref in items:
        words = ref.split(" ") if i < 30 else list(ref)
        n = len(words)
        glue = " " if i < 30 else ""
        cases = {0: ref, 1: glue.join(words[: int(n * 0.7)]), 2: glue.join("quiet" if i < 30 and k % 8 == 3 else "某" if i >= 30 and k % 12 == 5 else w for k, w in enumerate(words)), 3: ref.upper().replace(",", "，"), 4: glue.join(words[: int(n * 0.2)]), 5: en() if i < 30 else cn()}
        for c, body in cases.items():
            d = i * 10 + c
            if c == 0:
                body = body[: len(body) // 2] + "\n[00:44:25] speaker_2: " + body[len(body) // 2 :] if i >= 30 else body.replace(". ", ".\nspeaker_1: ")
            docs.append((d, f"{noise()}\n{body}\n{noise()}", "x"))
            if c <= 3:
                want.add((d, i))
    docs += [(9001, None, ""), (9002, "", ""), (9003, " \n", ""), (None, items[0][1], "")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, k string"), spark.createDataFrame([*items, (77, None), (78, "。"), items[0]], "item_id bigint, ref_text string"), want


def test_leaks(spark, leak_tables):
    docs, items, want = leak_tables
    got = {(r.doc_id, r.item_id) for r in leaks.found_leaks(docs, items).collect()}
    assert got == want


def test_leaks_without_broadcasts(spark, leak_tables, monkeypatch):
    docs, items, want = leak_tables
    monkeypatch.setattr(leaks, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(leaks, "CANDIDATE_BYTES", 0)
    assert {(r.doc_id, r.item_id) for r in leaks.found_leaks(docs, items).collect()} == want


def test_leaks_of_nothing(spark, leak_tables):
    docs, items, _ = leak_tables
    assert leaks.found_leaks(docs.limit(0), items).count() == 0 and leaks.found_leaks(docs, items.limit(0)).count() == 0


# 9. shared spans
def _corpus(seed, alphabet):
    rnd = random.Random(seed)
    t = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    notice, long = t(250), t(900)
    docs = [(i, notice + t(rnd.randint(0, 400))) for i in range(40)]
    docs += [(100 + i, t(rnd.randint(0, 200)) + long[rnd.randint(0, 300) : rnd.randint(500, 900)] + t(rnd.randint(0, 200))) for i in range(15)]
    for n in (299, 300, 301):
        s = t(n)
        docs += [(200 + n * 2 + k, t(rnd.randint(0, 150)) + s + t(rnd.randint(0, 150))) for k in range(2)]
    s = t(350)
    docs += [(900, s + t(100) + s), (901, t(600)), (902, docs[50][1]), (903, docs[50][1]), (904, None), (905, ""), (906, "a" * 1000), (907, "a" * 500 + "b" * 500)]
    return docs


def _pairs(docs, n=300):
    where = {}
    for d, x in docs:
        for k in range(len(x or "") - n + 1):
            where.setdefault(x[k : k + n], set()).add(d)
    return {(a, b) for ds in where.values() for a in ds for b in ds if a < b}


@pytest.mark.parametrize(("seed", "alphabet"), [(1, "abcdefghij 。"), (2, "ab"), (3, "一二三四五六七八九十百千")])
def test_shared_spans_equal_brute_force(spark, seed, alphabet, monkeypatch):
    docs = _corpus(seed, alphabet)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, h string")
    assert {tuple(r) for r in shared_spans.found_shared(df).collect()} == _pairs(docs)
    monkeypatch.setattr(shared_spans, "BROADCAST_BYTES", 0)
    covered = {}
    for d, x in docs:
        if x:
            cov = np.zeros(len(x), bool)
            for k in range(len(x) - 299):
                if any(x[k : k + 300] in (y or "") for e, y in docs if e != d):
                    cov[k : k + 300] = True
            covered[d] = int(cov.sum())
    assert {r.doc_id: r.shared_chars for r in shared_spans.shared_share(df).collect()} == covered


def test_copies_are_expanded_or_linked_to_one(spark):
    rnd = random.Random(9)
    t = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    x, y = t(700), t(400)
    docs = [(i, x) for i in range(10, 16)] + [(i, y) for i in (1, 20, 21)] + [(30, t(100) + x[:350]), (31, y[50:] + t(90)), (32, t(500)), (40, t(200)), (41, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {tuple(r) for r in shared_spans.found_shared(df).collect()} == _pairs(docs)
    got = [tuple(r) for r in shared_spans.found_shared(df, expand=False).collect()]
    assert len(got) == len(set(got)) and set(got) == {(10, i) for i in range(11, 16)} | {(10, 30)} | {(1, 20), (1, 21), (1, 31)}
    assert {(r.doc_id, r.class_id) for r in shared_spans.copy_classes(df).collect()} == {(i, 10) for i in range(10, 16)} | {(1, 1), (20, 1), (21, 1)}


def test_shared_spans_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert shared_spans.found_shared(df).count() == shared_spans.shared_share(df).count() == 0


def test_every_stretch_has_an_edge():
    rnd = random.Random(8)
    s = "".join(rnd.choice("abcd") for _ in range(300))
    seen = None
    for _ in range(50):
        x = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 333))) + s + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 333)))
        h = shared_spans.Hashed([x])
        _, pos = shared_spans.anchors(h, shared_spans.K, shared_spans.W)
        off = x.index(s)
        inside = {int(h.of(np.array([a]), np.array([b + shared_spans.K]))[0]) for a, b in zip(pos, pos[1:]) if a >= off and b + shared_spans.K <= off + 300}
        assert inside
        seen = inside if seen is None else seen & inside
    assert seen


def test_every_query_runs_on_the_smallest_tables(spark):
    for name, q in queries().items():
        assert len(q(spark, "/root/testdata/sf0.001").schema) > 0, name


def test_names_of_models_dont_matter(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(300):
        truth = [rnd.choice("abcdefghijkl") * 2 for _ in range(5)]
        src = [rnd.choice("mnop") * 2 if rnd.random() < 0.25 else w for w in truth]
        cp = list(src) if rnd.random() < 0.85 else [rnd.choice("qrst") * 2 if rnd.random() < 0.3 else w for w in truth]
        for m, w in (("src", src), ("cp", cp), ("p", [rnd.choice("uv") * 2 if rnd.random() < 0.1 else w for w in truth]), ("q", [rnd.choice("wx") * 2 if rnd.random() < 0.1 else w for w in truth])):
            rows.append((u, m, " ".join(w)))
    new = {"src": "z", "cp": "a", "p": "m", "q": "b"}
    found = [{(r.unit_key, r.model) for r in consensus.found_wrong(_hyps(spark, [(u, f(m), t) for u, m, t in rows])).collect()} for f in (lambda m: m, new.get)]
    assert {(u, new[m]) for u, m in found[0]} == found[1]
    copies = [{(r.model, r.copies) for r in consensus.reliability(_hyps(spark, [(u, f(m), t) for u, m, t in rows])).collect() if r.copies} for f in (lambda m: m, new.get)]
    assert len(copies[0]) == 1 and {(new[a], new[b]) for a, b in copies[0]} == copies[1]


def test_packing_of_many_pauses_is_quick():
    import time

    pauses = [(1000 * k + 600, 1000 * k + 950) for k in range(200_000)]
    began = time.perf_counter()
    ps = splitting.pack_span(0, 200_000_000, pauses, 30_000, 1000)
    assert time.perf_counter() - began < 2 and all(p[2] for p in ps) and all(b - a <= 30_000 for a, b, _ in ps)


def test_texts_are_split_by_the_hierarchy():
    t = "# A\n" + "Short one. " * 5 + "\n\n" + "Second paragraph here. " * 4 + "\n# B\n" + "w" * 90 + " " + "v" * 30
    ps = splitting.pack_text(t, 100, 10)
    assert all(0 < b - a <= 100 for a, b, _ in ps) and ps[-1][1] == len(t) and all(y[0] == x[1] - 10 for x, y in zip(ps, ps[1:]))
    assert t[: ps[0][1]].endswith("\n\n") and ps[0][2] == 1 and any(t[b:].startswith("# B") and lv == 0 for _, b, lv in ps)
    rnd = random.Random(4)
    for _ in range(300):
        x = "".join(rnd.choice(["word ", "句子。", "\n", "\n\n", "# h\n", "x" * rnd.randint(1, 60)]) for _ in range(rnd.randint(0, 40)))
        for whole in (False, True):
            ps = splitting.pack_text(x, 50, 12, whole)
            assert all(b - a <= 50 for a, b, _ in ps) and ps[0][0] == 0 and ps[-1][1] == len(x) and all(y[0] >= z[1] - 12 and z[0] < y[0] <= z[1] < y[1] for z, y in zip(ps, ps[1:]))


@pytest.mark.parametrize(("text", "want"), [("葛\U000e0100城", "葛城"), ("⻅到⻢", "见到马"), ("ɡood", "good"), ("🏴\U000e0067\U000e0062\U000e007f", None), ("a\U000e0061b", "ab")])
def test_supplements_and_selectors(spark, text, want):
    df = spark.createDataFrame([("t", 1, text), ("t", 1, text), ("t", 1, "plain")], "tbl string, row_id bigint, text string")
    assert [r.one_form for r in one_form.one_form_changes(df).collect()] == ([want] if want else [])
    assert sorted(r.one_form for r in one_form.one_form(df).collect()) == sorted([want or text] * 2 + ["plain"])
