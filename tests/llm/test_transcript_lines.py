"""Layouts of captions and transcripts."""

import pytest
from pyspark.sql import functions as F

from turnloom.llm import speaker_turns
from turnloom.llm.transcript_lines import parse_lines

SRT = "1\n00:00:01,000 --> 00:00:03,500\nAlice: We moved it.\n\n2\n00:00:04,000 --> 00:00:05,000\nBob: [laughter] Um, yes.\nIt is done.\n\n3\n00:00:06,000 --> 00:00:07,000\n42\n"
VTT = "WEBVTT - notes\nKind: captions\n\nNOTE made by a tool\nover two lines\n\nSTYLE\n::cue { color: red }\n\nintro\n00:01.000 --> 00:02.500 align:start position:0%\n<v Alice>We <i>moved</i> it.</v>\n\n00:03.000 --> 00:04.000\n<v.loud Bob>Yes.\n- and more\n"
BRACKETS = "[00:00:01] 王小明: 我们开始吧。\n[00:00:05] 李雷: 好的。\n[00:00:09] 没有名字。"
NAMES = "Alice: We moved it.\nBob: Yes.\nand so on\n\nNote that 3:15 stays."


def _lines(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(parse_lines(F.col("t")).alias("p"))
    p = df.first().p
    return [(x.start_ms, x.end_ms, x.label, x.text.strip()) for x in p.lines], p.times, p.labels


@pytest.mark.parametrize(
    ("text", "want", "times", "labels"),
    [
        (SRT, [(1000, 3500, "Alice", "We moved it."), (4000, 5000, "Bob", "[laughter] Um, yes."), (4000, 5000, None, "It is done."), (6000, 7000, None, "42")], True, True),
        (VTT, [(1000, 2500, "Alice", "We moved it."), (3000, 4000, "Bob", "Yes."), (3000, 4000, None, "- and more")], True, True),
        (BRACKETS, [(1000, None, "王小明", "我们开始吧。"), (5000, None, "李雷", "好的。"), (9000, None, None, "没有名字。")], True, True),
        (NAMES, [(None, None, "Alice", "We moved it."), (None, None, "Bob", "Yes."), (None, None, None, "and so on"), (None, None, None, "Note that 3:15 stays.")], False, True),
        ("Note: one thing.\nanother", [(None, None, None, "Note: one thing."), (None, None, None, "another")], False, False),
        ("7\nnot a cue\n\n8", [(None, None, None, "7"), (None, None, None, "not a cue"), (None, None, None, "8")], False, False),
        ("\n\n", [], False, False),
    ],
)
def test_layouts(spark, text, want, times, labels):
    assert _lines(spark, text) == (want, times, labels)


def test_null_text(spark):
    assert spark.createDataFrame([(None,)], "t string").select(parse_lines(F.col("t")).alias("p")).first().p is None


def test_turns_of_captions(spark):
    rows = [(1, "m", 0, 1.0, 9.0, "speaker_4", SRT, "x"), (2, "m", 1, 20.0, 21.0, "speaker_4", "Plain.", "x"), (3, "n", 0, 1.0, 9.0, "S2", VTT, "x"), (4, "n", 1, 30.0, 31.0, None, "a: b", "x")]
    df = spark.createDataFrame(rows, "turn_id bigint, meeting_id string, turn_index int, start_s double, end_s double, speaker_id string, text string, line string")
    got = sorted(tuple(r) for r in speaker_turns.speaker_turns(df).collect())
    assert got == [
        ("m", 1000, 3500, "Alice", "We moved it.", 1), ("m", 4000, 5000, "Bob", "yes.", 1), ("m", 4000, 21000, "speaker_4", "It is done. 42 Plain.", 3),
        ("n", 1000, 2500, "Alice", "We moved it.", 1), ("n", 3000, 4000, "Bob", "Yes.", 1), ("n", 3000, 4000, "speaker_2", "and more", 1), ("n", 30000, 31000, "unknown", "a: b", 1),
    ]
    dirt = {(r.turn_id, r.dirt) for r in speaker_turns.dirty_turns(df).collect()}
    assert dirt == {(1, "timestamp"), (1, "label"), (1, "sound"), (1, "filler"), (3, "timestamp"), (3, "label"), (4, "label")}
