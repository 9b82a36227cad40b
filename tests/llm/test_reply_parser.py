"""The pushdown parser for replies, and tiling against brute force."""

import random
import time

import pytest

from turnloom.llm.broken_pairs import CLOSING, defect, target_language, tile
from turnloom.llm.reply_parser import breaks_off, parse_reply


@pytest.mark.parametrize(
    ("reply", "broken"),
    [
        ("~~~\ncode.\n```", True), ("~~~\ncode.\n~~~", False), ("````\n```\nx.\n````", False), ("````\nx.\n```", True), ("```python\nprint(1", True),
        ("<ul><li>One.", True), ("<ul><li>One.<li>Two.</ul>", False), ("See <b>this.", True), ("See <b>this</b>.", False), ("Line<br>break.", False), ("The <unk> token.", False), ("a < b and c > d.", False), ("<note>half of it.", False), ("<note>a</note>.", False),
        ("1. First.\n2.", True), ("- one\n- two\n- three", False), ("- One.\n- Two.\n- Thr", True), ("1. First.\n2. Second.", False),
        ("We met (in room 12.", True), ("We met (in room 12).", False), ("We met [in room.", True), ("He said \"yes.", True), ("He said \"yes\".", False), ("A 5\" pipe.", False), ("（《）》。", True), ("（《》）。", False), ("“没有。", True), ("「好。」", False), ("1) one.", False), ("x in [0, 1).", False),
        ("This is **bold.", True), ("This is **bold**.", False), ("Call `run(.", True), ("Call `run(`.", False), ("2**3 is 8.", False), ("See https://example.org/a_b", False), ("No full stop", True), ("", False), ("Fine.", False), ("Don't, 'tis fine.", False),
        ("<think>a ( \" {</think>Fine.", False), ("<think>half", True), ("<think>a<think>b</think>", True),
    ],
)
def test_what_breaks_off(reply, broken):
    p = parse_reply(reply)
    assert (p.broken or not p.is_json and breaks_off(p, CLOSING)) == broken


@pytest.mark.parametrize(
    ("reply", "broken", "payload"),
    [
        ('{"text": "a"}', False, "a"), ('```json\n{"text": "a {"}\n```', False, "a {"), ('```json\n{"text": "a"}', True, "a"), ('{"text": "a', True, None), ('{"text": "a"} as config.', False, '{"text": "a"} as config.'), ("{17s} Fine.", False, "{17s} Fine."),
        ("Here is what I found after reading all of the candidates twice and weighing the neighbours and the hot words against each other:\n" + '{"text": "b"}', False, "b"), ('<think>{</think>{"text": "c"}', False, "c"), ("{", True, None), ('[{"text": "d"}]', False, "d"), ('{"text": "a"]', True, None),
    ],
)
def test_payloads(reply, broken, payload):
    p = parse_reply(reply)
    assert (p.broken, p.payload) == (broken, payload)


def _greedy(a, b, least):
    """Longest common run of free tokens first, one at a time."""
    fa, fb, n = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and fa[i + k] and fb[j + k] and a[i + k] == b[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return n
        fa[i : i + k] = [False] * k
        fb[j : j + k] = [False] * k
        n += k


def test_tiling_is_near_the_greedy_one():
    rnd = random.Random(3)
    for _ in range(150):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 24))] for _ in range(2))
        got, want = tile(a, b, 3), _greedy(a, b, 3)
        assert abs(got - want) <= 3 and (got == 0) == (want == 0)


def test_tiling_of_long_texts_is_quick():
    rnd = random.Random(1)
    a = [str(rnd.randrange(40)) for _ in range(2000)]
    b = [x if rnd.random() > 0.1 else "x" for x in a]
    for x, y in ((a, b), (["a", "b"] * 1000, ["b", "a"] * 1000), (["a"] * 2000, ["a"] * 2000)):
        began = time.perf_counter()
        assert tile(x, y, 5) > 1500
        assert time.perf_counter() - began < 0.5


@pytest.mark.parametrize(
    ("user", "reply", "want"),
    [
        ("Translate into French.\n\nThe room was full.", "Der Raum war voll und wir sind dann gegangen.", "wrong_language"), ("Translate into French.\n\nThe room was full.", "La salle est pleine et nous sommes partis.", None),
        ("把下面的句子翻译成日语。\n\n会议室满了。", "会议室满了，我们走吧。", "wrong_language"), ("把下面的句子翻译成日语。\n\n会议室满了。", "会議室がいっぱいでした。", None), ("Traduisez en allemand ... into German.\n\nx", "Das ist der Bericht und wir sind fertig.", None),
        ("Translate the line into English.\n\n会议室满了。", "Translate the line into English. " * 9, "copied_prompt"),
    ],
)
def test_targets_and_repeats(user, reply, want):
    assert defect("translate", user, reply) == want


def test_target_named_last_counts():
    assert target_language("Translate from German into French.") == "fr" and target_language("请翻译成英文。") == "en" and target_language("Say it again.") is None
