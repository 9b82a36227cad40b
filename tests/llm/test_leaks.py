"""Leaks of few, unlike and densely edited items."""

import random

import pytest

from turnloom.llm import leaks

DOC, ITEM = "doc_id bigint, text string, item_id string", "item_id bigint, ref_text string, text string"
ENGLISH = [
    "The old lighthouse keeper wrote every evening about storms, passing ships and the strange green glow above the northern reef.",
    "Our bakery stopped selling rye bread because the mill upstream burned down during a dry and windy August afternoon.",
    "Nobody expected the orchestra to finish its longest symphony while the roof of the hall was still under repair last winter.",
    "A quiet student measured how quickly copper rods cool when they are dropped into salted water at different depths.",
]
CHINESE = [
    "老灯塔的看守人每天晚上都记录风暴和路过的船只，还有北边礁石上方那种奇怪的绿光，他从来没有向任何人解释过原因，直到去年冬天才把本子交给了镇上的图书馆保存起来。",
    "面包房不再卖黑麦面包，因为上游的磨坊在一个干燥多风的八月下午烧毁了，工人们只好把剩下的粮食搬进教堂的地窖，等到第二年春天再想办法重新开始做生意养家糊口。",
    "没有人料到乐团能在屋顶仍在修理的时候演完最长的交响曲，观众裹着毯子坐到深夜，指挥却只说了一句谢谢大家，然后独自走进后台收拾他那把旧得掉漆的小提琴和一叠乐谱。",
    "一个安静的学生测量了铜棒放进盐水后在不同深度冷却得有多快，她把结果写满三本笔记，后来发现温度计从一开始就偏了两度，于是又从头再做了一遍全部的实验和计算工作。",
]


def _found(spark, docs, items):
    return {(r.doc_id, r.item_id) for r in leaks.found_leaks(spark.createDataFrame([(i, t, "clash") for i, t in docs], DOC), spark.createDataFrame([(i, t, "clash") for i, t in items], ITEM)).collect()}


@pytest.mark.parametrize("texts", [ENGLISH[:1], ENGLISH[:2], CHINESE[:1], CHINESE, ENGLISH + CHINESE])
def test_unlike_items_quoted_whole_or_in_part(spark, texts):
    items = list(enumerate(texts))
    docs = [(100 + i, f"Before it. 前文。\n{t}\nAfter it. 后文。") for i, t in items]
    part = lambda t: " ".join(t.split()[3:14]) if t.isascii() else t[10 : 10 + int(0.5 * len(t))]
    docs += [(200 + i, f"Some words that say something else entirely. {part(t)} 说完了。") for i, t in items]
    docs += [(300 + i, " ".join(t.split()[:5]) if t.isascii() else t[:20]) for i, t in items] + [(400, "nothing of it at all"), (401, None), (402, "")]
    assert _found(spark, docs, items) == {(100 + i, i) for i, _ in items} | {(200 + i, i) for i, _ in items}


def test_short_items(spark):
    items = [(1, "wide red door"), (2, "灯塔"), (3, "!!"), (4, ""), (5, None), (6, "wide red door")]
    assert _found(spark, [(1, "he saw a Wide, red door there"), (2, "那座灯塔很高"), (3, "a red house")], items) == {(1, 1), (1, 6), (2, 2)}


def test_densely_edited_quotes(spark):
    """About half of an item with one word in seven, or one ideograph in ten, replaced: where half of the slots are gone, a passage can't be told from another of its build."""
    rnd = random.Random(4)
    all_items = [(r.item_id, r.ref_text) for r in spark.read.parquet("/root/testdata/sf0.001/eval_items.parquet").collect()]
    docs, want = [], set()
    for i, t in all_items[:200]:
        units = t.split() if t.isascii() else list(t)
        k, step = int(0.5 * len(units)) + 1, 7 if t.isascii() else 10
        a = rnd.randrange(len(units) - k)
        units = units[a : a + k]
        letters = lambda x: sum(c.isalnum() for c in x)
        if letters("".join(units)) < 0.48 * letters(t):
            continue
        for j in range(rnd.randrange(step), k - 1, step):
            if any(c.isalnum() for c in units[j]):
                units[j] = "replaced" if t.isascii() else "某"
        docs.append((1000 + i, "Here: " + (" " if t.isascii() else "").join(units)))
        want.add((1000 + i, i))
    got = _found(spark, docs, all_items)
    assert len(got & want) / len(want) >= 0.95 and len(got - want) <= 2, (len(got & want), len(want), got - want)


def test_found_equals_exact_windows_of_all_items(spark):
    """Every document that holds 40 % of an item word for word, by brute force over the whole smallest tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/eval_items.parquet")
    got = {(r.doc_id, r.item_id) for r in leaks.found_leaks(docs, items).collect()}
    toks = lambda x: leaks.Tokens([leaks.LINE_LABEL.sub(" ", x)])
    held = {}
    for r in items.collect():
        t = toks(r.ref_text)
        n = t.size.sum()
        for a in range(len(t.hash)):
            b = a + 1
            while b < len(t.hash) and t.size[a:b].sum() < 0.4 * n:
                b += 1
            if t.size[a:b].sum() >= 0.4 * n:
                held.setdefault((b - a, tuple(t.hash[a:b].tolist())), set()).add(r.item_id)
    lengths = {k for k, _ in held}
    want = set()
    for r in docs.where("text is not null").collect():
        h = toks(r.text).hash.tolist()
        for k in lengths:
            for a in range(len(h) - k + 1):
                want |= {(r.doc_id, i) for i in held.get((k, tuple(h[a : a + k])), ())}
    assert want and want <= got


def test_other_names_and_numbers_are_listed_with_their_values(spark):
    items = [(i, f"The {n} ferry owes {m} harbour {c} crowns and {b} barrels of lamp oil.") for i, (n, m, c, b) in enumerate([("Deom", "Win", 490, 816), ("Hasp", "Trir", 82, 401), ("Feth", "Baln", 451, 25), ("Giar", "Stax", 104, 928)])]
    docs = [(10, "The Zorb ferry owes Klim harbour 77 crowns and 12 barrels of lamp oil."), (11, items[1][1]), (12, None)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, ref_text string")
    got = leaks.reparameterised(d, i).collect()
    assert {r.doc_id for r in got} == {10} and ("zorb | klim", "deom | win") in {(r.doc_values, r.item_values) for r in got} and _found(spark, docs, items) == {(11, 1)}
    assert leaks.reparameterised(d.limit(0), i).count() == leaks.reparameterised(d, i.limit(0)).count() == 0
