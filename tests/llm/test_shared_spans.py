"""Shared spans: repeats, hot groups and copies."""

import random

from turnloom.llm import shared_spans


def test_repeated_documents_keep_links(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    part = word(900)
    docs = [(1, word(200) + part + word(150)), (2, word(90) + part + word(260)), (3, word(1000)), (4, word(40) + part[100:600] + word(700))]
    docs.append((5, docs[1][1]))
    df = spark.createDataFrame([*docs, docs[0], docs[0], docs[2], docs[1]], "doc_id bigint, text string")
    once = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(map(tuple, shared_spans.found_shared(df).collect())) == [(1, 2), (1, 4), (1, 5), (2, 4), (2, 5), (4, 5)]
    for f in (shared_spans.shared_share, shared_spans.copy_classes):
        assert sorted(map(tuple, f(df).collect())) == sorted(map(tuple, f(once).collect()))


def test_hot_groups_are_paired_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    notice, other = word(500), word(800)
    docs = [(i, notice + word(120)) for i in range(40)] + [(100 + i, word(50) + other) for i in range(3)] + [(200 + i, other) for i in range(25)] + [(300, word(900)), (301, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = {(a, b) for a in range(40) for b in range(a + 1, 40)} | {(a, b) for a in [*range(100, 103), *range(200, 225)] for b in [*range(100, 103), *range(200, 225)] if a < b}
    whole = [tuple(r) for r in shared_spans.found_shared(df).collect()]
    monkeypatch.setattr(shared_spans.pairs_in_blocks, "__defaults__", (6,))
    monkeypatch.setattr(shared_spans._with_copies, "__defaults__", (6,))
    parts = [tuple(r) for r in shared_spans.found_shared(df).collect()]
    assert len(whole) == len(set(whole)) and len(parts) == len(set(parts)) and set(whole) == set(parts) == want
    members = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 5)], "k bigint, doc_id bigint")
    assert sorted(map(tuple, shared_spans.pairs_in_blocks(members, ["k"], 7).collect())) == [(a, b) for a in range(100) for b in range(a + 1, 100)]


def test_stretches_have_their_places(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    x, y = word(450), word(320)
    a, b, c = word(77) + "#" + x + "!" + word(100) + "?" + y, "%" + x + "&" + word(40), y + "=" + word(400)
    df = spark.createDataFrame([(1, a), (2, b), (3, c), (4, ""), (5, None)], "doc_id bigint, text string")
    assert sorted(map(tuple, shared_spans.shared_stretches(df).collect())) == [(1, 78, 528), (1, 630, 950), (2, 1, 451), (3, 0, 320)]
