import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnloom.operators.intervals import combine_summaries, gaps, label_periods, periods, union_overlap, valid_times


def brute(rows):
    out, holes = [], []
    by = {}
    for m, s, e in rows:
        if m is not None and s is not None and e is not None and e > s:
            by.setdefault(m, []).append((s, e))
    for m, xs in by.items():
        top = begun = None
        n = 0
        for s, e in sorted(xs):
            if top is None or s > top:
                if top is not None:
                    out.append((m, begun, top, n))
                    holes.append((m, top, s))
                begun, top, n = s, e, 0
            n += 1
            top = max(top, e)
        out.append((m, begun, top, n))
    return sorted(out), sorted(holes)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_periods_equal_brute_force_with_a_hot_entity(spark, partitions):
    rnd = random.Random(partitions)
    rows = [("hot" if rnd.random() < 0.5 else f"m{rnd.randint(0, 6)}", a := rnd.randint(0, 3000), a + rnd.randint(1, 40)) for _ in range(400)]
    rows += [("hot", 0, 2500), (None, 1, 2), ("x", None, 3), ("x", 5, 5), ("m1", 7, 3)] + rows[:20]
    df = spark.createDataFrame([(*r, "k") for r in rows], "m string, s bigint, e bigint, entity string")
    lab = label_periods(df, "m", "s", "e", partitions)
    want, holes = brute(rows)
    assert sorted(map(tuple, periods(lab, "m").collect())) == want
    assert sorted(map(tuple, gaps(lab, "m").collect())) == holes


def test_empty_table_gives_nothing(spark):
    lab = label_periods(spark.createDataFrame([], "m string, s bigint, e bigint"), "m", "s", "e", 2)
    assert periods(lab, "m").count() == 0 and gaps(lab, "m").count() == 0


def test_touching_turns_leave_no_silence(spark):
    lab = label_periods(spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 21, 30)], "m string, s bigint, e bigint"), "m", "s", "e", 2)
    assert [tuple(r) for r in gaps(lab, "m").collect()] == [("a", 20, 21)]


def test_valid_times(spark):
    rows = [(0.0, 1.0), (float("nan"), 1.0), (0.0, float("inf")), (2.0, 1.0), (0.0, 0.005), (None, 1.0), (0.0, 0.01)]
    assert valid_times(spark.createDataFrame(rows, "start_s double, end_s double")).count() == 2


def test_carry_bridges_partitions():
    carry = combine_summaries([(0, "a", "a", 100, 0), (1, "a", "a", 60, 50), (2, "a", "b", 9, 5)])
    assert carry == {1: ("a", 100, 0), 2: ("a", 100, 0)}


def test_union_overlap_counts_each_moment_once(spark):
    spans = spark.createDataFrame([(1, "m", 0, 100_000, "x"), (2, "m", 200_000, 200_010, None)], "k bigint, m string, start_ms bigint, end_ms bigint, who string")
    pieces = spark.createDataFrame([("m", 10_000, 30_000, "y"), ("m", 20_000, 40_000, "z"), ("m", 50_000, 300_000, "x"), ("m", 90_000, 260_000, "y")], "m string, start_ms bigint, end_ms bigint, who string")
    got = dict(union_overlap(spans, pieces, "m", "k", "who").collect())
    assert got == {1: 40_000, 2: 10}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(1, 20)), min_size=1, max_size=40), st.integers(1, 5))
def test_combining_equals_one_scan(rows, n):
    import numpy as np

    rows = sorted((m, s, s + d) for m, s, d in rows)
    cut = [rows[len(rows) * i // n : len(rows) * (i + 1) // n] for i in range(n)]
    sums = []
    for pid, part in enumerate(cut):
        if part:
            last = part[-1][0]
            own = [(s, e) for m, s, e in part if m == last]
            top, begun = None, None
            for s, e in own:
                if top is None or s > top:
                    begun = s
                top = e if top is None else max(top, e)
            sums.append((pid, part[0][0], last, top, begun))
    carry = combine_summaries(sums)
    for pid, part in enumerate(cut):
        if part and pid in carry:
            m, top, begun = carry[pid]
            before = [r for p in cut[:pid] for r in p if r[0] == m]
            assert top == max(e for _, _, e in before)
            want, _ = brute(before)
            assert begun == want[-1][1]
    assert np.all(True)
