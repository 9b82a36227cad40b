"""Consensus wording of several transcribers who disagree.

The wordings of a unit are aligned to one of them; where they differ they make slots with variants. A regularised
classifier over features of a variant in its context (how often the whole table has the words so) is the prior of the
true variant, each model has a confusion matrix over kept, replaced, dropped and added words, and models that copy
another's errors are found from the errors they share. Prior, matrices and copying are fitted together by
expectation-maximisation; each round is one job over the distinct slot patterns whose result is a few numbers per model.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.one_form import LOOK_ALIKES
from turnloom.llm.shared_spans import _mix
from turnloom.session import checkpointed

ROUNDS = 12  # at most; fewer where no parameter moves by more than STILL
STILL = 2e-3
RIDGE = 1.0  # weight of the squared norm of the classifier's weights
EMPTY_RIDGE = 0.02  # further weight on the feature of empty variants, for each vote
POOL = 2.0  # how far the two rows of a confusion matrix are drawn together, in votes for each vote
FEATURE_SPAN = 3.5  # doublings by which a variant can at most be rarer than the commonest of its slot
CONFUSIONS = 12.0  # wrong variants a model could have said instead
_PLAIN = re.compile(r"[\x00-\x7e　-〿一-鿿！-／：-＠［-｀｛-～‘’“”…—·]*\Z")
_HIDDEN = re.compile("[­͏؜᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
_TOKEN = re.compile(r"[一-鿿㐀-䶿]|[^\W_一-鿿㐀-䶿]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_MIXED_OTHER = re.compile("[Ͱ-ԯ]")
_LATIN = re.compile("[a-z]")
FEATURES = 3


def wording(text: str | None) -> list[str]:
    """Words and ideographs of a text; punctuation, white space, case and variant characters are ignored."""
    if not text:
        return []
    if not _PLAIN.match(text):
        text = unicodedata.normalize("NFKC", _HIDDEN.sub("", text))
        low = text.lower()
        if _MIXED_OTHER.search(low):
            text = _LETTERS.sub(lambda m: "".join(LOOK_ALIKES.get(c, c) for c in m.group()) if _LATIN.search(m.group().lower()) and _MIXED_OTHER.search(m.group()) else m.group(), text)
    return _TOKEN.findall(text.lower())


def edits(a: list[str], b: list[str]) -> list[tuple[int, int, int, int]]:
    """(a1, a2, b1, b2) of each differing stretch of two token lists."""
    n, m, p = len(a), len(b), 0
    while p < n and p < m and a[p] == b[p]:
        p += 1
    s = 0
    while s < n - p and s < m - p and a[n - 1 - s] == b[m - 1 - s]:
        s += 1
    if p == n - s or p == m - s or (n - s - p == 1 and m - s - p == 1):
        return [(p, n - s, p, m - s)] if p < n - s or p < m - s else []
    ops = SequenceMatcher(None, a[p : n - s], b[p : m - s], autojunk=False).get_opcodes()
    return [(i1 + p, i2 + p, j1 + p, j2 + p) for tag, i1, i2, j1, j2 in ops if tag != "equal"]


@dataclass
class Slot:
    """A stretch [a, b) of the pivot where wordings differ, its variants and who says which."""

    a: int
    b: int
    variants: list[list[str]]
    voters: list[list[int]]


def slots(said: dict[int, list[str]]) -> tuple[list[str], list[Slot]]:
    """The pivot wording of a unit and its slots; ``said`` has the wording of each model that says something."""
    by = Counter(tuple(w) for w in said.values())
    if not by:
        return [], []
    joined = Counter("".join(w) for w in said.values())
    pivot = min(by, key=lambda w: (-joined["".join(w)], -by[w], w))
    pivot = list(pivot)
    spans = {m: edits(pivot, w) if w != pivot else [] for m, w in said.items()}
    marks = sorted({(i1, i2) for es in spans.values() for i1, i2, _, _ in es})
    merged: list[list[int]] = []
    for i1, i2 in marks:
        if merged and (i1 < merged[-1][1] or [i1, i2] == merged[-1]):
            merged[-1][1] = max(merged[-1][1], i2)
        else:
            merged.append([i1, i2])
    out = []
    for a, b in merged:
        groups: dict[str, tuple[list[str], list[int]]] = {}
        for m, w in said.items():
            # words added at an edge of the stretch have a slot of their own
            inside = [e for e in spans[m] if (e[0] == e[1] == a if a == b else a <= e[0] and e[1] <= b and (e[0] < e[1] or a < e[0] < b))]
            words, at = [], a
            for i1, i2, j1, j2 in inside:
                words += pivot[at:i1] + w[j1:j2]
                at = i2
            words += pivot[at:b]
            groups.setdefault("".join(words), (words, []))[1].append(m)
        if len(groups) > 1:
            out.append(Slot(a, b, [v for v, _ in groups.values()], [sorted(v) for _, v in groups.values()]))
    return pivot, out


def _hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _gram(*h: np.ndarray) -> np.ndarray:
    x = np.zeros(len(h[0]), np.uint64)
    for y in h:
        x = _mix(x * np.uint64(0xD6E8FEB86659FD93) + y)
    return x


def current_wordings(hyps: DataFrame) -> DataFrame:
    """(unit_key, models, texts): the current row of each model per unit, as arrays in order of model; one shuffle by unit."""
    rows = hyps.where(F.col("unit_key").isNotNull() & F.col("model").isNotNull()).select("unit_key", "model", "text", "loaded_at")
    rows = rows.repartition(int(hyps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "unit_key")
    now = rows.groupBy("unit_key", "model").agg(F.max(F.struct("loaded_at", "text")).alias("r"))
    said = now.groupBy("unit_key").agg(F.array_sort(F.collect_list(F.struct("model", F.col("r.text").alias("text")))).alias("said"))
    return said.select("unit_key", F.transform("said", lambda x: x["model"]).alias("models"), F.transform("said", lambda x: x["text"]).alias("texts"))


_VARIANT = "array<struct<slot:int,a:int,b:int,v:string,empty:boolean,own:boolean,voters:array<int>,g2:array<bigint>,g3:array<bigint>>>"


def _lists(values: pa.Array, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int32)), values)


def _unit_rows(units: DataFrame, models: list[str]) -> DataFrame:
    """(unit_key, pivot, models, variants): aligned units, with the n-gram keys of each variant in its context.

    The pivot's words are kept as one string with spaces, which takes a quarter of an array's room in a checkpoint.
    """
    number = {m: i for i, m in enumerate(models)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str | None, list[str]] = {None: []}
            keys, names, texts = batch.column(0), batch.column(1), batch.column(2)
            cuts = names.offsets.to_pylist()
            who, said = names.values.to_pylist(), texts.values.to_pylist()
            pivots: list[str] = []
            spoke: list[list[int]] = []
            n_var: list[int] = []
            rows: list[tuple] = []
            words: list[str] = []
            for a, b in zip(cuts, cuts[1:]):
                heard = {}
                for k in range(a, b):
                    t = said[k]
                    w = known.get(t)
                    if w is None:
                        w = known[t] = wording(t)
                    if w:
                        heard[number[who[k]]] = w
                pivot, found = slots(heard)
                before = len(rows)
                for s in found:
                    left, right = ["^", "^", *pivot][s.a : s.a + 2], [*pivot, "$", "$"][s.b : s.b + 2]
                    own = "".join(pivot[s.a : s.b])
                    for v, voters in zip(s.variants, s.voters):
                        rows.append((s.a * 2 + (s.b > s.a), s.a, s.b, " ".join(v), not v, "".join(v) == own, voters, len(words), len(v)))
                        words += left
                        words += v
                        words += right
                pivots.append(" ".join(pivot))
                spoke.append(sorted(heard))
                n_var.append(len(rows) - before)
            slot, at, end, text, empty, mine, voters, begin, size = (list(x) for x in zip(*rows)) if rows else ([] for _ in range(9))
            h = _hashes(words)
            g2 = _gram(h[:-1], h[1:]).view(np.int64) if len(h) else np.empty(0, np.int64)
            g3 = _gram(h[:-2], h[1:-1], h[2:]).view(np.int64) if len(h) else np.empty(0, np.int64)
            begin, size = np.array(begin, np.int64), np.array(size, np.int64)
            step = np.arange(int((size + 1).sum())) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1)
            two = g2[np.repeat(begin + 1, size + 1) + step]
            step = np.arange(int((size + 2).sum())) - np.repeat(np.cumsum(size + 2) - (size + 2), size + 2)
            three = g3[np.repeat(begin, size + 2) + step]
            flat = lambda x, t: pa.array([y for z in x for y in z], t)
            fields = [
                pa.array(slot, pa.int32()), pa.array(at, pa.int32()), pa.array(end, pa.int32()), pa.array(text, pa.string()), pa.array(empty, pa.bool_()), pa.array(mine, pa.bool_()),
                _lists(flat(voters, pa.int32()), [len(x) for x in voters]), _lists(pa.array(two), (size + 1).tolist()), _lists(pa.array(three), (size + 2).tolist()),
            ]
            variants = pa.StructArray.from_arrays(fields, ["slot", "a", "b", "v", "empty", "own", "voters", "g2", "g3"])
            yield pa.RecordBatch.from_arrays([keys, pa.array(pivots, pa.string()), _lists(flat(spoke, pa.int32()), [len(x) for x in spoke]), _lists(variants, n_var)], ["unit_key", "pivot", "models", "variants"])

    return units.mapInArrow(run, f"unit_key bigint, pivot string, models array<int>, variants {_VARIANT}")


def _gram_counts(aligned: DataFrame) -> DataFrame:
    """(g, n): how many units have each pair and triple of words in their pivot; counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = batch.column(0)
            pivots = pc.split_pattern(pivots.filter(pc.not_equal(pivots, "")), " ")
            if not len(pivots):
                continue
            words = pivots.flatten().dictionary_encode()
            sizes = np.diff(pivots.offsets.to_numpy())
            h = _hashes(words.dictionary.to_pylist())[words.indices.to_numpy()]
            begin, end = _hashes(["^", "$"])
            line = np.empty(len(h) + 4 * len(sizes), np.uint64)
            starts = np.cumsum(sizes + 4) - (sizes + 4)
            for k, x in ((0, begin), (1, begin)):
                line[starts + k] = x
            for k in (2, 3):
                line[starts + sizes + k] = end
            line[np.repeat(starts + 2 - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(h))] = h
            g, n = np.unique(np.concatenate([_gram(line[:-1], line[1:]), _gram(line[:-2], line[1:-1], line[2:])]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], ["g", "n"])

    return aligned.select("pivot").mapInArrow(run, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))


def slot_table(aligned: DataFrame) -> DataFrame:
    """(unit_key, slot, vs): one row per slot; each variant with its voters, whether it is empty, and its features."""
    v = aligned.select("unit_key", F.explode("variants").alias("x")).select("unit_key", "x.*")
    grams = v.select("unit_key", "slot", "v", "own", F.explode(F.concat(F.transform("g2", lambda g: F.struct(g.alias("g"), F.lit(2).alias("k"))), F.transform("g3", lambda g: F.struct(g.alias("g"), F.lit(3).alias("k"))))).alias("e")).select("unit_key", "slot", "v", "own", "e.g", "e.k")
    known = grams.join(_gram_counts(aligned), "g", "left")
    others = F.greatest(F.lit(0), F.coalesce("n", F.lit(0)) - F.col("own").cast("int"))  # without the unit itself
    log = lambda k: F.round(2 * F.avg(F.when(F.col("k") == k, F.log2(1 + others))), 0) / 2
    feats = known.groupBy("unit_key", "slot", "v").agg(log(2).alias("f2"), log(3).alias("f3"))
    full = v.select("unit_key", "slot", "v", "empty", "voters").join(feats, ["unit_key", "slot", "v"])
    packed = F.struct("voters", "empty", F.coalesce("f2", F.lit(0.0)).alias("f2"), F.coalesce("f3", F.lit(0.0)).alias("f3"), "v")
    got = full.groupBy("unit_key", "slot").agg(F.array_sort(F.collect_list(packed)).alias("vs"))
    top = lambda f: F.array_max(F.transform("vs", lambda x: x[f]))
    rel = lambda x, f: F.greatest(x[f] - top(f), F.lit(-FEATURE_SPAN)).alias(f)
    return got.select("unit_key", "slot", F.transform("vs", lambda x: F.struct(x["voters"].alias("voters"), x["empty"].alias("empty"), rel(x, "f2"), rel(x, "f3"), x["v"].alias("v"))).alias("vs"))


class Params:
    """Classifier weights, confusion matrices (true word or nothing x kept, replaced, dropped or added) and copying."""

    def __init__(self, n_models: int):
        self.w = np.array([0.0, 0.3, 0.3])
        self.kept = np.tile([0.85, 0.85], (n_models, 1))  # true is a word, true is nothing
        self.swap = np.full(n_models, 0.6)  # share of the errors on a word that replace it
        self.copy_of = np.full(n_models, -1)
        self.rho = np.zeros(n_models)
        self.rounds, self.moved = 0, np.inf  # rounds done, and the largest change in the last one


class Slots:
    """Slots of a batch laid flat: variants by slot, votes by slot and model."""

    def __init__(self, batch: pa.RecordBatch, n_models: int):
        who, empty = batch.column("who"), batch.column("empty")
        self.cuts = empty.offsets.to_numpy().astype(np.int64) - empty.offsets[0].as_py()
        self.n_slots = len(self.cuts) - 1
        self.slot = np.repeat(np.arange(self.n_slots), np.diff(self.cuts))
        self.empty = empty.flatten().to_numpy(zero_copy_only=False).astype(bool)
        self.x = np.stack([self.empty.astype(float), batch.column("f2").flatten().to_numpy(), batch.column("f3").flatten().to_numpy()], 1) if len(self.empty) else np.zeros((0, FEATURES))
        votes = who.flatten()  # one list of models for each variant
        per = np.diff(votes.offsets.to_numpy())
        self.v_of = np.repeat(np.arange(len(per)), per)
        self.m_of = votes.flatten().to_numpy().astype(np.int64)
        self.s_of = self.slot[self.v_of]
        self.n_models = n_models
        code = self.s_of * n_models + self.m_of  # a model votes once in a slot
        self.by_code = np.argsort(code, kind="stable")
        self.codes = code[self.by_code]

    def vote_of(self, slots: np.ndarray, models: np.ndarray) -> np.ndarray:
        """The variant that each model says in each slot, or -1."""
        if not len(self.codes):
            return np.full(len(slots), -1)
        want = slots * self.n_models + models
        at = np.minimum(np.searchsorted(self.codes, want), len(self.codes) - 1)
        return np.where((self.codes[at] == want) & (models >= 0), self.v_of[self.by_code[at]], -1)

    def meetings(self) -> tuple[np.ndarray, np.ndarray]:
        """Ordered pairs of different votes of one slot, as positions in the list of votes; only models that meet make any."""
        first = np.searchsorted(self.s_of, np.arange(self.n_slots + 1))  # votes stand in order of their slots
        size = np.diff(first)
        wide = size[self.s_of]
        a = np.repeat(np.arange(len(self.s_of)), wide)
        b = np.repeat(first[self.s_of] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
        return a[a != b], b[a != b]

    def _softmax(self, score: np.ndarray) -> np.ndarray:
        begin = self.cuts[:-1]
        e = np.exp(score - np.maximum.reduceat(score, begin)[self.slot])
        return e / np.add.reduceat(e, begin)[self.slot]

    def posterior(self, p: Params) -> tuple[np.ndarray, np.ndarray]:
        """Posterior and prior of every variant."""
        if not self.n_slots:
            return np.empty(0), np.empty(0)
        prior = self._softmax(self.x @ p.w)
        wide = np.diff(self.cuts)[self.s_of]  # variants in the slot of each vote
        r = np.repeat(np.arange(len(self.v_of)), wide)
        z = np.repeat(self.cuts[:-1][self.s_of] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
        m, k = self.m_of[r], self.v_of[r]
        on_word = (1 - p.kept[m, 0]) * np.where(self.empty[k], 1 - p.swap[m], p.swap[m] / CONFUSIONS)
        like = np.where(z == k, p.kept[m, self.empty[z].astype(int)], np.where(self.empty[z], (1 - p.kept[m, 1]) / CONFUSIONS, on_word))
        parent = p.copy_of[m]
        theirs = self.vote_of(self.s_of, p.copy_of[self.m_of])[r]
        like = np.where(theirs >= 0, p.rho[m] * (theirs == k) + (1 - p.rho[m]) * like, like)
        score = np.log(np.maximum(prior, 1e-12)) + np.bincount(z, np.log(np.maximum(like, 1e-12)), len(self.slot))
        return self._softmax(score), prior


_COLUMNS = {"who": "voters", "empty": "empty", "f2": "f2", "f3": "f3"}


def _flat_columns() -> list:
    return [F.col("vs")[f].alias(c) for c, f in _COLUMNS.items()]


@dataclass
class Statistics:
    """Sufficient statistics of one round; ``both`` and ``equal`` only for pairs of models that meet."""

    kept: np.ndarray
    swap: np.ndarray
    grad: np.ndarray
    hess: np.ndarray
    both: dict[tuple[int, int], float]  # (m, o): weight of the slots in which o is wrong and m speaks
    equal: dict[tuple[int, int], float]  # … and m says the same


def _statistics(patterns: DataFrame, p: Params, n_models: int) -> Statistics:
    """Statistics of one round: some numbers per model and per pair of models that meet, however many slots there are."""
    shared = patterns.sparkSession.sparkContext.broadcast(p)
    d, m_all = FEATURES, n_models
    fixed = 5 * m_all + d + d * d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, total, pairs = shared.value, np.zeros(fixed), []
        for batch in batches:
            if not batch.num_rows:
                continue
            b, n = Slots(batch, m_all), batch.column("n").to_numpy().astype(float)
            post, prior = b.posterior(q)
            on_empty = np.add.reduceat(np.where(b.empty, post, 0.0), b.cuts[:-1])
            nv, e = n[b.s_of], b.empty[b.v_of]
            count = lambda w: np.bincount(b.m_of, w, m_all)
            hit, none = nv * post[b.v_of], on_empty[b.s_of]
            kept = np.stack([count(np.where(e, 0, hit)), count(nv * (1 - none)), count(np.where(e, hit, 0)), count(nv * none)], 1)
            swap = count(np.where(e, 0, nv * (1 - none) - hit))
            x, y = b.meetings()
            code, at = np.unique(b.m_of[x] * m_all + b.m_of[y], return_inverse=True)
            wrong = nv[y] * (1 - post[b.v_of[y]])
            pairs.append((code, np.bincount(at, wrong, len(code)), np.bincount(at, np.where(b.v_of[x] == b.v_of[y], wrong, 0.0), len(code))))
            nx = n[b.slot]
            mean = np.stack([np.add.reduceat(prior * b.x[:, f], b.cuts[:-1]) for f in range(d)], 1)
            diff = b.x - mean[b.slot]
            grad = (nx * (post - prior)) @ b.x
            hess = (diff * (nx * prior)[:, None]).T @ diff
            total += np.concatenate([kept.ravel(), swap, grad, hess.ravel()])
        keys, values = [np.arange(fixed)], [total]
        if pairs:
            for k in (1, 2):
                code, at = np.unique(np.concatenate([x[0] for x in pairs]), return_inverse=True)
                keys.append(fixed + 2 * code + k - 1)
                values.append(np.bincount(at, np.concatenate([x[k] for x in pairs]), len(code)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(values).astype(float))], ["i", "x"])

    got = patterns.mapInArrow(run, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    at, x = got.column(0).to_numpy(), got.column(1).to_numpy()
    out = np.zeros(fixed)
    out[at[at < fixed]] = x[at < fixed]
    both, equal = {}, {}
    for i, v in zip((at[at >= fixed] - fixed).tolist(), x[at >= fixed].tolist()):
        (equal if i % 2 else both)[divmod(i // 2, m_all)] = v
    m = m_all
    return Statistics(out[: 4 * m].reshape(m, 4), out[4 * m : 5 * m], out[5 * m : 5 * m + d], out[5 * m + d :].reshape(d, d), both, equal)


def copying(s: Statistics, n_models: int) -> tuple[np.ndarray, np.ndarray]:
    """Whom each model copies (-1: nobody) and how often, from the errors that models share.

    Of two models the one that has the larger share of the other's errors is the copier: who copies repeats the other's
    errors and has more of its own. The strongest pairs come first; nobody copies two, and no circle is closed. Names
    count only between exact ties.
    """
    share = {k: s.equal.get(k, 0.0) / v for k, v in s.both.items() if v > 5}
    copy_of, rho = np.full(n_models, -1), np.zeros(n_models)
    known = [v for v in share.values() if v > 0]
    base = float(np.median(known)) if known else 0.0
    for (a, b), v in sorted(share.items(), key=lambda x: (-x[1], x[0])):
        if v <= max(0.4, 2 * base):
            break
        top = b
        while top >= 0 and top != a:
            top = copy_of[top]
        if copy_of[a] < 0 and top < 0:
            copy_of[a], rho[a] = b, min(0.98, (v - base) / (1 - base))
    return copy_of, rho


def fit(table: DataFrame, n_models: int, rounds: int = ROUNDS) -> Params:
    """Expectation-maximisation over all slots until the parameters stand still; slots of one pattern are counted once with their number."""
    patterns = checkpointed(table.select(*_flat_columns()).groupBy(*_COLUMNS).agg(F.count(F.lit(1)).alias("n")))
    p = Params(n_models)
    for p.rounds in range(1, rounds + 1):
        s = _statistics(patterns, p, n_models)
        kept, swap, before = s.kept, s.swap, np.concatenate([p.kept.ravel(), p.swap, p.w, p.rho])
        # both kinds of truth are drawn to the model's own accuracy: else a model that seldom adds words can make its
        # additions true by itself, and the others' silence a loss
        own = (kept[:, 0] + kept[:, 2] + 8.5) / (kept[:, 1] + kept[:, 3] + 10)
        weight = POOL * (kept[:, 1] + kept[:, 3])
        p.kept = np.clip(np.stack([(kept[:, 0] + weight * own + 8.5) / (kept[:, 1] + weight + 10), (kept[:, 2] + weight * own + 8.5) / (kept[:, 3] + weight + 10)], 1), 0.02, 0.995)
        p.swap = np.clip((swap + 3) / (np.maximum(0.0, kept[:, 1] - kept[:, 0]) + 5), 0.05, 0.95)
        ridge = np.array([RIDGE + EMPTY_RIDGE * kept[:, 1::2].sum(), RIDGE, RIDGE])  # being empty alone says little
        p.w = p.w + np.linalg.solve(s.hess + np.diag(ridge), s.grad - ridge * p.w)
        p.copy_of, p.rho = copying(s, n_models)
        p.moved = float(np.abs(np.concatenate([p.kept.ravel(), p.swap, p.w, p.rho]) - before).max()) if n_models else 0.0
        if p.moved <= STILL:
            break
    return p


@dataclass
class Consensus:
    """The fitted model and its tables."""

    models: list[str]
    params: Params
    aligned: DataFrame
    table: DataFrame


def consensus(hyps: DataFrame, rounds: int = ROUNDS) -> Consensus:
    """Align, count, fit. Null, empty and blank texts abstain; a unit that nobody heard has an empty wording."""
    models = [r.model for r in hyps.where("model is not null").select("model").distinct().orderBy("model").collect()]  # the annotators
    aligned = checkpointed(_unit_rows(current_wordings(hyps), models))
    table = checkpointed(slot_table(aligned))
    return Consensus(models, fit(table, len(models), rounds), aligned, table)


def _decide(c: Consensus) -> DataFrame:
    """(unit_key, slot, v, wrong, sure): the chosen variant of each slot, the models that say another, its posterior."""
    shared, n_models = c.table.sparkSession.sparkContext.broadcast(c.params), len(c.models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            b = Slots(batch, n_models)
            post, _ = b.posterior(shared.value)
            top = np.maximum.reduceat(post, b.cuts[:-1])
            best = np.flatnonzero(post == top[b.slot])
            z = best[np.unique(b.slot[best], return_index=True)[1]]  # the first of equals
            bad = b.v_of != z[b.s_of]
            wrong = _lists(pa.array(b.m_of[bad].astype(np.int32)), np.bincount(b.s_of[bad], minlength=b.n_slots).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("unit_key"), batch.column("slot"), batch.column("v").flatten().take(pa.array(z)), wrong, pa.array(post[z])], ["unit_key", "slot", "v", "wrong", "sure"])

    flat = c.table.select("unit_key", "slot", F.col("vs")["v"].alias("v"), *_flat_columns())
    return flat.mapInArrow(run, "unit_key bigint, slot int, v string, wrong array<int>, sure double")


def found_wrong(hyps: DataFrame) -> DataFrame:
    """(unit_key, model): the current rows whose wording differs from the consensus wording of their unit."""
    c = consensus(hyps)
    names = F.array(*[F.lit(m) for m in c.models]) if c.models else F.array(F.lit(""))
    return _decide(c).select("unit_key", F.explode("wrong").alias("m")).distinct().select("unit_key", F.element_at(names, F.col("m") + 1).alias("model"))


def consensus_wordings(hyps: DataFrame) -> DataFrame:
    """(unit_key, wording, n_models, agreement, sure): the consensus of each unit.

    ``agreement`` is the share of speaking models whose whole wording equals the consensus (null where none speaks),
    ``sure`` the least posterior of a slot (1 where all agree).
    """
    c = consensus(hyps)
    chosen = _decide(c).groupBy("unit_key").agg(F.collect_list(F.struct("slot", "v")).alias("chosen"), F.array_distinct(F.flatten(F.collect_list("wrong"))).alias("wrong"), F.min("sure").alias("sure"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for u, pivot, models, variants, chosen, wrong, sure in zip(pdf["unit_key"].tolist(), pdf["pivot"], pdf["models"], pdf["variants"], pdf["chosen"], pdf["wrong"], pdf["sure"]):
                words = pivot.split()
                pick = {x["slot"]: x["v"] for x in chosen} if chosen is not None else {}
                span = {x["slot"]: (x["a"], x["b"]) for x in variants}
                for s in sorted(pick, reverse=True):
                    a, b = span[s]
                    words[a:b] = pick[s].split()
                n = len(models)
                bad = 0 if wrong is None else len(wrong)
                text = "".join((" " if k and w[0].isascii() and words[k - 1][-1].isascii() else "") + w for k, w in enumerate(words))
                rows.append((u, text, n, (n - bad) / n if n else None, 1.0 if pd.isna(sure) else sure))
            yield pd.DataFrame(rows, columns=["unit_key", "wording", "n_models", "agreement", "sure"])

    return c.aligned.join(chosen, "unit_key", "left").mapInPandas(run, "unit_key bigint, wording string, n_models int, agreement double, sure double")


def reliability(hyps: DataFrame) -> DataFrame:
    """(model, n_rows, n_wrong, accuracy, kept_words, kept_silence, copies, copied_share): one row per annotator."""
    c = consensus(hyps)
    p = c.params
    rows = [(m, float(p.kept[i, 0]), float(p.kept[i, 1]), c.models[p.copy_of[i]] if p.copy_of[i] >= 0 else None, float(p.rho[i])) for i, m in enumerate(c.models)]
    spark = hyps.sparkSession
    stats = spark.createDataFrame(rows, "model string, kept_words double, kept_silence double, copies string, copied_share double")
    names = F.array(*[F.lit(m) for m in c.models]) if c.models else F.array(F.lit(""))
    spoke = c.aligned.select(F.explode("models").alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n_rows"))
    wrong = _decide(c).select("unit_key", F.explode("wrong").alias("m")).distinct().groupBy("m").agg(F.count(F.lit(1)).alias("n_wrong"))
    counts = spoke.join(wrong, "m", "left").select(F.element_at(names, F.col("m") + 1).alias("model"), "n_rows", F.coalesce("n_wrong", F.lit(0)).alias("n_wrong"))
    return stats.join(F.broadcast(counts), "model", "left").select("model", "n_rows", "n_wrong", F.round(1 - F.col("n_wrong") / F.col("n_rows"), 6).alias("accuracy"), "kept_words", "kept_silence", "copies", "copied_share")
