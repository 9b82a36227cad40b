"""Evaluation passages inside corpus documents, by template canonicalisation.

Texts become tokens (words, single ideographs, numbers; case, width and invisible characters folded). Tokens that the
items share become the literals of templates, numbers and all other runs become typed placeholders. Template windows
are hash-joined in two ways of binding their slots:

* one slot at a time (template and the value of one slot), of which a pair needs two that agree: these survive edits
  of the other slots;
* all slots at once: a stretch of tokens of a given weight, whatever is literal or slot in it. These need no wording
  that items share, so one item, or items that are all unlike, are found as well. A stretch that many items hold
  (template text alone) is joined at twice its weight instead, so none is dropped.

The passage is then aligned in order and its slots are checked for consistency: sentences of one build with other names
and numbers fall out of ``found_leaks`` (``reparameterised`` lists them with their values), quotes with replaced words
or labels inside stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared_spans import _mix, _powers
from turnloom.session import checkpointed

WINDOW = 5  # elements of a window
BLOCK = 1 << 20
#: Share of the items of one script that hold a word or a pair of ideographs from which it counts as template text.
LITERAL_SHARE = 0.1
#: Weight of a stretch with all slots bound (words and numbers weigh 2, ideographs 1): four words or eight ideographs
#: stand unbroken in any 40 % of an item of 110 characters, even with one word in seven or one ideograph in ten replaced.
STRETCH = 8
#: Item keys up to which they are broadcast to the documents' windows, and bytes of candidates up to which they are broadcast to the documents.
BROADCAST_ROWS = 2_000_000
CANDIDATE_BYTES = 16 << 20
ITEM_BYTES = 16 << 20  # bytes of items' texts up to which they are broadcast
REPLACED = 7  # tokens of which one may be replaced in a passage that agrees in fewer than two slots
KNOWN_ITEMS = 10_000  # items whose tokens a task keeps at a time
_SEP, _HAN, _WORD, _NUM, _SKIP = 0, 1, 2, 3, 4
_C_NUM, _C_NAME = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
#: Labels at the head of a line that may stand inside a quoted passage.
LINE_LABEL = re.compile(r"(?m)(?:^|(?<=\n))[ \t]*(?:[-*•>#]+[ \t]+)?(?:[\[(（【]?\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d+)?[\])）】]?[ \t]*[-|]?[ \t]*)?(?:(?:speaker|spk|s|说话人|发言人)[_ \-]?\d+[ \t]*[:：>][ \t]*|[QA问答][:：][ \t]*)?", re.I)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Folded code point and class of each code point."""
    n = 0x30000
    fold, kind = np.arange(n, dtype=np.uint32), np.zeros(n, np.uint8)
    for o in range(n):
        if 0xD800 <= o <= 0xDFFF or (0xE000 <= o <= 0xF8FF):
            continue
        ch = chr(o)
        if 0x3400 <= o <= 0x9FFF or 0x20000 <= o <= 0x2FFFF and o < 0x2F800:
            kind[o] = _HAN
            continue
        if 0xAC00 <= o <= 0xD7A3:
            kind[o] = _HAN
            continue
        f = unicodedata.normalize("NFKC", ch).lower()
        if len(f) == 1:
            fold[o] = ord(f)
        elif unicodedata.normalize("NFKC", f)[:1] and unicodedata.category(ch)[0] in "LN":
            fold[o] = ord(f[0])
        c = unicodedata.category(chr(int(fold[o])))
        p = int(fold[o])
        if c in ("Mn", "Me", "Cf"):
            kind[o] = _SKIP
        elif 0x3400 <= p <= 0x9FFF or 0x3041 <= p <= 0x30FF:
            kind[o] = _HAN
        elif c[0] == "L" or c == "Mc":
            kind[o] = _WORD
        elif c[0] == "N":
            kind[o] = _NUM
    return fold, kind


class Tokens:
    """Tokens of a block of texts: number of the text, hash, kind and length of each."""

    def __init__(self, texts: list[str]):
        texts = [unicodedata.normalize("NFKC", t) if "ﬁ" in t or "ﬂ" in t else t for t in texts]
        fold, kind = _tables()
        cp = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        cp = np.minimum(cp, 0x2FFFF)
        k = kind[cp]
        stay = k != _SKIP
        doc_end = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        if not stay.all():
            upto = np.concatenate([[0], np.cumsum(stay)])
            doc_end = upto[np.minimum(doc_end, len(cp))]
            cp, k = cp[stay], k[stay]
        f = fold[cp]
        n = len(f)
        start = np.zeros(n, bool)
        if n:
            start[0] = k[0] != _SEP
            start[1:] = (k[1:] != _SEP) & ((k[1:] != k[:-1]) | (k[1:] == _HAN))
        s = np.flatnonzero(start)
        stop = np.zeros(n + 1, bool)
        stop[s] = True
        edge = np.flatnonzero(stop | np.concatenate([k == _SEP, [True]]))
        e = edge[np.searchsorted(edge, s, side="right")] if len(s) else s
        v = _mix(f.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        sums = np.zeros(n + 1, np.uint64)
        within = np.zeros(n, np.int64)
        if len(s):
            size = e - s
            flat = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            within[flat] = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        np.cumsum(_mix(v + (within.astype(np.uint64) << np.uint64(20))), out=sums[1:])
        self.hash = _mix(sums[e] - sums[s]) if len(s) else np.empty(0, np.uint64)
        self.kind = k[s] if len(s) else np.empty(0, np.uint8)
        self.size = e - s
        self.doc = np.searchsorted(doc_end, s, side="right")
        self.n_texts = len(texts)
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))
        self.spans, self.folded = (s, e), f

    def words(self, a: int, b: int) -> str:
        """The folded text of the tokens [a, b); ideographs without spaces between them."""
        out = []
        for k in range(a, b):
            w = "".join(map(chr, self.folded[self.spans[0][k] : self.spans[1][k]].tolist()))
            out.append(w if not out or self.kind[k] == _HAN and self.kind[k - 1] == _HAN else " " + w)
        return "".join(out)


def _units(t: Tokens) -> np.ndarray:
    """Words by their own hash, ideographs by the pair they begin (numbers as one type); 0 where nothing is counted."""
    h = np.where(t.kind == _NUM, _C_NUM, t.hash)
    out = np.where(t.kind == _WORD, t.hash, np.uint64(0))
    if len(h) > 1:
        pair = _mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        han = ((t.kind[:-1] == _HAN) | (t.kind[1:] == _HAN)) & (t.doc[1:] == t.doc[:-1]) & (t.kind[:-1] != _WORD) & (t.kind[1:] != _WORD)
        pairs = np.concatenate([np.where(han, pair, np.uint64(0)), np.zeros(1, np.uint64)])
        return np.where(t.kind == _WORD, out, pairs)
    return out


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values) or not len(x):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


class Keys:
    """A set of hashes: a table of their low bits first, then the sorted values."""

    def __init__(self, values: np.ndarray):
        self.values, self.low = values, np.uint64((1 << 22) - 1)
        self.table = np.zeros(1 << 22, bool)
        self.table[(values & self.low).astype(np.int64)] = True

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = self.table[(x & self.low).astype(np.int64)]
        at = np.flatnonzero(out)
        out[at] = _member(self.values, x[at])
        return out


def is_literal(t: Tokens, literals: np.ndarray) -> np.ndarray:
    """Which tokens are template text."""
    u = _member(literals, _units(t))
    han = u & (t.kind != _WORD)
    return u & (t.kind == _WORD) | (t.kind == _HAN) & (han | np.concatenate([[False], han[:-1]]))


@dataclass
class Elements:
    """Elements of a block: literals, numbers (type 1) and runs of other tokens (type 2), with the windows that hold two literals and a slot."""

    text: np.ndarray  # number of the text of each element
    begin: np.ndarray  # its first token, and the one after its last
    end: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    at: np.ndarray  # first element of each window
    template: np.ndarray


def elements(t: Tokens, literals: np.ndarray, templates: Keys | None = None) -> Elements | None:
    """The elements and template windows of a block (only those with these templates, if given); null where there is none."""
    if not len(t.hash):
        return None
    lit, num = is_literal(t, literals), t.kind == _NUM
    name = ~lit & ~num
    new_doc = np.concatenate([[True], t.doc[1:] != t.doc[:-1]])
    begin = ~name | new_doc | np.concatenate([[True], ~name[:-1]])
    s = np.flatnonzero(begin)
    e = np.concatenate([s[1:], [len(name)]])
    doc, typ = t.doc[s], np.where(lit[s], 0, np.where(num[s], 1, 2))
    rel = np.arange(len(name)) - np.repeat(s, e - s)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(t.hash + (rel.astype(np.uint64) << np.uint64(17))))])
    value = _mix(sums[e] - sums[s])
    shape = np.where(typ == 0, t.hash[s], np.where(typ == 1, _C_NUM, _C_NAME))
    n = len(s) - WINDOW + 1
    if n <= 0:
        return None
    tmpl = np.zeros(n, np.uint64)
    lits = np.zeros(n, np.int64)
    for j in range(WINDOW):
        tmpl = tmpl * np.uint64(0xD6E8FEB86659FD93) + _mix(shape[j : j + n])
        lits += typ[j : j + n] == 0
    at = np.flatnonzero((doc[:n] == doc[WINDOW - 1 :]) & (lits >= 2) & (lits < WINDOW))
    tmpl = _mix(tmpl[at])
    if templates is not None:
        keep = templates.holds(tmpl)
        at, tmpl = at[keep], tmpl[keep]
    return Elements(doc, s, e, typ, value, at, tmpl)


def windows(t: Tokens, literals: np.ndarray, templates: Keys | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, key, token position in the text, template) of each slot of each template window: its template and one value."""
    x = elements(t, literals, templates)
    if x is None:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64))
    docs, keys, places, shapes = [], [], [], []
    for j in range(WINDOW):
        slot = x.kind[x.at + j] > 0
        a, m = x.at[slot], x.template[slot]
        keys.append(_mix(m + x.value[a + j] * np.uint64(2 * j + 3)))
        docs.append(x.text[a])
        places.append(x.begin[a + j] - t.first[x.text[a]])
        shapes.append(m)
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(places), np.concatenate(shapes)


def slot_values(t: Tokens, literals: np.ndarray, templates: Keys | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(text number, template, key of all values, token position, values joined by a bar) of each template window.

    ``templates``: only windows with these templates, or null for all.
    """
    x = elements(t, literals, templates)
    if x is None:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, []
    at, tmpl = x.at, x.template
    bound = tmpl.copy()
    for j in range(WINDOW):
        bound = np.where(x.kind[at + j] > 0, _mix(bound * np.uint64(0xD6E8FEB86659FD93) + x.value[at + j]), bound)
    values = [" | ".join(t.words(x.begin[a + j], x.end[a + j]) for j in range(WINDOW) if x.kind[a + j] > 0) for a in at.tolist()]
    return x.text[at], tmpl, bound, x.begin[at] - t.first[x.text[at]], values


def _weights(t: Tokens) -> np.ndarray:
    return np.where(t.kind == _HAN, 1, 2)


def stretches(t: Tokens, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, valid) of the shortest stretch of at least ``weight`` that begins at each token, its tokens all bound."""
    n = len(t.hash)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, bool)
    upto = np.concatenate([[0], np.cumsum(_weights(t))])
    last = np.searchsorted(upto, upto[:-1] + weight) - 1  # the token that fills the stretch
    ok = last < n
    last = np.minimum(last, n - 1)
    ok &= t.doc[last] == t.doc
    up, down = _powers(1 << max(20, n.bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t.hash * down[:n])])
    a, b = np.arange(n), last + 1
    return _mix((sums[b] - sums[a]) * up[b] + np.uint64(weight)), ok


def _base_weight(total: np.ndarray, least: float) -> np.ndarray:
    """The weight of an item's stretches: STRETCH, less for items of which ``least`` is shorter than that."""
    room = least * total
    return np.where(room >= STRETCH, STRETCH, np.where(room >= STRETCH // 2, STRETCH // 2, 2))


def _blocks(ids: list, texts: list) -> Iterator[tuple[list, list[str]]]:
    size, a, b = 0, [], []
    for i, x in zip(ids, texts):
        if not x:
            continue
        x = LINE_LABEL.sub(" ", x)
        if size and size + len(x) > BLOCK:
            yield a, b
            size, a, b = 0, [], []
        a.append(i)
        b.append(x)
        size += len(x)
    if a:
        yield a, b


def _sorted_keys(df: DataFrame, column: str) -> np.ndarray:
    """A column of hashes as a sorted array, through Arrow."""
    got = df.select(column).distinct().toArrow().column(0)
    return np.unique(np.asarray(got.to_numpy(), np.int64).view(np.uint64)) if len(got) else np.empty(0, np.uint64)


def _literals(items: DataFrame) -> np.ndarray:
    """Hashes of template words and pairs of ideographs; at most item length / LITERAL_SHARE of each script's items."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, texts in _blocks(pdf["item_id"].tolist(), pdf["ref_text"].tolist()):
                t = Tokens(texts)
                han = np.bincount(t.doc, weights=t.kind == _HAN, minlength=len(ids)) > np.bincount(t.doc, weights=t.kind == _WORD, minlength=len(ids))
                u = _units(t)
                x = pd.DataFrame({"item_id": np.asarray(ids)[t.doc], "han": han[t.doc], "u": u.view(np.int64)})
                yield x[x["u"] != 0].drop_duplicates()

    rows = items.mapInPandas(run, "item_id bigint, han boolean, u bigint")
    total = rows.groupBy("han").agg(F.count_distinct("item_id").alias("n"))
    often = rows.groupBy("han", "u").agg(F.count_distinct("item_id").alias("df")).join(total, "han").where(F.col("df") >= F.greatest(F.lit(3), F.col("n") * LITERAL_SHARE))
    return _sorted_keys(often, "u")


def _item_keys(items: DataFrame, literals, least: float) -> DataFrame:
    """(item_id, k, shape, bound): keys of each item's windows; where all slots are ``bound``, shape is the weight, else the template.

    A stretch that more than LITERAL_SHARE of the items hold (and more than four) is taken at twice its weight, however
    many items hold that; only a text too short for it keeps the short one.
    """

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, block in _blocks(pdf["item_id"].tolist(), pdf["ref_text"].tolist()):
                doc, k, _, t = windows(Tokens(block), literals.value)
                yield pd.DataFrame({"item_id": np.asarray(ids, np.int64)[doc], "k": k.view(np.int64), "shape": t.view(np.int64)})

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, block in _blocks(pdf["item_id"].tolist(), pdf["ref_text"].tolist()):
                t = Tokens(block)
                total = np.bincount(t.doc, weights=_weights(t), minlength=len(ids))
                base = _base_weight(total, least)[t.doc]
                keys = {w: stretches(t, w) for w in sorted({*base.tolist(), *(2 * base).tolist()})}
                k, k2, ok = np.zeros(len(base), np.uint64), np.zeros(len(base), np.uint64), np.zeros(len(base), bool)
                for w in set(base.tolist()):
                    at = base == w
                    k[at], ok[at] = keys[w][0][at], keys[w][1][at]
                    k2[at] = np.where(keys[2 * w][1], keys[2 * w][0], np.uint64(0))[at]
                short = (total[t.doc] < 2 * base)[ok]
                yield pd.DataFrame({"item_id": np.asarray(ids, np.int64)[t.doc][ok], "k": k[ok].view(np.int64), "k2": k2[ok].view(np.int64), "short": short, "w": base[ok].astype(np.int64)})

    one = items.mapInPandas(slots, "item_id bigint, k bigint, shape bigint").withColumn("bound", F.lit(False))
    rows = items.mapInPandas(whole, "item_id bigint, k bigint, k2 bigint, short boolean, w bigint")
    often = rows.groupBy("k").agg(F.count_distinct("item_id").alias("df"))
    most = F.greatest(F.lit(4.0), F.lit(LITERAL_SHARE * items.count()))
    near = (F.col("df") <= most) | F.col("short")
    taken = F.when(near, F.col("k")).otherwise(F.nullif("k2", F.lit(0)))
    every = rows.join(often, "k").select("item_id", taken.alias("k"), F.when(near, F.col("w")).otherwise(2 * F.col("w")).alias("shape"), F.lit(True).alias("bound")).where("k is not null")
    return one.unionByName(every).distinct()


def _document_keys(docs: DataFrame, literals, known, weights: list[int]) -> DataFrame:
    """(doc_id, k, p): keys of the windows of each document; only those of items if ``known`` (templates, keys) is given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates, wanted = map(Keys, known.value) if known is not None else (None, None)
        for pdf in batches:
            for ids, block in _blocks(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                t = Tokens(block)
                found = [windows(t, literals.value, templates)[:3]]
                for w in weights:
                    h, ok = stretches(t, w)
                    at = np.flatnonzero(ok if wanted is None else ok & wanted.holds(h))
                    found.append((t.doc[at], h[at], at - t.first[t.doc[at]]))
                doc, k, p = (np.concatenate(x) for x in zip(*found))
                if wanted is not None:
                    hit = wanted.holds(k)
                    doc, k, p = doc[hit], k[hit], p[hit]
                yield pd.DataFrame({"doc_id": np.asarray(ids, np.int64)[doc], "k": k.astype(np.uint64).view(np.int64), "p": p.astype(np.int32)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, k bigint, p int")


def aligned_share(item: tuple[list, list, list], doc: list, penalty: float = 2.0, agree: float = 0.6) -> float:
    """Share of the item's letters and digits that the best passage of ``doc`` covers in order, replaced words included.

    ``item``: hash, length and whether it is a slot, of each token. Matched runs are chained; a gap costs ``penalty``
    tokens for each token replaced or left out, so that a passage with more than one token in three replaced breaks up. Of the slots in the passage at least the share ``agree`` must be the same, else it is another
    sentence of the same build; where fewer than two do, at most one token in REPLACED may be replaced.
    """
    toks, sizes, slots = item
    upto = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    slots_upto = np.concatenate([[0], np.cumsum(slots)]).tolist()
    blocks = [b for b in SequenceMatcher(None, toks, doc, autojunk=False).get_matching_blocks() if b.size]
    best, score, begin, prev, lost, same, swapped = 0.0, 0.0, 0, None, 0.0, 0, 0
    for a, b, n in blocks:
        if prev is not None:
            ga, gb = a - prev[0], b - prev[1]
            cost = penalty * max(ga, min(gb, ga + 1))
            if score - cost > 0:
                score -= cost
                swapped += ga
                lost += upto[a] - upto[prev[0]] if ga > gb + 1 else 0.0
            else:
                score, begin, lost, same, swapped = 0.0, a, 0.0, 0, 0
        else:
            begin = a
        score += n
        same += slots_upto[a + n] - slots_upto[a]
        prev = (a + n, b + n)
        if same >= agree * (slots_upto[a + n] - slots_upto[begin]) and (same >= 2 or swapped * REPLACED <= a + n - begin):
            best = max(best, upto[a + n] - upto[begin] - lost)
    return best / max(1.0, upto[-1])


def candidates(docs: DataFrame, items: DataFrame, literals, least: float = 0.4) -> DataFrame:
    """(doc_id, item_id, places): pairs with a stretch of all slots bound, or two windows with one slot bound, that agree."""
    spark = docs.sparkSession
    item_keys = checkpointed(_item_keys(items, literals, least))
    n = item_keys.count()
    small = n <= BROADCAST_ROWS  # else every window of the documents goes to the join
    known = spark.sparkContext.broadcast((_sorted_keys(item_keys.where("not bound"), "shape"), _sorted_keys(item_keys, "k"))) if small else None
    weights = [r.shape for r in item_keys.where("bound").select("shape").distinct().collect()]  # a few weights
    doc_keys = _document_keys(docs.where(F.col("doc_id").isNotNull()), literals, known, sorted(weights))
    item_keys = item_keys.select("item_id", "k", "bound")
    hit = doc_keys.join(F.broadcast(item_keys) if small else item_keys, "k")
    got = hit.groupBy("doc_id", "item_id").agg(F.collect_set("p").alias("places"), F.bool_or("bound").alias("bound"))
    return got.where((F.size("places") >= 2) | F.col("bound")).select("doc_id", "item_id", "places")


def _readable(items: DataFrame) -> DataFrame:
    return items.where(F.col("item_id").isNotNull() & (F.length("ref_text") > 0)).select("item_id", "ref_text").dropDuplicates(["item_id"])


def found_leaks(docs: DataFrame, items: DataFrame, least: float = 0.4) -> DataFrame:
    """(doc_id, item_id): documents that hold a passage with at least ``least`` of the item's wording.

    Null, empty and blank texts hold nothing; items without any letter or digit leak nowhere; any number of items will
    do, and they need not have wording in common. The eval items of a candidate are read by a join, so neither table is
    gathered.
    """
    return scored_leaks(docs, items, least).where(F.col("share") >= least).select("doc_id", "item_id")


def scored_leaks(docs: DataFrame, items: DataFrame, least: float = 0.4) -> DataFrame:
    """(doc_id, item_id, share) of the candidates."""
    items = _readable(items)
    literals = docs.sparkSession.sparkContext.broadcast(_literals(items))
    c = candidates(docs, items, literals, least)
    spark = docs.sparkSession
    near = (items.select(F.sum(F.octet_length("ref_text") + 64)).first()[0] or 0) <= ITEM_BYTES  # else their texts travel with the candidates
    refs = spark.sparkContext.broadcast({r.item_id: r.ref_text for r in items.collect()}) if near else None
    c = c.withColumn("ref_text", F.lit(None).cast("string")) if near else c.join(items, "item_id")
    wanted = checkpointed(c.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "places", "ref_text")).alias("cands")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[list, list, list]] = {}
        for pdf in batches:
            out = []
            for d, text, cands in zip(pdf["doc_id"], pdf["text"], pdf["cands"]):
                toks = Tokens([LINE_LABEL.sub(" ", text)]).hash.tolist()
                for cand in cands:
                    ref = refs.value[cand["item_id"]] if refs is not None else cand["ref_text"]
                    if ref not in known:
                        if len(known) >= KNOWN_ITEMS:
                            known.clear()
                        t = Tokens([LINE_LABEL.sub(" ", ref)])
                        known[ref] = (t.hash.tolist(), t.size.tolist(), (~is_literal(t, literals.value)).tolist())
                    item, share = known[ref], 0.0
                    n, places = len(item[0]), sorted(cand["places"])
                    a = places[0]
                    for k, p in enumerate(places):
                        if k + 1 == len(places) or places[k + 1] - p > n:
                            share = max(share, aligned_share(item, toks[max(0, a - n) : p + n]))
                            a = places[k + 1] if k + 1 < len(places) else a
                    out.append((d, cand["item_id"], share))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "share"])

    size = wanted.select(F.sum(F.aggregate("cands", F.lit(0).cast("bigint"), lambda acc, x: acc + 64 + 4 * F.size(x["places"]) + F.coalesce(F.octet_length(x["ref_text"]), F.lit(0))))).first()[0] or 0
    return docs.select("doc_id", "text").join(F.broadcast(wanted) if size <= CANDIDATE_BYTES else wanted, "doc_id").mapInPandas(run, "doc_id bigint, item_id bigint, share double")


def reparameterised(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, place, doc_values, item_values): passages of the build of an item with other names or numbers.

    One row for each template window of a document that an item has too, while no item has its values: ``place`` is the
    number of its first token, ``item_id`` the least item with that template and ``item_values`` its values there.
    Values are folded and joined by a bar. Null, empty and blank texts have none.
    """
    items = _readable(items)
    literals = docs.sparkSession.sparkContext.broadcast(_literals(items))

    def rows(key: str, text: str, known):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for ids, block in _blocks(pdf[key].tolist(), pdf[text].tolist()):
                    t = Tokens(block)
                    doc, tmpl, bound, place, values = slot_values(t, literals.value, None if known is None else Keys(known.value))
                    yield pd.DataFrame({key: np.asarray(ids, np.int64)[doc], "t": tmpl.view(np.int64), "bound": bound.view(np.int64), "place": place.astype(np.int32), "vals": values})

        return run

    form = "bigint, t bigint, bound bigint, place int, vals string"
    of_items = checkpointed(items.mapInPandas(rows("item_id", "ref_text", None), f"item_id {form}"))
    small = of_items.count() <= BROADCAST_ROWS
    known = docs.sparkSession.sparkContext.broadcast(_sorted_keys(of_items, "t")) if small else None
    of_docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInPandas(rows("doc_id", "text", known), f"doc_id {form}")
    side = F.broadcast if small else (lambda x: x)
    first = of_items.groupBy("t").agg(F.min(F.struct("item_id", "place", "vals")).alias("x")).select("t", F.col("x.item_id").alias("item_id"), F.col("x.vals").alias("item_values"))
    other = of_docs.join(side(of_items.select("t", "bound").distinct()), ["t", "bound"], "left_anti")
    return other.join(side(first), "t").select("doc_id", "item_id", "place", F.col("vals").alias("doc_values"), "item_values").distinct()
