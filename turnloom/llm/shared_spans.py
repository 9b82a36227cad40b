"""Long spans that stand verbatim in more than one document, by a compacted de Bruijn graph over anchors.

The tokens of the graph are anchors chosen by content alone: the least hash of each window of W character K-grams. Two
anchors in a row make an edge, labelled by the hash of the whole text from the first to the end of the second, so equal
edges are equal texts. With 2 W + K <= SPAN + 1 every stretch of SPAN characters holds at least one whole edge, and
another document that holds the stretch has the same edge there: no shared stretch can be missed, whatever its offset.

Edges of one document only are dropped by a join with per-edge statistics; what is left compacts into non-branching
paths (each occurrence of one edge is followed by the next, and each occurrence of that one preceded by it), so all
documents that touch a path hold all of it. The source coordinates of the paths are then joined to the texts once: a
path of SPAN characters or more is cut out there and counts only for documents whose text has the same 128-bit digest.
Around shorter paths (standard notices, say) the SPAN-character windows that hold only repeated edges are hashed (128
bits) and matched, so a short passage in a third of all documents doesn't turn into pairs.

The join with the edge statistics has one row for each edge on one side; an edge that a third of all documents hold is
split there by the adaptive skew join. Pairs of a group are made in blocks of at most BLOCK_DOCS by BLOCK_DOCS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.session import checkpointed

SPAN, K, W = 300, 24, 138
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE2 = np.uint64(0xD1342543DE82EF95)  # of the second half of 128-bit hashes
_POS_BITS = 27  # positions within a block of texts
BLOCK = 1 << 20  # characters hashed at a time, unless one text is longer
#: Bytes of document ids and coordinates up to which they are broadcast to the documents; beyond, both sides are shuffled.
BROADCAST_BYTES = 16 << 20
BLOCK_DOCS = 1000  # documents of a group on each side of a block of pairs


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _powers(n: int, base: int = int(_BASE)) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hashed:
    """Rolling hashes over a block of texts laid end to end."""

    def __init__(self, texts: list[str], base: np.uint64 = _BASE):
        self.lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.lens)
        self.begins = self.ends - self.lens
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(cp)
        self.up, down = _powers(1 << max(20, n.bit_length()), int(base))
        v = _mix(cp.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(v * down[:n], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of each text [a, b), the same wherever it stands."""
        return _mix((self.sums[b] - self.sums[a]) * self.up[b] + (b - a).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of each k-gram by its start."""
        n = len(self.sums) - 1
        return _mix((self.sums[k:] - self.sums[:-k]) * self.up[k : n + 1]) if n >= k else np.empty(0, np.uint64)


def anchors(h: Hashed, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, position in the block) of each anchor, in order."""
    g = h.grams(k)
    n = len(g)
    if n < w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.uint64((1 << _POS_BITS) - 1)
    key = (g & ~low) | (low - np.arange(n, dtype=np.uint64))  # the last of equal hashes is the least
    size, least = 1, key
    while size * 2 <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < w:
        least = np.minimum(least[: n - w + 1], least[w - size : w - size + n - w + 1])
    at = (low - (least & low)).astype(np.int64)
    starts = np.repeat(h.begins, np.maximum(0, h.lens - (k + w - 2)))
    count = np.maximum(0, h.lens - (k + w - 2))
    first = np.cumsum(count) - count
    windows = starts + np.arange(len(starts)) - np.repeat(first, count)
    doc = np.repeat(np.arange(len(h.lens)), count)
    pos = at[windows]
    if not len(pos):
        return doc, pos
    new = np.ones(len(pos), bool)
    new[1:] = (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], pos[new]


def _blocks(ids: list, texts: list[str], least: int) -> Iterator[tuple[list, list[str]]]:
    size, a, b = 0, [], []
    for i, t in zip(ids, texts):
        if t is None or len(t) < least:
            continue
        if size and size + len(t) > BLOCK:
            yield a, b
            size, a, b = 0, [], []
        a.append(i)
        b.append(t)
        size += len(t)
    if a:
        yield a, b


def unrepeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text): ``docs`` with each row once. Ids are shuffled, and texts only of ids that stand in several rows."""
    docs = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    twice = checkpointed(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    n = twice.count()
    if not n:
        return docs
    twice = F.broadcast(twice) if 16 * n <= BROADCAST_BYTES else twice
    return docs.join(twice, "doc_id", "left_anti").unionByName(docs.join(twice, "doc_id", "left_semi").distinct())


def edges(docs: DataFrame, span: int = SPAN, k: int = K, w: int = W) -> DataFrame:
    """(h, doc_id, ord, pos, len, prev, next): the edges of each text of at least ``span`` characters in order; prev and next are the neighbours' hashes, 0 at the ends.

    A row that stands twice counts once; a doc_id must not have different texts.
    """
    if 2 * w + k > span + 1:
        raise ValueError("2 w + k must not exceed span + 1")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, texts in _blocks(pdf["doc_id"].tolist(), pdf["text"].tolist(), span):
                h = Hashed(texts)
                doc, pos = anchors(h, k, w)
                if len(pos) < 2:
                    continue
                same = doc[1:] == doc[:-1]
                a, b, d = pos[:-1][same], pos[1:][same] + k, doc[:-1][same]
                label = h.of(a, b).view(np.int64)
                prev, nxt = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
                chain = d[1:] == d[:-1]
                prev[1:][chain] = label[:-1][chain]
                nxt[:-1][chain] = label[1:][chain]
                yield pd.DataFrame({"h": label, "doc_id": np.asarray(ids, np.int64)[d], "ord": np.arange(len(d), dtype=np.int32) - np.searchsorted(d, d).astype(np.int32), "pos": (a - h.begins[d]).astype(np.int32), "len": (b - a).astype(np.int32), "prev": prev, "next": nxt})

    return unrepeated(docs.where(F.length("text") >= span)).mapInPandas(run, "h bigint, doc_id bigint, ord int, pos int, len int, prev bigint, next bigint")


def repeated_paths(e: DataFrame, span: int = SPAN) -> DataFrame:
    """Occurrences of the compacted paths of the edges ``e``: (doc_id, run, part, pos, end, long), one row per path and place.

    ``run`` numbers the stretches of repeated edges of a document, ``part`` its paths.
    """
    e = checkpointed(e)  # the texts are hashed once; statistics and join read the edges
    stats = e.groupBy("h").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("prev").alias("p0"), F.max("prev").alias("p1"), F.min("next").alias("n0"), F.max("next").alias("n1"))
    stats = stats.where("d0 < d1").select("h", ((F.col("p0") == F.col("p1")) & (F.col("p0") != 0)).alias("one_prev"), ((F.col("n0") == F.col("n1")) & (F.col("n0") != 0)).alias("one_next"))
    rep = e.select("h", "doc_id", "ord", "pos", "len").join(stats, "h").select("doc_id", "ord", "pos", "len", "one_prev", "one_next")
    doc = Window.partitionBy("doc_id").orderBy("ord")
    upto = doc.rowsBetween(Window.unboundedPreceding, 0)
    rep = rep.withColumn("follows", F.coalesce(F.col("ord") == F.lag("ord").over(doc) + 1, F.lit(False)))
    rep = rep.withColumn("linked", F.col("follows") & F.coalesce(F.lag("one_next").over(doc), F.lit(False)) & F.col("one_prev"))
    rep = rep.withColumns({"run": F.sum((~F.col("follows")).cast("int")).over(upto), "part": F.sum((~F.col("linked")).cast("int")).over(upto)})
    paths = rep.groupBy("doc_id", "run", "part").agg(F.min("pos").alias("pos"), F.max(F.col("pos") + F.col("len")).alias("end"))
    return paths.withColumn("long", F.col("end") - F.col("pos") >= span)


def _cut(flagged: DataFrame, docs: DataFrame, span: int) -> DataFrame:
    """(k1, k2, doc_id, start, end): what stands at the flagged coordinates, each stretch once, by 128 bits of its text.

    ``flagged``: doc_id, lo, hi, whole. Whole stretches are cut out and digested; in the others each window of ``span``
    characters is hashed twice, with different bases.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = dict(zip(pdf["doc_id"].tolist(), pdf["reach"]))
            for ids, texts in _blocks(pdf["doc_id"].tolist(), pdf["text"].tolist(), span):
                starts, owner, begins, cut = [], [], [], []
                for i, d in enumerate(ids):
                    own, t = [], texts[i]
                    for r in at[d]:
                        a, b = max(0, int(r["lo"])), min(len(t), int(r["hi"]))
                        if r["whole"]:
                            digest = hashlib.blake2b(t[a:b].encode("utf-8", "surrogatepass"), digest_size=16).digest()
                            cut.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), d, a, b))
                        elif b - a >= span:
                            own.append(np.arange(a, b - span + 1))
                    if own:
                        s = np.unique(np.concatenate(own))
                        starts.append(s)
                        owner.append(np.full(len(s), d, np.int64))
                        begins.append(i)
                if cut:
                    yield pd.DataFrame(cut, columns=["k1", "k2", "doc_id", "start", "end"]).astype({"start": "int32", "end": "int32"})
                if starts:
                    s, used = np.concatenate(starts), [texts[i] for i in begins]
                    h, h2 = Hashed(used), Hashed(used, _BASE2)
                    g = s + np.repeat(h.begins, [len(x) for x in starts])
                    yield pd.DataFrame({"k1": h.of(g, g + span).view(np.int64), "k2": h2.of(g, g + span).view(np.int64), "doc_id": np.concatenate(owner), "start": s.astype(np.int32), "end": (s + span).astype(np.int32)})

    flagged = checkpointed(flagged.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi", "whole")).alias("reach")))
    size = flagged.select(F.sum(24 + 16 * F.size("reach"))).first()[0] or 0
    joined = docs.select("doc_id", "text").join(F.broadcast(flagged) if size <= BROADCAST_BYTES else flagged, "doc_id")
    return joined.mapInPandas(run, "k1 bigint, k2 bigint, doc_id bigint, start int, end int")


def _short_reach(paths: DataFrame, span: int, w: int) -> DataFrame:
    """(doc_id, lo, hi): stretches of short paths between long ones; a window that holds a long path's edge is proven by that path."""
    doc = Window.partitionBy("doc_id").orderBy("pos")
    cut = F.when(F.col("long") | (F.col("run") != F.lag("run").over(doc)), 1).otherwise(0)
    short = paths.withColumn("stretch", F.sum(cut).over(doc.rowsBetween(Window.unboundedPreceding, 0))).where("not long")
    reach = short.groupBy("doc_id", "run", "stretch").agg((F.min("pos") - w).alias("lo"), (F.max("end") + w).alias("hi"))
    return reach.where(F.col("hi") - F.col("lo") >= span).select("doc_id", "lo", "hi")


def _matched(flagged: DataFrame, docs: DataFrame, span: int) -> DataFrame:
    """The cut stretches whose text stands in at least two documents: (k1, k2, doc_id, start, end)."""
    cut = checkpointed(_cut(flagged, docs, span))
    twice = cut.groupBy("k1", "k2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("k1", "k2")
    return cut.join(twice, ["k1", "k2"])


def _flags(rows: DataFrame, whole: bool) -> DataFrame:
    return rows.select("doc_id", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"), F.lit(whole).alias("whole"))


def _long(paths: DataFrame) -> DataFrame:
    return _flags(paths.where("long").select("doc_id", F.col("pos").alias("lo"), F.col("end").alias("hi")), True)


def groups(docs: DataFrame, span: int = SPAN, k: int = K, w: int = W) -> DataFrame:
    """(k1, k2, doc_id): documents of one key share a span; each sharing pair meets under at least one key.

    Null and short texts have none. A key is the text of a path of at least span characters, or of a window of span
    characters around shorter paths; it has at least two documents. Copies aren't expanded into pairs here.
    """
    paths = checkpointed(repeated_paths(edges(docs, span, k, w), span))
    flagged = _long(paths).unionByName(_flags(_short_reach(paths, span, w), False))
    return _matched(flagged, docs, span).select("k1", "k2", "doc_id").distinct()


def shared_stretches(docs: DataFrame, span: int = SPAN, k: int = K, w: int = W) -> DataFrame:
    """(doc_id, start, end): the stretches of each document that stand in another one too, as long as possible, 0-based, end excluded.

    A character counts if it lies in a stretch of at least ``span`` characters that stands verbatim elsewhere; stretches
    that touch are one. How far beyond the ends of a path a stretch goes on is found by the windows that reach over them.
    """
    paths = checkpointed(repeated_paths(edges(docs, span, k, w), span))
    long = paths.where("long")
    over = long.select("doc_id", (F.col("pos") - w).alias("lo"), (F.col("pos") + span - 1).alias("hi")).unionByName(long.select("doc_id", (F.col("end") - span + 1).alias("lo"), (F.col("end") + w).alias("hi")))
    hit = _matched(_long(paths).unionByName(_flags(_short_reach(paths, span, w).unionByName(over), False)), docs, span)
    piece = "array<struct<start:int,end:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(acc, F.array(x)))

    spans = hit.groupBy("doc_id").agg(F.aggregate(F.array_sort(F.collect_set(F.struct("start", "end"))), F.array().cast(piece), step).alias("x"))
    return spans.select("doc_id", F.explode("x").alias("x")).select("doc_id", "x.start", "x.end")


def shared_share(docs: DataFrame, span: int = SPAN, k: int = K, w: int = W) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share) of each document with text: how much of it stands in another document too."""
    covered = shared_stretches(docs, span, k, w).groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).cast("int").alias("shared_chars"))
    sizes = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id", F.length("text").alias("n_chars")).distinct()
    return sizes.join(covered, "doc_id", "left").select("doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.round(F.coalesce("shared_chars", F.lit(0)) / F.col("n_chars"), 6).alias("share"))


def copy_classes(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, class_id, n): documents of at least ``span`` characters that are exact copies of another; class_id is the least of their ids.

    Copies agree in 128 bits of hashes and in length. Ids and hashes are shuffled, texts aren't.
    """
    h = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= span)).select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.reverse("text"), F.lit(1)).alias("h2"), F.length("text").alias("n_chars")).distinct()
    keys = ["h1", "h2", "n_chars"]
    classes = h.groupBy(*keys).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return h.join(classes, keys).select("doc_id", "class_id", "n")


def pairs_in_blocks(members: DataFrame, keys: list[str], block: int = BLOCK_DOCS) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b, of all documents that share a key; a pair comes once for each key it shares.

    A key of n documents is cut by hash into n / block parts, and each part meets each: no join key has more than about
    ``block`` documents on a side, however many documents one key holds.
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    m = members.join(sizes, keys).withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    m = m.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    a = m.select(*keys, F.col("own").alias("i"), F.col("other").alias("j"), F.col("doc_id").alias("doc_a"))
    b = m.select(*keys, F.col("other").alias("i"), F.col("own").alias("j"), F.col("doc_id").alias("doc_b"))
    return a.join(b, [*keys, "i", "j"]).where("doc_a < doc_b").select("doc_a", "doc_b")


def _with_copies(pairs: DataFrame, members: DataFrame, side: str, block: int = BLOCK_DOCS) -> DataFrame:
    """``pairs`` with the representative in column ``side`` replaced by each member of its class, a large class in parts."""
    parts = F.ceil(F.col("n") / block).cast("int")
    m = members.select(F.col("class_id").alias(side), F.pmod(F.xxhash64("doc_id"), parts).cast("int").alias("part"), F.col("doc_id").alias("copy"))
    sizes = members.select(F.col("class_id").alias(side), parts.alias("parts")).distinct()
    spread = pairs.join(sizes, side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return spread.join(m, [side, "part"], "left").where("parts is null or copy is not null").withColumn(side, F.coalesce("copy", side)).drop("copy", "part", "parts")


def found_shared(docs: DataFrame, span: int = SPAN, expand: bool = True) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: the pairs of documents that share a stretch of at least ``span`` characters.

    Exact copies are searched once, by their representative. With ``expand`` (the default, at every size) they are put
    back afterwards, so that each pair of documents comes out. Without it a class of copies is linked to its
    representative only, which alone stands for it in pairs with other texts (``copy_classes`` has its members): use
    that where one text may be a large share of all rows. Links between different texts are never lost.
    """
    docs = docs.select("doc_id", "text")
    members = checkpointed(copy_classes(docs, span))
    doubles = members.where("doc_id <> class_id").select("doc_id")
    few = 16 * doubles.count() <= BROADCAST_BYTES
    g = checkpointed(groups(docs.join(F.broadcast(doubles) if few else doubles, "doc_id", "left_anti"), span))
    pairs = pairs_in_blocks(g, ["k1", "k2"]).distinct()
    if not expand:
        star = members.where("doc_id <> class_id").select(F.col("class_id").alias("doc_a"), F.col("doc_id").alias("doc_b"))
        return pairs.unionByName(star)
    for side in ("doc_a", "doc_b"):
        pairs = _with_copies(pairs, members, side)
    pairs = pairs.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))
    return pairs.unionByName(pairs_in_blocks(members.select("class_id", "doc_id"), ["class_id"]))
