"""Cutting oversized items at natural boundaries, with overlap between consecutive pieces.

One packer serves times and texts: separators come in levels (text: section, paragraph, sentence, word, character;
time: pauses from long to short, then any moment). Pieces are packed greedily up to the limit, each cut lies at the
farthest separator of the coarsest level that still lets the piece be at least half full, else of a finer one, and each
piece after the first starts the overlap before the end of the one before it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reasons for a skip that only say a unit is too long, in any spelling.
TOO_LONG = r"(?i)(?:too|over|very)[\s_\-]*(?:long|cap|limit|length|size|duration)|exceed|long(?:er)?[\s_\-]*than|(?:>|above|beyond)\s*(?:the\s*)?(?:max|cap|limit|[0-9])|max[a-z]*[\s_\-]*(?:dur|len)|(?:dur|len)[a-z]*[\s_\-]*(?:cap|limit|max)|oversize|超长|过长|太长|超时|超限|超出|超过"


def pack_span(start: int, end: int, pauses: list[tuple[int, int]], limit: int, overlap: int, fill: float = 0.5, least: tuple[int, ...] = (1500, 800, 0)) -> list[tuple[int, int, bool]]:
    """Pieces (start, end, natural) of [start, end], each at most ``limit`` long; natural says the piece ends in a pause or at the end.

    ``pauses`` are disjoint stretches in order. The farthest pause that is reachable always allows as many natural
    cuts as any other choice, so it is what a piece falls back on where a coarser level would leave the next one
    without a pause.
    """
    pieces = _pack(start, end, pauses, limit, overlap, fill, least)
    if not all(p[2] for p in pieces):  # the farthest pause each time: as few forced cuts as there can be
        pieces = min(pieces, _pack(start, end, pauses, limit, overlap, fill, ()), key=lambda ps: sum(not p[2] for p in ps))
    return pieces


def _pack(start: int, end: int, pauses: list[tuple[int, int]], limit: int, overlap: int, fill: float, least: tuple[int, ...]) -> list[tuple[int, int, bool]]:
    levels = [[p for p in pauses if p[1] - p[0] >= longer] for longer in least] + [pauses]
    begins = [[a for a, _ in ps] for ps in levels]

    def farthest(k: int, upto: int) -> int | None:
        """The last moment of a pause of level k that is not after ``upto``; pauses are in order, so it is in the last one that begins by then."""
        i = bisect_right(begins[k], upto)
        return min(levels[k][i - 1][1], upto) if i else None

    pieces, at = [], start
    while end - at > limit:
        cut = None
        for k in range(len(levels)):
            best = farthest(k, at + limit)
            if best is None or best - overlap <= at:
                continue
            if k + 1 < len(levels):
                nxt = best - overlap
                if best - at < fill * limit or end - nxt > limit and (farthest(len(levels) - 1, nxt + limit) or best) <= best:
                    continue  # too short a piece, or the next one would be without a pause, which a farther cut may avoid
            cut = best
            break
        natural = cut is not None
        cut = cut if natural else at + limit
        pieces.append((at, cut, natural))
        at = cut - overlap
    pieces.append((at, end, True))
    return pieces


def long_units(units: DataFrame, turns: DataFrame, limit_ms: int = 30_000, pause_ms: int = 300) -> DataFrame:
    """Units over the limit that weren't skipped for another reason: (unit_key, start_ms, end_ms, pauses, turn_ms).

    ``units`` and ``turns`` are current rows. Members with null or impossible times are left out of the span; a unit
    without members has none. The join is on meeting and turn index, so a meeting of any size is spread evenly.
    """
    reason = F.trim(F.coalesce("skip_reason", F.lit("")))
    kept = units.where((reason == "") | reason.rlike(TOO_LONG))
    member = kept.select("unit_key", "meeting_id", F.explode(F.array_distinct("turn_indices")).alias("turn_index"))
    ms = lambda c: F.round(F.col(c) * 1000).try_cast("bigint").alias(c[:-2] + "_ms")
    ok = "start_s is not null and end_s is not null and not isnan(start_s) and not isnan(end_s) and abs(start_s) < 1e15 and abs(end_s) < 1e15 and end_s > start_s"
    times = turns.where(ok).select("meeting_id", "turn_index", ms("start_s"), ms("end_s"))
    spans = member.join(times, ["meeting_id", "turn_index"]).groupBy("unit_key").agg(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms"))).alias("turn_ms"))
    zero = F.struct(F.lit(None).cast("bigint").alias("top"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("p"))
    gap = lambda acc, x: F.when(x["start_ms"] - acc["top"] >= pause_ms, F.concat(acc["p"], F.array(F.struct(acc["top"].alias("a"), x["start_ms"].alias("b"))))).otherwise(acc["p"])
    folded = F.aggregate("turn_ms", zero, lambda acc, x: F.struct(F.greatest(acc["top"], x["end_ms"]).alias("top"), gap(acc, x).alias("p")))
    out = spans.withColumn("f", folded).select("unit_key", F.col("turn_ms")[0]["start_ms"].alias("start_ms"), F.col("f.top").alias("end_ms"), F.col("f.p").alias("pauses"), "turn_ms")
    return out.where(F.col("end_ms") - F.col("start_ms") > limit_ms)


def split_units(units: DataFrame, turns: DataFrame, limit_ms: int = 30_000, overlap_ms: int = 1_000, pause_ms: int = 300) -> DataFrame:
    """Pieces of the long units: (unit_key, piece, start_ms, end_ms, natural)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (u, k, a, b, nat)
                for u, s, e, ps in zip(pdf["unit_key"], pdf["start_ms"], pdf["end_ms"], pdf["pauses"])
                for k, (a, b, nat) in enumerate(pack_span(int(s), int(e), [(int(p["a"]), int(p["b"])) for p in ps], limit_ms, overlap_ms))
            ]
            yield pd.DataFrame(rows, columns=["unit_key", "piece", "start_ms", "end_ms", "natural"])

    long = long_units(units, turns, limit_ms, pause_ms).select("unit_key", "start_ms", "end_ms", "pauses")
    return long.mapInPandas(cut, "unit_key bigint, piece int, start_ms bigint, end_ms bigint, natural boolean")


def found_long_units(units: DataFrame, turns: DataFrame) -> DataFrame:
    """(unit_key, cut): natural if all cuts lie in pauses, else forced."""
    return split_units(units, turns).groupBy("unit_key").agg(F.when(F.every(F.col("natural")), "natural").otherwise("forced").alias("cut"))


#: Levels of separators of a text, coarse to fine; each match ends a piece.
TEXT_LEVELS = (r"\n(?=#{1,6} |\[[0-9:]+\])", r"\n\s*\n", r"\n|[。！？!?]+[”’\"')）]*|(?<=[a-z0-9)])[.]+(?=\s)", r"\s+|[，、；：,;:]")


def pack_text(text: str, limit: int, overlap: int, whole_words: bool = False) -> list[tuple[int, int, int]]:
    """Pieces (start, end, level) of a text; level 4 is a cut between characters, -1 the end of the text.

    The text is split at the coarsest level; parts are packed into a piece while they fit, a part that doesn't fit
    begins the next piece, and one that doesn't fit a piece at all is split at the next level in the same way. Each
    piece after the first starts ``overlap`` characters before the end of the one before it, or with ``whole_words`` at
    the first word that begins there.
    """
    ends = [[m.end() for m in re.finditer(p, text)] for p in TEXT_LEVELS]
    words = sorted({*ends[-1], *ends[-2]}) if whole_words else []
    pieces: list[tuple[int, int, int]] = []
    at = 0

    def cut(place: int, level: int) -> None:
        nonlocal at
        pieces.append((at, place, level))
        at = place - overlap
        k = bisect_left(words, at)
        if k < len(words) and words[k] < place:
            at = words[k]

    def walk(a: int, b: int, level: int) -> None:
        if level == len(ends):
            while b - at > limit:
                cut(at + limit, level)
            return
        bounds = ends[level][bisect_right(ends[level], a) : bisect_left(ends[level], b)]
        before = a
        for place in [*bounds, b]:
            if place - at > limit:
                if before > max(a, at + overlap) or before == a > at + overlap:
                    cut(before, level)
                if place - at > limit:
                    walk(before, place, level + 1)
            before = place

    walk(0, len(text), 0)
    pieces.append((at, len(text), -1))
    return pieces


def split_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1000, overlap: int = 100, whole_words: bool = False) -> DataFrame:
    """Pieces of at most ``limit`` characters: (key, piece, start, end, level, piece_text), whole texts.

    A null or empty text gives no piece; one within the limit gives itself as one piece.
    """
    if not 0 <= overlap < limit / 2:
        raise ValueError("overlap must be less than half the limit")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, k, a, b, lv, t[a:b]) for d, t in zip(pdf[key], pdf[text]) for k, (a, b, lv) in enumerate(pack_text(t, limit, overlap, whole_words))]
            yield pd.DataFrame(rows, columns=[key, "piece", "start", "end", "level", "piece_text"])

    src = docs.where(F.col(key).isNotNull() & (F.length(text) > 0)).select(key, text)
    return src.mapInPandas(cut, f"{key} {dict(docs.dtypes)[key]}, piece int, start int, end int, level int, piece_text string")
