"""Units from turns: validity, splitting of long turns, same-speaker runs under a span cap, numbering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import py_strip
from turnloom.operators.intervals import invalid_reason  # noqa: F401
from turnloom.operators.sequences import label_runs, row_positions
from turnloom.session import checkpointed

# Fixed values of the pipeline's configuration.
MAX_ASR_S, MAX_GAP_S, MIN_ASR_S, HEAVY = 30.0, 5.0, 0.35, 0.30


def coerce_turns(df: DataFrame) -> DataFrame:
    """Defaults of missing fields: status by text, source, confidence and empty text; other columns pass."""
    text = F.coalesce("text", F.lit(""))
    status = F.coalesce("asr_status", F.when(py_strip(text) != "", "provisional").otherwise("empty"))
    return df.withColumns({"text": text, "asr_status": status, "source": F.coalesce("source", F.lit("fused")), "confidence": F.coalesce("confidence", F.lit(1.0))})


def reindexed(valid: DataFrame) -> DataFrame:
    """Valid turns with ``pos``, their 0-based index per meeting after invalid rows are gone."""
    return row_positions(valid, "meeting_id", ["turn_index"], "pos")


def split_long(turns: DataFrame, cap_s: float = MAX_ASR_S) -> DataFrame:
    """Turns in ms, halved until each piece lasts at most ``cap_s``: (…, piece, n_pieces, start_ms, end_ms).

    The number of pieces is the least power of two that suffices; the first keeps the text in ``piece_text``.
    """
    dur = F.col("end_ms") - F.col("start_ms")
    n = F.when(dur <= cap_s * 1000, F.lit(1)).otherwise(F.pow(F.lit(2), F.ceil(F.round(F.log2(dur / (cap_s * 1000)), 9)))).cast("int")
    out = turns.withColumn("n_pieces", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    edge = lambda k: F.col("start_ms") + F.round((F.col("end_ms") - F.col("start_ms")) * k / F.col("n_pieces")).cast("bigint")
    a, b = edge(F.col("piece")), edge(F.col("piece") + 1)
    return out.withColumns({"piece_start_ms": a, "piece_end_ms": b}).withColumn("piece_text", F.when(F.col("piece") == 0, F.col("text")).otherwise("")).drop("start_ms", "end_ms").withColumnsRenamed({"piece_start_ms": "start_ms", "piece_end_ms": "end_ms"})


UNIT_COLUMNS = ["meeting_id", "speaker", "run", "start_ms", "first_end", "end_ms", "row_key", "turn_indices", "rest"]


def _fold(rows: list[tuple], cap_ms: int) -> list[tuple]:
    """Units (start, first end, last end, row key, turn indices) of a run's rows (start, end, turn index, row key) under the cap."""
    out: list[list] = []
    for s, e, t, k in rows:
        if out and e - out[-1][0] <= cap_ms:
            out[-1][2] = e
            if t not in out[-1][4][-1:]:
                out[-1][4].append(t)
        else:
            out.append([s, e, e, k, [t]])
    return [(s, e0, e, k, list(dict.fromkeys(t))) for s, e0, e, k, t in out]


def _folded(batches: Iterator[pd.DataFrame], cap_ms: int) -> Iterator[pd.DataFrame]:
    """Units of the runs that begin and end within the partition; the rows of its first and last run, if they may go on elsewhere, as ``rest``."""
    held: tuple | None = None  # meeting, speaker, run, rows, whether it begins here

    def done(h: tuple, ends: bool) -> list[tuple]:
        if h[4] and ends:
            return [(*h[:3], *u, None) for u in _fold(h[3], cap_ms)]
        return [(*h[:3], None, None, None, None, None, [dict(zip(("start_ms", "end_ms", "turn_index", "row_key"), r)) for r in h[3]])]

    for pdf in batches:
        out = []
        if not len(pdf):
            continue
        run = pdf["run"].to_numpy(np.int64)
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
        rows = list(zip(pdf["start_ms"].tolist(), pdf["end_ms"].tolist(), pdf["turn_index"].tolist(), pdf["row_key"].tolist()))
        for a, b in zip(cuts, cuts[1:]):
            if held is not None and held[2] == run[a]:
                held[3].extend(rows[a:b])
                continue
            if held is not None:
                out += done(held, True)
            held = (pdf["meeting_id"].iat[a], pdf["speaker"].iat[a], int(run[a]), rows[a:b], rows[a][3] == run[a])
        yield pd.DataFrame(out, columns=UNIT_COLUMNS)
    if held is not None:
        yield pd.DataFrame(done(held, False), columns=UNIT_COLUMNS)


def build_units(turns: DataFrame, gap_ms: int = 5000, cap_ms: int = 30_000, short_ms: int = 350) -> DataFrame:
    """(meeting_id, unit_seq, unit_id, start_ms, end_ms, speaker, turn_indices, skip_asr, skip_reason, moss_merged).

    ``turns``: meeting_id, turn_id, turn_index, start_ms, end_ms, speaker, text. In order of start, end and index, a
    turn joins the unit before it if the speaker is the same, the silence is 0 to ``gap_ms`` and the unit's span stays
    within ``cap_ms``. Speaker and gap depend on the row before only and are found by a carried scan; the cap is folded
    along each run where it lies, and only runs that cross the border of a partition are put together first.
    """
    pieces = split_long(turns.withColumn("text", F.lit("")) if "text" not in turns.columns else turns)
    pieces = pieces.select("meeting_id", (F.col("turn_id") * 4096 + F.col("piece")).alias("row_key"), "turn_index", "start_ms", "end_ms", "speaker")

    def breaks(before: pd.DataFrame, now: pd.DataFrame) -> np.ndarray:
        gap = now["start_ms"].to_numpy(float) - before["end_ms"].to_numpy(float)
        return (before["speaker"].to_numpy(object) != now["speaker"].to_numpy(object)) | ~((gap >= 0) & (gap <= gap_ms))

    runs = label_runs(pieces, "meeting_id", ["start_ms", "end_ms", "turn_index"], "row_key", breaks)
    unit = "meeting_id string, speaker string, run bigint, start_ms bigint, first_end bigint, end_ms bigint, row_key bigint, turn_indices array<int>, rest array<struct<start_ms:bigint,end_ms:bigint,turn_index:int,row_key:bigint>>"
    folded = checkpointed(runs.mapInPandas(lambda batches: _folded(batches, cap_ms), unit))
    part = folded.where("rest is not null").groupBy("meeting_id", "speaker", "run").agg(F.array_sort(F.flatten(F.collect_list("rest"))).alias("rest"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(m, s, r, *u, None) for m, s, r, rest in zip(pdf["meeting_id"], pdf["speaker"], pdf["run"], pdf["rest"]) for u in _fold([(x["start_ms"], x["end_ms"], x["turn_index"], x["row_key"]) for x in rest], cap_ms)]
            yield pd.DataFrame(rows, columns=UNIT_COLUMNS)

    units = folded.where("rest is null").unionByName(part.mapInPandas(join, unit)).select("meeting_id", "speaker", "start_ms", "first_end", "end_ms", "row_key", "turn_indices")
    first = F.col("turn_indices")[0]
    numbered = row_positions(units.withColumn("first_turn", first), "meeting_id", ["start_ms", "first_end", "first_turn", "row_key"], "unit_seq")
    skip = F.col("end_ms") - F.col("start_ms") < short_ms
    return numbered.select(
        "meeting_id", "unit_seq", F.format_string("unit_%04d", "unit_seq").alias("unit_id"), "start_ms", "end_ms", "speaker", "turn_indices", skip.alias("skip_asr"), F.when(skip, "too_short").alias("skip_reason"), (F.size("turn_indices") > 1).alias("moss_merged")
    )


def overlap_flags(units: DataFrame, ratio: str = "overlap_ratio") -> DataFrame:
    """contains_overlap and heavy_overlap from the ratio."""
    return units.withColumns({"contains_overlap": F.col(ratio) > 0, "heavy_overlap": F.col(ratio) > HEAVY})
