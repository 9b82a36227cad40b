"""WAV files as rows: decoding, crops of units, and cutting long turns at quiet moments.

Samples stay inside one Python task: a recording is decoded once per meeting, however many units it has.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATE = 16_000


def decode(content: bytes, rate: int = RATE) -> np.ndarray:
    """Mono samples in [-1, 1) at ``rate``; 16-bit PCM only, channels averaged, other rates resampled linearly."""
    with wave.open(io.BytesIO(content)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM is read")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768.0
        x = x.reshape(-1, w.getnchannels()).mean(axis=1)
        have = w.getframerate()
    if have != rate and len(x):
        at = np.linspace(0, len(x) - 1, max(1, round(len(x) * rate / have)))
        x = np.interp(at, np.arange(len(x)), x).astype(np.float32)
    return x


def encode(x: np.ndarray, rate: int = RATE) -> bytes:
    """A 16-bit mono WAV of the samples, clipped to [-1, 1]."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def silence(seconds: float, rate: int = RATE) -> bytes:
    """A silent WAV."""
    return encode(np.zeros(int(seconds * rate), np.float32), rate)


def crop_bounds(start: float, end: float, n: int, rate: int = RATE) -> tuple[int, int]:
    """Samples [a, b) of a crop, at least one sample where the recording has any."""
    a = min(max(0, int(start * rate)), n)
    return a, min(n, max(a + 1, int(end * rate)))


def quiet_split(x: np.ndarray, rate: int = RATE, window_ms: int = 25, hop_ms: int = 10, edge: float = 0.1) -> float:
    """The second at which a stretch is quietest, its edges left out; its middle where that can't be told."""
    size, hop, total = max(1, rate * window_ms // 1000), max(1, rate * hop_ms // 1000), len(x) / rate
    if len(x) < size:
        return total / 2
    begins = np.arange(0, len(x) - size + 1, hop)
    power = np.concatenate([[0.0], np.cumsum(x.astype(np.float64) ** 2)])
    level = np.sqrt((power[begins + size] - power[begins]) / size + 1e-12)
    at = (begins + size / 2) / rate
    inner = np.flatnonzero((at >= edge * total) & (at <= (1 - edge) * total))
    return float(at[inner[np.argmin(level[inner])]]) if len(inner) else total / 2


def split_spans(x: np.ndarray, start: float, end: float, cap: float, rate: int = RATE) -> list[tuple[float, float]]:
    """Spans of at most ``cap`` seconds that make up [start, end], halved at quiet moments."""
    if end - start <= cap:
        return [(start, end)]
    a, b = crop_bounds(start, end, len(x), rate)
    cut = start + quiet_split(x[a:b], rate) if b - a > 1 else (start + end) / 2
    if not start + 0.01 < cut < end - 0.01:
        cut = (start + end) / 2
    return split_spans(x, start, cut, cap, rate) + split_spans(x, cut, end, cap, rate)


def read_wavs(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the WAV files under ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path).select("path", "content")


def split_turns(recordings: DataFrame, turns: DataFrame, cap: float = 30.0, rate: int = RATE) -> DataFrame:
    """(…, piece, start_s, end_s, text): turns cut at quiet moments until no piece lasts more than ``cap`` seconds.

    ``recordings``: meeting_id, content; ``turns``: meeting_id, turn_index, start_s, end_s, text. Only turns over the cap
    meet their recording, which is decoded once; without one, or with one that can't be read, they are halved. The
    first piece keeps the text.
    """
    over = F.col("end_s") - F.col("start_s") > cap
    per = turns.where(over).groupBy("meeting_id").agg(F.collect_list(F.struct("turn_index", "start_s", "end_s")).alias("spans"))
    form = "meeting_id string, turn_index int, piece int, piece_start double, piece_end double"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for m, content, wanted in zip(pdf["meeting_id"], pdf["content"], pdf["spans"]):
                try:
                    x = decode(content, rate) if content is not None else np.empty(0, np.float32)
                except (wave.Error, ValueError, EOFError):
                    x = np.empty(0, np.float32)
                for t in wanted:
                    rows += [(m, t["turn_index"], k, a, b) for k, (a, b) in enumerate(split_spans(x, t["start_s"], t["end_s"], cap, rate))]
            yield pd.DataFrame(rows, columns=["meeting_id", "turn_index", "piece", "piece_start", "piece_end"]).astype({"turn_index": "int32", "piece": "int32"})

    pieces = per.join(recordings.select("meeting_id", "content"), "meeting_id", "left").mapInPandas(cut, form)
    whole = turns.where(~over).withColumn("piece", F.lit(0))
    done = turns.where(over).join(pieces, ["meeting_id", "turn_index"]).withColumns({"start_s": F.col("piece_start"), "end_s": F.col("piece_end"), "text": F.when(F.col("piece") == 0, F.col("text")).otherwise("")}).drop("piece_start", "piece_end")
    return whole.unionByName(done)


def clips(recordings: DataFrame, spans: DataFrame, have: DataFrame | None = None, rate: int = RATE) -> DataFrame:
    """(meeting_id, unit_id, wav): a clip for every span; null where there is no recording or it can't be read.

    ``have``: clips (meeting_id, unit_id, wav) that exist already; those with content are used again.
    """
    if have is None:
        have = spans.sparkSession.createDataFrame([], "meeting_id string, unit_id string, wav binary")
    kept = have.where(F.length("wav") > 0).select("meeting_id", "unit_id", "wav").join(spans.select("meeting_id", "unit_id"), ["meeting_id", "unit_id"], "left_semi")
    need = spans.join(kept, ["meeting_id", "unit_id"], "left_anti")
    made = need.select("meeting_id", "unit_id").join(crops(recordings, need, rate), ["meeting_id", "unit_id"], "left")
    return kept.unionByName(made)


def write_clips(made: DataFrame, path: str) -> None:
    """Write clips as a table under ``path``, partitioned by meeting; each ``wav`` is a whole file's bytes."""
    made.where("wav is not null").write.mode("overwrite").partitionBy("meeting_id").parquet(path)


def crops(recordings: DataFrame, spans: DataFrame, rate: int = RATE) -> DataFrame:
    """(meeting_id, unit_id, wav): a WAV of each span; recordings that can't be read give none.

    ``recordings``: meeting_id, content; ``spans``: meeting_id, unit_id, start_s, end_s. The spans of a meeting are
    gathered beside its recording, which is decoded once.
    """
    per = spans.groupBy("meeting_id").agg(F.collect_list(F.struct("unit_id", "start_s", "end_s")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for m, content, wanted in zip(pdf["meeting_id"], pdf["content"], pdf["spans"]):
                try:
                    x = decode(content, rate)
                except (wave.Error, ValueError, EOFError):
                    continue
                rows = []
                for s in wanted:
                    a, b = crop_bounds(s["start_s"], s["end_s"], len(x), rate)
                    rows.append((m, s["unit_id"], encode(x[a:b], rate)))
                yield pd.DataFrame(rows, columns=["meeting_id", "unit_id", "wav"])

    return recordings.select("meeting_id", "content").join(per, "meeting_id").mapInPandas(cut, "meeting_id string, unit_id string, wav binary")
