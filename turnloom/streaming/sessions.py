"""Turns as a stream: sessions per meeting and speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def speaker_sessions(turns: DataFrame, gap: str = "5 seconds", late: str = "10 minutes", time: str = "at") -> DataFrame:
    """(meeting_id, speaker, session_start, session_end, n_turns) of a stream of turns with an event time.

    A session ends after ``gap`` without a turn; turns later than ``late`` are dropped by the watermark, whose state
    is one open session per meeting and speaker. Works on a batch as well.
    """
    seen = turns.withWatermark(time, late)
    s = F.session_window(time, gap)
    out = seen.groupBy("meeting_id", "speaker", s.alias("w")).agg(F.count(F.lit(1)).alias("n_turns"))
    return out.select("meeting_id", "speaker", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_turns")
