"""Clean, ordered speaker turns from transcripts.

A finite-state parser (``transcript_lines``) reads texts of several lines in the known caption and transcript layouts;
each line is then read by regular grammars in order: tool times, sound annotations, speaker labels, then standalone
hesitations, each taken off before the next is read. All of that runs as JVM expressions. Consecutive lines of a speaker
are merged by a carried scan over range-sorted rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import fold_width, py_strip, speaker_label
from turnloom.llm.transcript_lines import parse_lines
from turnloom.operators.intervals import valid_times
from turnloom.operators.sequences import label_runs
from turnloom.session import checkpointed

_CLOCK = r"[0-9]{1,4}:[0-5]?[0-9](?::[0-5]?[0-9])?(?:[.,][0-9]{1,6})?"
_STAMP = r"[0-9]{1,3}:[0-5][0-9]:[0-5][0-9](?:[.,][0-9]{1,6})?"
#: Layouts of recording times: caption ranges, clocks in any bracket, clocks before a bar, seconds in braces or tags, bare stamps to the second.
TIMESTAMP = "|".join(
    [
        rf"{_CLOCK}\s*-{{1,2}}>\s*{_CLOCK}",
        rf"[\[【〔<({{（]\s*{_CLOCK}(?:\s*[-–~]+>?\s*{_CLOCK})?\s*/?\s*[\]】〕>)}}）]",
        rf"(?<![0-9:]){_CLOCK}\s*\|",
        r"[<\[{(]\s*(?:t|time|ts)\s*[=:]\s*[0-9]+(?:\.[0-9]+)?\s*s?\s*/?[>\]})]",
        r"[{\[<(]\s*[0-9]+(?:\.[0-9]+)?\s*s\s*[}\]>)]",
        rf"(?<![0-9:.]){_STAMP}(?![0-9:])",
    ]
)
# Stems of words for noises and silence.
SOUND_EN = "laugh|chuckl|giggl|cough|sneez|sniff|sigh|breath|inhal|exhal|yawn|music|song|singing|applau|clap|noise|noisy|static|silen|inaudible|unintelligible|indistinct|crosstalk|cross-talk|ring|beep|buzz|click|knock|door|footstep|typing|keyboard|chatter|background|pause|phone|throat|hum|thud|bang|rustl"
SOUND_ZH = "笑|咳|静音|静默|沉默|无声|音乐|掌声|鼓掌|敲门|关门|开门|门声|噪音|噪声|杂音|呼吸|叹气|叹息|喘|喷嚏|铃声|电话响|听不清|听不见|脚步|背景音|键盘|清嗓|哈欠|口哨"
_SOUND_BODY = rf"(?:(?:[\p{{L}}-]+\s+){{0,2}}(?:{SOUND_EN})[\p{{L}}-]*(?:\s+[\p{{L}}-]+){{0,2}}|[\p{{IsHan}}]{{0,4}}(?:{SOUND_ZH})[\p{{IsHan}}]{{0,3}})"
SOUND = rf"(?i)[\[【〔<({{（]{{1,2}}\s*{_SOUND_BODY}\s*[\]】〕>)}}）]{{1,2}}|\*{{1,2}}\s*{_SOUND_BODY}\s*\*{{1,2}}|[♩♪♫♬]+"
#: Labels at the head of a line: "speaker_3:", "S2>", "[spk5]" and their other spellings.
LABEL = r"(?im)^[\s>|\-–—,，.。、…]*(?:(?:speaker|spk|s|发言人|说话人)[\s_\-]*[0-9]+\s*[:：>]+|[\[【〔<({（](?:speaker|spk|s|发言人|说话人)[\s_\-]*[0-9]+[\]】〕>)}）]\s*[:：]?)"
FILLER = r"(?i)(?<![\p{L}\p{N}\p{M}'’])(?:u+h+m*|u+m+|h+m+|m{2,}|e+rm*|[嗯呃额唔]+)(?![\p{L}\p{N}\p{M}'’])"

#: Look-alikes of letters that occur in hesitation words and labels.
_LIKE, _LATIN = "аеорсухіѕѐАВЕМНОРСТХЅІΑΒΕΗΜΝΟΡΤΧΥΖµ", "aeopcyxisеABEMHOPCTXSIABEHMNOPTXYZu"


#: Cheap necessary conditions of the grammars: most lines meet none and skip them.
_MAY_TIME, _MAY_SOUND, _MAY_LABEL, _MAY_FILL = r"[0-9][:s.][0-9}\])>/\s]|[0-9]s?\s*/?[}\])>】〕）]", r"[\[【〔<({（*♩♪♫♬]", r"[0-9]\s*[:：>\]】〕)}）]", r"(?i)[嗯呃额唔]|u[hm]|h+m|mm|e+r"
_MAY_FOLD = r"[^\x00-\x7e\x{3001}-\x{9fff}\x{ff01}-\x{ff0f}\x{ff1a}-\x{ff1f}\x{2010}-\x{2027}]"


def _off(c: str, may: str, grammar: str) -> Column:
    """The text without what the grammar reads, where it can read anything."""
    return F.when(F.col(c).rlike(may), F.regexp_replace(c, grammar, " ")).otherwise(F.col(c))


def mark_dirt(turns: DataFrame, text: str = "text", speaker: str = "speaker_id") -> DataFrame:
    """``turns`` with ``speaker`` (speaker_N or unknown in column ``clean_speaker``), ``dirt`` (kinds found) and ``clean_text``.

    Null and empty texts carry no dirt of the text and give an empty clean_text; a null label is dirt of kind label.
    Whole texts are read. A remark in brackets stays unless it names a sound; a time stays unless a tool set it.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    out = turns.withColumn("__seen", F.when(raw.rlike(_MAY_FOLD), fold_width(raw)).otherwise(raw))
    out = out.withColumn("__t", _off("__seen", _MAY_TIME, TIMESTAMP)).withColumn("__s", _off("__t", _MAY_SOUND, SOUND)).withColumn("__l", _off("__s", _MAY_LABEL, LABEL))
    out = out.withColumn("__p", F.when(F.col("__l").rlike(r"[\p{IsCyrillic}\p{IsGreek}]"), F.translate("__l", _LIKE, _LATIN)).otherwise(F.col("__l")))
    bad_label = ~F.coalesce(F.col(speaker), F.lit("")).rlike(r"^speaker_(?:0|[1-9][0-9]*)$")
    kinds = {
        "timestamp": F.col("__t") != F.col("__seen"),
        "filler": F.col("__p").rlike(_MAY_FILL) & F.col("__p").rlike(FILLER),
        "sound": F.col("__s") != F.col("__t"),
        "label": bad_label | (F.col("__l") != F.col("__s")),
    }
    gone = _off("__l", _MAY_FILL, FILLER + r"[…~.]*[,，、]?")
    tidy = F.regexp_replace(F.regexp_replace(gone, r"\s+", " "), r"^[\s,，、.。…\-–|]+|[\s,，、]+(?=[,，、。.!?！？]|$)|(?<=[，、。？！])\s+(?=\p{IsHan})", "")
    return out.withColumns(
        {
            "dirt": F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()])),
            "clean_speaker": speaker_label(F.col(speaker)),
            "clean_text": py_strip(tidy),
        }
    ).drop("__seen", "__t", "__s", "__l", "__p")


def _parsed(turns: DataFrame, text: str = "text") -> DataFrame:
    """``turns`` with ``__read``: the parser's state after a text of several lines, null for one line."""
    raw = F.when(F.col(text).rlike("[\r\n]"), F.col(text))
    return turns.withColumn("__read", F.when(raw.isNotNull(), parse_lines(F.when(raw.rlike(_MAY_FOLD), fold_width(raw)).otherwise(raw))))


def dirty_turns(current: DataFrame) -> DataFrame:
    """One row per turn and kind of dirt: (turn_id, dirt, speaker)."""
    read = _parsed(current.select("turn_id", "speaker_id", "text"))
    read = read.withColumn("text", F.when(F.col("__read").isNull(), F.col("text")).otherwise(F.array_join(F.transform("__read.lines", lambda x: x["text"]), "\n")))
    more = F.when(F.col("__read").isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(F.when(F.col("__read.times"), F.lit("timestamp")), F.when(F.col("__read.labels"), F.lit("label")))))
    marked = mark_dirt(read).select("turn_id", F.when(F.col("__read").isNull(), F.col("dirt")).otherwise(F.array_union("dirt", more)).alias("dirt"), F.col("clean_speaker").alias("speaker"))
    # an outer explode: the filter that Spark infers for an inner one is pushed below the grammars and runs them again
    return marked.select("turn_id", F.explode_outer("dirt").alias("dirt"), "speaker").where("dirt is not null")


def turn_lines(turns: DataFrame) -> DataFrame:
    """(meeting_id, turn_id, line, start_ms, end_ms, speaker_id, text): a row per line that speaks; ``turns`` has times in ms.

    A line's own times and name hold where its layout gives them, else those of its turn.
    """
    own = F.struct(F.col("start_ms"), F.col("end_ms"), F.lit(None).cast("string").alias("label"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.when(F.col("__read").isNull(), F.array(own)).otherwise(F.col("__read.lines"))
    x = _parsed(turns).select("meeting_id", "turn_id", "speaker_id", F.col("start_ms").alias("s"), F.col("end_ms").alias("e"), F.posexplode(lines).alias("line", "x"))
    return x.select("meeting_id", "turn_id", "line", F.coalesce("x.start_ms", "s").alias("start_ms"), F.coalesce("x.end_ms", F.greatest("x.start_ms", "e"), "e").alias("end_ms"), F.coalesce("x.label", "speaker_id").alias("speaker_id"), F.col("x.label").alias("label"), F.col("x.text").alias("text"))


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of their runs: one row for each stretch of a run within the partition."""
    held: list | None = None  # meeting, run, speaker, first start, greatest end, texts
    for pdf in batches:
        out = []
        if not len(pdf):
            continue
        run = pdf["run"].to_numpy(np.int64)
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
        ends, texts = pdf["end_ms"].to_numpy(np.int64), pdf["clean_text"].tolist()
        for a, b in zip(cuts, cuts[1:]):
            r = int(run[a])
            if held is None or held[1] != r:
                if held is not None:
                    out.append((*held[:5], " ".join(held[5]), len(held[5])))
                held = [pdf["meeting_id"].iat[a], r, pdf["clean_speaker"].iat[a], int(pdf["start_ms"].iat[a]), int(ends[a]), []]
            held[4] = max(held[4], int(ends[a:b].max()))
            held[5] += texts[a:b]
        yield pd.DataFrame(out, columns=["meeting_id", "run", "speaker", "start_ms", "end_ms", "text", "n"])
    if held is not None:
        yield pd.DataFrame([(*held[:5], " ".join(held[5]), len(held[5]))], columns=["meeting_id", "run", "speaker", "start_ms", "end_ms", "text", "n"])


def speaker_turns(current: DataFrame, partitions: int | None = None) -> DataFrame:
    """Clean turns, consecutive lines of one speaker merged: (meeting_id, start_ms, end_ms, speaker, text, n_turns).

    Order is by start and end, then turn_id and line. The rows are range-sorted, so a meeting that holds a third of them
    is spread over many tasks; the run that is open at a partition's end is carried over as one row per partition, and a
    run's lines are joined within each partition before its parts meet. ``speaker`` is speaker_N, a name that the text
    itself gives, or unknown; ``n_turns`` counts lines. Turns with impossible times and lines of which nothing is left
    are not in the result.
    """
    rows = valid_times(current.where(F.col("meeting_id").isNotNull())).select("meeting_id", "turn_id", "start_ms", "end_ms", "speaker_id", "text")
    # written once before the range sort, which reads its input twice, and before lines without text are filtered, since
    # that filter would be pushed below the grammars and run them again
    rows = checkpointed(mark_dirt(turn_lines(rows)).select(
        "meeting_id", "start_ms", "end_ms", "turn_id", "line", F.xxhash64("turn_id", "line").alias("row_key"), "clean_text",
        F.when((F.col("clean_speaker") == "unknown") & F.col("label").isNotNull(), F.trim("label")).otherwise(F.col("clean_speaker")).alias("clean_speaker"),
    )).where("clean_text <> ''")

    def breaks(before: pd.DataFrame, now: pd.DataFrame) -> np.ndarray:
        return before["clean_speaker"].to_numpy(object) != now["clean_speaker"].to_numpy(object)

    runs = label_runs(rows, "meeting_id", ["start_ms", "end_ms", "turn_id", "line"], "row_key", breaks, partitions=partitions)
    parts = runs.mapInPandas(_merged, "meeting_id string, run bigint, speaker string, start_ms bigint, end_ms bigint, text string, n bigint")
    whole = parts.groupBy("meeting_id", "run", "speaker").agg(F.min("start_ms").alias("first"), F.max("end_ms").alias("last"), F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "text"))).alias("x"), F.sum("n").alias("n_turns"))
    return whole.select("meeting_id", F.col("first").alias("start_ms"), F.col("last").alias("end_ms"), "speaker", F.array_join(F.transform("x", lambda y: y["text"]), " ").alias("text"), "n_turns")
