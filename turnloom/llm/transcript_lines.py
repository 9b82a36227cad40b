"""A finite-state parser over the lines of a transcript, as one JVM expression.

Layouts: caption files (numbered cues or with a header, notes, cue names and settings), lines with a bracketed time, and
lines that begin with a speaker's name. Each line moves the automaton between its states (between cues, header, note,
cue name seen, inside a cue) and gives at most one piece of text with the times and the name that hold for it. A text of
one line has one state only and is left to the line's own grammars.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BETWEEN, HEADER, NOTE, NAMED, CUE = range(5)
LINE = "struct<start_ms:bigint,end_ms:bigint,label:string,text:string>"
STATE = f"struct<state:int,captions:boolean,held:string,start_ms:bigint,end_ms:bigint,times:boolean,labels:boolean,lines:array<{LINE}>>"

_TIME = r"(?:[0-9]{1,4}:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]{1,6})?"
TIME_LINE = rf"^\s*({_TIME})\s*-{{1,2}}>\s*({_TIME})(?:\s.*)?$"
LEAD_TIME = rf"^\s*[\[(【（<]\s*({_TIME})(?:\s*[-–~]+>?\s*({_TIME}))?\s*[\])】）>]\s*(.*)$"
VOICE = r"^\s*<v(?:\.[^\s>]+)*\s+([^>]+)>\s*(.*)$"
#: A name before a colon: one to three capitalised words, or two to four ideographs; also the known labels with a number.
NAME = r"^\s*(?:[-–>]+\s*)?(\p{Lu}[\p{L}'’.-]*(?:\s\p{Lu}[\p{L}'’.-]*){0,2}|\p{IsHan}{2,4}|(?i:speaker|spk|s|发言人|说话人)[\s_-]*[0-9]+)\s*[:：]\s+?(\S.*)$|^\s*(\p{IsHan}{2,4}|(?:发言人|说话人)[\s_-]*[0-9]+)[:：](\S.*)$"
TAGS = rf"</?(?:c|i|b|u|v|ruby|rt|lang)(?:[.\s][^>]*)?>|<{_TIME}>"


def milliseconds(clock: Column) -> Column:
    """A clock of two or three parts, with a point or a comma before fractions, in whole milliseconds; null for none."""
    parts = F.split(F.replace(clock, F.lit(","), F.lit(".")), ":")
    secs = F.aggregate(parts, F.lit(0.0), lambda acc, p: acc * 60 + p.cast("double"))
    return F.when(clock != "", F.round(secs * 1000).cast("bigint"))


def _state(acc: Column, state: Column | int | None = None, add: Column | None = None, **new: Column) -> Column:
    """The state after a line: what isn't named stays."""
    lines = acc["lines"] if add is None else F.concat(acc["lines"], F.array(add.cast(LINE)))
    values = {c: acc[c] for c in ("captions", "held", "start_ms", "end_ms", "times", "labels")} | new
    first = acc["state"] if state is None else F.lit(state) if isinstance(state, int) else state
    return F.struct(first.alias("state"), *[v.alias(k) for k, v in values.items()], lines.alias("lines")).cast(STATE)


def _piece(acc: Column, label: Column, text: Column, start: Column | None = None, end: Column | None = None) -> Column:
    return F.struct((acc["start_ms"] if start is None else start).alias("start_ms"), (acc["end_ms"] if end is None else end).alias("end_ms"), label.alias("label"), text.alias("text"))


def parse_lines(text: Column) -> Column:
    """The state after the last line of a text of several lines: its pieces in ``lines``, whether ``times`` and ``labels`` stood in it.

    Null gives null. A name counts as a label only where at least two lines begin with one, so that a single "Note: …"
    stays text. A number that stands alone is a cue number only if a time line follows.
    """
    none, no = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    rows = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")
    named = F.size(F.filter(rows, lambda x: x.rlike(NAME))) >= 2
    zero = F.struct(F.lit(BETWEEN).alias("state"), F.lit(False).alias("captions"), none.alias("held"), no.alias("start_ms"), no.alias("end_ms"), F.lit(False).alias("times"), F.lit(False).alias("labels"), F.array().cast(f"array<{LINE}>").alias("lines")).cast(STATE)

    def step(acc: Column, row: Column) -> Column:
        in_cue, free = acc["state"] == CUE, acc["state"].isin(BETWEEN, NAMED)
        line = F.when(in_cue, F.regexp_replace(row, rf"(?!<v[.\s]){TAGS}", "")).otherwise(row)
        part = lambda p, k: F.regexp_extract(line, p, k)
        name = F.coalesce(F.nullif(part(NAME, 1), F.lit("")), F.nullif(part(NAME, 3), F.lit("")))
        said = F.coalesce(F.nullif(part(NAME, 2), F.lit("")), F.nullif(part(NAME, 4), F.lit("")))
        lead_a, lead_b, lead_text = milliseconds(part(LEAD_TIME, 1)), milliseconds(part(LEAD_TIME, 2)), part(LEAD_TIME, 3)
        after = lambda p, k: F.regexp_extract(lead_text, p, k)
        lead_name = F.when(named | lead_text.rlike(NAME), F.coalesce(F.nullif(after(NAME, 1), F.lit("")), F.nullif(after(NAME, 3), F.lit(""))))
        lead_said = F.when(lead_name.isNotNull(), F.coalesce(F.nullif(after(NAME, 2), F.lit("")), F.nullif(after(NAME, 4), F.lit("")))).otherwise(lead_text)
        held = F.when(acc["held"].isNotNull(), F.array(_piece(acc, none, acc["held"]).cast(LINE))).otherwise(F.array().cast(f"array<{LINE}>"))
        kept = acc.withField("lines", F.concat(acc["lines"], held)).withField("held", none)  # what was held turns out to be text
        return (
            F.when(F.trim(line) == "", _state(kept, BETWEEN, start_ms=no, end_ms=no))
            .when(acc["state"].isin(HEADER, NOTE) & ~line.rlike(TIME_LINE), acc)
            .when((acc["state"] == BETWEEN) & (F.size(acc["lines"]) == 0) & line.rlike(r"^\x{feff}?WEBVTT(?:\s|$)"), _state(acc, HEADER, captions=F.lit(True)))
            .when((acc["state"] == BETWEEN) & acc["captions"] & line.rlike(r"^(?:NOTE|STYLE|REGION)(?:\s|$)"), _state(acc, NOTE))
            .when(line.rlike(TIME_LINE), _state(acc, CUE, held=none, times=F.lit(True), start_ms=milliseconds(part(TIME_LINE, 1)), end_ms=milliseconds(part(TIME_LINE, 2))))
            .when((free | in_cue) & line.rlike(r"^\s*[0-9]+\s*$") | (acc["state"] == BETWEEN) & acc["captions"], _state(kept, NAMED, held=line))
            .when(row.rlike(VOICE), _state(kept, add=_piece(kept, F.regexp_extract(row, VOICE, 1), F.regexp_replace(F.regexp_extract(row, VOICE, 2), TAGS, "")), labels=F.lit(True)))
            .when(line.rlike(LEAD_TIME), _state(kept, add=_piece(kept, lead_name, lead_said, lead_a, lead_b), times=F.lit(True), labels=acc["labels"] | lead_name.isNotNull()))
            .when(named & line.rlike(NAME), _state(kept, add=_piece(kept, name, said), labels=F.lit(True)))
            .otherwise(_state(kept, F.when(acc["state"] == NAMED, F.when(acc["start_ms"].isNotNull(), CUE).otherwise(BETWEEN)).otherwise(acc["state"]), add=_piece(kept, none, line)))
        )

    done = F.aggregate(rows, zero, step)
    return F.transform(F.array(done), lambda acc: F.when(acc["held"].isNotNull(), acc.withField("lines", F.concat(acc["lines"], F.array(_piece(acc, none, acc["held"]).cast(LINE))))).otherwise(acc))[0]
