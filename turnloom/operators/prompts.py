"""Prompts of the passes as column expressions over one row per unit or turn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.pinyin import to_pinyin

JUDGE_SYSTEM = "You correct transcripts of meetings by what was heard. You reply with one JSON object and nothing else."
POLISH_SYSTEM = "You tidy the text of one meeting turn. You reply with one JSON object and nothing else."

_JUDGE = """### Task
Choose or correct the wording of one unit. Change only what the hypotheses, their readings or the context support.

### Rules
- Tier A: a hypothesis as it stands. Tier B: other characters read exactly alike. Tier C: at most two syllables differ and an anchor supports it.
- Each edit keeps the length of its span to within one character. Under heavy overlap start from moss.
- Without evidence keep the hypothesis.

### Inputs
Hypotheses:
{hyps}
Hotwords: {hotwords}
Neighbours: {neighbors}
Overlap: {overlap}
Heavy overlap: {heavy}

### Reply
{"text": "...", "base_model": "...", "edits": [{"span_asr": "...", "span_out": "...", "tier": "A|B|C|punct", "anchor": "hyp|neighbor_draft|meeting_draft|hotword"}], "overlap": true|false}
"""

_POLISH = """### Task
Polish one turn by local edits: punctuation, names and mixed-script words that a source below contains. Numbers stay as they are.

### Inputs
Turn {index}: {text}
Hypotheses:
{hyps}
Hotwords: {hotwords}
Neighbours: {neighbors}

### Reply
{"text": "...", "edits": [{"span_asr": "...", "span_out": "...", "kind": "punc|entity|codeswitch", "anchor": "hyp|neighbor_draft|meeting_draft|hotword", "evidence": "...", "start_char": 0}]}
"""


def _fill(template: str, **values: Column) -> Column:
    """The template with each {name} replaced; braces of the reply's form stay, and values are never read as templates."""
    parts, rest = [], template
    while True:
        at = min((rest.find("{" + k + "}") for k in values if "{" + k + "}" in rest), default=-1)
        if at < 0:
            return F.concat(*parts, F.lit(rest))
        end = rest.index("}", at)
        parts += [F.lit(rest[:at]), F.coalesce(values[rest[at + 1 : end]], F.lit(""))]
        rest = rest[end + 1 :]


def hypothesis_lines(hyps: Column, readings: bool = True) -> Column:
    """One line for each hypothesis, with its reading; (none) where there is none."""
    text = lambda h: F.coalesce(h["text"], F.lit(""))
    line = lambda h: F.concat(F.lit("- "), h["model"], F.lit(": "), text(h), *([F.lit(" (pinyin: "), to_pinyin(text(h)), F.lit(")")] if readings else []))
    return F.when(F.size(F.coalesce(hyps, F.array().cast("array<struct<model:string,text:string>>"))) > 0, F.array_join(F.transform(hyps, line), "\n")).otherwise("(none)")


def flag(c: Column) -> Column:
    """true or false; null counts as false."""
    return F.when(c, "true").otherwise("false")


def judge_prompt(hyps: Column, hotwords: Column, neighbors: Column, overlap: Column, heavy: Column, readings: bool = True) -> Column:
    """The prompt of the first and the second pass; hotwords and neighbours are JSON texts."""
    return _fill(_JUDGE, hyps=hypothesis_lines(hyps, readings), hotwords=hotwords, neighbors=neighbors, overlap=flag(overlap), heavy=flag(heavy))


def polish_prompt(index: Column, text: Column, hyps: Column, hotwords: Column, neighbors: Column) -> Column:
    """The prompt of the polish."""
    return _fill(_POLISH, index=index.cast("string"), text=text, hyps=hypothesis_lines(hyps, readings=False), hotwords=hotwords, neighbors=neighbors)
