"""Text expressions that stay inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the metrics ignore besides white space.
CER_PUNCT = "，。！？、；：,.!?;:\"'“”‘’（）()【】[]《》<>…—-"
#: White space as Python's str.strip sees it, as a Java character class body.
PY_WS = "\\u0009-\\u000d\\u001c-\\u0020\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters that are not seen: soft hyphen, zero-width marks, direction marks, word joiner, byte order mark.
INVISIBLE = "\\u00ad\\u034f\\u061c\\u180e\\u200b-\\u200f\\u202a-\\u202e\\u2060-\\u2064\\u2066-\\u206f\\ufeff"
SPACES = "\\u00a0\\u1680\\u2000-\\u200a\\u202f\\u205f\\u3000"


def py_strip(c: Column) -> Column:
    """Strip Unicode white space at both ends, as Python does."""
    return F.regexp_replace(c, f"^[{PY_WS}]+|[{PY_WS}]+$", "")


def normalize_for_cer(c: Column) -> Column:
    """Without white space and the listed punctuation."""
    inside = "".join("\\" + ch if ch in "[]()-\\^&\"'.?!" else ch for ch in CER_PUNCT)
    return F.regexp_replace(c, f"[{PY_WS}{inside}]", "")


@lru_cache(1)
def width_pairs() -> tuple[str, str]:
    """Full-width letters and digits, radicals and compatibility ideographs with the one character each stands for, by rule."""
    spans = [(0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0x2E80, 0x2FD5), (0xF900, 0xFAFF)]
    pairs = [(chr(o), unicodedata.normalize("NFKC", chr(o))) for a, b in spans for o in range(a, b + 1)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_width(c: Column) -> Column:
    """A copy for matching: no invisible characters, plain spaces, ordinary width; punctuation stays."""
    a, b = width_pairs()
    c = F.regexp_replace(F.regexp_replace(c, f"[{INVISIBLE}]", ""), f"[{SPACES}]", " ")
    return F.translate(c, a, b)


def speaker_number(c: Column) -> Column:
    """The digits of a speaker label in any of its spellings, without leading zeros; null if it names nobody."""
    found = F.regexp_extract(fold_width(c), r"(?i)^[^\p{L}\p{N}]*(?:speaker|spk|s|发言人|说话人)[\s_\-]*0*([0-9]+)[^\p{L}\p{N}]*$", 1)
    return F.when(found != "", found)


def speaker_label(c: Column) -> Column:
    """speaker_N for any spelling, else unknown (null, empty and unreadable labels)."""
    return F.coalesce(F.concat(F.lit("speaker_"), speaker_number(c)), F.lit("unknown"))
