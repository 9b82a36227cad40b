"""Readings of ideographs as column expressions.

The table is made once on the driver by the ICU transliterator that Spark ships: each ideograph gets its toneless
reading, each reading of more than one letter one private code point. A text is then encoded by the built-in
``translate``, equality of readings is equality of strings, and the distance of readings is ``levenshtein``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.text import PY_WS

FIRST, LAST = 0x4E00, 0x9FFF


@lru_cache(1)
def _table() -> tuple[str, str, dict[str, str]]:
    jvm = SparkSession.getActiveSession().sparkContext._jvm
    reader = jvm.com.ibm.icu.text.Transliterator.getInstance("Han-Latin; Latin-ASCII; Lower")
    chars = [chr(o) for o in range(FIRST, LAST + 1)]
    read = reader.transliterate("\n".join(chars)).split("\n")
    if len(read) != len(chars):
        read = [reader.transliterate(c) for c in chars]
    codes: dict[str, str] = {}
    out, known = [], []
    for c, r in zip(chars, (x.strip() for x in read)):
        if not r.isascii() or not r.isalpha():
            continue
        known.append(c)
        out.append(r if len(r) == 1 else codes.setdefault(r, chr(0xE000 + len(codes))))
    return "".join(known), "".join(out), codes


def encode_readings(c: Column) -> Column:
    """One character per syllable or other character, white space dropped."""
    src, dst, _ = _table()
    return F.translate(F.regexp_replace(c, f"[{PY_WS}]", ""), src, dst)


def readings_equal(a: Column, b: Column) -> Column:
    """Whether two texts are read alike, tones aside."""
    return encode_readings(a) == encode_readings(b)


def reading_distance(a: Column, b: Column) -> Column:
    """Edits between the syllables of two texts."""
    return F.levenshtein(encode_readings(a), encode_readings(b))


def to_pinyin(c: Column) -> Column:
    """Syllables of a text with spaces between; other characters stand alone."""
    _, _, codes = _table()
    back = F.map_from_arrays(F.array(*[F.lit(v) for v in codes.values()]), F.array(*[F.lit(k) for k in codes]))
    return F.array_join(F.transform(F.split(encode_readings(c), ""), lambda x: F.coalesce(F.try_element_at(back, x), x)), " ")
