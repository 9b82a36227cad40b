"""One consistent form for texts that look alike.

Texts that hold any character outside the plain set are cut into segments, the suspicious segments are exploded to
positioned code points, joined to a broadcast table of decompositions and look-alikes (its size is bounded by the
Unicode tables), combining marks are ordered by class, pairs are recomposed, and the strings are rebuilt. Dirty rows
are shuffled once, by row; plain texts aren't shuffled or exploded at all.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Cyrillic and Greek letters that look like a Latin letter, and the Latin letter.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ё": "ë", "ї": "ï", "ӕ": "æ",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ё": "Ë", "Ї": "Ï",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
}
# Radicals of the supplement that have no decomposition, and a letter of phonetic script, with what they look like.
SUPPLEMENT = dict(zip("⻅⻆⻉⻋⻓⻔⻙⻚⻛⻜⻝⻢⻥⻦⻨⻩⻬⻮⻰⺠⻁⻄⻘⻤⻣ɡ", "见角贝车长门韦页风飞食马鱼鸟麦黄齐齿龙民虎西青鬼骨g"))
INVISIBLE_SPANS = ((0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF9, 0xFFFB), (0xE0000, 0xE007F), (0xE0100, 0xE01EF))
_INV = r"\x{00ad}\x{034f}\x{061c}\x{180b}-\x{180f}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}"
_EMO = r"\x{1f000}-\x{1faff}\x{2600}-\x{27bf}\x{2190}-\x{21ff}\x{2300}-\x{23ff}\x{2b00}-\x{2bff}\x{2049}\x{203c}\x{3030}\x{303d}\x{3297}\x{3299}"
EMOJI = rf"(?:[0-9#*]\x{{fe0f}}?\x{{20e3}}|[{_EMO}](?:[\x{{1f3fb}}-\x{{1f3ff}}]|[\x{{e0020}}-\x{{e007f}}]|\x{{fe0f}}|\x{{20e3}}|\x{{200d}}(?=[{_EMO}]))*)+"
_WORD = rf"[\p{{IsLatin}}\p{{IsCyrillic}}\p{{IsGreek}}][\p{{IsLatin}}\p{{IsCyrillic}}\p{{IsGreek}}\p{{M}}{_INV}]*"
SEGMENT = rf"{EMOJI}|{_WORD}|(?:(?![{_EMO}]|[0-9#*]\x{{fe0f}}?\x{{20e3}}|[\p{{IsLatin}}\p{{IsCyrillic}}\p{{IsGreek}}])[\s\S])+|[\s\S]"
#: A character outside the plain set, or a word that mixes scripts.
SUSPICIOUS = (
    r"[^\x{0009}-\x{007e}\x{00a1}-\x{00ac}\x{00ae}-\x{00bf}\x{00c0}-\x{017f}\x{0391}-\x{03a9}\x{03b1}-\x{03c9}\x{0386}-\x{0390}\x{03ac}-\x{03ce}\x{0400}-\x{045f}"
    r"\x{2010}-\x{2027}\x{2030}-\x{205e}\x{2190}-\x{22ff}\x{2460}-\x{27bf}\x{3001}-\x{3029}\x{3030}\x{3041}-\x{3096}\x{309d}-\x{309e}\x{30a0}-\x{30fe}\x{3400}-\x{9fff}\x{ac00}-\x{d7a3}"
    r"\x{ff01}-\x{ff0f}\x{ff1a}-\x{ff20}\x{ff3b}-\x{ff40}\x{ff5b}-\x{ff5e}\x{1f000}-\x{1faff}\x{20000}-\x{2a6df}]"
    r"|[\p{IsLatin}][\p{IsCyrillic}\p{IsGreek}]|[\p{IsCyrillic}\p{IsGreek}][\p{IsLatin}]|\x{0131}|\x{0149}|\x{0132}|\x{0133}|\x{013f}|\x{0140}|\x{017f}"
)
_KEPT_TAGS = ("<wide>", "<narrow>", "<compat>", "<font>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
_L, _V, _T, _S = 0x1100, 0x1161, 0x11A7, 0xAC00


def _decompose(ch: str) -> list[str] | None:
    """Full decomposition over canonical and look-alike (width, font, ligature, radical) mappings; null if there is none."""
    d = unicodedata.decomposition(ch).split()
    if not d or (_S <= ord(ch) <= 0xD7A3):
        return None
    if d[0].startswith("<"):
        kind = unicodedata.category(ch)
        if d[0] not in _KEPT_TAGS or not (kind[0] in "LNM" or kind == "Zs" or 0x2E80 <= ord(ch) <= 0x2FDF):
            return None
        d = d[1:]
    out = []
    for x in d:
        out += _decompose(chr(int(x, 16))) or [chr(int(x, 16))]
    return out


@lru_cache(1)
def form_rows() -> list[tuple[str, list[tuple[str, int]], str]]:
    """(character, replacement with combining classes, where it applies) by rule from the Unicode tables.

    ``where`` is any, or the script that a word mixing scripts is taken for: latin if each of its other letters looks
    like a Latin one, else cyrillic or greek, whose letters then replace the Latin ones.
    """
    hidden = {o for a, b in INVISIBLE_SPANS for o in range(a, b + 1)}
    rows = []
    for o in [*range(0x80, 0x20000), *range(0x2F800, 0x2FA20)]:
        if 0xD800 <= o <= 0xDFFF or 0x4E00 <= o <= 0x9FFF or 0xE000 <= o <= 0xF8FF:
            continue
        ch = chr(o)
        if o in hidden:
            continue
        out = _decompose(ch)
        if unicodedata.category(ch) == "Zs":
            out = [" "]
        if out is None and unicodedata.combining(ch):
            out = [ch]
        if out is not None and not (o in range(0x0370, 0x0530) and ch in LOOK_ALIKES):
            rows.append((ch, [(x, unicodedata.combining(x)) for x in out], "any"))
    rows += [(chr(o), [], "any") for o in hidden]
    rows += [(a, [(b, 0)], "any") for a, b in SUPPLEMENT.items()]
    for a, b in LOOK_ALIKES.items():
        rows.append((a, [(x, unicodedata.combining(x)) for x in unicodedata.normalize("NFD", b)], "latin"))
        if len(b) == 1 and b.isascii():
            rows.append((b, [(a, 0)], "greek" if ord(a) < 0x400 else "cyrillic"))
    return rows


@lru_cache(1)
def compositions() -> dict[str, str]:
    """Pairs of characters and the one they compose to, without Hangul, which follows a formula."""
    out = {}
    for o in range(0xA0, 0x20000):
        ch = chr(o)
        d = unicodedata.decomposition(ch).split()
        if len(d) == 2 and not d[0].startswith("<") and unicodedata.normalize("NFC", ch) == ch:
            out["".join(chr(int(x, 16)) for x in d)] = ch
    return out


def _composite(a: Column, b: Column) -> Column:
    """The character that a and b compose to, or null."""
    pairs = compositions()
    table = F.map_from_arrays(F.array(*[F.lit(k) for k in pairs]), F.array(*[F.lit(v) for v in pairs.values()]))
    syllables = F.lit("".join(chr(o) for o in range(_S, _S + 11172)))
    at = lambda n: F.substring(syllables, n.cast("int") + 1, F.lit(1))
    ca, cb = F.ascii(a), F.ascii(b)
    lv = ca.between(_L, _L + 18) & cb.between(_V, _V + 20)
    lvt = ca.between(_S, 0xD7A3) & ((ca - _S) % 28 == 0) & cb.between(_T + 1, _T + 27)
    return F.when(lv, at(((ca - _L) * 21 + (cb - _V)) * 28)).when(lvt, at(ca - _S + cb - _T)).when((cb < 0x80) | (ca.between(0x3400, 0x9FFF)), None).otherwise(F.try_element_at(table, F.concat(a, b)))


def _recompose(e: Column) -> Column:
    """The string of ordered (character, class) elements, marks sorted by class within their run and pairs composed."""
    starter = lambda i: F.size(F.filter(F.slice(e, F.lit(1), i + 1), lambda y: y["k"] == 0))
    keyed = F.array_sort(F.transform(e, lambda x, i: F.struct(starter(i).alias("s"), x["k"].alias("k"), i.alias("i"), x["c"].alias("c"))))
    zero = F.struct(F.lit("").alias("out"), F.lit("").alias("st"), F.lit("").alias("tail"), F.lit(0).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        free = (acc["st"] != "") & F.when(x["k"] == 0, acc["tail"] == "").otherwise((acc["tail"] == "") | (acc["last"] < x["k"]))
        made = F.when(free, _composite(acc["st"], x["c"]))
        new_start = F.struct(F.concat(acc["out"], acc["st"], acc["tail"]).alias("out"), x["c"].alias("st"), F.lit("").alias("tail"), F.lit(0).alias("last"))
        kept = F.struct(acc["out"].alias("out"), acc["st"].alias("st"), F.concat(acc["tail"], x["c"]).alias("tail"), x["k"].alias("last"))
        joined = F.struct(acc["out"].alias("out"), made.alias("st"), acc["tail"].alias("tail"), acc["last"].alias("last"))
        return F.when(made.isNotNull(), joined).when(x["k"] == 0, new_start).otherwise(kept)

    return F.aggregate(keyed, zero, step, lambda acc: F.concat(acc["out"], acc["st"], acc["tail"]))


def form_table(spark: SparkSession) -> DataFrame:
    """The table of form_rows as a DataFrame to broadcast; a few thousand rows, however large the data."""
    return spark.createDataFrame(form_rows(), "ch string, to array<struct<c:string,k:int>>, place string")


def one_form_changes(texts: DataFrame) -> DataFrame:
    """(tbl, row_id, text_hash, one_form) of each distinct text whose one form differs from it.

    ``texts`` has tbl, row_id and text; extra columns are ignored. Null and empty texts have no change. Rows that
    repeat a text under one id give one row.
    """
    keys = ["tbl", "row_id", "text_hash"]  # a row's texts are told apart by their hash, so that no text is a key
    dirty = texts.where(F.col("row_id").isNotNull()).select("tbl", "row_id", "text").where(F.col("text").rlike(SUSPICIOUS))
    seg = dirty.select("tbl", "row_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.regexp_extract_all("text", F.lit(f"({SEGMENT})"), F.lit(1))).alias("seg", "piece"))
    bad = F.col("piece").rlike(SUSPICIOUS + r"|\p{M}") & ~F.col("piece").rlike(f"^(?:{EMOJI})$")
    mixed = F.col("piece").rlike(r"\p{IsLatin}") & F.col("piece").rlike(r"[\p{IsCyrillic}\p{IsGreek}]")
    alien = F.translate("piece", "".join(LOOK_ALIKES), "")
    place = F.when(mixed, F.when(alien.rlike(r"\p{IsCyrillic}"), "cyrillic").when(alien.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))
    seg = seg.withColumn("mix", place).withColumn("bad", bad)
    cps = seg.select(*keys, "seg", "piece", "mix", "bad", F.posexplode(F.when(F.col("bad"), F.split("piece", "")).otherwise(F.array("piece"))).alias("idx", "ch"))
    table = F.broadcast(form_table(texts.sparkSession))
    hit = cps.join(table, (cps["ch"] == table["ch"]) & cps["bad"] & ((table["place"] == "any") | (table["place"] == cps["mix"])), "left").drop(table["ch"])
    one = F.when(F.col("to").isNotNull(), F.col("to")).otherwise(F.array(F.struct(F.col("ch").alias("c"), F.lit(0).alias("k"))))
    per_seg = hit.groupBy(*keys, "seg", "piece").agg(F.array_sort(F.collect_set(F.struct("idx", one.alias("to")))).alias("e"), F.first("bad").alias("bad"))
    flat = F.flatten(F.transform("e", lambda x: x["to"]))
    per_seg = per_seg.withColumn("e", flat)
    plain = ~F.exists("e", lambda x: (x["k"] > 0) | F.ascii(x["c"]).between(_L, 0x11FF))
    form = F.when(~F.col("bad"), F.col("piece")).when(plain, F.array_join(F.transform("e", lambda x: x["c"]), "")).otherwise(_recompose(F.col("e")))
    per_seg = per_seg.select(*keys, "seg", form.alias("form"), "piece")
    whole = per_seg.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "form"))), lambda x: x["form"]), "").alias("one_form"), F.bool_or(F.col("form") != F.col("piece")).alias("changed"))
    return whole.where("changed").drop("changed")


def one_form(texts: DataFrame) -> DataFrame:
    """(tbl, row_id, one_form) of every row with a row_id: plain texts pass as they are, null stays null."""
    rows = texts.where(F.col("row_id").isNotNull()).select("tbl", "row_id", "text", F.when(F.col("text").rlike(SUSPICIOUS), F.xxhash64("text")).alias("text_hash"))
    changed = one_form_changes(texts)
    plain = rows.where("text_hash is null").select("tbl", "row_id", F.col("text").alias("one_form"))
    dirty = rows.where("text_hash is not null").join(changed, ["tbl", "row_id", "text_hash"], "left")
    return plain.unionByName(dirty.select("tbl", "row_id", F.coalesce("one_form", "text").alias("one_form")))


def looks_alike_texts(turns: DataFrame, hyps: DataFrame) -> DataFrame:
    """(tbl, row_id, text) of both tables."""
    a = turns.select(F.lit("turns").alias("tbl"), F.col("turn_id").alias("row_id"), "text")
    return a.unionByName(hyps.select(F.lit("hyps").alias("tbl"), F.col("hyp_id").alias("row_id"), "text"))


def found_look_alikes(turns: DataFrame, hyps: DataFrame) -> DataFrame:
    """(tbl, row_id): each text that the one form changes."""
    return one_form_changes(looks_alike_texts(turns, hyps)).select("tbl", "row_id").distinct()
