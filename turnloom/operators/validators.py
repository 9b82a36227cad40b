"""Rules over proposed edits, as column expressions that give the first error of a reply or null.

Edits are arrays of structs; a missing field is null. The order of the rules is part of the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.pinyin import reading_distance, readings_equal
from turnloom.functions.text import py_strip

# Tiers, anchors and kinds of edits, and their limits; the texts of the errors below are fixed as well.
TIERS = ("A", "B", "C", "punct")
ANCHORS = ("hyp", "neighbor_draft", "meeting_draft", "hotword")
KINDS = ("punc", "entity", "codeswitch")
MAX_READING_EDITS, CJK_SLACK = 2, 2

EDIT = "array<struct<span_asr:string,span_out:string,tier:string,kind:string,anchor:string,evidence:string,start_char:int>>"
REPLY = f"struct<text:string,base_model:string,edits:{EDIT},overlap:boolean>"


def first_error(items: Column, rule) -> Column:
    """The error of the first item that breaks the rule; null if none does."""
    return F.try_element_at(F.filter(F.transform(F.coalesce(items, F.array().cast(EDIT)), rule), lambda e: e.isNotNull()), F.lit(1))


def _first(*checks: tuple[Column, Column | str]) -> Column:
    """CASE over (condition, error) in order."""
    return reduce(lambda acc, c: acc.when(c[0], c[1]), checks[1:], F.when(*checks[0]))


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def judgment_schema(reply: Column) -> Column:
    """Text and base model present, edits a list (null is none); each edit an object with tier and spans, a known tier, an anchor in tier C."""
    per_edit = lambda e: _first(
        (e.isNull(), "edit must be dict"),
        (e["tier"].isNull() | e["span_asr"].isNull() | e["span_out"].isNull(), "edit missing tier/span fields"),
        (~e["tier"].isin(*TIERS), F.concat(F.lit("bad tier "), e["tier"])),
        ((e["tier"] == "C") & _empty(e["anchor"]), "Tier C requires anchor"),
    )
    return F.when(reply["text"].isNull() | reply["base_model"].isNull(), "missing text or base_model").when(reply["edits"].isNull(), "edits must be list").otherwise(first_error(reply["edits"], per_edit))


def span_local(edits: Column, most: int = 1) -> Column:
    """Both sides of an edit differ by at most ``most`` characters, punctuation apart."""
    rule = lambda e: F.when((e["tier"] != "punct") & (F.abs(F.length(e["span_out"]) - F.length(e["span_asr"])) > most), F.concat(F.lit("span_local_char_count failed for '"), e["span_asr"], F.lit("' -> '"), e["span_out"], F.lit("'")))
    return first_error(edits, rule)


def evidence_ladder(edits: Column, allowed: tuple[str, ...] | None = None, most: int = MAX_READING_EDITS) -> Column:
    """Tier B reads exactly alike, tier C has an anchor and reads nearly alike; only allowed tiers."""

    def rule(e: Column) -> Column:
        dist = reading_distance(e["span_asr"], e["span_out"])
        checks = [] if allowed is None else [(~e["tier"].isin(*allowed), F.concat(F.lit("tier '"), e["tier"], F.lit("' not allowed in this pass")))]
        checks += [
            ((e["tier"] == "B") & ~readings_equal(e["span_asr"], e["span_out"]), F.concat(F.lit("Tier B requires exact pinyin: '"), e["span_asr"], F.lit("' vs '"), e["span_out"], F.lit("'"))),
            ((e["tier"] == "C") & _empty(e["anchor"]), F.lit("Tier C requires anchor")),
            ((e["tier"] == "C") & ~e["anchor"].isin(*ANCHORS), F.concat(F.lit("bad Tier C anchor "), e["anchor"])),
            ((e["tier"] == "C") & (dist > most), F.concat(F.lit("Tier C pinyin edit distance "), dist.cast("string"), F.lit(f" > {most}"))),
        ]
        return _first(*checks)

    return first_error(edits, rule)


def pass_a_error(reply: Column) -> Column:
    """Schema over all edits, then spans over all, then the ladder over all."""
    return F.coalesce(judgment_schema(reply), span_local(reply["edits"]), evidence_ladder(reply["edits"]))


def pass_b_error(reply: Column) -> Column:
    """As the first pass, but tier A is refused before spans are looked at."""
    tier_a = F.when(F.exists(F.coalesce(reply["edits"], F.array().cast(EDIT)), lambda e: e["tier"] == "A"), "pass_b_rejects_tier_a")
    return F.coalesce(judgment_schema(reply), tier_a, span_local(reply["edits"]), evidence_ladder(reply["edits"], ("B", "C", "punct")))


def core(c: Column) -> Column:
    """Ideographs and ASCII letters and digits only."""
    return F.regexp_replace(c, r"[^\x{4e00}-\x{9fff}A-Za-z0-9]", "")


def scripts(c: Column) -> Column:
    """cjk, latin, mixed, or null for a text of neither or of ideographs beside digits alone."""
    k = core(c)
    han, lat = k.rlike(r"[\x{4e00}-\x{9fff}]"), k.rlike("[A-Za-z]")
    return F.when(han & lat, "mixed").when(han & ~k.rlike("[0-9]"), "cjk").when(lat, "latin")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{Nd}]", "")


def _letters(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^A-Za-z]", ""))


def polish_edit_error(e: Column, text: Column, hyps: Column, neighbors: Column, hotwords: Column) -> Column:
    """The first rule a polish edit breaks; ``hyps``, ``neighbors`` and ``hotwords`` are the texts it may cite."""
    a, b = F.coalesce(e["span_asr"], F.lit("")), F.coalesce(e["span_out"], F.lit(""))
    kind, anchor = F.lower(F.coalesce(e["kind"], F.lit(""))), F.coalesce(e["anchor"], F.lit(""))
    sa, sb = scripts(a), scripts(b)
    cjk_pair = F.coalesce((sa == "cjk") & (sb == "cjk"), F.lit(False))
    times = F.when(F.length(b) > 0, F.floor(F.length(a) / F.length(b)).cast("int"))
    collapse = (F.length(b) > 0) & (F.length(b) < F.length(a)) & (F.length(a) % F.greatest(F.length(b), F.lit(1)) == 0) & (F.repeat(b, times) == a)
    added = b.startswith(a) & (core(F.substring(b, F.length(a) + 1, F.length(b))) != "")
    cut = a.startswith(b) & (core(F.substring(a, F.length(b) + 1, F.length(a))) != "")
    both_latin = F.coalesce((sa == "latin") & (sb == "latin"), F.lit(False))
    same_letters = (_letters(a) != "") & (_letters(a) == _letters(b)) & ~a.rlike(r"[\x{4e00}-\x{9fff}]") & ~b.rlike(r"[\x{4e00}-\x{9fff}]")
    switch = F.coalesce((sa != sb) | ((sa == "mixed") & (sb == "mixed")), F.lit(False))
    source = F.when(anchor == "hyp", hyps).when(anchor.isin("neighbor_draft", "meeting_draft"), neighbors).when(anchor == "hotword", hotwords)
    needle = F.lower(py_strip(b))
    cited = (needle != "") & F.lower(F.coalesce(source, F.lit(""))).contains(needle)
    ok = F.lit(None).cast("string")
    return _first(
        (~kind.isin(*KINDS), F.concat(F.lit("bad kind '"), kind, F.lit("'"))),
        (a == b, ok),
        (a == "", F.lit("insertions forbidden")),
        (~text.contains(a), F.lit("span_asr not in text")),
        (_digits(a) != _digits(b), F.lit("number rewrite forbidden")),
        (collapse, F.lit("repeat collapse forbidden")),
        (cjk_pair & (F.abs(F.length(core(a)) - F.length(core(b))) > CJK_SLACK), F.lit("cjk substitution exceeds ±2 character slack")),
        (~cjk_pair & added, F.lit("added content forbidden")),
        (~cjk_pair & cut, F.lit("deleted content forbidden")),
        ((kind == "punc") & (core(a) != core(b)), F.lit("punc cannot change words")),
        (kind == "punc", ok),
        (both_latin & ~same_letters, F.lit("latin rewrite must keep the same letters")),
        (~cjk_pair & ~both_latin & ~switch, F.lit("unsupported script mix")),
        (same_letters, ok),
        (py_strip(F.coalesce(e["evidence"], F.lit(""))) == "", F.lit("missing evidence")),
        (~anchor.isin(*ANCHORS), F.concat(F.lit("bad/missing anchor '"), anchor, F.lit("'"))),
        (~cited, F.concat(F.lit("span_out not found in "), anchor, F.lit(" evidence"))),
    )


def polish_error(reply: Column, text: Column, hyps: Column, neighbors: Column, hotwords: Column) -> Column:
    """Schema of all edits first, then the discipline of each."""
    schema = lambda e: _first(
        (e.isNull(), F.lit("edit must be dict")),
        (e["span_asr"].isNull() | e["span_out"].isNull() | e["kind"].isNull(), F.lit("edit missing span_asr/span_out/kind")),
        (~F.lower(e["kind"]).isin(*KINDS), F.concat(F.lit("bad kind '"), F.lower(e["kind"]), F.lit("'"))),
    )
    return F.coalesce(F.when(reply["text"].isNull(), "missing text").when(reply["edits"].isNull(), "edits must be list"), first_error(reply["edits"], schema), first_error(reply["edits"], lambda e: polish_edit_error(e, text, hyps, neighbors, hotwords)))


def judgment_shape(reply: Column) -> Column:
    """Whether a polish reply can be read at all: text and a list of edits; their rules need the texts they cite."""
    return F.when(reply["text"].isNull(), "missing text").when(reply["edits"].isNull(), "edits must be list")


def apply_first(text: Column, edits: Column) -> Column:
    """Each edit replaces the first occurrence of its span, one after the other; spans that aren't there change nothing."""
    def step(acc: Column, e: Column) -> Column:
        at = F.locate_column(acc, e["span_asr"]) if hasattr(F, "locate_column") else F.instr(acc, e["span_asr"])
        return F.when((e["span_asr"] != "") & (at > 0), F.concat(F.substring(acc, F.lit(1), at - 1), e["span_out"], F.substring(acc, at + F.length(e["span_asr"]), F.length(acc)))).otherwise(acc)

    return F.aggregate(F.coalesce(edits, F.array().cast(EDIT)), text, step)


def locate_polish(text: Column, edits: Column) -> Column:
    """The edits that can be placed, in order, as (span_asr, span_out, kind, anchor, evidence, start_char, end_char).

    A place given by a valid hint counts, else the first occurrence; edits of unknown kind, without change, without a
    place, or that overlap one placed before are left out.
    """
    t = "array<struct<span_asr:string,span_out:string,kind:string,anchor:string,evidence:string,start_char:int,end_char:int>>"

    def step(acc: Column, e: Column) -> Column:
        a, b, hint = F.coalesce(e["span_asr"], F.lit("")), F.coalesce(e["span_out"], F.lit("")), e["start_char"]
        hinted = hint.isNotNull() & (hint >= 0) & (hint + F.length(a) <= F.length(text)) & (F.substring(text, hint + 1, F.length(a)) == a)
        found = F.when(a == "", F.when(hinted, hint)).when(hinted, hint).otherwise(F.nullif(F.instr(text, a), F.lit(0)) - 1).cast("int")
        stop = found + F.length(a)
        clash = F.exists(acc, lambda o: (found < o["end_char"]) & (stop > o["start_char"]))
        ok = F.lower(F.coalesce(e["kind"], F.lit(""))).isin(*KINDS) & (a != b) & found.isNotNull() & ~clash
        item = F.struct(a.alias("span_asr"), b.alias("span_out"), F.lower(e["kind"]).alias("kind"), e["anchor"].alias("anchor"), e["evidence"].alias("evidence"), found.alias("start_char"), stop.alias("end_char"))
        return F.when(ok, F.concat(acc, F.array(item))).otherwise(acc)

    return F.aggregate(F.coalesce(edits, F.array().cast(EDIT)), F.array().cast(t), step)


def apply_located(text: Column, located: Column) -> Column:
    """The text with the placed edits put in; places are offsets of the text as it was."""
    byplace = F.array_sort(F.transform(located, lambda x: F.struct(x["start_char"].alias("a"), x["end_char"].alias("b"), x["span_out"].alias("o"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, x: F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["a"] - acc["at"]), x["o"]).alias("out"), x["b"].alias("at"))
    return F.aggregate(byplace, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
