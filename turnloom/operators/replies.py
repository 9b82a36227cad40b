"""Replies of a model as data: the JSON object in free text, its reasoning, typed errors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators.validators import EDIT, REPLY

# Names of blocks that hold reasoning.
BLOCKS = ("think", "thinking", "reason", "reasoning")
_BLOCK = re.compile("|".join([rf"<{b}>(.*?)</{b}>" for b in BLOCKS] + ["◁think▷(.*?)◁/think▷"]), re.S | re.I)
_FENCE = re.compile(r"\A```(?:json|JSON)?\s*|\s*```\Z")


def first_object(text: str) -> str | None:
    """The first balanced object of a text, braces inside strings apart."""
    begin, depth, at = text.find("{"), 0, 0
    if begin < 0:
        return None
    for m in re.compile(r'"(?:[^"\\]|\\.)*"|[{}"]', re.S).finditer(text, begin):
        if m.group() == '"':
            return None  # the string never ends
        if m.group() == "{":
            depth += 1
        elif m.group() == "}":
            depth -= 1
            if not depth:
                at = m.end()
                break
    return text[begin:at] if at else None


def split_reply(raw: str | None) -> tuple[str | None, str | None, str | None]:
    """(json_text, reasoning, error) of a reply; reasoning is what the blocks hold, else what stands before the object."""
    raw = raw or ""
    thoughts = [g.strip() for m in _BLOCK.finditer(raw) for g in m.groups() if g and g.strip()]
    rest = _FENCE.sub("", _FENCE.sub("", _BLOCK.sub("", raw).strip()))
    for source in (rest, raw):
        got = first_object(source)
        if got is not None:
            before = source[: source.find("{")].strip()
            return got, "\n\n".join(thoughts) or before or None, None
    return None, "\n\n".join(thoughts) or None, "no JSON object"


def extract_json(df: DataFrame, key: str, reply: str) -> DataFrame:
    """(key, json_text, reasoning, error): one row per row; a null reply counts as an empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [split_reply(r if isinstance(r, str) else None) for r in pdf[reply]]
            yield pd.DataFrame({key: pdf[key], "json_text": [g[0] for g in got], "reasoning": [g[1] for g in got], "error": [g[2] for g in got]}).astype({"json_text": object, "reasoning": object, "error": object})

    return df.select(key, reply).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, json_text string, reasoning string, error string")


def _present(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant").isNotNull()


def _text(v: Column, path: str) -> Column:
    """A field as text: null where the key is missing, "None" where its value is null."""
    return F.when(_present(v, path), F.coalesce(F.try_variant_get(v, path, "string"), F.lit("None")))


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def parsed(json_text: Column) -> Column:
    """The reply struct of a JSON text; null where it isn't an object.

    ``edits`` is empty where the key is missing and null where it isn't a list; a member that isn't an object is null.
    """
    v = F.try_parse_json(json_text)
    one = lambda e: F.struct(
        *[_text(e, f"$.{k}").alias(k) for k in ("span_asr", "span_out", "tier", "kind")],
        *[F.try_variant_get(e, f"$.{k}", "string").alias(k) for k in ("anchor", "evidence")], F.try_variant_get(e, "$.start_char", "int").alias("start_char"),
    )
    members = F.transform(F.try_variant_get(v, "$.edits", "array<variant>"), lambda e: F.when(_is(e, "OBJECT"), one(e)))
    edits = F.when(~_present(v, "$.edits"), F.array().cast(EDIT)).when(_is(F.try_variant_get(v, "$.edits", "variant"), "ARRAY"), members.cast(EDIT))
    reply = F.struct(_text(v, "$.text").alias("text"), _text(v, "$.base_model").alias("base_model"), edits.alias("edits"), F.coalesce(F.try_variant_get(v, "$.overlap", "boolean"), F.lit(False)).alias("overlap"))
    return F.when(_is(v, "OBJECT"), reply.cast(REPLY))


def parse_error(json_text: Column) -> Column:
    """Why there is no reply: no object found in the text, broken JSON, another root; null where there is one."""
    v = F.try_parse_json(json_text)
    return F.when(json_text.isNull(), "no JSON object").when(v.isNull(), "LLM JSON parse failed").when(~_is(v, "OBJECT"), "LLM JSON root must be object")


def coerced(reply: Column) -> Column:
    """A reply with defaults: empty texts, tier A, no edits; members that aren't objects are left out."""
    edit = lambda e: e.withField("tier", F.coalesce(e["tier"], F.lit("A"))).withField("span_asr", F.coalesce(e["span_asr"], F.lit(""))).withField("span_out", F.coalesce(e["span_out"], F.lit("")))
    edits = F.transform(F.filter(F.coalesce(reply["edits"], F.array().cast(EDIT)), lambda e: e.isNotNull()), edit)
    return reply.withField("text", F.coalesce(reply["text"], F.lit(""))).withField("base_model", F.coalesce(reply["base_model"], F.lit(""))).withField("edits", edits).withField("overlap", F.coalesce(reply["overlap"], F.lit(False)))
