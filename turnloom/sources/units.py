"""Stored units and hypothesis records: JSON files of either shape, read, reused and written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT = "struct<unit_id:string,start:double,end:double,speaker_id:string,turn_indices:array<int>,overlap_ratio:double,contains_overlap:boolean,heavy_overlap:boolean,skip_asr:boolean,skip_reason:string,moss_merged:boolean>"
RECORD = "struct<unit_id:string,turn_indices:array<int>,contains_overlap:boolean,heavy_overlap:boolean,skipped:boolean,reason:string,hyps:array<struct<model:string,text:string,lid:string,meta:map<string,string>>>>"


def _members(raw: Column, name: str, kind: str) -> Column:
    """The list ``name`` of a root object, or a bare list; members that don't fit are dropped, another root gives none."""
    listed = F.when(F.trim(raw).startswith("["), raw).otherwise(F.try_variant_get(F.try_parse_json(raw), f"$.{name}", "string"))
    texts = F.filter(F.coalesce(F.from_json(listed, "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x).startswith("{"))
    return F.transform(texts, lambda x: F.from_json(x, kind))


def read_units(docs: DataFrame, key: Column) -> DataFrame:
    """(meeting_id, unit_seq, unit_id, start_s, end_s, …): stored units of documents (path, raw), with the defaults of missing fields."""
    x = docs.select(key.alias("meeting_id"), F.posexplode(_members(F.col("raw"), "units", UNIT)).alias("unit_seq", "u"))
    flags = [F.coalesce(F.col(f"u.{c}"), F.lit(False)).alias(c) for c in ("contains_overlap", "heavy_overlap", "skip_asr", "moss_merged")]
    return x.select("meeting_id", "unit_seq", "u.unit_id", F.col("u.start").alias("start_s"), F.col("u.end").alias("end_s"), "u.speaker_id", F.coalesce("u.turn_indices", F.array().cast("array<int>")).alias("turn_indices"), F.coalesce("u.overlap_ratio", F.lit(0.0)).alias("overlap_ratio"), *flags, "u.skip_reason")


def units_json(units: DataFrame, skipped: DataFrame) -> DataFrame:
    """(meeting_id, value): one document per meeting with its units and the turns left out for their times (index, reason)."""
    fields = ["unit_id", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "speaker_id", "turn_indices", "overlap_ratio", "contains_overlap", "heavy_overlap", "skip_asr", "skip_reason", "moss_merged"]
    u = units.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("unit_seq", F.struct(*fields).alias("u")))).alias("us"))
    k = skipped.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn_index").alias("index"), "reason"))).alias("skipped_invalid_ts"))
    both = u.join(k, "meeting_id", "full").withColumn("us", F.transform("us", lambda x: x["u"]))
    none = lambda c: F.array().cast(both.schema[c].dataType)
    return both.select("meeting_id", F.to_json(F.struct(F.coalesce("us", none("us")).alias("units"), F.coalesce("skipped_invalid_ts", none("skipped_invalid_ts")).alias("skipped_invalid_ts"))).alias("value"))


def reuse_or_build(stored: DataFrame, meetings: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stored units of the meetings that have some, and units built for all others; ``build`` gets (meeting_id) of those."""
    have = stored.select("meeting_id").distinct()
    return stored.unionByName(build(meetings.select("meeting_id").distinct().join(have, "meeting_id", "left_anti")), allowMissingColumns=True)


def read_records(docs: DataFrame, key: Column) -> DataFrame:
    """(meeting_id, unit_id, turn_indices, contains_overlap, heavy_overlap, skipped, reason, hyps) of stored hypothesis records; of one unit the last holds."""
    x = docs.select(key.alias("meeting_id"), F.posexplode(_members(F.col("raw"), "records", RECORD)).alias("at", "r"))
    last = x.where("r.unit_id is not null").groupBy("meeting_id", F.col("r.unit_id").alias("unit_id")).agg(F.max_by("r", "at").alias("r"))
    return last.select("meeting_id", "unit_id", "r.turn_indices", F.coalesce("r.contains_overlap", F.lit(False)).alias("contains_overlap"), F.coalesce("r.heavy_overlap", F.lit(False)).alias("heavy_overlap"), F.coalesce("r.skipped", F.lit(False)).alias("skipped"), "r.reason", F.coalesce("r.hyps", F.array().cast("array<struct<model:string,text:string,lid:string,meta:map<string,string>>>")).alias("hyps"))


def records_json(records: DataFrame, stage: str, models: list[str]) -> DataFrame:
    """(meeting_id, value): hypothesis records of each meeting, those of skipped units too, with stage, models and count in the meta."""
    r = F.struct("unit_id", "turn_indices", "contains_overlap", "heavy_overlap", "skipped", "reason", "hyps")
    g = records.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("unit_id", F.to_json(r).alias("r")))).alias("x"))
    meta = F.to_json(F.struct(F.lit(stage).alias("stage"), F.array(*[F.lit(m) for m in sorted(models)]).alias("models"), F.size("x").alias("count")))
    return g.select("meeting_id", F.concat(F.lit('{"meta":'), meta, F.lit(',"records":['), F.array_join(F.transform("x", lambda y: y["r"]), ","), F.lit("]}")).alias("value"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, raw) of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
