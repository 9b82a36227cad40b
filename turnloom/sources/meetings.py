"""Meeting documents: JSON files of turns, read and written one file per meeting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TURN = "struct<start:double,end:double,speaker_id:string,text:string,asr_status:string,source:string,confidence:double>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, raw): whole files, so that a root of either shape can be told apart."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def turns_of(docs: DataFrame, key: Column) -> DataFrame:
    """(meeting_id, turn_index, start_s, end_s, speaker_id, text, asr_status, source, confidence).

    The root is an object with a list ``turns`` or a bare list; members that aren't objects are dropped before
    positions are counted. Any other root, and ``turns`` that isn't a list, fails with an error that names the path.
    """
    v = F.try_parse_json("raw")
    bare = F.trim("raw").startswith("[")
    body = F.when(bare, F.col("raw")).otherwise(F.try_variant_get(v, "$.turns", "string"))
    listed = F.when(bare | (F.trim("raw").startswith("{") & (body.isNull() | F.trim(body).startswith("["))), F.coalesce(body, F.lit("[]")))
    items = F.from_json(listed, "array<string>")
    checked = F.when(v.isNull() | listed.isNull(), F.raise_error(F.concat(F.lit("not a turns document: "), F.col("path"))).cast("array<string>")).otherwise(items)
    objects = F.filter(checked, lambda x: F.trim(x).startswith("{"))
    t = docs.select(key.alias("meeting_id"), F.posexplode(objects).alias("turn_index", "item")).withColumn("t", F.from_json("item", TURN))
    return t.select("meeting_id", "turn_index", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), "t.speaker_id", F.coalesce("t.text", F.lit("")).alias("text"), "t.asr_status", F.coalesce("t.source", F.lit("fused")).alias("source"), F.coalesce("t.confidence", F.lit(1.0)).alias("confidence"))


def meeting_json(turns: DataFrame, stage: str, metas: DataFrame | None = None, order: str = "turn_index", **extra: Column) -> DataFrame:
    """(meeting_id, value): one JSON document per meeting with its turns in order.

    The meta is that of ``metas`` (meeting_id, meta as a JSON object) with the stage and ``extra`` put over it; columns of
    ``turns`` beyond the fields of a turn (unit_id, turn_indices) are written with each turn.
    """
    fields = [F.col("start_s").alias("start"), F.col("end_s").alias("end"), "speaker_id", "text", "asr_status", "source", "confidence", *[c for c in ("unit_id", "turn_indices") if c in turns.columns]]
    grouped = turns.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.struct(*fields).alias("t")))).alias("x"), *[c.alias(k) for k, c in extra.items()])
    own = F.from_json(F.to_json(F.struct(F.lit(stage).alias("stage"), *extra)), "map<string,string>")
    if metas is None:
        grouped = grouped.withColumn("old", F.lit(None).cast("map<string,string>"))
    else:
        grouped = grouped.join(metas.select("meeting_id", F.from_json("meta", "map<string,string>").alias("old")), "meeting_id", "left")
    kept = F.coalesce(F.map_filter("old", lambda k, v: ~F.array_contains(F.map_keys(own), k)), F.expr("cast(map() as map<string,string>)"))
    return grouped.select("meeting_id", F.to_json(F.struct(F.map_concat(kept, own).alias("meta"), F.transform("x", lambda y: y["t"]).alias("turns"))).alias("value"))


def metas_of(docs: DataFrame, key: Column) -> DataFrame:
    """(meeting_id, meta): the meta object of each document that has one, as JSON."""
    return docs.select(key.alias("meeting_id"), F.try_variant_get(F.try_parse_json("raw"), "$.meta", "string").alias("meta")).where("meta is not null")


def write_meetings(turns: DataFrame, stage: str, path: str, **options) -> None:
    """Write meeting_json under ``path``, one folder per meeting."""
    meeting_json(turns, stage, **options).repartition("meeting_id").write.mode("overwrite").partitionBy("meeting_id").text(path)


def merged_json(grid: DataFrame, n_turns: DataFrame, stage: str, metas: DataFrame | None = None) -> DataFrame:
    """(meeting_id, value): the merged grid, one turn per unit with its unit_id and turn_indices; the meta names the grid and the number of source turns.

    ``grid``: a turn's fields, unit_seq, unit_id, turn_indices; ``n_turns``: meeting_id, n_source_turns.
    """
    rows = grid.join(n_turns, "meeting_id", "left")
    return meeting_json(rows, stage, metas, "unit_seq", grid=F.lit("asr_units"), n_source_turns=F.max("n_source_turns"))


def replace_audits(audits: DataFrame, path: str) -> None:
    """Write audit rows as JSON lines partitioned by pass; passes that aren't in ``audits`` stay as they are."""
    audits.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pass").json(path)
