"""Lists of hotwords from JSON arrays, JSON objects or plain lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.text import py_strip


def read_hotwords(spark: SparkSession, path: str) -> DataFrame:
    """(pos, term): stripped terms in order; blanks, comments and later repeats are dropped.

    A file whose first character opens an array or object is JSON (an object holds the list under ``hotwords`` or
    ``words``; another type there is refused), else each line is a term.
    """
    raw = spark.read.text(path, wholetext=True).select(py_strip(F.col("value")).alias("raw"))
    head = F.substring("raw", 1, 1)
    inner = F.coalesce(F.get_json_object("raw", "$.hotwords"), F.get_json_object("raw", "$.words"), F.lit("[]"))
    wrong = F.raise_error(F.lit("the object must hold a list of hotwords")).cast("array<string>")
    terms = F.when(head == "[", F.from_json("raw", "array<string>")).when(head == "{", F.when(inner.startswith("["), F.from_json(inner, "array<string>")).otherwise(wrong)).otherwise(F.split("raw", r"\r\n|\n|\r"))
    t = raw.select(F.posexplode(terms).alias("pos", "term")).withColumn("term", py_strip(F.col("term"))).where((F.col("term") != "") & ~F.col("term").startswith("#"))
    return t.groupBy("term").agg(F.min("pos").alias("pos")).select("pos", "term")
