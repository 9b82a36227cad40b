"""Batches of inputs: discovery over folders, a limit on pairs, guarded reading and the summary of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.operators.reports import discover
from turnloom.sources.meetings import turns_of


def tree(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(dataset, stem, path) of the files root/dataset/stem + suffix; names only, no content is read. A missing root fails."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).load(root).select("path")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return files.select(F.element_at(parts, -2).alias("dataset"), F.left(name, F.length(name) - len(suffix)).alias("stem"), "path")


def discover_trees(spark: SparkSession, audio_root: str, document_root: str, datasets: list[str] | None = None, suffix: str = ".json") -> tuple[DataFrame, DataFrame]:
    """(pairs, skips) over two folders: recordings with and without a document; pairs have both paths."""
    a, d = tree(spark, audio_root, ".wav"), tree(spark, document_root, suffix)
    pairs, skips = discover(a.select("dataset", "stem"), d, datasets)
    with_paths = pairs.join(a.withColumnRenamed("path", "wav"), ["dataset", "stem"]).join(d.withColumnRenamed("path", "document"), ["dataset", "stem"])
    return with_paths, skips


def first_pairs(pairs: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` pairs in order of dataset and stem; none for 0 or less, all for null. Skips aren't affected."""
    return pairs if n is None else pairs.orderBy("dataset", "stem").limit(max(0, n))


def guarded_turns(docs: DataFrame, key: Column, most: int = 500, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(turns, status): turns of the documents that can be read, and (path, ok, error) of each; with ``fail_fast`` the first bad one raises."""
    v = F.try_parse_json("raw")
    body = F.try_variant_get(v, "$.turns", "variant")
    root = F.substring_index(F.schema_of_variant(v), "<", 1)
    error = F.when(v.isNull(), F.lit("not JSON")).when(~root.isin("OBJECT", "ARRAY"), F.concat(F.lit("root is "), F.lower(root))).when((root == "OBJECT") & body.isNotNull() & ~F.schema_of_variant(body).startswith("ARRAY"), F.lit("turns is not a list"))
    status = docs.select("path", error.isNull().alias("ok"), F.left(error, F.lit(most)).alias("error"))
    if fail_fast:
        return turns_of(docs, key), status
    return turns_of(docs.where(error.isNull()), key), status


def run_summary(status: DataFrame, skips: DataFrame) -> DataFrame:
    """(n_ok, n_error, n_skip, errors): one row for a run; ``errors`` has the path and error of each bad sample."""
    rows = status.select("ok", F.lit(False).alias("skip"), "path", "error").unionByName(skips.select(F.lit(None).cast("boolean").alias("ok"), F.lit(True).alias("skip"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("error")))
    bad = F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("path", "error"))))
    return rows.agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_error"), F.count_if("skip").alias("n_skip"), bad.alias("errors"))
