"""Counts over audits and runs, replacement of audit partitions, discovery of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unit_pass_stats(decisions: DataFrame, *by: str, alarm: float = 0.05) -> DataFrame:
    """Counts of the first pass, the share of failed attempts among judged units, and whether it passes the alarm."""
    n = lambda c: F.count_if(F.col(c))
    out = decisions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_units"), n("skipped_llm").alias("skipped_llm"), F.sum("retries").alias("retries_total"), n("fallback").alias("fallback_to_best_hyp"), n("fallback_ok").alias("fallback_judge_success"))
    judged = F.col("n_units") - F.col("skipped_llm")
    out = out.withColumn("approx_retry_rate", F.round(F.when(judged > 0, F.col("retries_total") / judged).otherwise(0.0), 9))
    return out.withColumn("suggest_raise_temperature", F.col("approx_retry_rate") > alarm)


def path_counts(audits: DataFrame, paths: list[str], *by: str) -> DataFrame:
    """Number of audit rows, and of each path in a column of its own."""
    return audits.groupBy(*by).agg(F.count(F.lit(1)).alias("n_audits"), *[F.count_if(F.col("path") == p).alias(p) for p in paths])


def turn_pass_stats(audits: DataFrame, *by: str) -> DataFrame:
    """Counts over the audits of the second pass: (by, n_audits, hotword_alias, llm_edits, llm_fallback, fallback_judge_success, moss_aware_reject, moss_force, empty_edits_reject, n_batched).

    ``audits``: path, fallback_ok. All rows of a judge are batched here; aliases and forced moss texts come without one.
    """
    path = F.col("path")
    return audits.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_audits"), F.count_if(path == "hotword_alias").alias("hotword_alias"), F.count_if(path == "llm").alias("llm_edits"), F.count_if(path == "fallback").alias("llm_fallback"),
        F.count_if(F.coalesce("fallback_ok", F.lit(False))).alias("fallback_judge_success"), F.count_if(path == "moss_aware_reject").alias("moss_aware_reject"), F.count_if(path == "moss_force").alias("moss_force"),
        F.count_if(path == "empty_edits_reject").alias("empty_edits_reject"), F.count_if(~path.isin("hotword_alias", "moss_force")).alias("n_batched"),
    )


def polish_stats(audits: DataFrame) -> DataFrame:
    """(measure, value, n): totals of the polish audits, and histograms of their edits by kind and by anchor."""
    llm = F.col("path") == "llm"
    pair = lambda name, value=None: F.struct(F.lit(name).alias("measure"), (F.lit(None).cast("string") if value is None else value).alias("value"))
    rows = F.array(
        pair("n_audits"), F.when(llm, pair("llm_edits")), F.when(F.col("path") == "empty_edits_reject", pair("empty_edits_reject")), F.when(F.col("path") == "fallback", pair("fallback")),
        F.when(llm & (F.col("kind") != ""), pair("kind", F.col("kind"))), F.when(llm & (F.col("anchor") != ""), pair("anchor", F.col("anchor"))),
    )
    return audits.select(F.explode(F.array_compact(rows)).alias("x")).groupBy(F.col("x.measure").alias("measure"), F.col("x.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def recovered(before: DataFrame, still: DataFrame, key: str) -> DataFrame:
    """(key): what failed before and doesn't any more."""
    return before.select(key).distinct().join(still.select(key), key, "left_anti")


def histogram(audits: DataFrame, column: str, *by: str) -> DataFrame:
    """(by, column, n): how often each value occurs, nulls left out."""
    return audits.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))


def replace_pass(kept: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """Audit rows with one pass replaced: rows of other passes stay, ``new`` stands for this one (null passes stay)."""
    return kept.where(~F.col("pass").eqNullSafe(F.lit(name))).unionByName(new.withColumn("pass", F.lit(name)), allowMissingColumns=True)


def discover(audio: DataFrame, documents: DataFrame, datasets: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, skips) of inputs by (dataset, stem): those with a document, and those without as missing_mode_c."""
    a = audio if datasets is None else audio.where(F.col("dataset").isin(*datasets))
    d = documents.select("dataset", "stem").distinct()
    return a.join(d, ["dataset", "stem"], "left_semi"), a.join(d, ["dataset", "stem"], "left_anti").withColumn("reason", F.lit("missing_mode_c"))


def overlap_metadata(units: DataFrame) -> DataFrame:
    """(meeting_id, turn_index, in_overlap, in_heavy): the union of the flags of the units a turn belongs to."""
    x = units.select("meeting_id", F.explode("turn_indices").alias("turn_index"), F.coalesce("contains_overlap", F.lit(False)).alias("o"), F.coalesce("heavy_overlap", F.lit(False)).alias("h"))
    return x.groupBy("meeting_id", "turn_index").agg(F.bool_or("o").alias("in_overlap"), F.bool_or("h").alias("in_heavy"))
