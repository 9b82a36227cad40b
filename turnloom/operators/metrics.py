"""Character error rates and their aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.pinyin import encode_readings
from turnloom.functions.text import normalize_for_cer


BANDS = (8, 32, 128)  # edits within which the distance is looked for, one after the other


def _edits(a: Column, b: Column) -> Column:
    """Edit distance; equal texts, which are most, are not walked, and others in widening bands before the whole table."""
    near = [F.levenshtein(a, b, band) for band in BANDS]
    found = F.when(near[0] >= 0, near[0]).when(near[1] >= 0, near[1]).when(near[2] >= 0, near[2]).otherwise(F.levenshtein(a, b))
    return F.when(a == b, 0).otherwise(found)


def _rate(edits: Column, n_ref: Column, n_hyp: Column) -> Column:
    return F.when((n_ref == 0) & (n_hyp == 0), 0.0).when(n_ref == 0, 1.0).otherwise(edits / n_ref)


def error_rate(ref: Column, hyp: Column) -> Column:
    """Edits per reference character after normalisation; 0 if both are empty, 1 if only the reference is; may exceed 1."""
    r, h = normalize_for_cer(ref), normalize_for_cer(hyp)
    return _rate(_edits(r, h), F.length(r), F.length(h))


def reading_error_rate(ref: Column, hyp: Column) -> Column:
    """The same over syllables."""
    r, h = encode_readings(normalize_for_cer(ref)), encode_readings(normalize_for_cer(hyp))
    return _rate(_edits(r, h), F.length(r), F.length(h))


def _distances(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the edit distance of two columns, each band a column of its own, so that no distance is computed twice."""
    df = df.withColumn("__d", F.when(F.col(a) == F.col(b), 0).otherwise(F.levenshtein(a, b, BANDS[0])))
    for band in (*BANDS[1:], None):
        wider = F.levenshtein(a, b) if band is None else F.levenshtein(a, b, band)
        df = df.withColumn("__d", F.when(F.col("__d") >= 0, F.col("__d")).otherwise(wider))
    return df.withColumnRenamed("__d", name)


def cer_rows(pairs: DataFrame, readings: bool = False) -> DataFrame:
    """``pairs`` (ref, hyp) with n_ref, edits and cer; with ``readings`` also cp_cer, the mean of character and syllable rate.

    Null counts as empty.
    """
    ref, hyp = F.coalesce("ref", F.lit("")), F.coalesce("hyp", F.lit(""))
    out = pairs.withColumns({"__r": normalize_for_cer(ref), "__h": normalize_for_cer(hyp)})
    return _rated(out, readings)


def _rated(out: DataFrame, readings: bool) -> DataFrame:
    """Rates of normalised texts __r and __h, which are dropped."""
    out = _distances(out.withColumn("n_ref", F.length("__r")), "__r", "__h", "edits")
    out = out.withColumn("cer", _rate(F.col("edits"), F.col("n_ref"), F.length("__h")))
    if readings:
        out = _distances(out.withColumns({"__pr": encode_readings(F.col("__r")), "__ph": encode_readings(F.col("__h"))}), "__pr", "__ph", "__pe")
        out = out.withColumn("cp_cer", (F.col("cer") + _rate(F.col("__pe"), F.length("__pr"), F.length("__ph"))) / 2).drop("__pr", "__ph", "__pe")
    return out.drop("__r", "__h")


def unit_rates(hyps: DataFrame, refs: DataFrame, readings: bool = False) -> DataFrame:
    """(unit_key, model, n_ref, edits, cer and cp_cer with ``readings``) of each hypothesis of a unit with a reference.

    ``hyps``: unit_key, model, text; ``refs``: unit_key, ref. Hypotheses are gathered by unit first, so a reference goes
    through one join and is normalised once, and the distance is taken once for all models that say the same.
    """
    said = F.struct("model", normalize_for_cer(F.coalesce("text", F.lit(""))).alias("h"))
    by = hyps.groupBy("unit_key").agg(F.collect_list(said).alias("said")).join(refs.select("unit_key", normalize_for_cer(F.coalesce("ref", F.lit(""))).alias("__r")), "unit_key")
    texts = by.select("unit_key", "said", "__r", F.explode(F.array_distinct(F.transform("said", lambda x: x["h"]))).alias("__h"))
    texts = texts.withColumn("who", F.transform(F.filter("said", lambda x: x["h"] == F.col("__h")), lambda x: x["model"])).drop("said")
    rated = _rated(texts, readings)
    return rated.select("unit_key", F.explode("who").alias("model"), *[c for c in rated.columns if c not in ("unit_key", "who")])


def document_rates(ref: DataFrame, hyp: DataFrame, readings: bool = False) -> DataFrame:
    """(meeting_id, pos, n_ref, edits, cer, …) of two documents of a meeting, compared place by place; the longer one's rest is left out.

    Both: meeting_id, pos, text.
    """
    pairs = ref.select("meeting_id", "pos", F.col("text").alias("ref")).join(hyp.select("meeting_id", "pos", F.col("text").alias("hyp")), ["meeting_id", "pos"])
    return cer_rows(pairs, readings).drop("ref", "hyp")


def document_report(ref: DataFrame, hyp: DataFrame, readings: bool = False) -> DataFrame:
    """(meeting_id, n_turns, n_hyp, n_ref, mean_cer, corpus_cer, …): one row per meeting that either document has."""
    size = lambda df, name: df.groupBy("meeting_id").agg(F.count(F.lit(1)).alias(name))
    rates = cer_report(document_rates(ref, hyp, readings), "meeting_id").withColumnRenamed("n", "n_turns")
    both = size(ref, "n_ref").join(size(hyp, "n_hyp"), "meeting_id", "full").join(rates, "meeting_id", "left")
    return both.select("meeting_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_turns", "n_hyp", "n_ref")], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in rates.columns if c not in ("meeting_id", "n_turns")])


def aligned_report(places: DataFrame, readings: bool = False) -> DataFrame:
    """``document_report`` of two documents whose places are those of one table: (meeting_id, ref, hyp), null ``hyp`` where the second has none.

    Every place is in the first document, so no join on places is needed and each meeting is one aggregate.
    """
    heard = F.col("hyp").isNotNull()
    rows = cer_rows(places.where("meeting_id is not null").withColumns({"heard": heard, "ref": F.when(heard, F.col("ref"))}), readings)
    held = [c for c in ("n_ref", "edits", "cer", "cp_cer") if c in rows.columns]
    rows = rows.select("meeting_id", "heard", *[F.when(F.col("heard"), F.col(c)).alias(c) for c in held])
    n = F.count_if("heard")
    out = rows.groupBy("meeting_id").agg(n.alias("n_turns"), n.alias("n_hyp"), F.count(F.lit(1)).alias("places"), *_rates_of(rows))
    return out.withColumnRenamed("places", "n_ref")


def _rates_of(rows: DataFrame) -> list[Column]:
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 9).alias("mean_" + c)
    corpus = F.round(F.coalesce(F.sum(F.when(F.col("n_ref") > 0, F.col("edits"))) / F.sum("n_ref"), F.lit(0.0)), 9).alias("corpus_cer")
    return [mean("cer"), *([mean("cp_cer")] if "cp_cer" in rows.columns else []), corpus]


def cer_report(rows: DataFrame, *by: str) -> DataFrame:
    """(by, n, mean_cer, corpus_cer) and mean_cp_cer where rows have it; empty references count in the means, not in the corpus rate."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_rates_of(rows))
