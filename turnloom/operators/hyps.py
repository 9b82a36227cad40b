"""Sets of hypotheses per unit: upsert, filling, gating, agreement, choice, and mapping to turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import normalize_for_cer
from turnloom.operators.textgrid import distribute_text, join_texts

MODELS = ("firered", "moss", "qwen")


def upsert(prior: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both by unit and model, the new ones winning; rows without a model are dropped.

    Both: unit_key, model, text, loaded_at. One shuffle with a partial maximum; among rows of one side the latest wins.
    """
    tagged = prior.withColumn("side", F.lit(0)).unionByName(new.withColumn("side", F.lit(1)))
    best = tagged.where((F.col("model") != "") & F.col("unit_key").isNotNull()).groupBy("unit_key", "model").agg(F.max(F.struct("side", "loaded_at", "text")).alias("r"))
    return best.select("unit_key", "model", F.col("r.text").alias("text"), (F.col("r.side") == 1).alias("is_new"))


def by_unit(hyps: DataFrame) -> DataFrame:
    """(unit_key, hyps): the hypotheses of each unit as structs in order of model."""
    return hyps.groupBy("unit_key").agg(F.array_sort(F.collect_list(F.struct("model", "text"))).alias("hyps"))


def all_agree(hyps: Column) -> Column:
    """Whether the non-empty texts are one after normalisation; none or one agrees."""
    texts = F.filter(hyps, lambda h: F.coalesce(h["text"], F.lit("")) != "")
    return F.size(F.array_distinct(F.transform(texts, lambda h: normalize_for_cer(h["text"])))) <= 1


def best_hyp(hyps: Column, overlap: Column) -> Column:
    """The struct to fall back on: non-empty moss under overlap, else the first non-empty, else the first; null for none."""
    full = F.filter(hyps, lambda h: F.coalesce(h["text"], F.lit("")) != "")
    moss = F.filter(full, lambda h: h["model"] == "moss")
    get = lambda a: F.try_element_at(a, F.lit(1))
    return F.when(overlap & (F.size(moss) > 0), get(moss)).otherwise(F.coalesce(get(full), get(hyps)))


def fill_moss(units: DataFrame, hyps: DataFrame, unit_members: DataFrame) -> DataFrame:
    """Hypotheses with a moss row for each unit that has none with text: the joined texts of its member turns.

    Units whose turns have no text keep what they have.
    """
    built = unit_members.select("unit_key", join_texts(F.transform("members", lambda t: t["text"])).alias("text")).where("text <> ''")
    have = hyps.where((F.col("model") == "moss") & (F.trim(F.coalesce("text", F.lit(""))) != "")).select("unit_key").distinct()
    missing = units.select("unit_key").join(built, "unit_key").join(have, "unit_key", "left_anti")
    rest = hyps.select("unit_key", "model", "text").join(missing.select("unit_key", F.lit("moss").alias("model")), ["unit_key", "model"], "left_anti")
    return rest.withColumn("filled", F.lit(False)).unionByName(missing.select("unit_key", F.lit("moss").alias("model"), "text", F.lit(True).alias("filled")))


def wanted_models(heavy: Column, selected: tuple[str, ...] = MODELS) -> Column:
    """Models to run: moss alone under heavy overlap, else the selected ones."""
    return F.when(heavy, F.array(F.lit("moss"))).otherwise(F.array(*[F.lit(m) for m in sorted(selected)]))


def check_models(names: list[str]) -> tuple[str, ...]:
    """A selection of models, folded; none means all; unknown names are refused."""
    picked = {n.strip().lower() for n in names if n.strip()}
    if picked - set(MODELS):
        raise ValueError(f"unknown models: {sorted(picked - set(MODELS))}")
    return tuple(sorted(picked or MODELS))


def cache_misses(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Wanted (unit_key, model) rows that the cache doesn't hold with a text."""
    return wanted.join(cached.where("text <> ''").select("unit_key", "model").distinct(), ["unit_key", "model"], "left_anti")


def to_turns(hyps: DataFrame, unit_members: DataFrame) -> DataFrame:
    """(unit_key, turn_index, model, text): each hypothesis cut back to the member turns; an empty piece gives the whole text."""
    j = hyps.select("unit_key", "model", F.coalesce("text", F.lit("")).alias("text")).join(unit_members, "unit_key")
    cut = distribute_text(F.col("text"), F.transform("members", lambda t: t["dur_s"]))
    pairs = F.arrays_zip(F.transform("members", lambda t: t["turn_index"]).alias("i"), F.col("cut").alias("p"))
    got = j.withColumn("cut", cut).select("unit_key", "model", "text", F.explode(pairs).alias("x"))
    return got.select("unit_key", F.col("x.i").alias("turn_index"), "model", F.when(F.coalesce(F.col("x.p"), F.lit("")) != "", F.col("x.p")).otherwise(F.col("text")).alias("text"))
