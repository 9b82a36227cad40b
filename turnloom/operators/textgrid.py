"""Texts between the grid of turns and the grid of units, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import PY_WS, py_strip

# The sentence joiner, marks that end a piece, marks folded at the edges.
JOINER = "。"
ENDS = "。，、？！；,.!?"
EDGE = "。，、？！；,.!?;:\"'"


def join_texts(pieces: Column) -> Column:
    """Non-blank pieces in a row, stripped, with a joiner after each that doesn't end in a mark; empty for none."""
    clean = F.filter(F.transform(pieces, py_strip), lambda p: p.isNotNull() & (p != ""))
    last = lambda s: F.right(s, F.lit(1))
    glue = lambda acc: F.when(F.lit(ENDS).contains(last(acc)), acc).otherwise(F.concat(acc, F.lit(JOINER)))
    return F.aggregate(clean, F.lit(""), lambda acc, p: F.when(acc == "", p).otherwise(F.concat(glue(acc), p)))


def fold_edges(c: Column) -> Column:
    """Stripped, then without marks at both ends."""
    marks = "".join("\\" + ch if ch in ".?!\"'" else ch for ch in EDGE)
    return F.regexp_replace(py_strip(c), f"^[{marks}]+|[{marks}]+$", "")


def overlap_length(left: Column, right: Column) -> Column:
    """Length of the longest suffix of ``left`` that is a prefix of ``right``."""
    most = F.least(F.length(left), F.length(right))
    ks = F.when(most > 0, F.sequence(most, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.try_element_at(F.filter(ks, lambda k: F.endswith(left, F.substring(right, F.lit(1), k))), F.lit(1)), F.lit(0))


def collapse_tandem(c: Column) -> Column:
    """A text of 8 or more characters that is one half twice, as that half."""
    n = F.length(c)
    half = F.floor(n / 2).cast("int")
    return F.when((n >= 8) & (n % 2 == 0) & (F.substring(c, F.lit(1), half) == F.substring(c, half + 1, half)), F.substring(c, F.lit(1), half)).otherwise(c)


def stitch_texts(pieces: Column) -> Column:
    """Fragments of member turns as one sentence: contained or repeated ones dropped, overlaps of two or more merged."""
    clean = F.filter(F.transform(pieces, py_strip), lambda p: p.isNotNull() & (p != ""))
    both = F.transform(clean, lambda p: F.struct(p.alias("p"), fold_edges(p).alias("f")))
    inside = lambda x: (x["f"] != "") & F.exists(both, lambda y: y["f"].contains(x["f"]) & (F.length(y["f"]) > F.length(x["f"])))
    first = lambda x, i: F.array_position(F.transform(both, lambda y: y["f"]), x["f"]) == i + 1
    kept = F.filter(both, lambda x, i: ~inside(x) & first(x, i))

    def step(acc: Column, x: Column) -> Column:
        fo, k = fold_edges(acc), overlap_length(acc, x["p"])
        grown = F.concat(acc, F.when(k >= 2, F.substring(x["p"], k + 1, F.length(x["p"]))).otherwise(x["p"]))
        return F.when(acc == "", x["p"]).when(fo.contains(x["f"]), acc).when(x["f"].contains(fo), x["p"]).otherwise(grown)

    return collapse_tandem(F.aggregate(kept, F.lit(""), step))


def distribute_text(text: Column, durations: Column) -> Column:
    """A unit's text cut back to its member turns: at the joiners if they give as many pieces, else by duration.

    ``durations``: seconds of each member in order. Shares are rounded half to even, the last piece takes the rest,
    and joiners at the edges of a piece are dropped. No members give no pieces, one gives the whole text.
    """
    n = F.size(durations)
    parts = F.filter(F.split(text, JOINER), lambda p: p != "")
    floor = F.transform(durations, lambda d: F.greatest(d, F.lit(1e-6)))
    total = F.aggregate(floor, F.lit(0.0), lambda a, d: a + d)
    take = F.transform(floor, lambda d: F.rint(F.length(text) * (d / total)).cast("int"))
    begin = lambda i: F.aggregate(F.slice(take, F.lit(1), i), F.lit(0), lambda a, k: a + k)
    piece = lambda k, i: F.when(i == n - 1, F.substring(text, begin(i) + 1, F.length(text))).otherwise(F.substring(text, begin(i) + 1, k))
    tidy = lambda p: F.replace(F.regexp_replace(p, f"^{JOINER}+|{JOINER}+$", ""), F.lit(JOINER * 2), F.lit(JOINER))
    return F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(text)).when(F.size(parts) == n, parts).otherwise(F.transform(take, lambda k, i: tidy(piece(k, i))))


def members(units: DataFrame, turns: DataFrame, unit_key: str = "unit_key") -> DataFrame:
    """(unit_key, members): the turns of each unit in order, as structs of what ``turns`` has; a join on meeting and turn index."""
    m = units.select(unit_key, "meeting_id", F.posexplode("turn_indices").alias("k", "turn_index"))
    t = turns.select("meeting_id", "turn_index", F.struct(*[c for c in ("turn_index", "text", "dur_s", "source", "confidence") if c in turns.columns]).alias("t"))
    got = m.join(t, ["meeting_id", "turn_index"]).groupBy(unit_key).agg(F.array_sort(F.collect_list(F.struct("k", "t"))).alias("m"))
    return got.select(unit_key, F.transform("m", lambda x: x["t"]).alias("members"))


def merged_grid(units: DataFrame, turns: DataFrame, whole: bool = False) -> DataFrame:
    """(unit_key, text, asr_status, source, confidence, n_turns): one row per unit with the stitched text of its turns.

    Source and confidence are those of the last member; a unit without members is empty, fused and 1.0. What ``units``
    has of meeting_id, unit_id, start_s, end_s, speaker_id and turn_indices goes along if ``whole``.
    """
    own = [c for c in ("meeting_id", "unit_id", "start_s", "end_s", "speaker_id", "turn_indices") if c in units.columns] if whole else []
    m = units.select("unit_key", *own).join(members(units, turns), "unit_key", "left")
    some = F.coalesce("members", F.array().cast(m.schema["members"].dataType))
    m = m.withColumn("members", some).withColumn("text", stitch_texts(F.transform("members", lambda t: t["text"])))
    last = F.try_element_at(F.col("members"), F.lit(-1))
    return m.select("unit_key", *own, "text", F.when(F.col("text") != "", "final").otherwise("empty").alias("asr_status"), F.coalesce(last["source"], F.lit("fused")).alias("source"), F.coalesce(last["confidence"], F.lit(1.0)).alias("confidence"), F.size("members").alias("n_turns"))
