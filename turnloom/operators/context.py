"""Context of units and turns under a character budget, without quadratic scans of a meeting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, ROW_COST, MAX_TURNS, WINDOW_MS = 8192, 32, 20, 600_000


def budget_cut(df: DataFrame, group: list[str], order: list, cost: Column, k: int = MAX_TURNS, budget: int = BUDGET) -> DataFrame:
    """The first rows of each group while the running cost stays within the budget; the first row always stays."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.withColumn("used", F.sum(cost).over(w.rowsBetween(Window.unboundedPreceding, 0))).where((F.col("rank") == 1) | (F.col("used") <= budget))


def nearest_turns(units: DataFrame, turns: DataFrame, window_ms: int = WINDOW_MS, k: int = MAX_TURNS) -> DataFrame:
    """(unit_key, rank, turn_index, dist_ms2): the turns nearest in time to each unit, its members left out.

    ``units``: unit_key, meeting_id, start_ms, end_ms, turn_indices; ``turns``: meeting_id, turn_index, start_ms,
    end_ms, text. Middles are compared in half milliseconds, so that they are whole numbers. The join is on meeting and
    a time bucket of the window's width (a unit looks into three), which spreads a hot meeting over its duration; of a
    text only its cost goes along.
    """
    mid = (F.col("start_ms") + F.col("end_ms")).alias("mid2")
    u = units.select("unit_key", "meeting_id", "turn_indices", mid).withColumn("bucket", F.explode(F.array(*[F.floor(F.col("mid2") / (2 * window_ms)) + d for d in (-1, 0, 1)])))
    t = turns.select("meeting_id", "turn_index", F.length(F.coalesce("text", F.lit(""))) + ROW_COST, F.col("start_ms") + F.col("end_ms")).toDF("meeting_id", "turn_index", "cost", "t_mid2").withColumn("bucket", F.floor(F.col("t_mid2") / (2 * window_ms)))
    dist = F.abs(F.col("mid2") - F.col("t_mid2"))
    near = u.join(t, ["meeting_id", "bucket"]).where((dist <= 2 * window_ms) & ~F.array_contains("turn_indices", F.col("turn_index"))).withColumn("dist_ms2", dist)
    return budget_cut(near, ["unit_key"], ["dist_ms2", "turn_index"], F.col("cost"), k).select("unit_key", "rank", "turn_index", "dist_ms2")


def leading_turns(turns: DataFrame, k: int = MAX_TURNS, budget: int = BUDGET) -> DataFrame:
    """(meeting_id, pos, n_neighbors, last_pos): how far the first other turns of the meeting fill each turn's context.

    ``turns``: meeting_id, pos, text. Only the first k + 1 positions of a meeting can be anyone's context, so they are
    the small side of the join; with k below 1 the first row is still taken.
    """
    k = max(k, 1)
    head = turns.where(F.col("pos") <= k).groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("pos", (F.length(F.coalesce("text", F.lit(""))) + ROW_COST).alias("cost")))).alias("head"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(-1).cast("bigint").alias("last"), F.lit(False).alias("full"))

    def step(acc, x):
        over = acc["full"] | (acc["n"] >= k) | ((acc["n"] > 0) & (acc["used"] + x["cost"] > budget))
        take = F.struct((acc["n"] + 1).alias("n"), (acc["used"] + x["cost"]).alias("used"), x["pos"].cast("bigint").alias("last"), F.lit(False).alias("full"))
        stop = F.struct(acc["n"].alias("n"), acc["used"].alias("used"), acc["last"].alias("last"), F.lit(True).alias("full"))
        return F.when(over, stop).otherwise(take)

    joined = turns.select("meeting_id", "pos").join(head, "meeting_id")
    own = F.filter("head", lambda x: x["pos"] != F.col("pos"))
    return joined.withColumn("r", F.aggregate(own, zero, step)).select("meeting_id", "pos", F.col("r.n").alias("n_neighbors"), F.when(F.col("r.n") > 0, F.col("r.last")).alias("last_pos"))
