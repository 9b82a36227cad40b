"""Interval unions per entity without gathering an entity in one task.

Rows are range-sorted over the whole cluster by entity and start. Each partition yields one summary row (its first
and last entity, the greatest end and the open period of the last), the summaries are prefix-combined in partition
order, and every partition is scanned again with the state carried into it. An entity that holds a third of all rows
is thus spread over many tasks; what reaches the driver is one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.session import checkpointed

MIN_TURN_S = 0.01  # fixed value: seconds a turn lasts at least
PARTITION_BYTES, MOST_PARTITIONS = 256 << 20, 100_000


def invalid_reason(start: Column, end: Column, least_s: float = MIN_TURN_S) -> Column:
    """Why times are impossible, the first that fits; null for valid ones. Missing times count as not finite.

    The shortest length is tested on the difference in whole microseconds, before anything is rounded to milliseconds.
    """
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad(start) | bad(end), "nan_or_inf").when(end <= start, "end_le_start").when(F.round((end - start) * 1e6) < least_s * 1e6, "too_short_invalid")


def valid_times(df: DataFrame, start: str = "start_s", end: str = "end_s", least_s: float = MIN_TURN_S) -> DataFrame:
    """Rows whose times are finite, in order and at least ``least_s`` apart, with start_ms and end_ms added; times that don't fit a bigint are left out."""
    ms = lambda c: F.round(F.col(c) * 1000).try_cast("bigint")
    kept = df.where(invalid_reason(F.col(start), F.col(end), least_s).isNull()).withColumns({"start_ms": ms(start), "end_ms": ms(end)})
    return kept.where("start_ms is not null and end_ms is not null")


def _scan(entities: np.ndarray, s: np.ndarray, e: np.ndarray, carry: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order: the greatest end before each row within its entity (or the least integer), and the carried start."""
    low = np.iinfo(np.int64).min
    n = len(s)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = entities[1:] != entities[:-1]
    group = np.cumsum(first) - 1
    reach = np.empty(n, np.int64)
    bounds = np.flatnonzero(first).tolist() + [n]
    for a, b in zip(bounds[:-1], bounds[1:]):
        head = carry[1] if carry is not None and a == 0 and entities[0] == carry[0] else low
        reach[a] = head
        if b - a > 1:
            np.maximum(np.maximum.accumulate(e[a : b - 1]), head, out=reach[a + 1 : b])
    return group, reach


def _summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row: first and last entity of the partition, the last one's greatest end and the start of its open period."""
    first = last = None
    top = begun = None
    for pdf in batches:
        if not len(pdf):
            continue
        ent, s, e = pdf["entity"].to_numpy(object), pdf["start_ms"].to_numpy(np.int64), pdf["end_ms"].to_numpy(np.int64)
        if first is None:
            first = ent[0]
        group, reach = _scan(ent, s, e, None if last is None else (last, top))
        a = int(np.searchsorted(group, group[-1]))
        opens = np.flatnonzero(s[a:] > reach[a:])
        if len(opens):
            begun = int(s[a + opens[-1]])
        new = int(e[a:].max())
        top = max(top, new) if last is not None and last == ent[-1] else new
        last = ent[-1]
    if first is not None:
        yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "first_e": [first], "last_e": [last], "top": [top], "begun": [begun]})


def combine_summaries(rows: list[tuple]) -> dict[int, tuple]:
    """State carried into each partition: (entity, greatest end, start of the open period). rows are in partition order."""
    carry, state = {}, None
    for pid, first, last, top, begun in rows:
        if state is not None:
            carry[pid] = state
        if state is not None and first == last == state[0]:
            # one entity fills the partition: its open period reaches back if the carried end bridges to the last start
            state = (last, max(top, state[1]), state[2] if begun <= state[1] else begun)
        else:
            state = (last, top, begun)
    return carry


def _bytes_read(df: DataFrame) -> int:
    """Bytes of the files and checkpoints a plan reads; what isn't known counts as nothing."""
    leaves, total = df._jdf.queryExecution().optimizedPlan().collectLeaves(), 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.nodeName() != "LogicalRDD":
            total += int(leaf.stats().sizeInBytes())
        elif (at := leaf.rdd().getCheckpointFile()).isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at.get())
            total += path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total


def range_sorted(df: DataFrame, entity: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned by entity and order, sorted inside, and written to a reliable checkpoint.

    The number of partitions is fixed, so that the two scans that follow see the same ones: spark.sql.shuffle.partitions,
    or more where the input is so large that they would pass PARTITION_BYTES. Spark takes the product of both sides as
    the size of a join, and a checkpoint of it keeps that, so its estimate only counts as far as what is read.
    """
    if partitions is None:
        size = min(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()), _bytes_read(df))
        partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTITIONS, size // PARTITION_BYTES))
    n = partitions
    return checkpointed(df.repartitionByRange(n, entity, *order).sortWithinPartitions(entity, *order))


def label_periods(df: DataFrame, entity: str, start: str = "start_ms", end: str = "end_ms", partitions: int | None = None) -> DataFrame:
    """Rows (entity, start_ms, end_ms, period_start_ms, gap_from_ms).

    ``period_start_ms`` labels the continuous period a row lies in; ``gap_from_ms`` is the end of the silence's left
    side where a row begins a new period after an earlier one of the same entity, else null. Periods that touch are
    one. Rows with a null entity, start or end are dropped, exact repeats change nothing, an empty table gives an
    empty result; other columns aren't carried, so clashing names can't disturb.
    """
    src = df.select(F.col(entity).alias("entity"), F.col(start).cast("bigint").alias("start_ms"), F.col(end).cast("bigint").alias("end_ms"))
    src = src.where(F.col("entity").isNotNull() & F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull() & (F.col("end_ms") > F.col("start_ms")))
    rows = range_sorted(src, "entity", ["start_ms", "end_ms"], partitions)
    kind = dict(rows.dtypes)["entity"]
    summaries = rows.mapInPandas(_summary, f"pid int, first_e {kind}, last_e {kind}, top bigint, begun bigint").collect()  # one row per partition
    carry = combine_summaries(sorted(((r.pid, r.first_e, r.last_e, r.top, r.begun) for r in summaries), key=lambda r: r[0]))
    shared = df.sparkSession.sparkContext.broadcast(carry)

    def rescan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = np.iinfo(np.int64).min
        state = shared.value.get(TaskContext.get().partitionId())
        for pdf in batches:
            if not len(pdf):
                continue
            ent, s, e = pdf["entity"].to_numpy(object), pdf["start_ms"].to_numpy(np.int64), pdf["end_ms"].to_numpy(np.int64)
            group, reach = _scan(ent, s, e, state)
            opens = s > reach
            mark = np.where(opens, np.arange(len(s)), -1)
            mark = np.maximum.accumulate(mark)
            began = np.where(mark >= 0, s[np.maximum(mark, 0)], state[2] if state is not None else 0)
            a = int(np.searchsorted(group, group[-1]))
            top = int(e[a:].max())
            state = (ent[-1], max(top, state[1]) if state is not None and state[0] == ent[-1] else top, int(began[-1]))
            gap = pd.array(reach, dtype="Int64")
            gap[~(opens & (reach > low))] = pd.NA
            yield pd.DataFrame({"entity": ent, "start_ms": s, "end_ms": e, "period_start_ms": began, "gap_from_ms": gap})

    out = rows.mapInPandas(rescan, f"entity {kind}, start_ms bigint, end_ms bigint, period_start_ms bigint, gap_from_ms bigint")
    return out.withColumnRenamed("entity", entity)


def periods(labelled: DataFrame, entity: str) -> DataFrame:
    """The continuous periods: (entity, period_start_ms, period_end_ms, n_rows)."""
    return labelled.groupBy(entity, "period_start_ms").agg(F.max("end_ms").alias("period_end_ms"), F.count(F.lit(1)).alias("n_rows"))


def gaps(labelled: DataFrame, entity: str) -> DataFrame:
    """The silences between periods: (entity, gap_start_ms, gap_end_ms), each at least 1 ms long."""
    return labelled.where(F.col("gap_from_ms").isNotNull()).select(entity, F.col("gap_from_ms").alias("gap_start_ms"), F.col("start_ms").alias("gap_end_ms"))


def union_overlap(spans: DataFrame, pieces: DataFrame, entity: str, span_key: str, differ: str | None = None, bucket_ms: int = 60_000) -> DataFrame:
    """Milliseconds of each span covered by the union of pieces of the same entity: (span_key, covered_ms).

    ``differ`` names a column that must not be equal on both sides (null counts as a value of its own). The join is on
    entity and time bucket, so that a hot entity is spread over its buckets; each pair meets in the bucket of the later
    start only. Spans without any piece are absent.
    """
    keys = [entity, "start_ms", "end_ms"] + ([differ] if differ else [])
    cut = lambda c: F.floor(F.col(c) / bucket_ms)
    b = lambda: F.explode(F.sequence(cut("start_ms"), cut("end_ms")))
    left = spans.select(span_key, *keys).withColumn("bucket", b())
    right = pieces.select(*[F.col(k).alias("r_" + k) for k in keys], F.explode(F.sequence(cut("start_ms"), cut("end_ms"))).alias("r_bucket"))
    lo, hi = F.greatest("start_ms", "r_start_ms"), F.least("end_ms", "r_end_ms")
    on = (F.col(entity) == F.col("r_" + entity)) & (F.col("bucket") == F.col("r_bucket")) & (hi > lo) & (F.floor(lo / bucket_ms) == F.col("bucket"))
    if differ:
        on = on & ~F.col(differ).eqNullSafe(F.col("r_" + differ))
    hits = left.join(right, on).select(span_key, lo.alias("lo"), hi.alias("hi"))
    arr = F.array_sort(F.collect_set(F.struct("lo", "hi")))
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-(2**62)).cast("bigint").alias("top"))
    step = lambda acc, x: F.struct((acc["sum"] + F.greatest(F.lit(0).cast("bigint"), x["hi"] - F.greatest(x["lo"], acc["top"]))).alias("sum"), F.greatest(acc["top"], x["hi"]).alias("top"))
    return hits.groupBy(span_key).agg(F.aggregate(arr, zero, step, lambda acc: acc["sum"]).alias("covered_ms"))
