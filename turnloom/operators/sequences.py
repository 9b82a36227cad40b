"""Order-dependent operators per entity that never gather an entity in one task.

Rows are range-sorted by entity and order; each partition gives one summary row, the summaries are combined on the
driver in partition order, and the partitions are scanned again with the state carried into them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.operators.intervals import range_sorted


def _with_long(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])


def row_positions(df: DataFrame, entity: str, order: list[str], name: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based position of each row within its entity in column ``name``.

    Ties in ``order`` keep no defined order, so it should be unique per entity. Rows with a null entity are dropped;
    nulls in ``order`` come first.
    """
    rows = range_sorted(df.where(F.col(entity).isNotNull()), entity, order, partitions)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = None
        n = 0
        for pdf in batches:
            ent = pdf[entity].to_numpy(object)
            if not len(ent):
                continue
            first = ent[0] if first is None else first
            same = int((ent == ent[-1]).sum())
            n = n + same if last == ent[-1] and same == len(ent) else same
            last = ent[-1]
        if first is not None:
            yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "first": [str(first)], "last": [str(last)], "n": [n]})

    parts = rows.select(entity).mapInPandas(count, "pid int, first string, last string, n bigint").collect()  # one row per partition
    carry, state = {}, (None, 0)
    for r in sorted(parts, key=lambda r: r.pid):
        carry[r.pid] = state
        state = (r.last, r.n + state[1]) if r.first == r.last == state[0] else (r.last, r.n)
    shared = df.sparkSession.sparkContext.broadcast(carry)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ent0, n0 = shared.value.get(TaskContext.get().partitionId(), (None, 0))
        for pdf in batches:
            if not len(pdf):
                continue
            ent = pdf[entity].astype(str)
            pos = ent.groupby(ent, sort=False).cumcount().to_numpy()
            pos = pos + np.where(ent.to_numpy(object) == ent0, n0, 0)
            ent0, n0 = ent.iloc[-1], int(pos[-1]) + 1
            yield pdf.assign(**{name: pos})

    return rows.mapInPandas(number, _with_long(rows, name))


def label_runs(df: DataFrame, entity: str, order: list[str], key: str, breaks: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray], name: str = "run", partitions: int | None = None) -> DataFrame:
    """``df`` with the ``key`` of the first row of each run in column ``name``.

    ``breaks(before, now)`` gets two equally long frames of consecutive rows and says where a new run begins; another
    entity always begins one. ``key`` must be unique and of type bigint.
    """
    rows = range_sorted(df.where(F.col(entity).isNotNull()), entity, order, partitions)
    columns = rows.columns

    def starts(before: pd.DataFrame | None, pdf: pd.DataFrame) -> np.ndarray:
        shifted = pdf.shift(1)
        if before is not None:
            shifted.iloc[0] = before.iloc[0]
        new = breaks(shifted, pdf) | (shifted[entity].to_numpy(object) != pdf[entity].to_numpy(object))
        if before is None:
            new[0] = True
        return new

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, first, begun, whole = None, None, None, True
        for pdf in batches:
            if not len(pdf):
                continue
            new = starts(before, pdf)
            if first is None:
                first, begun = pdf.iloc[:1], int(pdf[key].iloc[0])
                new[0] = False
            at = np.flatnonzero(new)
            if len(at):
                whole, begun = False, int(pdf[key].iloc[at[-1]])
            before = pdf.iloc[-1:]
        if first is not None:
            import pickle

            yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "ends": [pickle.dumps((first, before))], "begun": [begun], "whole": [whole]})

    import pickle

    parts = rows.mapInPandas(summary, "pid int, ends binary, begun bigint, whole boolean").collect()  # one row per partition
    carry, state = {}, None
    for r in sorted(parts, key=lambda r: r.pid):
        first, last = pickle.loads(bytes(r.ends))
        goes_on = state is not None and not starts(state[0], first)[0]
        carry[r.pid] = state
        state = (last, state[1] if goes_on and r.whole else r.begun)
    shared = df.sparkSession.sparkContext.broadcast(carry)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = shared.value.get(TaskContext.get().partitionId())
        before, run = state if state is not None else (None, 0)
        for pdf in batches:
            if not len(pdf):
                continue
            new = starts(before, pdf)
            ids = pdf[key].to_numpy(np.int64)
            at = np.maximum.accumulate(np.where(new, np.arange(len(pdf)), -1))
            runs = np.where(at >= 0, ids[np.maximum(at, 0)], run)
            before, run = pdf.iloc[-1:], int(runs[-1])
            yield pdf[columns].assign(**{name: runs})

    return rows.mapInPandas(label, _with_long(rows, name))
