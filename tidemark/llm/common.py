"""Helpers that several operators share: scratch tables and running totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

Batches = Iterator[pa.RecordBatch]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again: its lineage ends there and no executor need keep it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_numbers(count: int, done: int) -> np.ndarray:
    """Numbers for the next rows of this task that no other task of the same stage gives."""
    return (np.int64(TaskContext.get().partitionId()) << np.int64(36)) + np.arange(done, done + count)


def running_totals(df: DataFrame, lane: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with column ``out``: the sum of ``value`` over the rows of the same ``lane`` that stand before in ``order``.

    Rows are cut into ranges of (lane, order), so a lane of any size spreads over tasks. Each range is summed by
    itself; what precedes it in its lane comes from one row for each pair of range and lane.
    """
    ranged = df.repartitionByRange(F.col(lane).asc_nulls_first(), *order)
    ranged = ranged.sortWithinPartitions(F.col(lane).asc_nulls_first(), *order)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, `_range` int, `_inside` bigint"

    def inside(batches: Batches) -> Batches:
        part, last, total = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            lanes = batch.column(lane).to_numpy(zero_copy_only=False)
            new = np.ones(len(values), dtype=bool)
            new[1:] = lanes[1:] != lanes[:-1]
            new[0] = lanes[0] != last
            sums = np.cumsum(values) - values
            firsts = np.flatnonzero(new)
            base = np.full(len(values), total, dtype=np.int64)
            if len(firsts):
                group = np.cumsum(new) - 1
                base = np.where(group >= 0, -sums[firsts][np.maximum(group, 0)], total)
            found = sums + base
            total, last = int(found[-1] + values[-1]), lanes[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(values), part, dtype=np.int32)), pa.array(found)],
                names=[*batch.schema.names, "_range", "_inside"],
            )

    from pyspark.sql import Window

    cut = stored(ranged.mapInArrow(inside, schema), "ranges")
    sums = cut.groupBy(lane, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(lane).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        F.col(lane).alias("_lane"), F.col("_range").alias("_part"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    joined = cut.join(base, F.col(lane).eqNullSafe(F.col("_lane")) & (F.col("_range") == F.col("_part")))
    return joined.select(*df.columns, (F.col("_inside") + F.col("_base")).alias(out))


def in_tasks(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Batches], Batches]:
    """A function of one batch as one of a task's batches; empty ones are left out."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None:
                    yield made

    return run
