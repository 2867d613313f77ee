"""Row numbers in a global order, without a window over the rows.

Rows are cut into range partitions of about equal row counts, sorted inside
them and written with their partition and place; only one row per partition is
then put in order to find where each partition (or each group that goes on into
it) starts. Equal order values are told apart by the row's place in the input
scan, so neither a hot value nor a hot group lands in one task; which of several
equal rows comes first is not defined."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.llm.common import discard, written

_PLACE = (1 << 33) - 1          # the bits of monotonically_increasing_id that count within a partition


def _ranged(x: DataFrame, order: list[Column]) -> DataFrame:
    """``x`` in range partitions of ``order``, sorted inside them."""
    return x.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, F.col("_tie")).drop("_tie")


def _tied(rows: DataFrame) -> DataFrame:
    """Written first, so that finding the range borders does not run what is
    above it twice."""
    return written(rows.withColumn("_tie", F.monotonically_increasing_id()), "unordered")


def row_numbers(rows: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """``rows`` with ``out``, their number from 0 in the order of ``order``.
    Columns ``_part`` and ``_place`` must be free."""
    loose = _tied(rows)
    x = written(_ranged(loose, order).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place")), "ordered")
    discard(loose)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # a row per partition
    starts = x.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return x.join(F.broadcast(starts), "_part").withColumn(out, F.col("_place") + F.col("_start")).drop(
        "_part", "_place", "_start")


def positions(rows: DataFrame, key: str, order: list[Column], columns: list[Column], out: str = "pos") -> DataFrame:
    """(key, ``columns``, ``out``): each row's number from 0 among the rows of
    its whole-number ``key`` in the order of ``order``; rows without a key take
    no part. ``columns`` are evaluated after the sort."""
    loose = _tied(rows.where(F.col(key).isNotNull()))
    x = _ranged(loose, [F.col(key), *order]).select(
        F.col(key).cast("long").alias(key), *columns, F.spark_partition_id().alias("_part"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, length = None, 0                  # the run that the batch before ended with
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(0).to_numpy()
            new = np.empty(len(k), bool)
            new[0], new[1:] = last is None or k[0] != last, k[1:] != k[:-1]
            at = np.arange(len(k))
            start = np.maximum.accumulate(np.where(new, at, 0))
            place = at - start
            if not new[0]:
                place[:int(np.argmax(new)) if new.any() else len(k)] += length
            last, length = k[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], names=[*b.schema.names, "_place"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema.fields)
    x = written(x.mapInArrow(each, schema + ", _place long"), "placed")
    discard(loose)
    # the run a partition ends with goes on in the next one, perhaps for many partitions
    ends = x.groupBy("_part").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    tail = x.join(F.broadcast(ends), "_part").where(F.col(key) == F.col("_last")).groupBy("_part").agg(
        F.max("_place").alias("_n"))
    parts = Window.orderBy("_part")
    run = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    starts = written(ends.join(tail, "_part").withColumn("_sum", F.sum(F.col("_n") + 1).over(run)).select(
        "_part", "_first", F.when(F.lag("_last").over(parts) == F.col("_first"), F.lag("_sum").over(parts)).alias("_start"))
        .where(F.col("_start").isNotNull()), "starts")
    going_on = F.when(F.col(key) == F.col("_first"), F.col("_start"))
    return x.join(F.broadcast(starts), "_part", "left").withColumn(
        out, F.col("_place") + F.coalesce(going_on, F.lit(0))).drop("_part", "_place", "_first", "_start")
