"""Reproducible shuffle into shards by a Feistel permutation.

Every row gets its global number r in the order of the given columns
(``numbering``), so the number does not depend on how files were split. A
Feistel network over as many bits as the largest number needs is a permutation
of those bits; walking on along the cycle while a value lies outside [0, n)
turns it into a permutation p of the n row numbers (less than two steps on
average). Row r goes to shard p(r) mod shards, slot p(r) div shards: shard sizes
differ by one row at most, slots have no gaps, and both can be computed from the
row number alone. ``rows_at`` goes the other way, from shard and slot to the row
number, so a reader finds the k-th sample without an index.

The law is ``rows``: shards hold equal numbers of rows, whatever their sizes, so
equal texts are not kept together and one more shard deals all rows anew.

Defined results: null order values come first; of rows equal in all order
columns any may have either number; a null text has no bytes; an input column
with the name of an output column gives way to it; an empty table gives an empty
result."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.numbering import row_numbers

ROUNDS = 8
# fixed values: multipliers of the round function
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:4], "big") for i in range(rounds)]


def _mixed(v: np.ndarray, key: int) -> np.ndarray:
    low = np.uint64(0xFFFFFFFF)
    t = (v ^ np.uint64(key)) * np.uint64(MULTIPLIERS[0]) & low
    t ^= t >> np.uint64(15)
    t = t * np.uint64(MULTIPLIERS[1]) & low
    return t ^ (t >> np.uint64(13))


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. n-1 (n at most 2^62)."""
    n: int
    seed: int = 0

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        bits = max(2, (self.n - 1).bit_length())
        low = bits - bits // 2
        shift, high_mask, low_mask = np.uint64(low), np.uint64((1 << bits // 2) - 1), np.uint64((1 << low) - 1)
        left, right = x >> shift, x & low_mask
        order = list(enumerate(round_keys(self.seed)))
        for i, key in reversed(order) if back else order:
            if i % 2 == 0:
                left = left ^ (_mixed(right, key) & high_mask)
            else:
                right = right ^ (_mixed(left, key) & low_mask)
        return left << shift | right

    def _walked(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = np.asarray(x).astype(np.uint64)
        if not self.n:
            return x.astype(np.int64)
        out = self._once(x, back)
        while (outside := np.nonzero(out >= np.uint64(self.n))[0]).size:
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walked(x, False)

    def backward(self, y: np.ndarray) -> np.ndarray:
        return self._walked(y, True)

    def column(self, x: Column, back: bool = False) -> Column:
        """The permuted value of a column of row numbers."""
        move = self.backward if back else self.forward
        return F.pandas_udf(lambda s: pd.Series(move(s.to_numpy())), "long")(x)


def place(rows: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``. ``order`` names the
    columns that fix the row numbers; the other columns travel along."""
    names = ["row_number", "shard", "slot"]
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    x = row_numbers(held, [F.col("row")[c] for c in order], "row_number")
    p = Permutation(x.count(), seed).column(F.col("row_number"))
    kept = [F.col("row")[c].alias(c) for c in rows.columns if c not in names]
    return x.withColumn("_p", p).select(*kept, "row_number", F.expr(f"int(_p % {shards})").alias("shard"),
                                        F.expr(f"_p div {shards}").alias("slot"))


def rows_at(places: DataFrame, n: int, shards: int, seed: int = 0) -> DataFrame:
    """``places`` (columns shard and slot) with the ``row_number`` found there."""
    return places.withColumn("row_number", Permutation(n, seed).column(
        F.col("slot").cast("long") * shards + F.col("shard"), back=True))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1 << 16) -> None:
    """One folder per shard and piece of ``rows_per_file`` slots, rows in slot
    order; a piece is one task's work, however large its shard."""
    pieces = placed.withColumn("piece", F.expr(f"slot div {rows_per_file}"))
    pieces.repartition("shard", "piece").sortWithinPartitions("shard", "piece", "slot").write.partitionBy(
        "shard", "piece").parquet(path)
