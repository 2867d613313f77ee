"""Exact top-k inner products over a bit-sliced index.

Vector components are integers. A block of rows is stored as bit slices: for
attribute i and bit b one bitmap over the rows. The score of a query is a
weighted sum of attributes, so it is computed for all rows at once by adding
slices with bitmap arithmetic: the bitmaps of equal weight go through full
adders (three bitmaps in, a sum and a carry out) until each weight holds one
bitmap, which are the slices of the score. Attributes keep their ``KEEP``
highest bits in the index; negative query components use complemented slices.

The k best rows are then taken from the most significant score slice downward:
a slice that still covers more than k rows narrows the tied set, otherwise its
rows are settled. That gives the k-th quantised score; every row whose score
can reach it under the bound of what quantising dropped is a boundary row and
is resolved by its exact product, ties to the smaller id.

Rows are dealt once into groups of a bounded size, by their place in the input,
so that neither an id nor a vector that many rows share makes a large group. A
task reads its group's rows, builds the index of each block once and keeps it;
then the queries stream past, and only the k best rows of each query in the group
leave the task. A block is skipped for the queries whose k-th best so far exceeds
what the least and greatest values of the block's attributes allow. Rows move
once; a query is copied to every group, and the number of groups follows the
memory they need (``GROUP_CELLS``), not the number of queries.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; vectors are compared with vectors of
their own length; a query never meets rows with its own id; queries of one id are
ranked together, equal ones once; equal rows are candidates each; with fewer than
k candidates all are returned; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayframe.llm.common import written

KEEP = 6             # highest bits of an attribute in the index
KEEP_QUERY = 8       # highest bits of a query component
ROW_BLOCK = 2048
QUERY_BLOCK = 128
PAIRS = 1 << 16      # boundary rows resolved at a time
GROUP_CELLS = 1 << 23        # vector components of a group, 64 MB
LEAST_GROUPS = 64            # tasks for tables that would need fewer


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    double = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(double, lambda x: F.floor(F.lit(scale) * x)))


def slices(u: np.ndarray, bits: int) -> np.ndarray:
    """[attributes, bits, words] bitmaps of a [rows, attributes] array of
    non-negative numbers."""
    n, d = u.shape
    out = np.zeros((d, bits, -(-n // 64) * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((u.T >> b) & 1, axis=1, bitorder="little")
        out[:, b, :packed.shape[1]] = packed
    return out.view(np.uint64)


class SliceSum:
    """Carry-save addition of bitmaps by weight."""

    def __init__(self):
        self.level: list[list[np.ndarray]] = []

    def add(self, weight: int, x: np.ndarray) -> None:
        while True:
            while len(self.level) <= weight:
                self.level.append([])
            held = self.level[weight]
            if len(held) < 2:
                held.append(x)
                return
            y, z = held.pop(), held.pop()
            half = y ^ z
            held.append(half ^ x)
            x, weight = (y & z) | (half & x), weight + 1

    def total(self) -> list[np.ndarray]:
        """One bitmap per weight, lowest first."""
        w = 0
        while w < len(self.level):
            if len(self.level[w]) == 2:
                y, z = self.level[w]
                self.level[w] = [y ^ z]
                self.add(w + 1, y & z)
            w += 1
        zero = next(x[0] for x in self.level if x) & np.uint64(0)
        return [x[0] if x else zero for x in self.level]


def _bits(v: np.ndarray) -> int:
    return int(v.max()).bit_length() if v.size else 0


_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mask(b: np.ndarray) -> np.ndarray:
    return np.where(b, _ONES, np.uint64(0))


class Block:
    """Rows with their bit-sliced index: ids int64, x [rows, d] int64."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        n, d = x.shape
        self.low, self.high = (f(axis=0) if n else np.zeros(d, np.int64) for f in (x.min, x.max))
        u = x - (x.min() if x.size else 0)
        self.drop = max(0, _bits(u) - KEEP)
        self.bits = _bits(u) - self.drop
        self.index = slices(u >> self.drop, self.bits) if self.bits else None

    def bound(self, q: np.ndarray) -> np.ndarray:
        """The most that a row of the block can score for each query."""
        return np.maximum(q, 0) @ self.high + np.minimum(q, 0) @ self.low

    def top_k(self, qids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, id, score) arrays of the k best rows for each query;
        qids and q [queries, d] int64."""
        ids, x, bits, drop = self.ids, self.x, self.bits, self.drop
        n, d = x.shape
        packed = np.packbits(ids[None, :] != qids[:, None], axis=1, bitorder="little")
        allowed = np.zeros((len(qids), -(-n // 64) * 8), np.uint8)
        allowed[:, :packed.shape[1]] = packed
        allowed = allowed.view(np.uint64)
        candidates = allowed
        size = np.abs(q)
        qdrop = max(0, _bits(size) - KEEP_QUERY)
        qbits = _bits(size) - qdrop
        if bits and qbits:
            short = size >> qdrop
            negative = _mask(q < 0)
            acc = SliceSum()
            for a in range(qbits):
                chosen = _mask((short >> a) & 1)
                for i in np.nonzero(chosen.any(axis=0))[0]:
                    c, s = chosen[:, i, None], negative[:, i, None]
                    for b in range(bits):
                        acc.add(a + b, (self.index[i, b][None, :] ^ s) & c)
            score = acc.total()
            # from the most significant slice downward: settled rows and the tied set
            settled, tied = np.zeros_like(allowed), allowed
            kth = np.zeros(len(qids), object)
            for w in range(len(score) - 1, -1, -1):
                reach = settled | (tied & score[w])
                enough = np.bitwise_count(reach).sum(axis=1) >= k
                kth += np.where(enough, 1 << w, 0).astype(object)
                e = _mask(enough)[:, None]
                settled = (settled & e) | (reach & ~e)
                tied = tied & (score[w] ^ ~e)
            # what the dropped bits can add to a score, in units of the kept ones
            top = ((1 << bits) - 1) << drop
            lost = [int(sum(int(v) * ((1 << drop) - 1) for v in r)) + d * ((1 << qdrop) - 1) * (top + (1 << drop) - 1)
                    for r in size] if drop or qdrop else [0] * len(qids)
            unit = 1 << (drop + qdrop)
            least = [max(0, -((lost[i] - int(kth[i]) * unit) // unit)) for i in range(len(qids))]
            over, same = np.zeros_like(allowed), allowed
            for w in range(len(score) - 1, -1, -1):
                c = _mask(np.array([v >> w & 1 for v in least], bool))[:, None]
                over |= same & score[w] & ~c
                same = same & ~(score[w] ^ c)
            candidates = over | same
        qi, ri = np.nonzero(np.unpackbits(candidates.view(np.uint8), axis=1, count=n, bitorder="little"))
        exact = np.concatenate([np.einsum("ij,ij->i", q[qi[s:s + PAIRS]], x[ri[s:s + PAIRS]])
                                for s in range(0, len(qi), PAIRS)] or [np.zeros(0, np.int64)])
        return _first_k(len(qids), qi, ids[ri], exact, k)


def _first_k(queries: int, qi: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to smaller ids."""
    order = np.lexsort((ids, -score, qi))
    qi, ids, score = qi[order], ids[order], score[order]
    best = np.arange(len(qi)) - np.searchsorted(qi, np.arange(queries))[qi] < k
    return qi[best], ids[best], score[best]


def block_top_k(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int):
    """``Block.top_k`` of a block that is used once."""
    return Block(ids, x).top_k(qids, q, k)


def group_top_k(blocks: list[Block], qids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of all blocks for each query."""
    held = (np.zeros(0, np.int64),) * 3
    kth = np.full(len(qids), np.iinfo(np.int64).min)
    bounds = [b.bound(q) for b in blocks]
    # the most promising block first, so that others can be skipped
    for i in sorted(range(len(blocks)), key=lambda i: -int(bounds[i].max(initial=np.iinfo(np.int64).min))):
        use = np.nonzero(bounds[i] >= kth)[0]
        if not len(use):
            continue
        qi, ids, score = blocks[i].top_k(qids[use], q[use], k)
        held = _first_k(len(qids), *(np.concatenate(p) for p in zip(held, (use[qi], ids, score), strict=True)), k)
        full = np.bincount(held[0], minlength=len(qids)) == k
        last = np.searchsorted(held[0], np.arange(len(qids)), side="right") - 1
        kth = np.where(full, held[2][last] if len(held[2]) else kth, kth)
    return held


def _matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim else np.zeros((len(vectors), 0), np.int64)


def _scan(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of rows (dim, g, query, id, v), a group's rows before its queries."""
    here, ids, mats, blocks = None, [], [], None
    for b in batches:
        if not b.num_rows:
            continue
        dim, g, query = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        change = np.nonzero(np.r_[True, (dim[1:] != dim[:-1]) | (g[1:] != g[:-1]) | (query[1:] != query[:-1])])[0]
        for s, e in zip(change, np.r_[change[1:], b.num_rows], strict=True):
            if (dim[s], g[s]) != here:
                here, ids, mats, blocks = (dim[s], g[s]), [], [], None
            part = b.slice(s, e - s)
            keys, x = part.column(3).to_numpy(), _matrix(part.column(4), int(dim[s]))
            if not query[s]:
                ids.append(keys)
                mats.append(x)
                continue
            if blocks is None:
                i, m = (np.concatenate(p) if p else np.zeros((0, int(dim[s])), np.int64) for p in (ids, mats))
                blocks = [Block(i[a:a + ROW_BLOCK], m[a:a + ROW_BLOCK]) for a in range(0, len(i), ROW_BLOCK)]
                ids, mats = [], []
            for a in range(0, len(keys), QUERY_BLOCK):
                qids = keys[a:a + QUERY_BLOCK]
                qi, found, score = group_top_k(blocks, qids, x[a:a + QUERY_BLOCK], k)
                if len(qi):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (qids[qi], found, score)],
                                                     names=["query_id", "id", "score"])


def top_k(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "q", cells: int = GROUP_CELLS,
          least: int = LEAST_GROUPS) -> DataFrame:
    """(query_id, rank, key, score): the k best rows for each query. ``vector``
    holds arrays of whole numbers or null (takes no part)."""
    def ready(df: DataFrame) -> DataFrame:
        return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
            F.col(key).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("v"), F.size(vector).alias("dim"))

    x = written(ready(rows).withColumn("place", F.monotonically_increasing_id()), "rows")
    q = written(ready(queries).dropDuplicates(["id", "v"]), "queries")
    n, size = x.agg(F.count(F.lit(1)), F.sum("dim")).first()
    groups = max(1, min(least, -(-n // ROW_BLOCK)), -(-(size or 0) // cells))
    members = x.select("dim", F.pmod(F.xxhash64("place"), F.lit(groups)).cast("int").alias("g"), F.lit(False).alias("query"), "id", "v")
    asked = q.select("dim", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(True).alias("query"), "id", "v")
    stream = members.unionByName(asked).repartition(groups, "dim", "g").sortWithinPartitions("dim", "g", "query")
    found = stream.mapInArrow(partial(_scan, k), "query_id long, id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")
