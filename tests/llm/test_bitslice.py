"""Bit-sliced search over several blocks and groups, hot ids and repeated rows."""

import collections

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayframe.llm import bitslice


def brute(rows, queries, k):
    out = {}
    for i in {i for i, _ in queries}:
        vs = {tuple(v) for j, v in queries if j == i}
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for q in vs for j, v in rows if j != i and len(v) == len(q))
        out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return {i: v for i, v in out.items() if v}


def search(spark, rows, queries, k, **how):
    schema = "vec_id long, q array<long>"
    got = collections.defaultdict(list)
    x, q = (spark.createDataFrame([(i, [int(a) for a in v]) for i, v in t], schema) for t in (rows, queries))
    for r in bitslice.top_k(x, q, k, **how).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {i: sorted(v) for i, v in got.items()}


def test_groups_and_blocks_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "ROW_BLOCK", 16)
    monkeypatch.setattr(bitslice, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=6) * 40 + 60 * (i % 4 == 0)).astype(int)) for i in range(300)] + [(1000 + i, [1, 2]) for i in range(7)]
    queries = [r for r in rows if r[0] % 10 == 0]
    for how in ({}, {"least": 3, "cells": 200}, {"least": 1, "cells": 1 << 30}):
        assert search(spark, rows, queries, 5, **how) == brute(rows, queries, 5)


def test_blocks_that_cannot_reach_are_skipped(monkeypatch):
    rng = np.random.default_rng(2)
    blocks = [bitslice.Block(np.arange(i * 50, i * 50 + 50), rng.integers(0, 20, (50, 4)) + (500 if i == 3 else 0)) for i in range(6)]
    q = rng.integers(1, 30, (9, 4))
    used = []
    plain = bitslice.Block.top_k
    monkeypatch.setattr(bitslice.Block, "top_k", lambda self, *a: used.append(self) or plain(self, *a))
    qi, ids, score = bitslice.group_top_k(blocks, np.arange(9) + 9000, q, 3)
    assert used == [blocks[3]]
    every = np.concatenate([b.x for b in blocks])
    for i in range(9):
        p = every @ q[i]
        assert sorted(score[qi == i].tolist(), reverse=True) == sorted(p.tolist(), reverse=True)[:3]


def test_a_hot_id_is_spread_over_groups(spark, monkeypatch):
    """A third of all rows have one id, and most of these one vector; as a query
    it is asked once per different vector."""
    rng = np.random.default_rng(3)
    rows = [(50, [3, -1, 2] if i % 3 else rng.integers(-9, 9, 3).tolist()) for i in range(600)]
    rows += [(i + 51, rng.integers(-9, 9, 3).tolist()) for i in range(1200)]
    queries = [r for r in rows if r[0] % 50 == 0]
    seen = []
    plain = bitslice.written

    def spy(df, name, **how):
        out = plain(df, name, **how)
        seen.append((name, out))
        return out
    monkeypatch.setattr(bitslice, "written", spy)
    assert search(spark, rows, queries, 5, cells=300) == brute(rows, queries, 5)
    tables = dict(seen)
    assert tables["queries"].count() == len({(i, tuple(v)) for i, v in queries})
    groups = tables["rows"].groupBy(F.pmod(F.xxhash64("place"), F.lit(18))).count().agg(F.max("count")).first()[0]
    assert groups < 2 * len(rows) / 18


def test_stream_of_groups_without_rows_or_queries():
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                           pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows], pa.int64()),
                                           pa.array([r[4] for r in rows], pa.list_(pa.int64()))], names=["dim", "g", "query", "id", "v"])
    rows = [(2, 0, False, 1, [1, 1]), (2, 0, False, 2, [2, 0]), (2, 1, True, 3, [1, 0]), (2, 2, False, 4, [5, 5]), (2, 2, True, 3, [1, 0]),
            (2, 2, True, 4, [1, 0]), (0, 0, False, 5, []), (0, 0, True, 6, [])]
    got = [tuple(r.values()) for cut in (1, 3, 8) for b in bitslice._scan(2, (batch(rows[i:i + cut]) for i in range(0, 8, cut)))
           for r in b.to_pylist()]
    assert got == [(3, 4, 5), (6, 5, 0)] * 3
