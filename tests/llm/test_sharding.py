"""Feistel sharding: the permutation, row numbers under ties and hot keys, files."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.llm import numbering, q_sharding, sharding
from stayframe.llm.numbering import positions, row_numbers
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, shard string, slot string, _p int, row int"


def brute(r, n, seed):
    """One row number, with plain whole numbers."""
    bits = max(2, (n - 1).bit_length())
    high, low = bits // 2, bits - bits // 2

    def f(v, i):
        key = int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:4], "big")
        t = (v ^ key) * 0x9E3779B1 % 2 ** 32
        t ^= t >> 15
        t = t * 0x85EBCA77 % 2 ** 32
        return t ^ t >> 13
    while True:
        a, b = r >> low, r % 2 ** low
        for i in range(8):
            if i % 2 == 0:
                a ^= f(b, i) % 2 ** high
            else:
                b ^= f(a, i) % 2 ** low
        r = a << low | b
        if r < n:
            return r


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 100, 1000, 4097])
def test_permutation(n):
    p = sharding.Permutation(n, 5)
    x = np.arange(n)
    y = p.forward(x)
    assert y.tolist() == [brute(r, n, 5) for r in range(n)]
    assert sorted(y.tolist()) == x.tolist() and (p.backward(y) == x).all()


def test_permutation_of_a_large_range_and_seeds():
    p = sharding.Permutation(10 ** 15 + 7, 3)
    x = np.arange(0, 10 ** 15, 10 ** 12 + 1)
    y = p.forward(x)
    assert (p.backward(y) == x).all() and y.max() <= 10 ** 15 + 6 and len(set(y.tolist())) == len(x)
    # neighbours are spread evenly over shards
    counts = np.bincount(sharding.Permutation(10 ** 6, 1).forward(np.arange(8000)) % 8, minlength=8)
    assert abs(counts - 1000).max() < 150
    a, b = (sharding.Permutation(1000, s).forward(np.arange(1000)) for s in (1, 2))
    assert (a == b).sum() < 20


def rows(spark, data):
    return spark.createDataFrame([(i, t, "x", "y", 3, 4) for i, t in data], DOCS)


def test_odd_rows(spark):
    data = [(5, "a"), (5, "a"), (None, None), (None, ""), (1, "é"), (2, "x" * 100_000), (5, "b"), (3, None)]
    out = sharding.place(rows(spark, data), ["doc_id", "text"], 3, 9)
    assert out.columns == ["doc_id", "text", "_p", "row", "row_number", "shard", "slot"]
    got = out.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    expected = collections.Counter((*d, r, brute(r, 8, 9) % 3, brute(r, 8, 9) // 3) for r, d in enumerate(sorted(data, key=key)))
    assert collections.Counter((r.doc_id, r.text, r.row_number, r.shard, r.slot) for r in got) == expected
    assert sharding.place(rows(spark, []), ["doc_id"], 8).count() == 0
    assert [r.row_number for r in sharding.place(rows(spark, [(1, "z")]), ["doc_id"], 8).collect()] == [0]


def test_same_shards_however_the_input_is_split(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    a, b = (sharding.place(d, ["doc_id"], 8, 2) for d in (docs.repartition(7), docs.coalesce(1)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_back_from_places_and_files(spark, tmp_path):
    out = sharding.place(spark.range(1000).withColumnRenamed("id", "k"), ["k"], 7, 4)
    back = sharding.rows_at(out.select("k", "shard", "slot"), 1000, 7, 4)
    assert back.where("row_number <> k").count() == 0
    sharding.write_shards(out, str(tmp_path / "shards"), rows_per_file=50)
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert read.count() == 1000
    sizes = read.groupBy("shard", "piece").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert all(r.n <= 50 and r.lo >= 50 * r.piece and r.hi < 50 * (r.piece + 1) for r in sizes)
    one = spark.read.parquet(str(tmp_path / "shards/shard=0/piece=1")).collect()
    assert [r.slot for r in one] == list(range(50, 100))


def test_hot_key_is_numbered_by_many_tasks(spark):
    x = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                 (F.col("id") * 7919 % 9001).alias("t"))
    out = row_numbers(x.repartition(8), [F.col("k")])
    assert sorted(r.row_number for r in out.collect()) == list(range(9000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = numbering._ranged(numbering._tied(x), [F.col("k")])
        tasks = ranged.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 2800
    placed = positions(x, "k", [F.col("t")], [F.col("t")]).collect()
    got = sorted((r.pos, r.t) for r in placed if r.k == 7)
    assert [p for p, _ in got] == list(range(len(got))) and [t for _, t in got] == sorted(t for _, t in got)
    assert all(r.pos == 0 for r in placed if r.k != 7) and len(placed) == 9000


def test_query_against_sql_and_its_law(spark):
    ok, why = compare(q_sharding.op11_sharding(spark, SF), duck(SF), q_sharding.ORACLE_SQL)
    assert ok, why
    got = q_sharding.op11_sharding(spark, SF).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(by) == 8 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in got)


def test_positions_go_on_over_partitions(spark):
    """A key's rows in several range partitions, some of them filled by one key."""
    x = spark.range(6000).select(F.when(F.col("id") % 10 < 7, F.lit(5)).when(F.col("id") % 10 < 9, F.lit(3)).otherwise(
        F.col("id")).alias("k"), (F.col("id") * 7919 % 6007).alias("t"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "11"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = positions(x.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 1L AS t")), "k", [F.col("t")], [F.col("t")]).collect()
        parts = numbering._ranged(numbering._tied(x), [F.col("k"), F.col("t")]).groupBy(F.spark_partition_id()).agg(
            F.min("k").alias("a"), F.max("k").alias("b")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r.a == r.b == 5 for r in parts) >= 3          # whole partitions of one key
    by = collections.defaultdict(list)
    for r in got:
        by[r.k].append((r.pos, r.t))
    assert len(got) == 6000
    for rows in by.values():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows))) and [t for _, t in rows] == sorted(t for _, t in rows)
