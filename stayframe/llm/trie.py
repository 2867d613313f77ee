"""Prefix trie of conversations by ROLLUP over positional turn columns.

A node is a distinct sequence of first turns. Each turn is a 128-bit digest of
its role and text. Conversations are cut into blocks of ``WIDTH`` turns, one row
per block with a column per position, and ``ROLLUP`` over these columns with
``grouping_id`` aggregates the prefixes of all lengths together. A longer
conversation goes on in further rows whose grouping also has the key of the
prior block's last node, so one ROLLUP serves blocks of every depth; a node's
key is a 128-bit XOR of (depth, turn) hashes along its path, and whole turns of
a block are always compared as digests.

Totals over a subtree need no walk over the tree. The smallest member of a node
owns it; what a conversation owns is the end of its path from some depth on. A
first ROLLUP finds what each conversation owns and whether its end is a leaf;
the second one adds up, per node, its members' leaves and the characters of
their turns that other conversations own. If ``n`` conversations share a node
that has ``before`` characters above it, its subtree saves
``sum(shared) - min(shared) - (n - 1) * before`` (its owner shares least).

A conversation of any length is cut by blocks, and state along it is carried
over chunks of ``CHUNK`` blocks, so no step holds a whole conversation; the ids
that end at a node are joined in pieces and digested as a stream.

Defined results: a null role or text is empty; rows without a conversation id
take no part; turns are ordered by turn (null first), then role and text, and
repeated rows are turns of their own; a conversation without turns (a row with a
null depth) belongs to the root; an empty table has no nodes, not even a root."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayframe.llm.common import written
from stayframe.llm.numbering import positions

WIDTH = 8            # positional columns of a block
CHUNK = 4096         # blocks of a conversation scanned together
PIECE = 4096         # ids joined into one string


def digest(role: Column, text: Column) -> Column:
    """128 bits that tell turns apart by role and text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def turn_rows(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(key, pos, turn, chars): the turns of every conversation in order, from 0."""
    rows = turns.select(F.col(key), F.col(order).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return positions(rows, key, [F.col("turn"), F.col("role"), F.col("text")],
                     [digest(F.col("role"), F.col("text")).alias("turn"), F.length("text").cast("long").alias("chars")])


def _lane(n: int, depth: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(n), depth.cast("long"), turn)


def _blocks(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The block rows of (key, depth, turn, chars), and one row for each chunk of
    a conversation's blocks. A block row has the turns t1.. and characters c1.. of
    its positions, the key (p1, p2) and characters (before) of the path above it,
    and the conversation's turns, characters and end key (e1, e2)."""
    at = F.coalesce(F.col("depth"), F.lit(1)) - 1
    one = F.when(F.col("depth").isNotNull(), F.struct((at % WIDTH).alias("j"), "turn", "chars"))
    lanes = [F.coalesce(F.bit_xor(F.when(F.col("depth").isNotNull(), _lane(n, F.col("depth"), F.col("turn")))),
                        F.lit(0)).alias(f"x{n}") for n in (1, 2)]
    blocks = rows.groupBy(F.col(key).alias("conv"), F.floor(at / WIDTH).alias("block")).agg(
        F.sort_array(F.collect_list(one)).alias("list"), *lanes)
    blocks = written(blocks.select("conv", "block", F.floor(F.col("block") / CHUNK).alias("chunk"), "list", "x1", "x2",
                                   F.aggregate("list", F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("size")),
                     "blocks")
    per = blocks.groupBy("conv", "chunk").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                                              F.sum("size").alias("size"), F.sum(F.size("list")).alias("n"))
    whole = W.partitionBy("conv")
    above = whole.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    chunks = written(per.select(
        "conv", "chunk", *[zero(F.bit_xor(f"x{n}").over(above)).alias(f"a{n}") for n in (1, 2)],
        zero(F.sum("size").over(above)).alias("above"), *[F.bit_xor(f"x{n}").over(whole).alias(f"e{n}") for n in (1, 2)],
        F.sum("n").over(whole).alias("n_turns"), F.sum("size").over(whole).alias("total")), "chunks")
    inside = W.partitionBy("conv", "chunk").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    local = blocks.select("conv", "block", "chunk", "list", *[zero(F.bit_xor(f"x{n}").over(inside)).alias(f"i{n}") for n in (1, 2)],
                          zero(F.sum("size").over(inside)).alias("i_size"))
    out = local.join(chunks.drop("e1", "e2"), ["conv", "chunk"]).select(
        "conv", "chunk", "block", *[F.col(f"i{n}").bitwiseXOR(F.col(f"a{n}")).alias(f"p{n}") for n in (1, 2)],
        (F.col("i_size") + F.col("above")).alias("before"), "n_turns", "total",
        *[F.get("list", F.lit(j))["turn"].alias(f"t{j + 1}") for j in range(WIDTH)],
        *[F.get("list", F.lit(j))["chars"].alias(f"c{j + 1}") for j in range(WIDTH)])
    return written(out, "positional"), chunks


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """All nodes with the given aggregates over their members, ``level`` in the
    block, ``depth``, and the characters of the last turn and of those above."""
    columns = [f"t{j + 1}" for j in range(WIDTH)]
    sizes = ", ".join(f"max(c{j + 1}) AS c{j + 1}" for j in range(WIDTH))
    nodes = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(columns)}, {WIDTH} - bit_count(grouping_id()) AS level, count(*) AS n_convs, "
        f"min(conv) AS conv_id, max(before) AS block_before, {sizes}, {aggregates} "
        f"FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({', '.join(columns)})", blocks=blocks)
    # a group whose last column is empty holds conversations that have ended above;
    # the top of a further block is the last level of the block before
    level = F.col("level")
    real = F.when(level == 0, F.col("block") == 0)
    chars, above = F.when(level == 0, F.lit(0)), F.when(level == 0, F.lit(0))
    total = F.col("block_before")
    for j in range(1, WIDTH + 1):
        real = real.when(level == j, F.col(f"t{j}").isNotNull())
        chars, above = chars.when(level == j, F.col(f"c{j}")), above.when(level == j, total)
        total = total + F.coalesce(F.col(f"c{j}"), F.lit(0))
    return nodes.where(real).withColumns({"depth": F.col("block") * WIDTH + level, "chars": chars, "before": above})


def _keys(nodes: DataFrame) -> DataFrame:
    """Adds the keys k1, k2 of each node, q1, q2 of its parent, and ``turn``."""
    out = {}
    for n in (1, 2):
        steps = [F.when(F.col("level") >= j, _lane(n, F.col("block") * WIDTH + j, F.col(f"t{j}"))).otherwise(F.lit(0))
                 for j in range(1, WIDTH + 1)]
        path = F.col(f"p{n}")
        for s in steps:
            path = path.bitwiseXOR(s)
        out[f"k{n}"] = path
    out["turn"] = F.expr(f"CASE {' '.join(f'WHEN level = {j} THEN t{j}' for j in range(1, WIDTH + 1))} END")
    nodes = nodes.withColumns(out)
    return nodes.withColumns({f"q{n}": F.when(F.col("depth") > 0, F.col(f"k{n}").bitwiseXOR(
        _lane(n, F.col("depth"), F.col("turn")))) for n in (1, 2)})


def _ends(chunks: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes at which conversations end."""
    names = ["k1", "k2", "depth"]
    kinds = "k1 long, k2 long, depth long"
    rows = chunks.where("chunk = 0").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"),
                                            F.col("n_turns").alias("depth"), "conv")
    ranged = rows.repartitionByRange(*names, "conv").sortWithinPartitions(*names, "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(s, PIECE) for s in range(0, whole.num_rows, PIECE)):
                k = np.stack([c.to_numpy() for c in b.columns], 1)
                first = np.nonzero(np.r_[True, (k[1:, :3] != k[:-1, :3]).any(axis=1)])[0]
                ids = [str(v) for v in k[:, 3].tolist()]
                joined = [",".join(ids[s:e]) for s, e in zip(first, np.r_[first[1:], len(k)], strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(k[first, i]) for i in range(4)), pa.array(joined, pa.string())],
                                                 names=[*names, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            out = []
            for *node, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if node == last:
                    state.update(b"," + ids.encode())
                    continue
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = node, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*names, "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*last, state.hexdigest())], names=[*names, "ends_sha256"])

    parts = ranged.mapInArrow(pieces, kinds + ", first long, ids string")
    return parts.repartition(*names).sortWithinPartitions(*names, "first").mapInArrow(hashed, kinds + ", ends_sha256 string")


def prefixes(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per node of the conversations ``rows`` (key, depth from 1, turn,
    chars): conv_id (its smallest member), depth, turn, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks, chunks = _blocks(rows, key)
    found = _rollup(blocks, "max(n_turns) AS longest")
    owned = written(found.groupBy("conv_id").agg(F.sum("chars").alias("own"), F.max(
        (F.col("longest") == F.col("depth")).cast("int")).alias("leaf")), "owned")
    # facts of a conversation meet its blocks by (conversation, chunk)
    owned = chunks.select("conv", "chunk").join(owned.withColumnRenamed("conv_id", "conv"), "conv")
    shared = written(blocks.join(owned, ["conv", "chunk"], "left").withColumns({
        "shared": F.col("total") - F.coalesce("own", F.lit(0)), "leaf": F.coalesce("leaf", F.lit(0))}), "shared")
    nodes = _rollup(shared, "sum(leaf) AS n_leaves, sum(shared) AS shared, min(shared) AS least")
    nodes = written(_keys(nodes).select(
        "conv_id", "depth", "turn", "n_convs", "n_leaves", "k1", "k2", "q1", "q2",
        (F.col("shared") - F.col("least") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens")), "nodes")
    above = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    nodes = written(nodes.join(above, ["q1", "q2", "depth"], "left"), "with-parents")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    return nodes.join(children, ["conv_id", "depth"], "left").join(_ends(chunks), ["k1", "k2", "depth"], "left").select(
        "conv_id", "depth", "turn", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def labelled(nodes: DataFrame, turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``nodes`` with the role and text of their last turn (null at the root)."""
    texts = turns.select(F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("turn", digest(F.col("role"), F.col("text"))).groupBy("turn").agg(
        F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    return nodes.join(texts, "turn", "left")
