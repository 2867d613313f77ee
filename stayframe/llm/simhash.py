"""SimHash near-duplicates by multi-index hashing.

``fingerprints`` gives each text a 64-bit SimHash over word shingles.
``links`` finds all pairs of different fingerprints within ``max_bits``: the
64 bits are cut into segments, each segment value is the key of one table, and
every fingerprint asks each table for the small Hamming ball around its own
segment value. With r = m * q + a (m segments, r bits) a pair within r differs
by at most q bits in one of the first a + 1 segments, or by at most q - 1 in
one of the others, so these radii lose no pair; every match is verified on the
complete fingerprint.

A table entry (bucket) may hold very many different fingerprints. A bucket of
more than ``BUCKET`` members is cut further by the rest of the fingerprint:
members and askers are listed under neighbours of the remaining bits, so that
every pair within the distance meets under a common key, and one key has at
most 65 members. No pair is dropped, and no bucket is paired as a whole.

``components`` joins linked fingerprints into classes by alternating large-star
and small-star rounds, written to the shared folder each round. Equal
fingerprints are one node, so copies are never paired.

Defined results: a null or wordless text has fingerprint zero and links like
any other; a text with fewer words than a shingle is one shingle; a null
``doc_id`` gets a fingerprint and takes its class from the others; repeated ids
stay repeated rows; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import written

# ---- fixed values ---------------------------------------------------------
SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# ---------------------------------------------------------------------------
SEGMENTS = 2
BUCKET = 64          # members of a bucket that are compared directly
_BYTE_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)])
_ROWS = np.arange(8) * 256


def simhash(text: str, k: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text, unsigned. A bit is set if more than half of the
    shingle hashes (repeats included) have it."""
    w = text.encode().lower().split()      # ASCII case and ASCII white space only
    if not w:
        return 0
    if len(w) < k:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    digest = xxhash.xxh64_digest
    joined = map(b" ".join, zip(*(w[i:] for i in range(k)), strict=False))
    raw = np.frombuffer(b"".join([digest(s, SEED) for s in joined]), np.uint8).reshape(-1, 8)
    if len(raw) * 8 < 4096:
        counts = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        per_byte = np.zeros(2048, np.int64)
        for part in np.array_split(raw, -(-len(raw) // 65536)):
            per_byte += np.bincount((part + _ROWS).ravel(), minlength=2048)
        counts = (per_byte.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * counts > len(raw), bitorder="little").tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(key, fp): the SimHash of every whole text, as a signed 64-bit number."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash(t.as_py() or "", k) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], names=[key, "fp"])
    rows = docs.select(key, text)
    return rows.mapInArrow(each, f"`{key}` {rows.schema[key].dataType.simpleString()}, fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _radii(m: int, r: int) -> list[int]:
    q, a = divmod(r, m)
    return [q if s <= a else q - 1 for s in range(m)]


def _masks(shift: int, width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` bits inside one segment."""
    bits = range(shift, shift + width)
    return [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(bits, n)]


def _signed(v: int) -> int:
    v &= (1 << 64) - 1
    return v - (1 << 64) if v >> 63 else v


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of different fingerprints of ``fps`` (distinct column ``fp``)
    with 1 to ``max_bits`` differing bits; each pair once."""
    width = 64 // segments
    radii = _radii(segments, max_bits)
    fp, long = F.col("fp"), lambda v: F.lit(_signed(v)).cast("long")
    inside = [((1 << width) - 1) << (s * width) for s in range(segments)]
    tables = F.array(*[F.struct(F.lit(s).alias("s"), long(inside[s]).alias("inside"))
                       for s in range(segments) if radii[s] >= 0])
    index = fps.select(fp, F.explode(tables).alias("t")).select("fp", "t.s", fp.bitwiseAND(F.col("t.inside")).alias("v"))
    crowded = written(index.groupBy("s", "v").count().where(F.col("count") > bucket)
                      .select("s", "v", F.lit(True).alias("crowded")), "crowded")
    # the ball around each segment value; one-bit flips only set a bit, so a pair is met from one side
    ball = F.array(*[F.struct(F.lit(s).alias("s"), long(inside[s]).alias("inside"), long(m).alias("m"))
                     for s in range(segments) if radii[s] >= 0 for m in _masks(s * width, width, radii[s])])
    asks = fps.select(fp, F.explode(ball).alias("t")).where(
        (F.bit_count("t.m") != 1) | (fp.bitwiseAND(F.col("t.m")) == 0)).select(
        "fp", "t.s", fp.bitwiseAND(F.col("t.inside")).bitwiseXOR(F.col("t.m")).alias("v"))
    members = index.join(crowded, ["s", "v"], "left")
    asks = asks.join(crowded, ["s", "v"], "left")

    def verified(pairs: DataFrame) -> DataFrame:
        far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        return pairs.where((F.col("a") != F.col("b")) & (far <= max_bits)).select("a", "b")

    plain = F.col("crowded").isNull()
    direct = verified(members.where(plain).select("s", "v", F.col("fp").alias("b")).join(
        asks.where(plain).select("s", "v", F.col("fp").alias("a")), ["s", "v"]))

    # crowded buckets: members and askers meet half-way in the rest of the bits
    def listed(rows: DataFrame, side: str, radius: int) -> DataFrame:
        rest = [F.array(*[long(m) for m in _rest_masks(s, width, radius)]) for s in range(segments)]
        outside = F.element_at(F.array(*[long(~inside[s]) for s in range(segments)]), F.col("s") + 1)
        rows = rows.where(~plain).select("s", "v", "fp", F.explode(F.element_at(F.array(*rest), F.col("s") + 1)).alias("m"))
        return rows.select("s", "v", fp.bitwiseAND(outside).bitwiseXOR(F.col("m")).alias("o"), fp.alias(side))
    met = verified(listed(members, "b", max_bits // 2).join(
        listed(asks, "a", max_bits - max_bits // 2), ["s", "v", "o"]))
    ordered = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered(direct).unionByName(ordered(met)).distinct()


def _rest_masks(s: int, width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` bits outside segment ``s``."""
    free = [b for b in range(64) if not s * width <= b < (s + 1) * width]
    return [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(free, n)]


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs`` (a, b): the smallest node
    reachable. Star rounds halve long chains; each round is written."""
    edges = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        # small star: smaller neighbours and the node itself go to the smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after = written(small.where(F.col("u") != F.col("v")).distinct(), "small-star")
        same = after.count() == edges.count() and after.exceptAll(edges).isEmpty()
        edges = after
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(key, fp, component_id): every row of ``docs`` with its fingerprint and
    the smallest key of its class of linked fingerprints."""
    fps = written(fingerprints(docs, key, text, k), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    classes = components(links(nodes.select("fp"), max_bits, bucket=bucket))
    linked = nodes.join(classes.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = written(linked.join(lowest, "root").select("fp", "component_id"), "classes")
    return fps.join(of_fp, "fp", "left").select(key, "fp", "component_id")
