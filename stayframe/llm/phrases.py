"""Substring deduplication with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Every word covered by
a window whose word sequence also starts earlier (smaller id, or the same
document and an earlier start) is removed.

1. ``sketch`` reads each text once. The minimum hash among the ``GRAM``-word
   grams inside a window is the window's key: equal windows have equal keys, and
   neighbouring windows mostly share one, so a document becomes a short list of
   runs (key, first window, number of windows). Documents of equal words have
   equal digests; only the first of them goes on, the others are copies.
2. Keys are counted with map-side sums. A window that recurs has a key that
   recurs (in another run, or nearby in its own), so only such runs become segments of words. Segments of
   one key meet in one place; a key that very many runs share (``HOT``) is cut
   into its windows, each under its own hash, so that no group grows with the
   input and equal windows still meet.
3. Equal segments are collapsed before they meet: all but the first occurrence
   of a segment consist of repeated windows. The distinct segments are sorted by
   key; a shard is a bounded number of whole groups. A shard's windows that
   occur at least twice are its confirmed passages. They are compiled into an
   Aho-Corasick automaton over words (several of a bounded size, if a key's
   group is large), and all segments of the shard run through it, which locates
   every occurrence and tells whether it is the first.
4. The located windows of a document are gathered and its covered words removed.

Hashes only choose where words meet; windows are compared word by word.

Defined results: words are kept as they are; a null text has no words; a null
id sorts after all others; different texts under one id count as documents in
an order given by their hash, equal rows as one document; a document shorter
than a window loses nothing; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm import common
from stayframe.llm.common import discard

# ---- fixed values ---------------------------------------------------------
WINDOW = 20
# ---------------------------------------------------------------------------
GRAM = 6                 # words of the grams whose minimum keys a window
RUN = 64                 # most windows in a run
HOT = 4096               # runs of a key beyond which its windows are dealt singly
SHARD_WINDOWS = 20_000   # windows gathered before an automaton is compiled
PASSAGES = 20_000        # passages of one automaton; a larger shard runs through several
CHUNK = 1 << 20          # bytes of text hashed at a time
LAST = (1 << 63) - 1     # id that rows without one are ordered by
NO_ID = 1 << 62          # ties from here on belong to them

written = partial(common.written, free=True)      # the tables here are large beside the input

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64)
_POWER = _RNG.integers(1, 1 << 63, 4096, np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, GRAM, np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def runs_of(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(document index, key, first window, windows, whether a gram of the run
    comes again within a window) of every run of the texts."""
    empty = np.zeros(0, np.int64)
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    char = ~_SPACE[raw]
    first = char.copy()
    first[1:] &= ~char[:-1]
    starts = np.nonzero(first)[0]
    if len(starts) < window:
        return empty, empty, empty, empty, empty.astype(bool)
    letters = raw[char]
    at = np.cumsum(char)[starts] - 1                       # first letter of each word among the letters
    place = np.arange(len(letters)) - np.repeat(at, np.diff(at, append=len(letters)))
    word = _mix(np.add.reduceat(_BYTE[letters] * _POWER[place & 4095], at))
    n = len(word) - GRAM + 1
    gram = np.zeros(n, np.uint64)
    for j in range(GRAM):
        gram += word[j:j + n] * _PLACE[j]
    low, width, need = _mix(gram), 1, window - GRAM + 1
    again = np.zeros(n + 1, np.int64)
    for d in range(1, need + 1):
        again[1:n + 1 - d] += low[d:] == low[:-d]
    again = np.cumsum(again)
    while 2 * width <= need:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    if need > width:
        low = np.minimum(low[:width - need], low[need - width:])
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    doc_first = np.searchsorted(starts, offsets[:-1])      # first word of each document
    doc = np.repeat(np.arange(len(texts)), np.diff(doc_first, append=len(starts)))
    m = len(low)
    whole = doc[:m] == doc[window - 1:window - 1 + m]
    local = np.arange(m) - doc_first[doc[:m]]
    new = whole & (local % RUN == 0)
    new[1:] |= whole[1:] & (low[1:] != low[:-1])
    begin = np.nonzero(new)[0]
    left = np.cumsum(whole)
    count = np.diff(left[begin], append=left[-1] + 1) if len(begin) else empty
    near = again[begin + count + need - 1] > again[begin] if len(begin) else empty.astype(bool)
    return doc[begin], low[begin].view(np.int64), local[begin], count, near


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tie, n_words, sha, runs) of every row: ``sha`` is the digest of the
    words joined by one space; (id, tie) names a text."""
    rows = _identified(docs, key, text)
    run = pa.struct([("key", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("near", pa.bool_())])

    def part(b: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]
        d, k, at, n, near = runs_of(texts)
        offsets = np.searchsorted(d, np.arange(len(texts) + 1))
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(k, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(near)], fields=list(run)))
        return pa.record_batch([*b.columns[:2], pa.array(list(map(len, words)), pa.int64()),
                                pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary()), runs],
                               names=["id", "tie", "n_words", "sha", "runs"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begin, size, texts = 0, 0, []
            for i, t in enumerate(b.column(2)):
                texts.append((t.as_py() or "").encode())
                size += len(texts[-1])
                if size >= CHUNK or i == b.num_rows - 1:
                    yield part(b.slice(begin, i + 1 - begin), texts)
                    begin, size, texts = i + 1, 0, []
    return rows.mapInArrow(each, "id long, tie long, n_words long, sha binary, "
                                 "runs array<struct<key:long,at:int,n:int,near:boolean>>")


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tie, text): the tie tells texts of one id apart, and rows without an
    id from those that really have the last one."""
    own, tie = F.col(key).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2)
    return docs.select(F.coalesce(own, F.lit(LAST)).alias("id"), F.when(own.isNull(), tie + NO_ID).otherwise(tie).alias("tie"),
                       F.col(text).alias("text"))


def segments(texts: DataFrame) -> DataFrame:
    """(key, id, tie, at, n, words) for each chosen run of (id, tie, text, runs);
    a hot run gives one row per window."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "tie", "at", "n", "words"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for b in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            for i, t, text, runs in zip(*(c for c in b.columns), strict=True):
                w = text.as_py().encode().split()
                i, t = i.as_py(), t.as_py()
                for r in runs.as_py():
                    at, n = r["at"], r["n"]
                    for s, m in (((at + j, 1) for j in range(n)) if r["hot"] else ((at, n),)):
                        piece = b" ".join(w[s:s + m + WINDOW - 1])
                        k = xxhash.xxh64_intdigest(piece) - (1 << 63) if r["hot"] else r["key"]
                        for column, v in zip(out, (k, i, t, s, m, piece), strict=True):
                            column.append(v)
                        size += len(piece)
                if size > 4 * CHUNK:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
                    out, size = [[] for _ in names], 0
            if out[0]:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
    return texts.select("id", "tie", "text", "runs").mapInArrow(
        each, "key long, id long, tie long, at int, n int, words binary")


class _Characters(dict):
    """A character of its own for each word, given when it is first met."""

    def __missing__(self, word: bytes) -> str:
        n = len(self)
        c = self[word] = chr(n if n < 0xD800 else n + 0x800)       # not the surrogates
        return c


def located(shard: list[tuple[int, int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """The repeated windows of a shard's distinct segments (id, tie, at,
    occurrences, words), each at its first occurrence: (id, tie, at, mask), bit j
    of the mask for a window j words on whose sequence starts earlier elsewhere.

    Each word of the shard is one character of its own, so a segment is a short
    string, a window a slice of it, and the automaton runs over characters."""
    char = _Characters()
    first: dict[str, int] = {}          # window -> its first place, as row and window in one number
    confirmed: set[str] = set()
    rows: list[tuple[int, int, int, str]] = []
    for i, t, at, times, words in shard:
        line = "".join(map(char.__getitem__, words.split(b" ")))
        place = len(rows) << 7
        rows.append((i, t, at, line))
        for j in range(len(line) - WINDOW + 1):
            w = line[j:j + WINDOW]
            seen = first.setdefault(w, place + j)
            if seen != place + j:
                confirmed.add(w)
                other = rows[seen >> 7]
                if (i, t, at + j) < (other[0], other[1], other[2] + (seen & 127)):
                    first[w] = place + j
            elif times > 1:
                confirmed.add(w)
    masks = [0] * len(rows)
    passages = list(confirmed)
    for s in range(0, len(passages), PASSAGES):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_STRING)
        for w in passages[s:s + PASSAGES]:
            automaton.add_word(w, first[w])
        automaton.make_automaton()
        for r, row in enumerate(rows):
            mask, place = 0, r << 7
            for end, seen in automaton.iter(row[3]):
                j = end - WINDOW + 1
                if seen != place + j:
                    mask |= 1 << j
            if mask:
                masks[r] |= mask
    for (i, t, at, _), mask in zip(rows, masks, strict=True):
        if mask:
            yield i, t, at, mask - (1 << 64) if mask >> 63 else mask


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of whole key groups from rows sorted by key."""
    def found(shard: list) -> pa.RecordBatch:
        out = list(located(shard))
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.record_batch([pa.array(list(c), k) for c, k in
                                zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                               names=["id", "tie", "at", "mask"])
    shard, size, last = [], 0, None
    for b in batches:
        for key, *row, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if size >= SHARD_WINDOWS and key != last:
                yield found(shard)
                shard, size = [], 0
            shard.append(row)
            size += n
            last = key
    if shard:
        yield found(shard)


def kept_words(rows: DataFrame) -> DataFrame:
    """(id, tie, n_removed, kept_sha, kept) of (id, tie, text, found), ``found`` an
    array of (at, mask): the words that no located window covers."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                removed, digests, kept = [], [], []
                for text, found in zip(b.column(2), b.column(3), strict=True):
                    w = text.as_py().encode().split()
                    edge = np.zeros(len(w) + 1, np.int64)
                    for f in found.as_py():
                        mask, s = f["mask"] & ((1 << 64) - 1), f["at"]
                        while mask:
                            low = mask & -mask
                            j = s + low.bit_length() - 1
                            edge[j] += 1
                            edge[j + WINDOW] -= 1
                            mask ^= low
                    free = np.nonzero(np.cumsum(edge[:-1]) == 0)[0]
                    rest = b" ".join([w[j] for j in free])
                    removed.append(len(w) - len(free))
                    digests.append(hashlib.sha256(rest).digest())
                    kept.append(rest.decode())
                yield pa.record_batch([*b.columns[:2], pa.array(removed, pa.int64()), pa.array(digests, pa.binary()),
                                       pa.array(kept, pa.string())],
                                      names=["id", "tie", "n_removed", "kept_sha", "kept"])
    return rows.select("id", "tie", "text", "found").mapInArrow(
        each, "id long, tie long, n_removed long, kept_sha binary, kept string")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, n_words, n_removed, kept_sha, kept) of every row of ``docs``; ``kept``
    is the rest of the words joined by one space, null where nothing was removed
    (the text stays as it is) or everything was."""
    own = F.struct("id", "tie")
    whole = written(sketch(docs, key, text), "sketches")
    sketches = written(whole.drop("runs"), "digests")
    # the first of the documents with equal words stands for all of them
    firsts = written(whole.groupBy("sha").agg(F.min(own).alias("rep"), F.first("runs").alias("runs")), "firsts")
    discard(whole)
    reps = written(firsts.select("sha", "rep"), "reps")
    runs = firsts.select("rep", F.explode("runs").alias("r")).select("rep", "r.*")
    times = F.sum(F.when(F.col("near"), 2).otherwise(1))
    recurring = written(runs.groupBy("key").agg(times.alias("times")).where("times > 1")
                        .select("key", (F.col("times") > hot).alias("hot")), "recurring")
    chosen = written(runs.join(recurring, "key").groupBy("rep").agg(
        F.collect_list(F.struct("key", "at", "n", "hot")).alias("runs")).select("rep.*", "runs"), "chosen")
    discard(firsts, recurring)
    texts = _identified(docs, key, text)
    pieces = written(segments(texts.join(chosen, ["id", "tie"])), "segments")
    discard(chosen)
    distinct = written(pieces.groupBy("key", "words", "n").agg(
        F.min(F.struct("id", "tie", "at")).alias("first"), F.count("*").alias("times"))
        .select("key", "first.*", "times", "words", "n"), "distinct")
    # all but the first occurrence of a segment repeat every window of it
    later = written(pieces.select("key", "id", "tie", "at", "n").join(
        distinct.select("key", "id", "tie", "at"), ["key", "id", "tie", "at"], "left_anti").select(
        "id", "tie", "at", F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), 64 - F.col("n")).alias("mask")), "later")
    discard(pieces)
    shards = distinct.repartition("key").sortWithinPartitions("key")
    located_first = written(shards.mapInArrow(_stream, "id long, tie long, at int, mask long"), "located")
    discard(distinct)
    found = later.unionByName(located_first).groupBy("id", "tie").agg(
        F.collect_list(F.struct("at", "mask")).alias("found"))
    rest = written(kept_words(texts.join(found, ["id", "tie"])).dropDuplicates(["id", "tie"]), "kept")
    discard(later, located_first)
    copy = (own != F.col("rep")) & (F.col("n_words") >= WINDOW)
    every = sketches.join(reps, "sha").join(rest, ["id", "tie"], "left")
    return every.select(
        F.when(F.col("tie") < NO_ID, F.col("id")).alias(key), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha"),
        F.when(~copy, F.col("kept")).alias("kept"))
