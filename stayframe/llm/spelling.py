"""Spelling variants of corpus words by blocked Gram matrices.

Two words are near if one inserted, deleted or replaced character makes them
equal. One edit changes the counts of the letters by little: their squared
distance is 2 after a replacement and 1 after an insertion, and words of a near
pair have equal or adjacent lengths. Words therefore lie in cells by length and
by how many letters fall into each of ``GROUPS`` letter groups; a near pair lies
in one cell or in two cells that differ by one letter added, or moved from one
group to another. No pair is lost that way, and only such cells meet.

A cell's words (members) are cut into blocks, and the words of the cells next to
it (visitors) into slices, by counts taken beforehand, so neither a long word
list nor a hot cell makes a large task. In a task the letter-count matrices of a
block and of a part of its visitors give one Gram matrix product, from it all
squared distances; pairs of distance two at most are then compared letter by
letter, and each word's near words are counted and its best one kept before
anything is shuffled.

``roots`` follows each word's form to the end of its chain by pointer jumping:
forms at least double in count, so six rounds reach every end.

Defined results: a null text has no words; a null id counts as the empty text;
rows that repeat an id are each counted; words of any length are compared; equal
counts are settled by code point order; an empty table gives an empty result."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import written

# fixed values of the contract: letters of a word, least length and count, share of runs that lose a letter
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, LOSS = 5, 3, 97
# ---------------------------------------------------------------------------
GROUPS = 5           # letter groups that words are told apart by
BLOCK = 2048         # members of a block
SLICE = 1 << 16      # visitors of a slice
HELD = 200_000       # words counted in a task before it passes them on
CELLS = 1 << 22      # numbers in a matrix


def runs(text: str) -> dict[str, int]:
    """Times of each maximal run of letters of a text, A-Z lower-cased."""
    out: dict[str, int] = {}
    for r in re.findall(RUN, text.encode().lower().decode()):
        out[r] = out.get(r, 0) + 1
    return out


def spelled(run: str, start: int) -> str:
    """The run as it counts: where 97 divides the CRC of id and run, it loses a
    letter. ``start`` is the CRC of the id and the colon."""
    h = zlib.crc32(run.encode(), start)
    if h % LOSS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words with the least length and count over all rows."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                           names=["word", "n"])
            held.clear()
            return b
        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                if not t.is_valid:
                    continue
                start = zlib.crc32((i.as_py() or "").encode() + b":")
                for run, n in runs(t.as_py()).items():
                    w = spelled(run, start)
                    if len(w) >= least_length:
                        held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    rows = docs.select(F.col(key).cast("string"), F.col(text).cast("string"))
    return rows.mapInArrow(each, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least_count)


def _cell(groups: int) -> Column:
    """Letters of a word in each group, in code points; their sum is the length."""
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    marks = "".join(chr(ord("0") + ord(c) % groups) for c in letters)
    marked = F.translate("word", letters, marks)
    return F.array(*[F.length("word") - F.length(F.replace(marked, F.lit(str(g)), F.lit(""))) for g in range(groups)])


def _steps(groups: int) -> list[tuple[int, ...]]:
    """From a member's cell to the cells of its visitors: its own, those with a
    letter more, and of those with a letter moved one of each two directions."""
    unit = lambda g: np.eye(groups, dtype=int)[g]
    moved = [unit(a) - unit(b) for a, b in permutations(range(groups), 2) if a < b]
    return [tuple(int(v) for v in s) for s in [0 * unit(0), *map(unit, range(groups)), *moved]]


def _letters(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points [words, length] and letter counts [words, letters]."""
    codes = words.astype(f"U{length}").view(np.uint32).reshape(len(words), length).astype(np.int64)
    column = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26)
    at = np.arange(len(words))[:, None] * 90 + column
    counts = np.bincount(at.ravel(), minlength=len(words) * 90).reshape(-1, 90)
    return codes, counts.astype(np.float32 if length < 2048 else np.float64)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of the near words a[i], b[j]. All words of ``a`` have one
    length, those of ``b`` the same one or one letter more."""
    la, lb = len(a[0]), len(b[0])
    (ca, x), (cb, y) = _letters(a, la), _letters(b, lb)
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(square <= 2)
    keep = []
    for s in range(0, len(i), step := max(1, CELLS // lb)):
        u, v = ca[i[s:s + step]], cb[j[s:s + step]]
        if la == lb:
            keep.append((u != v).sum(axis=1) == 1)
        else:      # the shorter word agrees up to some letter, and from there on one place later
            head = np.cumprod(u == v[:, :-1], axis=1).sum(axis=1)
            tail = np.cumprod((u == v[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            keep.append(head + tail >= la)
    good = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[good], j[good]


def _best(word: np.ndarray, near: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Per word: how many near words, and the one of the largest count."""
    order = np.lexsort((near, -n, word))
    word, near, n = word[order], near[order], n[order]
    first = np.nonzero(np.r_[True, word[1:] != word[:-1]])[0]
    return pa.RecordBatch.from_arrays(
        [pa.array(word[first].tolist(), pa.string()), pa.array(np.diff(np.r_[first, len(word)])),
         pa.array(near[first].tolist(), pa.string()), pa.array(n[first])], names=["word", "n_near", "near", "near_n"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of members, each followed by its visitors; rows (block, visitor,
    same cell, word, n) sorted by block and members first. Members and visitors of
    one block have at most two lengths."""
    block, held = None, []
    members = counts = None
    for b in batches:
        key, visitor, same = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        words, n = b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy()
        part = np.nonzero(np.r_[True, (key[1:] != key[:-1]) | (visitor[1:] != visitor[:-1])])[0]
        for s, e in zip(part, np.r_[part[1:], len(key)], strict=True):
            if key[s] != block:
                block, held, members = key[s], [], None
            if not visitor[s]:
                held.append((words[s:e], n[s:e]))
                continue
            if not held:
                continue
            if members is None:
                members, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            size = np.fromiter(map(len, words[s:e]), int, e - s)
            for length in np.unique(size):
                at = s + np.nonzero(size == length)[0]
                for p in range(0, len(at), step := max(1, CELLS // max(len(members), 90, int(length)))):
                    these = at[p:p + step]
                    for m in range(0, len(members), wide := max(1, CELLS // max(90, int(length)))):
                        own = members[m:m + wide]
                        i, j = near_pairs(own, words[these])
                        a, c = own[i], words[these][j]
                        once = ~same[these][j].astype(bool) | (a < c) if len(i) else np.zeros(0, bool)
                        if once.any():
                            a, c = a[once].astype(str), c[once].astype(str)
                            na, nc = counts[m:m + wide][i][once], n[these][j][once]
                            yield _best(np.concatenate([a, c]), np.concatenate([c, a]), np.concatenate([nc, na]))


def near_words(words: DataFrame, groups: int = GROUPS, block: int = BLOCK, slice_: int = SLICE) -> DataFrame:
    """(word, n_near, near, near_n) of the words (distinct, with n) that have
    near words: their number and the one of the largest count."""
    placed = written(words.select("word", "n", _cell(groups).alias("cell"), F.xxhash64("word").alias("h")), "cells")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.array(*[F.lit(v) for v in s]).alias("by"))
                                for i, s in enumerate(_steps(groups))])).alias("s")
    # the cell that a visitor of each step comes to
    to = F.zip_with("cell", "s.by", lambda x, y: x - y).alias("cell")
    callers = sizes.select("size", "cell", steps).select(to, "size").groupBy("cell").agg(F.sum("size").alias("visitors"))
    plan = written(sizes.join(callers, "cell").select(
        "cell", F.ceil(F.col("size") / block).cast("int").alias("blocks"),
        F.ceil(F.col("visitors") / slice_).cast("int").alias("slices")), "plan")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n, shift: F.pmod(F.shiftright("h", shift), F.col(n)).cast("int")
    members = placed.join(plan, "cell").select("cell", deal("blocks", 0).alias("b"), upto("slices").alias("s"),
                                               F.lit(False).alias("visitor"), F.lit(False).alias("same"), "word", "n")
    visitors = placed.select("word", "n", "h", "cell", steps).select("word", "n", "h", to, (F.col("s.step") == 0).alias("same"))
    visitors = visitors.join(plan, "cell").select("cell", upto("blocks").alias("b"), deal("slices", 20).alias("s"),
                                                  F.lit(True).alias("visitor"), "same", "word", "n")
    name = F.concat_ws(",", F.col("cell").cast("array<string>"), "b", "s").alias("block")
    rows = members.unionByName(visitors).select(name, "visitor", "same", "word", "n")
    found = rows.repartition("block").sortWithinPartitions("block", "visitor").mapInArrow(
        _meet, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.word").alias("near"), (-F.col("best.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): the end of each
    word's chain of forms."""
    at = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(6):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = written(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("moved")), "roots")
        at = more.select("word", "root")
        if more.where("moved").isEmpty():
            break
    return at


def variants(words: DataFrame, ratio: int = 2, groups: int = GROUPS, block: int = BLOCK, slice_: int = SLICE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n). The form
    is the near word of the largest count if that is ``ratio`` times the word's."""
    words = written(words.select("word", "n"), "words")
    found = words.join(near_words(words, groups, block, slice_), "word", "left")
    big = F.col("near_n") >= ratio * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                 F.when(big, F.col("near")).alias("form"), F.when(big, F.col("near_n")).alias("form_n")), "near")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
