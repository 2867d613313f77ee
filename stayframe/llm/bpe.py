"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word is a row of symbols; every adjacent pair that the merge table knows has
a rank. The leaves of a segment tree hold (rank, position) of each pair, so the
root is the lowest rank and among equals the leftmost one. A merge replaces two
symbols by one and updates the three leaves it touches, each in logarithmic
time, until the root holds no mergeable pair: a word of n symbols costs
O(n log n), however long it is.

The vocabulary file is a parameter; the driver reads it and broadcasts its text
(fixed size, a few MB). A worker process builds its tables from that once, under
the text's digest, and keeps them for its later tasks. Words repeat, so beside
them it keeps a bounded table of finished words: a word's ids as bytes, and
nothing more, since idle workers hold their tables while other stages run.

Defined results: a null or empty text has no ids and decodes to the empty
string; texts are encoded whole; special tokens written in a text become their
ids, as the file's library does; other columns are not read, and kept columns with the name
of an output column give way to it."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
import types
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = 1 << 62
WORDS_KEPT = 300_000        # finished words a worker remembers before it starts afresh
PIECE = 1 << 16             # ids decoded at once
OUT_BYTES = 8 << 20         # text per output batch
LATIN_END = 0x250           # texts below this code point are cut here, others by the file's own rules


class PairTree:
    """Minimum segment tree over the pair at each symbol position."""

    def __init__(self, keys: list[int]):
        self.size = 1 << max(0, len(keys) - 1).bit_length()
        pad = [NONE] * (self.size - len(keys))
        self.node = node = [NONE] * self.size + keys + pad
        for i in range(self.size - 1, 0, -1):
            a, b = node[2 * i], node[2 * i + 1]
            node[i] = a if a <= b else b

    def put(self, at: int, key: int) -> None:
        node, i = self.node, at + self.size
        node[i] = key
        i >>= 1
        while i:
            a, b = node[2 * i], node[2 * i + 1]
            low = a if a <= b else b
            if node[i] == low:
                break
            node[i] = low
            i >>= 1

    def lowest(self) -> int:
        return self.node[1]


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    bytes stand for themselves, the others take code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Tokenizer:
    """Encoder and decoder of one vocabulary file (BPE with a word-end suffix,
    words cut by a pattern, bytes as symbols)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        v = self.vocab
        # (left id, right id) -> (rank, merged id)
        self.merges = {(v[a], v[b]): (rank, v[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in v.items()} | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        kind = lambda k: "".join(re.escape(chr(c)) for c in range(LATIN_END)
                                 if unicodedata.category(chr(c))[0] == k)
        letters, digits = kind("L"), kind("N")
        # the file's word pattern, its classes spelled out for the Latin blocks
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|"
                                f"[^\\x09-\\x0D\\x20\\x85\\xA0{letters}{digits}]+")
        self.far = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
        self.bytes = _byte_symbols()
        self.file_text, self.rules = file_text, None
        self.done: dict[str, bytes] = {}

    def cut_words(self, text: str) -> list[str]:
        """The normalized words of a text. In the Latin blocks composition does
        nothing and white space never enters a word, so lower case and the
        pattern suffice; elsewhere the file's own normalizer and cutter, whose
        Unicode tables differ between libraries, give the words."""
        low = text.lower()
        if low.isascii() or not self.far.search(low):
            return self.words.findall(low)
        if self.rules is None:
            self.rules = tokenizers.Tokenizer.from_str(self.file_text)
        byte_of = {c: b for b, c in enumerate(self.bytes)}
        cut = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))
        return [bytes(map(byte_of.__getitem__, w)).decode() for w, _ in cut]

    def merge(self, ids: list[int]) -> list[int]:
        """The ids after all merges, lowest rank first and leftmost among equals."""
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda i, j: merges[p][0] * n + i if (p := (ids[i], ids[j])) in merges else NONE
        tree = PairTree([rank(i, i + 1) for i in range(n - 1)])
        while (low := tree.lowest()) < NONE:
            i = low % n
            j = after[i]
            ids[i] = merges[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.put(j, NONE)
            if k < n:
                before[k] = i
                tree.put(i, rank(i, k))
            else:
                tree.put(i, NONE)
            h = before[i]
            if h >= 0:
                tree.put(h, rank(h, i))
        return [i for i in ids if i >= 0]

    def word(self, w: str) -> bytes:
        """Ids of one word, as bytes."""
        symbols = [self.bytes[b] for b in w.encode()]
        symbols[-1] += self.suffix
        ids = self.merge([self.vocab[s] for s in symbols])
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(w) <= 64:
            if len(self.done) >= WORDS_KEPT:
                self.done.clear()
            self.done[w] = out
        return out

    def encode_bytes(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as little-endian 32-bit numbers, and their decoding."""
        found: list[bytes] = []
        get, word = self.done.get, self.word
        for k, part in enumerate(self.cut.split(text) if "<|" in text else (text,)):
            if k % 2:
                found.append(struct.pack("<I", self.special[part]))
            else:
                found += [get(w) or word(w) for w in self.cut_words(part)]
        raw = b"".join(found)
        parts = (raw[i:i + 4 * PIECE] for i in range(0, len(raw), 4 * PIECE))
        return raw, " ".join([self.decode(struct.unpack(f"<{len(p) // 4}I", p)) for p in parts])

    def encode(self, text: str) -> list[int]:
        raw = self.encode_bytes(text)[0]
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids) -> str:
        """The tokens joined by one space: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def of_worker(file_text: str) -> Tokenizer:
    """The process's tokenizer of a file, built when first asked for. Functions
    travel by value, so what is kept hangs on a module of the process itself."""
    kept = sys.modules.setdefault("stayframe_worker_tokenizers", types.ModuleType("stayframe_worker_tokenizers"))
    name = "t" + hashlib.sha256(file_text.encode()).hexdigest()
    if not hasattr(kept, name):
        vars(kept).clear()                   # one file at a time
        setattr(kept, name, Tokenizer(file_text))
    return getattr(kept, name)


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, n_tokens, ids, decoded) of every whole text; ``ids`` is binary,
    little-endian unsigned 32-bit numbers."""
    names = [key, *(c for c in keep if c not in (key, "n_tokens", "ids", "decoded"))]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) \
        + ", n_tokens long, ids binary, decoded string"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = of_worker(shared.value)

        def out(b: pa.RecordBatch, first: int, ids: list[bytes], decoded: list[str]) -> pa.RecordBatch:
            kept = [b.column(i).slice(first, len(ids)) for i in range(len(names))]
            return pa.record_batch([*kept, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                                    pa.array(decoded, pa.string())], names=[*names, "n_tokens", "ids", "decoded"])

        for b in batches:
            first, size, ids, decoded = 0, 0, [], []
            for i, t in enumerate(b.column(len(names))):
                raw, back = tok.encode_bytes(t.as_py() or "")
                ids.append(raw)
                decoded.append(back)
                size += len(decoded[-1])
                if size > OUT_BYTES:
                    yield out(b, first, ids, decoded)
                    first, size, ids, decoded = i + 1, 0, [], []
            if ids:
                yield out(b, first, ids, decoded)
    return rows.mapInArrow(each, schema)
