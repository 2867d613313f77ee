"""Topics of documents as clusters of their terms.

A document's words (ASCII lower case, split at ASCII white space) are counted in
``BUCKETS`` hash buckets; square-rooted counts times the buckets' rarity in the
corpus make a vector of length one. The mean vector of the document's language
is taken off, so that topics do not tell languages apart, and spherical k-means
gives the centres. Rarities, means, first centres and every round are taken over
all documents: each is one pass over their bucket counts (``_vectors`` packs
these for the rounds), of which only sums by bucket reach the driver. Sums are added as whole numbers (``UNIT`` is one), so
the order of rows and tasks does not change them.

Defined results: a null or wordless text has the topic ``none``; a language
outside the ``LANGUAGES`` most frequent ones uses the mean of all; equal texts of
one language have one topic; an empty table gives topic ``none`` only."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import discard, written

BUCKETS = 1024
LANGUAGES = 4000       # languages with a mean of their own
UNIT = float(1 << 30)
TOPICS = 6
ROUNDS = 25
BATCH = 512            # documents worked on at once, and in a round
ROUND = 128
_SHIFT = BUCKETS.bit_length() - 1
GROUP = 8              # documents in one row of the table that the rounds pass over
NONE = "none"


_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)      # the table of the byte-wise sum
_LONG = 64             # bytes of a word from which it is hashed by itself
_PIECE = 1 << 18       # bytes of text hashed at once


def _hashed(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 of every word of ``low``: all words' first bytes at once, then
    their second ones, and so on; longer words one by one."""
    short = sizes < _LONG
    order = np.argsort(np.where(short, -sizes, 0).astype(np.int8), kind="stable")
    at = starts[order]
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    still = np.cumsum(np.bincount(sizes[short], minlength=_LONG)[::-1])[::-1]       # words of so many bytes or more
    for p in range(_LONG - 1):
        k = still[p + 1]
        if not k:
            break
        c = crc[:k]
        crc[:k] = _CRC[(c ^ low[at[:k] + p]) & 0xFF] ^ (c >> 8)
    out = np.empty_like(crc)
    out[order] = ~crc
    for i in np.flatnonzero(~short).tolist():
        out[i] = zlib.crc32(low[starts[i]:starts[i] + sizes[i]].tobytes())
    return out


def _buckets(texts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (UTF-8, ``ends`` counted from 0): each one's
    number of words and of buckets, the buckets in order and their counts."""
    n, low = len(ends) - 1, _LOWER[texts]
    edge = np.zeros(len(low) + 1, bool)
    edge[ends] = True                        # a word ends with its text
    word = ~_SPACE[low]
    gap = np.concatenate([[True], ~word, [True]])
    starts = np.flatnonzero(word & (gap[:-2] | edge[:-1]))
    sizes = np.flatnonzero(word & (gap[2:] | edge[1:])) + 1 - starts
    words = np.diff(np.searchsorted(starts, ends))
    flat = np.repeat(np.arange(n) * BUCKETS, words) + _hashed(low, starts, sizes) % BUCKETS
    times = np.bincount(flat, minlength=n * BUCKETS)
    met = np.flatnonzero(times)
    return words, np.bincount(met >> _SHIFT, minlength=n), (met & BUCKETS - 1).astype(np.uint16), times[met]


def counted(text: str, cache: dict[bytes, int] | None = None) -> tuple[int, np.ndarray]:
    """Number of words, and the square-rooted count of each bucket."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words, _, at, times = _buckets(raw, np.array([0, len(raw)]))
    x = np.zeros(BUCKETS, np.float32)
    x[at] = np.sqrt(times.astype(np.float32))
    return int(words[0]), x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=-1, keepdims=True)), 1e-9)


class Terms:
    """Bucket counts of a batch of documents, as the buckets each one has."""

    def __init__(self, at: pa.Array, root: pa.Array, langs: list[str | None]):
        self.n, self.langs = len(at), langs
        self.sizes, buckets = _flat(at, np.uint16)
        self.row = np.repeat(np.arange(self.n), self.sizes)
        self.at, self.root = buckets.astype(np.int64), _flat(root, np.float32)[1]

    def lengths(self, rarity: np.ndarray) -> np.ndarray:
        w = self.root.astype(float) * rarity[self.at]
        return np.maximum(np.sqrt(np.bincount(self.row, w * w, self.n)), 1e-9)

    def units(self, rarity: np.ndarray) -> np.ndarray:
        """Values of the vectors of length one, bucket by bucket."""
        return self.root.astype(float) * rarity[self.at] / self.lengths(rarity)[self.row]


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers each value of a binary column holds, and all of them."""
    whole = column.cast(pa.large_binary())
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, kind)
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    held = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].tobytes() if ends[-1] > ends[0] else b""
    return np.diff(ends) // np.dtype(kind).itemsize, np.frombuffer(held, kind)


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Buckets (16 bits each) and their square-rooted counts, for ``Terms``."""
    at = np.nonzero(counts)[0]
    return at.astype(np.uint16).tobytes(), counts[at].astype(np.float32).tobytes()


@dataclass
class Vectors:
    """Vectors of a batch of documents: their own parts (in UNITs), less ``by``
    times the mean numbered ``lang``."""
    own: np.ndarray
    by: np.ndarray
    lang: np.ndarray


def _own(root: np.ndarray, rarity: np.ndarray, length: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Own parts of vectors, made in the place of a matrix of roots."""
    root *= rarity
    root /= length[:, None]
    root *= (by * UNIT)[:, None]
    return np.rint(root, out=root)


@dataclass
class Topics:
    rarity: np.ndarray                                      # [buckets]
    mean: np.ndarray                                        # of all languages
    means: dict[str, np.ndarray] = field(default_factory=dict)
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS)))

    def numbered(self) -> tuple[dict[str | None, int], np.ndarray]:
        """Numbers of the languages with a mean of their own, and the means; number 0 is the mean of all."""
        names = sorted(self.means)
        return {v: i for i, v in enumerate(names, 1)}, np.stack([self.mean, *[self.means[v] for v in names]])

    def factors(self, terms: Terms, lang: np.ndarray, means: np.ndarray) -> np.ndarray:
        """What brings each document's vector to length one once its mean is off."""
        u = terms.units(self.rarity)
        met, place = np.unique(lang, return_inverse=True)
        mean = means[met]
        square = np.bincount(terms.row, u * u, terms.n) - 2 * np.bincount(
            terms.row, u * mean[place[terms.row], terms.at], terms.n) + (mean * mean).sum(axis=1)[place]
        return 1 / np.maximum(np.sqrt(np.maximum(square, 0)), 1e-9)

    def likeness(self, v: Vectors, taken: np.ndarray) -> np.ndarray:
        """Cosine of every document with every centre; ``taken`` is that of the
        means, ``means @ centres.T``."""
        return v.own @ (self.centres.T / UNIT) - v.by[:, None] * taken[v.lang]

    def finder(self) -> Callable[[Terms, list[int]], list[str]]:
        """A function that gives each document of a batch, and its number of words, a topic."""
        number, means = self.numbered()
        taken = means @ self.centres.T

        def nearest(terms: Terms, n_words: list[int]) -> list[str]:
            if not len(self.centres) or not terms.n:
                return [NONE] * terms.n
            lang = np.array([number.get(v, 0) for v in terms.langs], np.int64)
            by, root = self.factors(terms, lang, means), np.zeros((terms.n, BUCKETS))
            root[terms.row, terms.at] = terms.root
            v = Vectors(_own(root, self.rarity, terms.lengths(self.rarity), by), by, lang)
            return [f"topic{b}" if n else NONE for b, n in zip(self.likeness(v, taken).argmax(axis=1).tolist(), n_words, strict=True)]
        return nearest

    def assign(self, counts: np.ndarray, n_words: list[int], langs: list[str | None]) -> list[str]:
        at, root = zip(*map(packed, counts), strict=True) if len(counts) else ((), ())
        return self.finder()(Terms(pa.array(at, pa.binary()), pa.array(root, pa.binary()), langs), n_words)

    def named(self) -> Callable[[Column, Column, Column, Column], Column]:
        """Column function: the topic of ``at``, ``root``, ``lang`` and the number of words."""
        nearest = self.finder()

        def each(at: pa.Array, root: pa.Array, lang: pa.Array, n: pa.Array) -> pa.Array:
            out: list[str] = []
            for i in range(0, len(at), BATCH):
                out += nearest(Terms(at[i:i + BATCH], root[i:i + BATCH], lang[i:i + BATCH].to_pylist()), n[i:i + BATCH].to_pylist())
            return pa.array(out, pa.string())
        each.__annotations__ = {"at": pa.Array, "root": pa.Array, "lang": pa.Array, "n": pa.Array, "return": pa.Array}
        return F.arrow_udf(each, "string")


def _terms(whole: pa.RecordBatch) -> Iterator[Terms]:
    """Rows (at, root, lang, ..) in batches."""
    for i in range(0, whole.num_rows, BATCH):
        b = whole.slice(i, BATCH)
        yield Terms(b.column(0), b.column(1), b.column(2).to_pylist())


VECTORS = {"bits": np.uint8, "count": np.uint8, "root": np.float32, "length": np.float64, "factor": np.float64, "lang": np.int32}
_ROOT = np.sqrt(np.arange(256, dtype=np.float32)).astype(float)


def _vectors(rows: DataFrame, model: Topics) -> DataFrame:
    """``GROUP`` documents of ``rows`` (at, root, lang, h) a row, with all that
    the rounds need of each, kept short: a bit for each bucket, the counts (the
    roots, where one is above 255), length, factor and language."""
    number, means = model.numbered()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, t in zip(range(0, whole.num_rows, BATCH), _terms(whole), strict=True):
                bits = np.zeros((t.n, BUCKETS), bool)
                bits[t.row, t.at] = True
                lang = np.array([number.get(v, 0) for v in t.langs], np.int32)
                count = np.rint(t.root.astype(float) ** 2)
                of = [np.packbits(bits, axis=1), t.lengths(model.rarity), model.factors(t, lang, means), lang]
                ends = np.concatenate([[0], np.cumsum(t.sizes)])
                h = whole.column(3).slice(start, t.n).to_pylist()
                out = []
                for lo in range(0, t.n, GROUP):
                    hi = min(lo + GROUP, t.n)
                    here = slice(ends[lo], ends[hi])
                    plain = not (count[here] > 255).any()
                    b, *more = (x[lo:hi].tobytes() for x in of)
                    out.append((b, count[here].astype(np.uint8).tobytes() if plain else b"", b"" if plain else t.root[here].tobytes(), *more, h[lo:hi]))
                *held, h = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.binary()) for x in held], pa.array(h, pa.list_(pa.string()))], names=[*VECTORS, "h"])
    return rows.select("at", "root", "lang", "h").mapInArrow(each, ", ".join(f"{c} binary" for c in VECTORS) + ", h array<string>")


def _read(whole: pa.RecordBatch, rarity: np.ndarray) -> Iterator[tuple[Vectors, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Rows of ``_vectors`` in batches, with the bits, roots and lengths they hold."""
    for i in range(0, whole.num_rows, ROUND // GROUP):
        b = whole.slice(i, ROUND // GROUP)
        sizes, (bits, count, some, length, by, lang) = zip(*(_flat(b.column(j), kind) for j, kind in enumerate(VECTORS.values())), strict=True)
        bits, root = np.unpackbits(bits).view(bool).reshape(len(by), BUCKETS), _ROOT.take(count)
        if len(some):
            wide = np.repeat(sizes[2] > 0, sizes[1] + sizes[2])
            plain, root = root, np.empty(len(wide))
            root[wide], root[~wide] = some, plain
        own = np.zeros(bits.shape)
        own[bits] = root
        yield Vectors(_own(own, rarity, length, by), by, lang.astype(np.int64)), bits, root, length, b


def _totals(rows: DataFrame, each: Callable[[pa.RecordBatch], Iterator[tuple[str | None, np.ndarray]]]) -> dict[str | None, np.ndarray]:
    """Sums by name of the arrays (a value per bucket and one more) that ``each`` gives per batch of rows."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, np.ndarray] = {}
        for whole in batches:
            for name, values in each(whole):
                if name in sums:
                    sums[name] += values
                else:
                    sums[name] = values.copy()
        for name, values in sums.items():
            k = np.nonzero(values)[0]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(k.astype(np.int32)),
                                              pa.array(values[k].astype(np.int64))], names=["name", "k", "v"])
    got = rows.mapInArrow(part, "name string, k int, v long").groupBy("name", "k").agg(F.sum("v").alias("v")).toArrow().to_pydict()
    out: dict[str | None, np.ndarray] = {}
    for name, k, v in zip(got["name"], got["k"], got["v"], strict=True):
        out.setdefault(name, np.zeros(BUCKETS + 1, np.int64))[k] = v
    return out


def _with_number(values: np.ndarray, n: int) -> np.ndarray:
    return np.append(values, float(n))


def _first(rows: DataFrame, model: Topics, means: np.ndarray) -> np.ndarray | None:
    """The vector of the document least like any centre so far (the first in
    the order of ``h``, where there is none yet)."""
    taken = means @ model.centres.T

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for whole in batches:
            for v, bits, root, length, b in _read(whole, model.rarity):
                like = model.likeness(v, taken).max(axis=1) if len(model.centres) else np.zeros(len(v.by))
                ends = np.concatenate([[0], np.cumsum(bits.sum(axis=1))])
                h = b.column(len(VECTORS)).flatten()
                for j in np.nonzero(like == like.min())[0].tolist():
                    here = (float(like[j]), h[j].as_py(), np.flatnonzero(bits[j]).astype(np.uint16).tobytes(),
                            root[ends[j]:ends[j + 1]].astype(np.float32).tobytes(), int(v.lang[j]), float(length[j]), float(v.by[j]))
                    if best is None or here < best:
                        best = here
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([z]) for z in best], names=["score", "h", "at", "root", "lang", "length", "factor"])
    got = rows.mapInArrow(part, "score double, h string, at binary, root binary, lang long, length double, factor double").orderBy(
        "score", "h", "at", "root", "lang").limit(1).collect()
    if not got:
        return None
    r, root = got[0], np.zeros((1, BUCKETS))
    root[0, np.frombuffer(bytes(r["at"]), np.uint16)] = np.frombuffer(bytes(r["root"]), np.float32)
    own = _own(root, model.rarity, np.array([r["length"]]), np.array([r["factor"]]))
    return own[0] / UNIT - r["factor"] * means[r["lang"]]


def _frequent(whole: pa.RecordBatch) -> Iterator[tuple[str | None, np.ndarray]]:
    at = _flat(whole.column(0), np.uint16)[1]
    yield "", _with_number(np.bincount(at, minlength=BUCKETS), whole.num_rows)


def fit(rows: DataFrame, topics: int = TOPICS) -> Topics:
    """Centres over all ``rows`` (at, root, lang, h), largest cluster first."""
    seen = _totals(rows.select("at"), _frequent).get("")
    if seen is None:
        return Topics(np.ones(BUCKETS), np.zeros(BUCKETS))
    n = int(seen[-1])
    rarity = np.log((1 + n) / (1 + seen[:-1]))
    kept = {r["lang"] for r in rows.where("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(
        LANGUAGES).collect()}

    def by_language(whole: pa.RecordBatch) -> Iterator[tuple[str | None, np.ndarray]]:
        for batch in _terms(whole):
            x = np.rint(batch.units(rarity) * UNIT)
            lang = [v if v in kept else None for v in batch.langs]
            met = list(dict.fromkeys(lang))
            place = {v: i for i, v in enumerate(met)}
            own = np.array([place[v] for v in lang], np.int64)
            sums = np.bincount(own[batch.row] * BUCKETS + batch.at, x, len(met) * BUCKETS).reshape(len(met), BUCKETS)
            for v, s, k in zip(met, sums, np.bincount(own, minlength=len(met)).tolist(), strict=True):
                yield v, _with_number(s, k)
    sums = _totals(rows.select("at", "root", "lang"), by_language)
    model = Topics(rarity, sum(sums.values())[:-1] / UNIT / n, {v: s[:-1] / UNIT / s[-1] for v, s in sums.items() if v is not None})
    means = model.numbered()[1]
    held = written(_vectors(rows, model), "vectors")
    while len(model.centres) < min(topics, n):
        model.centres = np.concatenate([model.centres, _first(held, model, means)[None]])
    blocks = range(0, len(means), BUCKETS)

    def by_centre(taken: np.ndarray) -> Callable[[pa.RecordBatch], Iterator[tuple[str | None, np.ndarray]]]:
        def each(whole: pa.RecordBatch) -> Iterator[tuple[str | None, np.ndarray]]:
            k = len(model.centres)
            for v, *_ in _read(whole, model.rarity):
                own = model.likeness(v, taken).argmax(axis=1)
                parts = (own == np.arange(k)[:, None]).astype(float) @ v.own
                factors = np.bincount(own * len(means) + v.lang, np.rint(v.by * UNIT), k * len(means)).reshape(k, len(means))
                for c, size in enumerate(np.bincount(own, minlength=k).tolist()):
                    yield f"{c}", _with_number(parts[c], size)
                    for i in blocks:
                        f = factors[c, i:i + BUCKETS]
                        if f.any():
                            yield f"{c}/{i // BUCKETS}", np.append(f, np.zeros(BUCKETS + 1 - len(f)))
        return each
    rounds = held.select(*VECTORS)
    before, sizes = None, None
    for left in range(ROUNDS, -1, -1):
        got = _totals(rounds, by_centre(means @ model.centres.T))
        sizes = np.array([got[f"{c}"][-1] if f"{c}" in got else 0 for c in range(len(model.centres))])
        if not left or before is not None and np.array_equal(model.centres, before):
            break                          # no more rounds, or none that would change a centre
        before = model.centres
        new = []
        for c, old in enumerate(before):
            factors = np.concatenate([got.get(f"{c}/{j}", np.zeros(BUCKETS + 1))[:-1] for j in range(len(blocks))])
            new.append(_unit((got[f"{c}"][:-1] - factors[:len(means)] @ means) / UNIT) if sizes[c] else old)
        model.centres = np.stack(new)
    model.centres = model.centres[np.argsort(-sizes, kind="stable")]
    discard(held)
    return model


def described(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, buckets and square-rooted counts of each text (null: empty)."""
    whole = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8) if len(whole) else np.zeros(0, np.uint8)
    found, at = [_buckets(np.zeros(0, np.uint8), np.zeros(1, np.int64))], 0
    while at < len(whole):
        # as many texts as fit a piece, one at least
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _PIECE, "right")) - 1)
        found.append(_buckets(data[ends[at]:ends[to]], ends[at:to + 1] - ends[at]))
        at = to
    words, sizes, buckets, times = (np.concatenate(x) for x in zip(*found, strict=True))

    def binary(values: np.ndarray) -> pa.Array:
        cuts = np.concatenate([[0], np.cumsum(sizes * values.itemsize)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(values.tobytes())])
    return pa.array(words, pa.int64()), binary(buckets), binary(np.sqrt(times.astype(np.float32)))


def order(key: Column, text: Column) -> Column:
    """Text by which documents are ordered: a hash of the id, of the text where there is none."""
    return F.md5(F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit("")))))


def train(docs: DataFrame, key: str, text: str, lang: str, sample: int | None = None, topics: int = TOPICS) -> Topics:
    """Topics fitted on all of ``docs``; on the first ``sample`` of them, in the
    order of a hash of their ids, for a caller that asks for so many only."""
    rows = docs.select(order(F.col(key), F.col(text)).alias("h"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    if sample is not None:
        rows = rows.orderBy("h", F.xxhash64("text"), "lang").limit(sample)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                b = whole.slice(i, BATCH)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *described(b.column(1))[1:]], names=["h", "lang", "at", "root"])
    held = written(rows.mapInArrow(each, "h string, lang string, at binary, root binary"), "terms")
    model = fit(held, topics)
    discard(held)
    return model
