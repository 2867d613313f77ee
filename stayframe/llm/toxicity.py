"""Toxicity categories by a classifier chain.

Categories are predicted one after another. The model of each category is a
linear (logistic) model over terms of its own (words and word beginnings, chosen
by their chi-square with that category), over the text's form (``FORM``) and over
the probabilities of all earlier categories. In training those probabilities are
out-of-fold: the sample is cut into ``FOLDS`` parts, and a document's earlier
probability comes from a model whose terms, scales and weights were all taken
from the other parts, so a later model learns how far an earlier one can be
trusted, and thresholds are set on predictions that are honest. In use the chain
runs in order.

The models are fitted on the driver on at most ``SAMPLE`` labelled documents,
half of them positive in the main category, taken in the order of a hash of
their ids (a documented bound that holds however often an id repeats); the
sample's ids reach the tasks as a broadcast of at most that many. Sample rows
count by how many labelled documents of their kind they stand for when thresholds
are set. Every document is then scored whole.

Defined results: a null or wordless text has the probability of the models'
constants; unlabelled documents are scored alike; equal rows score alike; an id
with several labels is positive if one is; with no positive or no negative label
a category has the constant probability of its share; kept columns with the name
of an output column give way to it; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import written

SAMPLE = 6000            # labelled documents fitted on
FEATURES = 1024          # words and beginnings of a category, by their chi-square
BEGINNINGS = (4, 5, 6)   # lengths of word beginnings
FOLDS = 3
ROUNDS = 80
TRUST = 4.0              # scale of earlier probabilities, so that they are learned as fast as terms
RATE = 0.1
RIDGE = 1e-4
PRECISION = 0.99         # out-of-fold, of a category's flags; where nothing reaches it, the best balance
FLOOR = 0.3              # least threshold
EDGE = "\"'`.,;:!?()[]{}<>*#%&$|-_…«»“”„’‘¡¿/\\+=~^@"
# form of a text: words, share of symbols, capitals, digits, repeated words and lines, letters a word
FORM = ("words", "symbols", "capitals", "digits", "repeats", "lines", "width")
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&|<>!{}=_~^@", bytes(range(65, 91)), bytes(range(48, 58))


def form(text: str) -> list[float]:
    """The numbers of ``FORM``."""
    raw = text.encode()
    words, lines, n = raw.split(), [x for x in raw.split(b"\n") if x.strip()], max(1, len(raw))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    return [float(np.log1p(len(words))), share(_SYMBOLS), share(_CAPITALS), share(_DIGITS), 1 - len(set(words)) / max(1, len(words)),
            1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(words)) / 10]


def terms(text: str) -> set[int]:
    """Hashes of the distinct words of a text and of their beginnings."""
    out: set[int] = set()
    for w in {x.strip(EDGE) for x in set(text.lower().split())}:
        out.update(_term(w))
    return out


def _term(word: str) -> tuple[int, ...]:
    if not word:
        return ()
    h = xxhash.xxh32_intdigest
    return (h(word, 0), *(h(word[:k], k) for k in BEGINNINGS if len(word) >= k))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights, the constant last, by Adam steps on the whole sample."""
    n = len(x)
    w = np.zeros(x.shape[1] + 1)
    if not 0 < y.sum() < n:                      # one label only: its share as a constant
        share = (y.sum() + 0.5) / (n + 1)
        w[-1] = np.log(share / (1 - share))
        return w
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = _probability(x, w)
        g = np.append((p - y).astype(np.float32) @ x, (p - y).sum()) / n
        g[:-1] += RIDGE * w[:-1]
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        w = w - RATE * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-8)
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -30, 30)))


@dataclass
class Link:
    """The model of one category."""
    terms: np.ndarray                # hashes
    weights: np.ndarray              # of the terms, the form, earlier categories, and the constant
    threshold: float
    precision: float                 # out of fold, at the threshold
    recall: float
    base: float                      # share of positives


@dataclass
class Chain:
    categories: list[str]
    links: list[Link]
    centre: np.ndarray = field(default_factory=lambda: np.zeros(len(FORM)))
    spread: np.ndarray = field(default_factory=lambda: np.ones(len(FORM)))

    def __post_init__(self):
        """One table of all links' terms: hash -> row of weights."""
        known = sorted({int(h) for link in self.links for h in link.terms})
        self.column = {h: i for i, h in enumerate(known)}
        self.table = np.zeros((len(known), len(self.links)), np.float32)
        for j, link in enumerate(self.links):
            for h, w in zip(link.terms.tolist(), link.weights, strict=False):
                self.table[self.column[h], j] = w

    def score(self, texts: list[str], cache: dict[str, tuple[int, ...]]) -> np.ndarray:
        """[texts, categories] probabilities. ``cache`` remembers words."""
        z = np.zeros((len(texts), len(self.links)))
        for i, t in enumerate(texts):
            rows: set[int] = set()
            for w in set(t.lower().split()):
                found = cache.get(w)
                if found is None:
                    if len(cache) > 500_000:
                        cache.clear()
                    found = tuple(self.column[h] for h in _term(w.strip(EDGE)) if h in self.column)
                    if len(w) <= 64:
                        cache[w] = found
                rows.update(found)
            if rows:
                z[i] = self.table[list(rows)].sum(axis=0)
        shape = (np.array([form(t) for t in texts]).reshape(-1, len(FORM)) - self.centre) / self.spread
        p = np.zeros_like(z)
        for j, link in enumerate(self.links):
            rest = link.weights[len(link.terms):]
            p[:, j] = 1 / (1 + np.exp(-np.clip(z[:, j] + np.hstack([shape, p[:, :j]]) @ rest[:-1] + rest[-1], -30, 30)))
        return p


class _Terms:
    """The sample's term sets as one numbered list."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.known, self.code = np.unique(np.concatenate([*sets, np.zeros(0, np.uint32)]), return_inverse=True)
        self.row = np.repeat(np.arange(self.n), [len(t) for t in sets])

    def chosen(self, y: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, scales) by chi-square with ``y`` over the rows ``use`` alone. A
        term weighs as much as it tells, so that strong terms are learned first."""
        here = use[self.row]
        code, label = self.code[here], y[self.row[here]]
        with_term = np.bincount(code, minlength=len(self.known)).astype(float)
        positive = np.bincount(code, label, len(self.known))
        share = y[use].mean() if use.any() else 0.0
        chi = (positive - share * with_term) ** 2 / np.maximum(with_term * share * (1 - share), 1e-9)
        chi = np.where(with_term >= 3, chi, 0)
        best = np.lexsort((self.known, -chi))[:FEATURES]
        best = best[chi[best] > 0]
        return best, np.sqrt(chi[best] / max(chi[best].max(initial=0), 1e-9)).astype(np.float32)

    def matrix(self, terms: np.ndarray, scale: np.ndarray) -> np.ndarray:
        column = np.full(len(self.known), -1)
        column[terms] = np.arange(len(terms))
        x = np.zeros((self.n, len(terms)), np.float32)
        use = column[self.code] >= 0
        x[self.row[use], column[self.code[use]]] = scale[column[self.code[use]]]
        return x


def fit(term_sets: list[np.ndarray], forms: np.ndarray, labels: np.ndarray, categories: list[str],
        stand_for: np.ndarray | None = None) -> Chain:
    """A chain over the categories in their order. forms [documents, FORM];
    labels [documents, categories] of 0 and 1; ``stand_for`` how many documents
    each one counts for."""
    n = len(term_sets)
    known, fold = _Terms(term_sets), np.arange(n) % FOLDS
    weigh = np.ones(n) if stand_for is None else stand_for
    centre = forms.mean(axis=0) if n else np.zeros(len(FORM))
    spread = forms.std(axis=0) + 1e-6 if n else np.ones(len(FORM))
    shape = ((forms - centre) / spread).astype(np.float32).reshape(n, len(FORM))
    earlier = np.zeros((n, 0), np.float32)                          # out-of-fold probabilities
    links = []
    for j in range(len(categories)):
        y = labels[:, j].astype(float)

        out = np.zeros(n)
        for f in range(FOLDS):
            held = fold == f
            if held.any() and not held.all():
                terms, scale = known.chosen(y, ~held)
                x = np.hstack([known.matrix(terms, scale), shape, TRUST * earlier])
                out[held] = _probability(x[held], _logistic(x[~held], y[~held]))
        terms, scale = known.chosen(y, np.ones(n, bool))
        w = _logistic(np.hstack([known.matrix(terms, scale), shape, TRUST * earlier]), y)
        w[:len(terms)] *= scale                                     # texts to score have plain terms
        w[len(terms) + len(FORM):-1] *= TRUST
        links.append(Link(known.known[terms], w, *_threshold(out, y, weigh), float(np.average(y, weights=weigh)) if n else 0.0))
        earlier = np.hstack([earlier, out[:, None].astype(np.float32)])
    return Chain(list(categories), links, centre, spread)


def _threshold(p: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> tuple[float, float, float]:
    """(threshold, precision, recall) out of fold: the lowest score with enough
    precision, at least FLOOR; else the one with the best balance of both."""
    if not len(p) or not y.any():
        return 0.5, 0.0, 0.0
    order = np.argsort(-p, kind="stable")
    hit, flagged = np.cumsum((y * weigh)[order]), np.cumsum(weigh[order])
    precision, recall = hit / flagged, hit / hit[-1]
    good = np.nonzero((precision >= PRECISION) & (p[order] >= FLOOR))[0]
    at = good[-1] if len(good) else int(np.argmax(2 * precision * recall / np.maximum(precision + recall, 1e-9)))
    return float(p[order][at]), float(precision[at]), float(recall[at])


def gather(docs: DataFrame, labelled: DataFrame, main: str, others: list[str], key: str = "doc_id", text: str = "text",
           sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Term sets, forms, labels (main first) and weights of the bounded sample.
    ``labelled`` has one column of 0 and 1 per category beside the key."""
    names = [main, *others]
    ids = labelled.where(F.col(key).isNotNull() & F.col(main).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        *[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in names])
    ids = written(ids.withColumn("h", F.md5(F.col("id").cast("string"))), "labelled")
    whole = {r[main]: r["n"] for r in ids.groupBy(main).agg(F.count(F.lit(1)).alias("n")).collect()}      # two rows
    halves = [ids.where(F.col(main) == v).orderBy("h", "id").limit(sample // 2) for v in (0, 1)]
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(halves[0].unionByName(halves[1])), "id").select("id", "h", *names, "text")
    kinds = dict(rows.dtypes)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(len(names) + 2).to_pylist()]
            found = [np.array(sorted(terms(t)), np.uint32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(found, pa.binary()), pa.array([form(t) for t in texts], pa.list_(pa.float64()))],
                names=["id", "h", *names, "terms", "form"])
    schema = f"id {kinds['id']}, h string, " + ", ".join(f"`{c}` int" for c in names) + ", terms binary, form array<double>"
    got = written(rows.mapInArrow(each, schema), "sample")
    order = ["h", "id", F.xxhash64("terms"), F.xxhash64("form")]
    sampled = [r for v in (0, 1) for r in got.where(F.col(main) == v).orderBy(*order).limit(sample // 2).collect()]
    sampled.sort(key=lambda r: (r["h"], str(r["id"]), bytes(r["terms"])))
    taken = {v: sum(r[main] == v for r in sampled) for v in (0, 1)}
    return ([np.frombuffer(r["terms"], np.uint32) for r in sampled], np.array([r["form"] for r in sampled]).reshape(-1, len(FORM)),
            np.array([[r[c] for c in names] for r in sampled], np.int64).reshape(-1, len(names)),
            np.array([whole[r[main]] / taken[r[main]] for r in sampled]))


def score(docs: DataFrame, chain: Chain, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, and for each category its probability
    ``p_<category>`` and whether it reaches the threshold, ``<category>``."""
    names = [n for c in chain.categories for n in (f"p_{c}", c)]
    kept = [c for c in keep if c not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias("_text"))
    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, ...]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                p = chain.score([t or "" for t in b.column(len(kept)).to_pylist()], cache)
                out = [a for j, link in enumerate(chain.links)
                       for a in (pa.array(np.round(p[:, j], 6)), pa.array(p[:, j] >= link.threshold))]
                yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], *out], names=[*kept, *names])
    return rows.mapInArrow(each, schema + ", ".join(f"`p_{c}` double, `{c}` boolean" for c in chain.categories))
