"""Mixing sources to target weights by iterative proportional fitting.

Every document gets a label in each dimension: source and language as they are,
topic from its terms (``topics``). Targets of a dimension are shares by label,
with ``*`` for every label not named, or a power p: each label's share is in
proportion to its tokens to the p-th power, over all labels the corpus holds (the
``MOST_LABELS`` largest; the rest share one label). Token sums by cell, a cell
being one combination of labels, are all that reaches the driver; there are at
most ``cells_bound`` of them whatever the corpus holds. Raking scales the cells of
each label to its target in turn until all marginals agree, never above the
tokens a cell has. A document is then kept with the probability its cell needs:
weight after raking over tokens held. The draw is a hash of the document's id, so
it is the same on every run and machine.

Where the marginals cannot all be met, since a label holds too few tokens or
labels come only together, each row says how far its labels end from their
targets (``short_<dimension>``: tokens expected over tokens asked for, less one).

Defined results: a null label is an unnamed label; a null or wordless text has
no tokens and is drawn like the rest of its cell; a cell without tokens keeps
the sampling share of the whole; rows with one id are drawn alike (null ids by
their text); targets for labels the corpus lacks are shared out among the
others; kept columns with the name of an output column give way to it; an empty
table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm import topics as T
from stayframe.llm.common import written

OTHER = "*"
MOST_LABELS = 200
SWEEPS = 500
TOLERANCE = 1e-9
Targets = Mapping[str, Mapping[str, float] | float]


def cells_bound(targets: Targets) -> int:
    return int(np.prod([MOST_LABELS + 1 if isinstance(t, float) else len({*t, OTHER}) for t in targets.values()]))


def _filled(held: np.ndarray, weight: np.ndarray, target: float) -> np.ndarray:
    """``weight`` scaled by one factor and cut at ``held`` so that it sums to
    ``target``, or to all that is held."""
    use = weight > 0
    w, u = weight[use], held[use]
    if not len(w):
        return weight
    out = weight.copy()
    if target >= u.sum():
        out[use] = u
        return out
    order = np.argsort(u / w, kind="stable")
    full = np.concatenate([[0], np.cumsum(u[order])])[:-1]          # held by the cells cut so far
    rest = np.cumsum(w[order][::-1])[::-1]                          # weight of the others
    factors = (target - full) / rest
    i = int(np.argmax(factors <= (u / w)[order]))
    out[use] = np.minimum(u, factors[i] * w)
    return out


def _goals(tokens: np.ndarray, member: list[np.ndarray], targets: list[np.ndarray], budget: float) -> list[np.ndarray]:
    total, goals = budget * tokens.sum(), []
    for m, t in zip(member, targets, strict=True):
        held = np.bincount(m, tokens, len(t))
        share = np.where(held > 0, t, 0.0)
        goals.append(share / share.sum() * total if share.sum() else budget * held)
    return goals


def rake(tokens: np.ndarray, member: list[np.ndarray], targets: list[np.ndarray], budget: float) -> np.ndarray:
    """Weights of the cells with the given marginals. tokens [cells]; member[d]
    label number of each cell in dimension d; targets[d] share of each label."""
    total = budget * tokens.sum()
    weight = budget * tokens.astype(float)
    goals = _goals(tokens, member, targets, budget)
    cells = [[np.nonzero(m == label)[0] for label in range(len(g))] for m, g in zip(member, goals, strict=True)]
    held = tokens.astype(float)
    for _ in range(SWEEPS):
        before = weight
        weight = weight.copy()
        for of_label, goal in zip(cells, goals, strict=True):
            for at, g in zip(of_label, goal, strict=True):
                if len(at):
                    weight[at] = _filled(held[at], weight[at], g)
        if np.abs(weight - before).max(initial=0) <= TOLERANCE * max(total, 1):
            break
    return weight


def shortfall(tokens: np.ndarray, member: list[np.ndarray], targets: list[np.ndarray], budget: float,
              weight: np.ndarray) -> list[np.ndarray]:
    """For each dimension, how far each label's weight ends from its goal, as a
    share of the goal (0 where nothing was asked for and nothing is kept)."""
    out = []
    for m, g in zip(member, _goals(tokens, member, targets, budget), strict=True):
        got = np.bincount(m, weight, len(g))
        out.append(np.where(g > 0, got / np.where(g > 0, g, 1) - 1, np.where(got > 0, 1.0, 0.0)))
    return out


def uniform(key: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the id (by the text where the id is null)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def _described(docs: DataFrame, values: dict[str, str], lang: str, key: str, text: str, keep: tuple[str, ...], seed: int) -> DataFrame:
    """(row, draw, h, v_<dimension>.., lang, tokens, at, root) of every row: one pass over the texts."""
    names = [key, *(c for c in keep if c != key)]
    held = text in names                    # the text travels once
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), uniform(F.col(key), F.col(text), seed).alias("draw"),
                       T.order(F.col(key), F.col(text)).alias("h"),
                       *[F.col(c).cast("string").alias(f"v_{d}") for d, c in values.items()], F.col(lang).cast("string").alias("lang"),
                       *([] if held else [F.col(text).cast("string").alias("text")]))
    kept = rows.columns[:rows.columns.index("lang") + 1]
    place = names.index(text) if held else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, T.BATCH):
                b = whole.slice(i, T.BATCH)
                texts = pc.struct_field(b.column(0), [place]) if held else b.column(len(kept))
                yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], *T.described(texts)], names=[*kept, "tokens", "at", "root"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(kept)])
    return rows.mapInArrow(each, f"{schema}, tokens long, at binary, root binary")


def mix(docs: DataFrame, targets: Targets, columns: dict[str, str], budget: float, seed: int = 1, key: str = "doc_id",
        text: str = "text", lang: str = "lang", keep: tuple[str, ...] = (), model: T.Topics | None = None) -> DataFrame:
    """The columns key and ``keep`` of every row with its label in each dimension
    of ``targets``, ``tokens``, ``probability``, ``sampled`` and the shortfalls of
    its labels. ``columns`` names the column of each dimension but topic, whose
    labels come from ``model`` (fitted on all of ``docs`` if none is given)."""
    rows = written(_described(docs, {d: columns[d] for d in targets if d in columns}, lang, key, text, keep, seed), "described")
    if "topic" in targets:
        model = T.fit(rows) if model is None else model
        rows = rows.withColumn("v_topic", model.named()("at", "root", "lang", "tokens"))
    names = [f"label_{d}" for d in targets]
    labels = [f"v_{d}" for d in targets]
    sums = written(rows.groupBy(*labels).agg(F.sum("tokens").alias("tokens")), "labels")
    order, shares, label = {}, {}, []
    for d, t in targets.items():
        v = F.col(f"v_{d}")
        if isinstance(t, float):
            top = sums.where(v.isNotNull() & (v != OTHER)).groupBy(v.alias("v")).agg(F.sum("tokens").alias("n")).orderBy(
                F.desc("n"), "v").limit(MOST_LABELS).collect()
            order[d] = [*[r["v"] for r in top], OTHER]
        else:
            order[d] = [*t, *([] if OTHER in t else [OTHER])]
        label.append(F.when(v.isin([x for x in order[d] if x != OTHER]), v).otherwise(OTHER).alias(f"label_{d}"))
    rows = rows.select("row", "draw", "tokens", *label)
    cells = sums.select(*label, "tokens").groupBy(*names).agg(F.sum("tokens").alias("tokens")).limit(cells_bound(targets)).collect()      # the limit is the number of possible cells
    cells.sort(key=lambda c: [c[n] for n in names])
    tokens = np.array([c["tokens"] for c in cells], np.int64)
    member = [np.array([order[d].index(c[n]) for c in cells], np.int64) for d, n in zip(targets, names, strict=True)]
    for (d, t), m in zip(targets.items(), member, strict=True):
        held = np.bincount(m, tokens, len(order[d])).astype(float)
        shares[d] = held ** t * (held > 0) if isinstance(t, float) else np.array([t.get(x, 0.0) for x in order[d]])
    goal = [shares[d] for d in targets]
    weight = rake(tokens, member, goal, budget)
    short = shortfall(tokens, member, goal, budget, weight)
    share = [float(w / t) if t else budget for w, t in zip(weight, tokens, strict=True)]
    extra = [*[f"short_{d}" for d in targets], "probability"]
    facts = [(*(c[n] for n in names), *(float(s[m[i]]) for s, m in zip(short, member, strict=True)), share[i]) for i, c in enumerate(cells)]
    table = docs.sparkSession.createDataFrame(facts, ", ".join([f"{n} string" for n in names] + [f"{n} double" for n in extra]))
    out = [*names, "tokens", "probability", "sampled", *extra[:-1]]
    named = [F.col("row")[c].alias(c) for c in rows.schema["row"].dataType.names if c not in out or c == key]
    return rows.join(F.broadcast(table), names).withColumn("sampled", F.col("draw") < F.col("probability")).select(*named, *out)
