"""Source mixing: rows, marginals, shortfalls, kept columns; topics from terms."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stayframe.llm import mixing, q_mixing, topics
from stayframe.llm import queries as Q

DIMS = ("source", "lang", "topic")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tokens string, draw int, sampled string, label_lang int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, 1, "mine", 2, "no", 3) for i, t, lang, src in rows], DOCS)


def check_marginals(got, targets, budget):
    """Recomputes every marginal from the rows; how far each is from its target."""
    total = sum(r.tokens for r in got)
    worst = 0.0
    for d in DIMS:
        held, kept, said = collections.Counter(), collections.Counter(), {}
        for r in got:
            label = getattr(r, f"label_{d}")
            held[label] += r.tokens
            kept[label] += r.tokens * r.probability
            said.setdefault(label, getattr(r, f"short_{d}"))
        t = targets[d]
        share = {k: (held[k] ** t if isinstance(t, float) else t.get(k, 0.0)) * (held[k] > 0) for k in held}
        for k in held:
            goal = share[k] / sum(share.values()) * total * budget
            if goal:
                assert said[k] == pytest.approx(kept[k] / goal - 1, abs=1e-6)
                worst = max(worst, abs(said[k]))
    return worst


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.QUERIES["op7_source_mixing"](spark, sf).collect()
    text = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(text)
    seen = collections.defaultdict(set)
    for r in got:
        d = text[r.doc_id]
        assert (r.tokens, r.label_source, r.label_lang) == (
            len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")), d.source, d.lang if d.lang in q_mixing.TARGETS["lang"] else "*")
        u = int(hashlib.md5(f"1:{r.doc_id}".encode()).hexdigest()[:13], 16) / 16 ** 13
        assert r.sampled == (u < r.probability) and 0 <= r.probability <= 1
        seen[d.text, d.lang].add(r.label_topic)
    assert all(len(v) == 1 for v in seen.values()) and len({r.label_topic for r in got}) > 3
    assert check_marginals(got, q_mixing.TARGETS, q_mixing.BUDGET) < 0.01
    kept = sum(r.tokens for r in got if r.sampled) / sum(r.tokens for r in got)
    assert abs(kept - q_mixing.BUDGET) < 0.1


def test_marginals_at_a_larger_size(spark):
    got = Q.QUERIES["op7_source_mixing"](spark, "/root/testdata/sf0.1").collect()
    assert check_marginals(got, q_mixing.TARGETS, q_mixing.BUDGET) < 0.01
    assert len({r.label_source for r in got}) == 20
    # topics are not languages: every large topic has documents of several
    langs = collections.defaultdict(collections.Counter)
    for r in got:
        langs[r.label_topic][r.label_lang] += 1
    assert sum(len(c) > 1 for c in langs.values()) >= 3


def test_targets_that_cannot_be_met_are_reported(spark):
    rows = [(i, "w " * 10, "en", "big") for i in range(90)] + [(i, "w " * 10, "de", "small") for i in range(90, 100)]
    t = {"source": {"big": 0.5, "small": 0.5}, "lang": {"en": 0.5, "de": 0.5}}
    got = mixing.mix(docs(spark, rows), t, {"source": "source", "lang": "lang"}, 0.5).collect()
    short = {r.label_source: (r.short_source, r.probability) for r in got}
    assert short["small"] == (pytest.approx(10 / 25 - 1), pytest.approx(1.0)) and short["big"][0] == pytest.approx(0)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "en", "a"), (None, "a b", None, None), (None, "a b", None, None), (4, "", "*", "b"), (5, "x " * 5000, "xx", "*")]
    keep = ("text", "lang", "tokens", "draw", "sampled", "label_lang", "n_chars")
    out = q_mixing.mixed(docs(spark, rows), keep=keep)
    assert len(set(out.columns)) == len(out.columns) and set(keep) <= set(out.columns)
    got = out.collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got) and {r.draw for r in got} == {2}
    assert sorted(r.tokens for r in got) == [0, 0, 2, 2, 5000] and len({r.sampled for r in got if r.tokens == 2}) == 1
    assert all(r.label_topic in ("none", "*") for r in got if not r.tokens)
    assert {r.label_lang for r in got} <= {"en", "*"}
    assert q_mixing.mixed(docs(spark, [])).count() == 0


def test_many_sources_share_a_label(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_LABELS", 3)
    rows = [(i, "w " * (i % 10 + 1), "en", f"s{i % 10}") for i in range(100)]
    got = mixing.mix(docs(spark, rows), {"source": 0.5}, {"source": "source"}, 0.3).collect()
    assert {r.label_source for r in got} == {"s9", "s8", "s7", "*"} and len(got) == 100


def test_topics_separate_terms_and_ignore_languages(spark):
    rng = np.random.default_rng(1)
    words = {k: [f"{k}{i}" for i in range(40)] for k in ("law", "sea", "en", "de")}
    rows = []
    for i in range(200):
        theme, lang = ("law", "sea")[i % 2], ("en", "de")[i // 2 % 2]
        rows.append((i, " ".join([*rng.choice(words[theme], 30), *rng.choice(words[lang], 60)]), lang, "s"))
    d = docs(spark, rows)
    model = topics.train(d, "doc_id", "text", "lang", topics=2)
    n, counts = zip(*(topics.counted(r[1], {}) for r in rows), strict=True)
    got = model.assign(np.stack(counts), list(n), [r[2] for r in rows])
    assert len(set(got[::2])) == 1 and len(set(got[1::2])) == 1 and got[0] != got[1]
    # an id that very many rows share does not fill the driver
    hot = docs(spark, [(7, f"w{i}", "en", "s") for i in range(500)])
    assert len(topics.train(hot, "doc_id", "text", "lang", sample=10).centres) <= 10
    assert topics.train(hot.limit(0), "doc_id", "text", "lang").assign(np.zeros((1, topics.BUCKETS)), [3], ["en"]) == ["none"]


def test_topics_come_from_every_document(spark):
    """A theme that only the documents last in the order of their ids' hashes hold has a topic of its own."""
    rng = np.random.default_rng(2)
    words = {k: [f"{k}{i}" for i in range(30)] for k in ("law", "sea", "farm")}
    ids = sorted(range(4300), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    theme = {i: "farm" if at >= 4100 else ("law", "sea")[at % 2] for at, i in enumerate(ids)}
    rows = [(i, " ".join(rng.choice(words[theme[i]], 12)), ("en", "de")[i % 2], "s") for i in range(4300)]
    model = topics.train(docs(spark, rows), "doc_id", "text", "lang", topics=3)
    n, counts = zip(*(topics.counted(r[1], {}) for r in rows), strict=True)
    seen = collections.Counter(zip((theme[r[0]] for r in rows), model.assign(np.stack(counts), list(n), [r[2] for r in rows]), strict=True))
    assert set(seen.values()) == {2050, 200} and len(seen) == 3


def test_topics_against_plain_k_means(spark):
    """The passes over parts of the table give what one matrix of all documents gives, in any order of rows."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 60, rng.integers(0, 25)) + i % 4 * 20), (None, "en", "de")[i % 3], "s")
            for i in range(300)]
    n, counts = zip(*(topics.counted(r[1], {}) for r in rows), strict=True)
    c, langs = np.stack(counts).astype(float), [r[2] for r in rows]

    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)
    u = unit(c * np.log((1 + len(c)) / (1 + (c > 0).sum(axis=0))))
    x = unit(u - np.stack([u.mean(axis=0) if v is None else u[[w == v for w in langs]].mean(axis=0) for v in langs]))
    centres = x[[min(range(300), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())]]
    while len(centres) < 4:
        centres = np.concatenate([centres, x[(x @ centres.T).max(axis=1).argmin()][None]])
    for _ in range(topics.ROUNDS):
        own = (x @ centres.T).argmax(axis=1)
        centres = unit(np.stack([x[own == k].sum(axis=0) for k in range(4)]))
    want = (x @ centres.T).argmax(axis=1)
    models = [topics.train(docs(spark, r).repartition(p), "doc_id", "text", "lang", topics=4) for r, p in ((rows, 2), (rows[::-1], 5))]
    assert np.array_equal(models[0].centres, models[1].centres)
    got = models[0].assign(np.stack(counts), list(n), langs)
    pairs = {(int(w), g) for w, g, k in zip(want, got, n, strict=True) if k}
    assert len(pairs) == 4 == len({g for _, g in pairs}) and {g for g, k in zip(got, n, strict=True) if not k} == {"none"}


def test_words_are_hashed_as_one_by_one(spark):
    """Texts laid end to end give each document its own words, short and long, whatever stands at its ends."""
    texts = [None, "", " ", "a", "A a é\u0085b\x1cc\x0bd\r\n", "x" * 63 + " " + "y" * 64 + "\t" + "z" * 5000, " lead", "trail ", " wide sp",
             "w " * 300, " ".join(f"W{i}" for i in range(70_000)), "last"]
    for col in (pa.array(texts), pa.array(["cut", *texts])[1:], pa.chunked_array([texts]).combine_chunks()):
        for t, n, at, root in zip(texts, *(x.to_pylist() for x in topics.described(col)), strict=True):
            plain = collections.Counter(zlib.crc32(w) % topics.BUCKETS for w in (t or "").encode().lower().split())
            assert n == sum(plain.values()) and np.frombuffer(at, np.uint16).tolist() == sorted(plain)
            assert np.array_equal(np.frombuffer(root, np.float32), np.sqrt([np.float32(plain[k]) for k in sorted(plain)]))


def test_rounds_read_several_documents_a_row(spark, monkeypatch):
    """The passes of the rounds read short packed rows, counts above 255 included, and lose none."""
    read, totals = [], topics._totals

    def seen(rows, each):
        read.append((rows.count(), rows.columns))
        return totals(rows, each)
    monkeypatch.setattr(topics, "_totals", seen)
    rows = [(i, f"w{i % 7} " * (300 if i % 50 == 3 else 3) + f"x{i % 3} y{i % 5}", ("en", "de", None)[i % 3], "s") for i in range(700)]
    model = topics.train(docs(spark, rows).coalesce(1), "doc_id", "text", "lang", topics=3)
    assert len(read) > 4 and {n for n, _ in read[2:]} == {-(-700 // topics.GROUP)} and all("bits" in c for _, c in read[2:])
    held = spark.createDataFrame([(*topics.packed(topics.counted(r[1])[1]), r[2], "h") for r in rows], "at binary, root binary, lang string, h string")
    packed = topics._vectors(held.coalesce(1), model).toArrow().combine_chunks().to_batches()[0]
    got = np.concatenate([v.own.copy() for v, *_ in topics._read(packed, model.rarity)])
    number, means = model.numbered()
    want = topics.Terms(*(pa.array(x, pa.binary()) for x in zip(*(topics.packed(topics.counted(r[1])[1]) for r in rows), strict=True)), [r[2] for r in rows])
    by = model.factors(want, np.array([number.get(r[2], 0) for r in rows]), means)
    dense = np.zeros(got.shape)
    dense[want.row, want.at] = np.rint(want.units(model.rarity) * by[want.row] * topics.UNIT)
    assert np.array_equal(got, dense)
