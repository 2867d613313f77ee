"""SimHash, substring deduplication, mixing, bit-sliced search and the pipeline."""

import collections
import hashlib
import os
import random
import re
import subprocess
import sys

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stayframe.llm import bitslice, mixing, phrases, q_mixing, quality, simhash
from stayframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, id long, tie int, component_id int"


def docs(spark, rows):
    """Documents with null columns and extra columns of clashing names."""
    return spark.createDataFrame([(i, t, None, None, None, "x", 5, 6, 7) for i, t in rows], DOCS)


# ---- SimHash ---------------------------------------------------------------

def brute_simhash(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)]
    hs = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    out = collections.defaultdict(set)
    for n in nodes:
        out[find(n)].add(n)
    return out.values()


def test_fingerprints():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 700):
        t = " ".join(rng.choice(["Ab", "É", "c\x0bd", "x", "yz"]) + str(rng.randint(0, 99)) for _ in range(n))
        assert simhash.simhash(t) == brute_simhash(t)


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_and_components_against_all_pairs(spark, bucket):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base:
        for _ in range(12):
            for _ in range(rng.randint(1, 4)):
                b ^= 1 << rng.randrange(64)
            fps.add(b)
    fps |= {(base[0] >> 32 << 32) | rng.getrandbits(32) for _ in range(90)} | {base[0] ^ (1 << i) for i in range(40)}
    f = sorted(fps)
    expected = {(f[i], f[j]) for i in range(len(f)) for j in range(i + 1, len(f)) if (f[i] ^ f[j]).bit_count() <= 2}
    df = spark.createDataFrame([(simhash._signed(v),) for v in f], "fp long")
    links = simhash.links(df, bucket=bucket)
    plain = lambda v: v & ((1 << 64) - 1)
    got = [tuple(sorted((plain(r.a), plain(r.b)))) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    if bucket == 64:
        found = collections.defaultdict(set)
        for r in simhash.components(links).collect():
            found[r.root].add(plain(r.node))
        assert sorted(map(sorted, found.values())) == sorted(sorted(c) for c in classes(expected, f) if len(c) > 1)


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(7, text), (3, text), (3, text), (None, text), (9, None), (8, ""), (5, "\n \t"), (1, "Other words here now"), (2, None)]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == collections.Counter(
        [(7, 3), (3, 3), (3, 3), (None, 3), (9, 2), (8, 2), (5, 2), (1, 1), (2, 2)])
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_simhash_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fp = {r.doc_id: brute_simhash(r.text) for r in rows}
    pairs = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    lowest = {n: min(c) for c in classes(pairs, fp) for n in c}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.QUERIES["op6_simhash"](spark, SF).collect()}
    assert got == {i: (format(v, "016x"), lowest[i]) for i, v in fp.items()}


# ---- substring deduplication -----------------------------------------------

def brute_dedup(rows):
    """Rows of distinct ids: (words, removed, kept digest) by id."""
    first, out = {}, {}
    for d, t in sorted(rows):
        w = (t or "").encode().split()
        cover = [False] * len(w)
        for i in range(len(w) - 19):
            if first.setdefault(tuple(w[i:i + 20]), (d, i)) != (d, i):
                cover[i:i + 20] = [True] * 20
        kept = [x for x, c in zip(w, cover, strict=True) if not c]
        out[d] = (len(w), sum(cover), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def dedup(df, **k):
    return [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept_sha).hex()) for r in phrases.deduplicate(df, **k).collect()]


@pytest.mark.parametrize("hot, passages", [(phrases.HOT, phrases.PASSAGES), (2, 7)])
def test_removed_words_against_brute_force(spark, monkeypatch, hot, passages):
    monkeypatch.setattr(phrases, "PASSAGES", passages)
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(50)]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(15, 60))) for _ in range(5)]
    rows = []
    for d in range(60):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 40))) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        rows.append((d * 3, rng.choice([" ", "\n"]).join(parts)))
    rows += [(1000, rows[5][1]), (1001, rows[5][1] + " x"), (1002, "a " * 500), (1003, "a b c d e f g " * 30), (1004, "a " * 25),
             (1005, None), (1006, ""), (1007, " ".join(vocab)), (1008, " ".join(vocab)), (1009, "a b c d e " * 5)]
    got = {r[0]: r[1:] for r in dedup(docs(spark, rows), hot=hot)}
    assert got == brute_dedup(rows)


def test_dedup_of_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    got = sorted(dedup(docs(spark, [(5, t), (5, t), (None, t), (2, None)])), key=str)
    assert [r[:3] for r in got] == [(2, 0, 0), (5, 30, 0), (5, 30, 0), (None, 30, 30)]
    assert phrases.deduplicate(docs(spark, [])).count() == 0


def test_dedup_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in Q.QUERIES["op5_substring_dedup"](spark, SF).collect()}
    assert got == brute_dedup(rows)


# ---- mixing ----------------------------------------------------------------

def test_raking_meets_the_marginals_within_what_is_held():
    rng = np.random.default_rng(4)
    tokens = rng.integers(1, 1000, 60)
    member = [np.arange(60) // 12, np.arange(60) % 4, np.arange(60) % 3]
    goals = [np.array(t) / np.sum(t) for t in ([3, 2, 2, 2, 1], [1, 1, 1, 1], [2, 1, 1])]
    w = mixing.rake(tokens, member, goals, 0.2)
    assert (w <= tokens + 1e-9).all() and (w >= 0).all()
    for m, g in zip(member, goals, strict=True):
        assert np.allclose(np.bincount(m, w), g * 0.2 * tokens.sum(), rtol=1e-4)
    plain = 0.2 * tokens.astype(float)                  # textbook raking, no upper bounds reached
    for _ in range(2000):
        for m, g in zip(member, goals, strict=True):
            plain *= (g * 0.2 * tokens.sum() / np.bincount(m, plain))[m]
    if (plain < tokens).all():
        assert np.allclose(w, plain, rtol=1e-4)
    full = mixing.rake(np.array([10, 90]), [np.array([0, 1])], [np.array([.9, .1])], 0.5)
    assert full[0] == 10                                # a goal beyond what is held takes all of it


# ---- bit-sliced search -----------------------------------------------------

def test_block_top_k_against_products():
    rng = np.random.default_rng(5)
    for n, m, d, scale in ((300, 40, 8, 30), (900, 64, 64, 33), (50, 7, 3, 10 ** 6), (5, 9, 2, 3), (700, 30, 16, 1), (1, 1, 4, 9)):
        x = np.rint(rng.normal(size=(n, d)) * scale).astype(np.int64)
        x[n // 2:n // 2 + n // 5] = x[0]
        ids = rng.permutation(n).astype(np.int64)
        pick = rng.choice(n, min(m, n), replace=False)
        qi, got, score = bitslice.block_top_k(ids, x, ids[pick], x[pick], 5)
        products = x[pick] @ x.T
        for i, p in enumerate(pick):
            best = sorted((-int(products[i, j]), int(ids[j])) for j in range(n) if j != p)[:5]
            assert [(-int(s), int(v)) for s, v in zip(score[qi == i], got[qi == i], strict=True)] == best


def test_search_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [0.0, -1.0]),
            (None, [1.0, 1.0]), (50, [0.5, 0.5]), (100, [1.0, 2.0, 3.0]), (150, []), (0, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, id string").select(
        "vec_id", "rank", bitslice.quantised(F.col("embedding")).alias("q"))
    got = [tuple(r) for r in bitslice.top_k(df, df.where("vec_id = 50"), 5).orderBy("rank").collect()]
    assert got == [(50, 1, 0, 65536), (50, 2, 0, 49152), (50, 3, 1, 49152), (50, 4, 2, 49152), (50, 5, 6, -32768)]
    assert bitslice.top_k(df, df.where("vec_id = 100"), 5).count() == 0
    assert bitslice.top_k(df.limit(0), df.limit(0), 5).count() == 0


# ---- pipeline --------------------------------------------------------------

def test_stages_keep_the_columns_and_clean_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    before = d
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, before, SF).cache()
        assert after.columns == list(corpus_pipeline.COLUMNS) == d.columns, name
        before = after
    bad = {r.doc_id for r in quality.judge(d).where("not quality.kept").select("doc_id").collect()}
    good = d.where(~F.col("doc_id").isin(list(bad)))
    lowest = {r.component_id for r in simhash.near_duplicates(good).collect()}
    assert {r.doc_id for r in before.collect()} == lowest
    assert before.where(F.col("text").rlike("[a-z0-9]@[a-z0-9]+[.]")).count() == 0
    assert before.where("n_chars <> length(text)").count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    text = " ".join(f"the word{i} of" for i in range(40))
    rows = [(1, text, "en", "src0", 9), (1, text, "en", "src0", 9), (2, text, None, None, None), (None, text + " a@b.cd", "en", "s", 1),
            (3, None, "en", "s", 0), (4, "", None, None, None), (1, text + " more words to it", "en", "z", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, quality string, ids int, kept int"
    spark.createDataFrame([(*r, "q", 1, 2) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} <= {1, None}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0


def test_entry_imports_without_this_subpackage(tmp_path):
    """The driver takes the folders and the pipeline away; the rest still works."""
    import shutil
    repo = os.path.dirname(corpus_pipeline.__file__)
    shutil.copytree(f"{repo}/stayframe", tmp_path / "stayframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_a_star_of_many_fingerprints_is_one_class(spark):
    """One centre and everything within two bits of it: 2,081 fingerprints."""
    centre = 0x0123456789ABCDEF
    fps = [centre] + [centre ^ 1 << i for i in range(64)] + [centre ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)]
    df = spark.createDataFrame([(simhash._signed(v),) for v in fps], "fp long")
    links = simhash.links(df).cache()
    v = np.array(fps, np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 2
    assert links.count() == (near.sum() - len(fps)) // 2
    found = simhash.components(links)
    assert found.count() == len(fps) and found.select("root").distinct().count() == 1
