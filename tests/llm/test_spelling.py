"""Spelling variants: words, near pairs against all pairs, forms and roots."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from stayframe.llm import q_spelling, spelling
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, word string, n string, cell int, block string"


def brute_words(rows, least=3):
    out = collections.Counter()
    for d, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            if h % 97 == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            out[r] += 1
    return {w: n for w, n in out.items() if n >= least and len(w) >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    near = collections.defaultdict(list)
    ws = sorted(words)
    for i, a in enumerate(ws):
        for b in ws[i + 1:]:
            if abs(len(a) - len(b)) < 2 and is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in ws:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in ws:
        r = w
        while form[r]:
            r = form[r]
        out[w] = (form[w], r, words[w], len(near[w]), words.get(form[w]))
    return out


def read(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_words(rng, size):
    letters = "abeinst" + "éßÿ×Àz"
    out = set()
    while len(out) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        out.add(w)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            out.add(rng.choice([w[:i] + w[i + 1:] + "s", w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:]]))
    return {w: rng.choice([3, 3, 4, 6, 7, 12, 30, 61, 200]) for w in out}


@pytest.mark.parametrize("groups, block, slice_", [(5, 2048, 1 << 16), (3, 5, 16), (1, 40, 64), (2, 1, 1)])
def test_variants_against_all_pairs(spark, groups, block, slice_):
    words = made_words(random.Random(groups), 250 if block > 1 else 40)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    out = spelling.variants(df, groups=groups, block=block, slice_=slice_)
    assert out.count() == len(words)
    assert read(out) == brute_variants(words)


def test_near_pairs_of_single_letters_and_long_words():
    pairs = lambda a, b: list(zip(*(x.tolist() for x in spelling.near_pairs(
        np.array(a, object), np.array(b, object))), strict=True))
    assert pairs(["abcde"], ["abcde", "abcdf", "abced", "edcba", "xbcde"]) == [(0, 1), (0, 4)]
    assert pairs(["abcde"], ["xabcde", "abcdex", "abxcde", "abcxxe", "aabcde"]) == [(0, 0), (0, 1), (0, 2), (0, 4)]
    long = "ab" * 3000
    assert pairs([long], [long[:-1] + "x", long, "y" + long[1:], long[1:] + "b"]) == [(0, 0), (0, 2)]
    assert pairs([long], [long + "a", "q" + long, long[:2999] + "ba" + long[3000:]]) == [(0, 0), (0, 1), (0, 2)]


def test_one_cell_holds_most_words(spark):
    # the same letters in other orders, so that length and letter counts tell nothing
    rng = random.Random(8)
    words = {"".join(rng.sample("abcdefgh", 8)): rng.randint(3, 50) for _ in range(600)}
    words |= {w[:3] + "z" + w[4:]: 100 for w in list(words)[:50]}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert read(spelling.variants(df, block=16, slice_=64)) == brute_variants(words)


def test_chains_of_forms(spark):
    # each word's form is the next one: the longest chain that counts allow
    chain = ["a" * 5 + "b" * i for i in range(40)]
    words = {w: 3 * 2 ** i for i, w in enumerate(chain)}
    got = read(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {v[1] for v in got.values()} == {chain[-1]} and got == brute_variants(words)
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_odd_rows(spark):
    long = "né" * 20_000
    rows = [(1, None), (2, ""), (None, "Hello hello HELLO hellO"), (None, "Hello hallo"), (3, "hallo hallo x×y÷z Ωmega naïve"),
            (3, "naïve NAÏVE naïve naive naive naive"), (4, f"{long} {long} {long}b {long}b {long}b"), (5, f"{long}"),
            (5, f"{long}"), (6, "a1b2 it's café-café Café CAFÉS cafés cafés")]
    df = spark.createDataFrame([(d, t, "w", "n", 1, "b") for d, t in rows], DOCS)
    got = read(spelling.variants(spelling.word_counts(df)))
    assert got == brute_variants(brute_words(rows)) and len(got) >= 5
    empty = spark.createDataFrame([], DOCS)
    assert spelling.variants(spelling.word_counts(empty)).count() == 0


def test_words_lose_letters(spark):
    rows = [(d, " ".join(f"{a}{b}cdef" for a in "ghijklm" for b in "nopqrst")) for d in range(60)]
    df = spark.createDataFrame([(d, t, "w", "n", 1, "b") for d, t in rows], DOCS)
    got = {r.word: r.n for r in spelling.word_counts(df, least_count=1).collect()}
    assert got == brute_words(rows, 1) and any(len(w) == 5 for w in got)


def test_query_against_sql_and_all_pairs(spark):
    ok, why = compare(q_spelling.op13_spelling_variants(spark, SF), duck(SF), q_spelling.ORACLE_SQL)
    assert ok, why
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert read(q_spelling.op13_spelling_variants(spark, SF)) == brute_variants(brute_words(rows))
