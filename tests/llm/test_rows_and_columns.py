"""Ids, kept columns, hidden text, short secrets, and the last pipeline stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from stayframe.llm import bpe, html_text, phrases, pii, q_mixing
from stayframe.llm import queries as Q
from tests.llm.test_text import brute_base

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, spans string, redacted int, ids string, decoded int, n_tokens string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "i", 2, "n") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def model():
    return pii.train()


# ---- ids ---------------------------------------------------------------------

def test_the_last_id_is_not_taken_for_a_missing_one(spark):
    t = " ".join(f"w{i}" for i in range(30))
    last = (1 << 63) - 1
    rows = [(last, t), (None, t), (last, "short"), (None, None), (-1, t + " x")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in phrases.deduplicate(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(last, 30, 30), (None, 30, 30), (last, 1, 0), (None, 0, 0), (-1, 31, 0)], key=str)


# ---- kept columns with an output's name ---------------------------------------

def test_kept_columns_give_way(spark, model):
    d = docs(spark, [(1, "mail a@b.cd"), (2, None)])
    out = pii.find(d, model, keep=("doc_id", "spans", "redacted", "ids"))
    assert out.columns == ["doc_id", "ids", "spans", "redacted"]
    assert {r.doc_id: r.redacted for r in out.collect()} == {1: "mail [EMAIL]", 2: None}
    text = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    out = bpe.round_trip(d, text, keep=("ids", "decoded", "n_tokens", "doc_id", "spans", "text"))
    assert out.columns == ["doc_id", "spans", "text", "n_tokens", "ids", "decoded"]
    assert {r.doc_id: r.decoded for r in out.collect()}[2] == ""
    pages = spark.createDataFrame([(1, "u", "<article><p>Some words that stand here.</p></article>", "old")],
                                  "page_id long, url string, html string, text string")
    got = html_text.extract(pages, html_text.train(60), keep=("page_id", "text"))
    assert got.columns == ["page_id", "text"] and got.first().text != "old"


# ---- BPE -----------------------------------------------------------------------

def test_every_document_equals_the_library(spark):
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in Q.QUERIES["op10_bpe"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        e = lib.encode(r.text or "", add_special_tokens=False)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (
            len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest())


def test_a_worker_builds_a_file_once(monkeypatch):
    text = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    built = []
    monkeypatch.setattr(bpe, "Tokenizer", lambda t, make=bpe.Tokenizer: built.append(t) or make(t))
    first = bpe.of_worker(text)
    assert bpe.of_worker(text) is first and len(built) <= 1
    raw, back = first.encode_bytes("Hello <|endoftext|> it's  12")
    assert first.decode(np.frombuffer(raw, "<u4").tolist()) == back and first.encode("Hello <|endoftext|> it's  12") == np.frombuffer(raw, "<u4").tolist()


# ---- personal data --------------------------------------------------------------

def test_query_against_brute_force_base_spans(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op1_pii"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        base = brute_base(r.text or "")
        g = got[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == s[0] for s in base) for k in pii.BASE)
        order = sorted(base, key=lambda s: (pii.BASE.index(s[0]), s[1]))
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in order)
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [x for x in g.spans.split(",") if x]
        assert [x for x in spans if x.split(":")[0] in pii.BASE] == [x for x in joined.split(",") if x]
        kinds = [(pii.BASE + pii.MORE).index(x.split(":")[0]) for x in spans]
        assert kinds == sorted(kinds)


def test_short_secrets_after_a_cue(model):
    hits = ["pwd: Tr0ub4dor&3", "password = hunter2!x", "The passwd is s3cr3t_99.", 'pass: "Qw3rty#12"', "Password=Zx9_kk21", "pin: 94Ab77x!"]
    misses = ["The password is required here", "key: aeiouaeiou value", "a token is missing. Then", "password: see the page", "the secret is never-shown to them"]
    for t in hits:
        assert any(k == "secret" for k, *_ in model.spans([t])[0]), t
    for t in misses:
        assert not any(k == "secret" for k, *_ in model.spans([t])[0]), t
    long = "password: " + "x1" * 200_000 + " pwd=" * 50_000
    assert len(pii.candidates(long)) < 10


# ---- pages ------------------------------------------------------------------------

def test_text_that_is_not_shown_is_not_extracted():
    page = ("<article><h1>A title of the page</h1><p>First words of it, told in full.</p><p hidden>hid.</p>"
            "<p style='color:red; display : none'>gone.</p><div style=\"visibility:hidden\"><p>inner gone too</p></div>"
            "<p style='overflow:hidden' data-id='menu' title='the hidden id'>Kept words stand here, as before.</p>"
            "<p>Last <span hidden>not this</span>words, which end it.</p></article>")
    blocks = [t for t, _ in html_text.leaf_blocks(page)]
    assert blocks == ["A title of the page", "First words of it, told in full.", "Kept words stand here, as before.", "Last words, which end it."]
    marks, shown = html_text._marks("div", " class='x' data-id=menu title='class=sidebar hidden' ")
    assert shown and not any(m.startswith("cue:") for m in marks)
    assert html_text._marks("div", " HIDDEN")[1] is False and html_text._marks("div", " id=nav hidden=''")[1] is False


# ---- the last pipeline stages -------------------------------------------------------

def test_mixing_stage_keeps_what_the_draw_says(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.source_mixing(spark, d, SF)
    assert out.columns == list(corpus_pipeline.COLUMNS)
    judged = {r.doc_id: r.probability for r in q_mixing.mixed(d).collect()}
    want = {i for i, p in judged.items() if int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:13], 16) / 16 ** 13 < p}
    before = {r.doc_id: tuple(r) for r in d.select(*corpus_pipeline.COLUMNS).collect()}
    got = out.collect()
    assert {r.doc_id for r in got} == want and all(tuple(r) == before[r.doc_id] for r in got) and len(got) == len(want)


def test_token_stage_equals_the_library(spark):
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    d = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 4 = 0")
    text = {r.doc_id: r for r in d.collect()}
    got = corpus_pipeline.token_ids(spark, d, SF).collect()
    assert len(got) == len(text)
    for r in got:
        e = lib.encode(text[r.doc_id].text or "", add_special_tokens=False)
        assert (r.n_tokens, bytes(r.ids)) == (len(e.ids), np.array(e.ids, "<u4").tobytes())
        assert (r.lang, r.source) == (text[r.doc_id].lang, text[r.doc_id].source)
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_rows_follow_from_its_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    expected = d
    for _, stage in corpus_pipeline.STAGES:
        expected = stage(spark, expected, SF)
    rows = lambda df: sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in df.collect())
    got = corpus_pipeline.run(spark, SF)
    assert rows(got) == rows(expected) and got.count() > 10
    assert not [c for c in got.columns if re.search("text", c)] and got.where(F.col("ids").isNull()).count() == 0


def test_word_table_holds_ids_only(monkeypatch):
    """What a worker remembers of a word is its ids; their decoding is made of the text's ids."""
    tok = bpe.Tokenizer(bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    text = "Déjà-vu isn't <|endoftext|> 42 déjà vu naïve " + "x" * 70
    raw, back = tok.encode_bytes(text)
    assert tok.done and {type(v) for v in tok.done.values()} == {bytes} and tok.encode_bytes(text) == (raw, back)
    assert back == tok.decode(tok.encode(text)) and tok.encode_bytes("") == (b"", "")
    monkeypatch.setattr(bpe, "PIECE", 3)
    assert tok.encode_bytes(text) == (raw, back)
