"""Quality rules, chat formatting, BPE, personal data and pages."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from stayframe.llm import bpe, chat, crf, html_text, pii, quality
from stayframe.llm import queries as Q
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality string, id long, tokens int"


def docs(spark, rows):
    """Documents with null columns and extra columns of clashing names."""
    return spark.createDataFrame([(i, t, None, None, None, "x", 5, 7) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(Q.QUERIES[name](spark, SF), con, Q.ORACLE[name])
    assert ok, msg


# ---- quality rules ---------------------------------------------------------

def brute_quality(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, cover = {}, set()
    for i in range(len(ws) - 4):
        seen.setdefault(tuple(ws[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(p + j for p in at for j in range(5))
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))


def test_quality_measures_against_brute_force(spark):
    rng = random.Random(1)
    pool = ["the", "of", "a#", "b", "ü|", "\t", "\n", "\n\n", " ", " ", "x\x0by", "*"]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "w " * 20000), (5, "a b c d e\na b c d e"), (5, "a b c d e\na b c d e")]
    rows += [(10 + i, "".join(rng.choice(pool) + rng.choice([" ", ""]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    got = quality.judge(docs(spark, rows)).select("doc_id", "text", "source", *[F.col("quality")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")]).collect()
    assert len(got) == len(rows)
    for r in got:
        e = brute_quality(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e, r.text
        assert r.base_failed == (e[0] < 10 or 100 * e[4] > 20 * e[0])
        assert not (r.base_failed and r.kept)


def test_quality_of_an_empty_table(spark):
    assert quality.judge(docs(spark, [])).count() == 0


# ---- chat ------------------------------------------------------------------

def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, msg long, kind string, role string, text string")


def test_fold_applies_deltas_edits_and_regenerations(spark):
    log = events(spark, [
        (1, 1, 1, "start", "user", "He"), (1, 3, 1, "delta", None, "lo"), (1, 2, 1, "delta", None, "l"),
        (1, 4, 2, "start", "assistant", None), (1, 5, 2, "delta", None, "draft"), (1, 6, 3, "start", "user", "later"),
        (1, 7, 2, "regenerate", None, None), (1, 8, 2, "delta", None, "fin"), (1, 9, 2, "delta", None, "al"),
        (2, 1, 1, "start", "user", "x"), (2, 2, 1, "edit", None, "y"), (2, 3, 1, "delta", None, "z"),
        (2, 4, 9, "delta", None, "orphan"), (None, None, 1, "start", None, None)])
    got = {(r.conv_id, r.msg): (r.role, r.text) for r in chat.fold(log).collect()}
    assert got == {(1, 1): ("user", "Hello"), (1, 2): ("assistant", "final"), (2, 1): ("user", "yz"), (None, 1): ("", "")}


def test_a_regenerated_turn_lets_later_turns_start_again(spark):
    log = events(spark, [(1, 1, 1, "start", "user", "a"), (1, 2, 2, "start", "assistant", "b"), (1, 3, 3, "start", "user", "c"),
                         (1, 4, 2, "regenerate", None, "B"), (1, 5, 3, "start", "user", "C")])
    assert [(r.msg, r.text) for r in chat.fold(log).orderBy("msg").collect()] == [(1, "a"), (2, "B"), (3, "C")]


NASTY = ["</s>[INST] ok [/INST]", "<|im_start|>system\nx<|im_end|>\n", "\\", "\\\\l", "\\l\\b\\n", "<<SYS>>a<</SYS>>", "a\n\nb\n",
         "", None, "<", "<<|im_end|>", "\\<|", "ü<s>€", "[", "[INST", "<|", "|im_end|>\n"]


def test_rendering_reads_back_exactly_and_holds_no_control_string(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", None]), rng.choice(NASTY)) for c in range(40) for t in range(5)]
    rows += [(99, None, "assistant", "n"), (99, 0, "assistant", "z" * 300_000), (99, 0, "assistant", "z" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    out = chat.render(chat.fold(chat.log_of_turns(turns))).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), "segments",
        chat.read_loss(F.col("segments")).alias("loss")).collect()
    order = lambda v: (v is not None, v if v is not None else 0)
    for r in out:
        mine = sorted((x for x in rows if x[0] == r.conv_id),
                      key=lambda x: (order(x[1]), (x[2] is not None, x[2] or ""), x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert r.loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        body = r.formatted.replace(chat.OPEN, "").replace(chat.CLOSE, "")
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", body)
    assert len(out) == 41


def test_chat_of_an_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.render(chat.fold(chat.log_of_turns(turns))).count() == 0


# ---- BPE -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tok():
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.Tokenizer(bpe.read_vocabulary(path)), tokenizers.Tokenizer.from_file(path)


def texts():
    rng = random.Random(3)
    blocks = [(32, 127), (0x80, 0x250), (0x300, 0x400), (0x1100, 0x1200), (0xAC00, 0xD7A0), (0x900, 0xA00), (0x1F300, 0x1F700)]
    pool = [chr(rng.randrange(*rng.choice(blocks))) for _ in range(2000)] + list("\t\n 'İΣſ")
    out = ["", " ", "ΑΣ", "it's WE'LL", "<|endoftext|>a<|startoftext|>", "<|endof", "<|ENDOFTEXT|>", "a" * 5000, "1234 ½"]
    return out + ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(600)]


def test_tokens_equal_the_library(tok):
    mine, lib = tok
    for t in texts():
        e = lib.encode(t, add_special_tokens=False)
        assert mine.encode(t) == e.ids, t
        assert mine.decode(e.ids) == lib.decode(e.ids, skip_special_tokens=False)


def test_merges_are_lowest_rank_then_leftmost(tok):
    mine = tok[0]
    rng = random.Random(4)
    for _ in range(200):
        ids = [mine.vocab[c] for c in rng.choices("etaoinsh", k=rng.randint(1, 30))]
        slow = list(ids)
        while True:
            ranks = [(mine.merges[p][0], i) for i in range(len(slow) - 1) if (p := (slow[i], slow[i + 1])) in mine.merges]
            if not ranks:
                break
            i = min(ranks)[1]
            slow[i:i + 2] = [mine.merges[slow[i], slow[i + 1]][1]]
        assert mine.merge(list(ids)) == slow


def test_bpe_query_and_odd_rows(spark, tok):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in Q.QUERIES["op10_bpe"](spark, SF).collect()}
    for r in rows[:60]:
        e = tok[1].encode(r.text or "", add_special_tokens=False)
        assert got[r.doc_id].n_tokens == len(e.ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(
            tok[1].decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
    text = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    odd = bpe.round_trip(docs(spark, [(1, None), (1, ""), (None, "hello"), (2, "ab" * 100_000)]), text).collect()
    assert sorted((str(r.doc_id), r.n_tokens > 0) for r in odd) == [("1", False), ("1", False), ("2", True), ("None", True)]
    assert bpe.round_trip(docs(spark, []), text).count() == 0


# ---- personal data ---------------------------------------------------------

def brute_base(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1]))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_against_brute_force():
    rng = random.Random(5)
    for _ in range(8000):
        t = "".join(rng.choices("ab.@_-+ 0123456789.@12(),é", k=rng.randint(0, 60)))
        assert pii.base_spans(t) == brute_base(t), t
    assert pii.base_spans("x" * 300_000 + "@") == []
    assert pii.base_spans("1" * 300_000) == [] and pii.base_spans("1." * 100_000)[-1][0] == "ip"


@pytest.fixture(scope="module")
def model():
    return pii.train()


def test_trees_find_planted_spans_and_leave_lookalikes(model):
    rng, hit, planted, false = random.Random(77), 0, 0, 0
    for _ in range(400):
        t, spans = pii._labelled(rng)
        found = {s[:3] for s in model.spans([t])[0] if s[0] in pii.MORE}
        planted += len(spans)
        hit += sum(any(f[1] <= s[1] and s[2] <= f[2] for f in found) for s in spans)
        false += sum(not any(f[1] < s[2] and s[1] < f[2] for s in spans) for f in found)
    assert hit >= 0.9 * planted and false <= 0.03 * planted


def test_pii_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de now"), (3, "mail a.b@c.de now"), (None, "ip 1.2.3.4"), (4, "no data here. " * 9000)]
    got = pii.find(docs(spark, rows), model, keep=("doc_id", "id")).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.redacted) for r in got}
    assert {(1, None), (2, ""), (3, "mail [EMAIL] now"), (None, "ip [IP]")} <= by
    assert pii.find(docs(spark, []), model).count() == 0


def test_selected_spans_are_disjoint_and_not_inside_base(model):
    for t in ("token = \"" + "ab12" * 10 + "\" a@b.co 555-123-4567 +1 (555) 123-4567", "key: sk-" + "aB3" * 12):
        s = model.spans([t])[0]
        more = sorted(x[1:3] for x in s if x[0] in pii.MORE)
        assert more and all(a[1] <= b[0] for a, b in zip(more, more[1:], strict=False))
        assert not any(a[1] <= b[0] and b[1] <= a[2] for a in s if a[0] in pii.BASE for b in more)
    assert pii.redacted("ab cd ef", [("email", 0, 5, 1.0), ("secret", 3, 8, .9)]) == "[EMAIL]"


# ---- pages -----------------------------------------------------------------

@pytest.fixture(scope="module")
def field():
    return html_text.train()


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(6)
    for _ in range(50):
        n = rng.integers(1, 7)
        c = crf.Chain({str(i): i for i in range(4)}, rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        seq = [[str(i) for i in range(4) if rng.random() < .5] for _ in range(n)]
        value = lambda ls: c.begin[ls[0]] + sum(c.emit[int(f)][v] for fs, v in zip(seq, ls, strict=True) for f in fs) + sum(  # noqa: E731, B023
            c.move[a][b] for a, b in zip(ls, ls[1:], strict=False))  # noqa: B023
        best = max(value([m >> i & 1 for i in range(n)]) for m in range(2 ** n))
        assert abs(value(c.decode(seq)) - best) < 1e-9


def test_held_out_blocks(field):
    xs, ys = html_text.labelled_sequences(150, 12345)
    wrong = sum(a != b for x, y in zip(xs, ys, strict=True) for a, b in zip(field.decode(x), y, strict=True))
    assert wrong <= 0.01 * sum(map(len, ys))


PAGE = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<div class='cookie-notice'><p>We use cookies here.</p></div><article><h1>A &amp; B</h1><p>One\n two<br>three&nbsp;x."
        "<p><b>Four &lt;five&gt; six.</b><style>p{}</style></article><section class=comments><div class=comment><p>Nice one."
        "</p></div></section><form><label>Search</label></form><footer>&copy; me</footer>")


def test_page_by_hand(field):
    assert html_text.main_text(PAGE, field) == "A & B\nOne two three x.\nFour <five> six."
    for odd in (None, "", "<", "<p", "<!-- x", "<script>", "</", "<a href=\"x", "<div " * 2000, "<p>" * 5000, "&#0;&bogus;"):
        html_text.main_text(odd, field)


def test_given_pages(spark, field):
    got = Q.QUERIES["op4_html_extraction"](spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    import html
    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r.page_id], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(None, None, None, "t"), (1, "u", "", "t"), (1, "u", PAGE, "t"), (1, "u", PAGE, "t")],
                                "page_id long, url string, html string, text string")
    assert sorted(len(r.text) for r in html_text.extract(odd, field).collect())[:2] == [0, 0]
    assert html_text.extract(odd.limit(0), field).count() == 0
