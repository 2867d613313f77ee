"""Personal data by candidate gradient boosting.

Four base kinds (email, ip, card, phone) are found by their fixed formats and
always stay. Beyond them, high-recall generators propose overlapping spans of
further kinds; boosted trees score each span from its format and its context,
and a threshold per kind, calibrated on held-out labelled spans, selects the
redactions. Of overlapping selected spans the best scored stays; spans inside
a base span are dropped, since that text is redacted already.

The trees are fitted on the driver on ``TRAIN_TEXTS`` generated, labelled texts
(a fixed bound): no table here labels personal data.

Every generator scans a text once and left to right; none re-reads a run of
characters for each of its positions, so very long texts cost linear time.

Defined results: a null or empty text has no spans; offsets count code points,
end exclusive; equal rows give equal rows; other columns are not read unless
asked for, and kept columns named ``spans`` or ``redacted`` give way; an empty
table gives an empty result."""

from __future__ import annotations

import bisect
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm import boost

# ---- fixed values: base kinds in their order, and the further kinds --------
BASE = ("email", "ip", "card", "phone")
MORE = ("handle", "iban", "local_phone", "secret", "ssn")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# ---------------------------------------------------------------------------
TRAIN_TEXTS = 3000
PRECISION = 0.99        # of selected spans of a kind on the held-out texts
SEED = 7

_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/=-]{15,}")
_DIGITS = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CUED = re.compile(r"(?i:\b(?:password|passwd|passphrase|pwd|pass|pin|secret|token|key|credential)s?)[\"'`]?\s{0,3}(?:is\b|[:=])\s{0,3}[\"'`]?"
                   r"([^\s\"'`]{6,64})")
_HANDLE = re.compile(r"[A-Za-z0-9._-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}| ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}){1,4}")
CUES = {
    "phone": ("phone", "tel", "call", "fax", "mobile", "dial", "reach"),
    "ssn": ("ssn", "social", "security no", "tax id"),
    "secret": ("key", "token", "secret", "password", "passwd", "pwd", "bearer", "credential"),
    "bank": ("iban", "account", "bank", "transfer"),
    "mail": ("mail", "contact", "write", "address"),
    "number": ("order", "invoice", "isbn", "version", "id", "no.", "page", "year", "total", "sum", "commit", "sha",
               "build", "serial", "ticket", "item", "model"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds by kind, then start."""
    out, end = [], 0
    at = t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(t, at + 1)):
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at + 1)
        at = t.find("@", max(at + 1, end))
    for m in IP_CHAIN.finditer(t):
        # a run of dotted numbers holds one address for each four of them
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append(("ip", start, stop))
            start = stop + 1
    for m in CARD.finditer(t):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(t):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def candidates(t: str) -> list[tuple[str, int, int]]:
    """Proposed spans of the further kinds; they may overlap."""
    out = []
    for m in _DIGITS.finditer(t):
        n = sum(c.isdigit() for c in m.group())
        if 7 <= n <= 15:
            start = m.start() - (m.start() > 0 and t[m.start() - 1] == "(")
            out.append(("local_phone", start, m.end()))
            if n == 9:
                out.append(("ssn", m.start(), m.end()))
    for m in _TOKEN.finditer(t):
        s = m.group()
        if any(c.isdigit() for c in s) or s.isupper():
            out.append(("secret", m.start(), m.end()))
            at = s.rstrip("=").rfind("=") + 1          # name=value: the value alone as well
            if at and len(s) - at >= 16:
                out.append(("secret", m.start() + at, m.end()))
    for m in _CUED.finditer(t):                        # what follows a cue, however short
        s = m[1].rstrip(".,;:!?)]}>")
        if len(s) >= 6:
            out.append(("secret", m.start(1), m.start(1) + len(s)))
    for m in _IBAN.finditer(t):
        out.append(("iban", m.start(), m.end()))
    if "at]" in t or "at)" in t:
        for m in _HANDLE.finditer(t):
            out.append(("handle", m.start(), m.end()))
    return list(dict.fromkeys(out))


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return len(s) >= 15 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(t: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and its context (24 characters before, 12 after)."""
    s, n = t[start:end], end - start
    digits = sum(c.isdigit() for c in s)
    upper, lower = sum("A" <= c <= "Z" for c in s), sum("a" <= c <= "z" for c in s)
    counts = Counter(s)
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
    groups = re.findall(r"[0-9]+", s)
    shape = "-".join(str(len(g)) for g in groups)
    turns = sum((a.isdigit() != b.isdigit()) for a, b in zip(s, s[1:], strict=False))
    before, after = t[max(0, start - 24):start].lower(), t[end:end + 12].lower()
    last, first = before[-1:], after[:1]
    return [
        *(float(kind == k) for k in MORE), n, digits / n, upper / n, lower / n, entropy, len(counts), len(groups),
        max(map(len, groups), default=0), turns / n, float(shape == "3-3-4"), float(shape == "3-2-4"),
        float(shape in ("4-2-2", "2-2-4", "4-2-2-2-2", "4-2-2-2-2-2")), sum(c in " ().-" for c in s), float("(" in s),
        float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s) is not None), float("/" in s), float("=" in s[-2:]),
        float(kind == "iban" and _iban_ok(s)), float(last.isalnum() or last in "_.@/-+"),
        float(first.isalnum() or first in "_@/"), float(last in "\"'`"), float(re.search(r"[=:]\s*[\"'`]?$", before) is not None),
        *(float(any(c in before for c in cues)) for cues in CUES.values()),
        float(any(c in after for c in ("%", "€", "$", " kg", " km", " items", " pages"))),
        (n - digits - upper - lower) / n, sum(map(bool, (digits, upper, lower, n - digits - upper - lower))),
        float(re.search(r"(?:pass\w*|pwd|pin|secret|token|key|credential)s?[\"'`]?\s*(?:is|[:=])\s*[\"'`]?$", before) is not None),
    ]


def _labelled(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """One generated text with the spans that are personal data."""
    words = lambda k: " ".join("".join(rng.choice("aeioudnrstlmh") for _ in range(rng.randint(2, 8))) for _ in range(k))
    dig = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(k))

    def iban() -> str:
        body, land = dig(rng.choice((14, 16, 18, 20))), rng.choice(("DE", "FR", "ES", "GB"))
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        s = f"{land}{check:02d}{body}"
        return s if rng.random() < .5 else " ".join(s[i:i + 4] for i in range(0, len(s), 4))

    def short() -> str:
        """A password that people choose: letters, digits and signs."""
        s = [*words(1)[:6], *dig(rng.randint(1, 4)), *rng.choice(("", "!", "&", "_", "$x", "-9", "#Q"))]
        s = [c.upper() if rng.random() < .3 else c for c in s] + [rng.choice("ABCDEFGH23456789")] * max(0, 6 - len(s))
        return "".join(s if rng.random() < .6 else rng.sample(s, len(s)))

    sep = rng.choice("-. ")
    cue_word = rng.choice(("password", "pwd", "passwd", "pass", "Password", "secret", "token", "pin", "key"))
    good = [
        ("local_phone", rng.choice(("phone ", "call ", "tel. ", "fax: ", "mobile ", "")), rng.choice((
            f"({dig(3)}) {dig(3)}-{dig(4)}", f"{dig(3)}{sep}{dig(3)}{sep}{dig(4)}", f"0{dig(3)} {dig(3)} {dig(4)}"))),
        ("ssn", rng.choice(("ssn ", "social security ", "SSN: ", "")), f"{dig(3)}-{dig(2)}-{dig(4)}"),
        ("iban", rng.choice(("iban ", "account ", "transfer to ", "")), iban()),
        ("secret", rng.choice(("api_key = \"", "token = \"", "secret: ", "password=", "Bearer ", "access key ")),
         rng.choice((hexa(rng.choice((32, 40, 64))), mixed(rng.randint(20, 48)), "sk-" + mixed(rng.randint(20, 40)),
                     "AKIA" + mixed(16).upper(), "ghp_" + mixed(36)))),
        ("secret", cue_word + rng.choice((": ", " = ", "=", " is ", ": \"", "='")), short()),
        ("handle", rng.choice(("contact ", "write to ", "mail ", "")),
         f"{words(1)} [at] {words(1)} [dot] {rng.choice(('com', 'org', 'net'))}"),
    ]
    bad = [
        ("", f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"), ("order ", dig(rng.randint(7, 12))),
        ("", f"{dig(2)}.{dig(2)}.{rng.randint(1900, 2030)}"), ("total ", f"{dig(4)}.{dig(4)}"), ("isbn ", f"978-{dig(1)}-{dig(4)}-{dig(4)}-{dig(1)}"),
        ("commit ", hexa(40)), ("", f"{rng.randint(1900, 2030)}-{dig(2)}-{dig(2)} {dig(2)}.{dig(2)}.{dig(2)}"), ("", words(2).replace(" ", "_") + "_section_" + dig(2)),
        ("version ", f"{dig(1)}.{dig(2)}.{dig(4)}"), ("page ", f"{dig(3)}-{dig(4)}"), ("", "/".join(words(4).split()) + "/" + dig(3)),
        ("serial ", mixed(18)), ("", "-".join(words(5).split()) + "-" + dig(1)), ("sha ", hexa(64)), ("", dig(rng.randint(7, 15))),
        ("", " ".join(dig(rng.randint(1, 4)) for _ in range(rng.randint(3, 6)))), ("item ", f"{dig(4)}-{dig(5)}"),
        (cue_word + rng.choice((": ", " is ", " = ")), words(1) + rng.choice("aeiou") * 5), (words(1) + ": ", short()),
        (cue_word + " is ", rng.choice(("required", "missing.", "(optional)", "not-set", "never-shown", "changed"))),
    ]
    text, spans = words(rng.randint(2, 8)) + " ", []
    for _ in range(rng.randint(1, 4)):
        if rng.random() < .55:
            kind, cue, s = rng.choice(good)
            spans.append((kind, len(text) + len(cue), len(text) + len(cue) + len(s)))
        else:
            cue, s = rng.choice(bad)
        text += cue + s + ('"' if cue.endswith('"') else "") + rng.choice((" ", ". ", ", ")) + words(rng.randint(2, 8)) + " "
    return text, spans


@dataclass
class Model:
    trees: boost.Trees
    threshold: dict[str, float]

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """For each text its base spans (score 1) and the selected further ones,
        by kind in the fixed order, then start."""
        base = [base_spans(t) for t in texts]
        found = [(i, *c) for i, t in enumerate(texts) for c in candidates(t)]
        scores = np.concatenate([self.trees.score(np.array([features(texts[i], *c) for i, *c in found[s:s + 4096]]))
                                 for s in range(0, len(found), 4096)] or [np.zeros(0)])
        picked: list[list] = [[] for _ in texts]
        for (i, kind, start, end), p in zip(found, scores.tolist(), strict=True):
            if p >= self.threshold[kind]:
                picked[i].append((kind, start, end, p))
        order = {k: j for j, k in enumerate(BASE + MORE)}
        out = []
        for b, more in zip(base, picked, strict=True):
            spans = [(*s, 1.0) for s in b]
            if more:
                # best first among overlapping; none inside a base span
                taken = _free(b, more)
                spans += sorted(taken, key=lambda s: (order[s[0]], s[1]))
            out.append(spans)
        return out


def _free(base: list[tuple[str, int, int]], more: list[tuple[str, int, int, float]]) -> list:
    """The spans of ``more`` that lie in no base span and touch no better span."""
    cover = merged([(s, e) for _, s, e in base])
    starts, ends, out = [], [], []           # of taken spans, disjoint and sorted
    for x in sorted(more, key=lambda x: (-x[3], x[1], -x[2], x[0])):
        i = bisect.bisect_right(cover, (x[1], 1 << 62)) - 1
        j = bisect.bisect_left(ends, x[1] + 1)
        if (i < 0 or cover[i][1] < x[2]) and not (j < len(starts) and starts[j] < x[2]):
            starts.insert(j, x[1]), ends.insert(j, x[2])
            out.append(x)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def train(texts: int = TRAIN_TEXTS, seed: int = SEED, precision: float = PRECISION) -> Model:
    """Fit the trees on two thirds of the generated texts, calibrate each
    kind's threshold on the last third."""
    rng = random.Random(seed)
    x, y, kinds, third = [], [], [], []
    for i in range(texts):
        text, spans = _labelled(rng)
        for c in candidates(text):
            x.append(features(text, *c))
            y.append(float(c in spans))
            kinds.append(c[0])
            third.append(i % 3 == 2)
    x, y, kinds, held = np.array(x), np.array(y), np.array(kinds), np.array(third)
    trees = boost.fit(x[~held], y[~held])
    p = trees.score(x[held])
    return Model(trees, {k: _threshold(p[kinds[held] == k], y[held][kinds[held] == k], precision) for k in MORE})


def _threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score from which on the selected spans are precise enough,
    at least one half; 2 (nothing) if there is none."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(p) + 1)
    good = np.nonzero(share >= precision)[0]
    return max(0.5, float(p[order][good[-1]])) if len(good) else 2.0


def redacted(t: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    if not spans:
        return t
    kind_at = {}
    for k, s, _, _ in spans:
        kind_at.setdefault(s, k)
    out, at = [], 0
    for s, e in merged([x[1:3] for x in spans]):
        out += [t[at:s], f"[{kind_at[s].upper()}]"]
        at = e
    return "".join([*out, t[at:]])


def find(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with ``spans``, an array of (kind, start,
    end, score, base), and ``redacted``, the text without them (null stays null)."""
    keep = tuple(c for c in keep if c not in ("spans", "redacted"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
                      ("base", pa.bool_())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = b.column(len(keep)).to_pylist()
                found = model.spans([t or "" for t in texts])
                arrays = pa.array([[dict(kind=k, start=s, end=e, score=p, base=k in BASE) for k, s, e, p in f]
                                   for f in found], pa.list_(span))
                clean = pa.array([None if t is None else redacted(t, f) for t, f in zip(texts, found, strict=True)],
                                 pa.string())
                yield pa.record_batch([*b.columns[:len(keep)], arrays, clean], names=[*keep, "spans", "redacted"])
    return rows.mapInArrow(each, schema + ", spans array<struct<kind:string,start:long,end:long,score:double,base:boolean>>, "
                                          "redacted string")
