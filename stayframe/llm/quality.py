"""Quality rules: a threshold table compiled into one Spark projection.

Each rule is a ratio of two per-document measures with a lower and an upper
bound. ``measure`` builds all measures as one native expression over the whole
text and ``verdict`` compiles the table into one boolean, so a document is
judged inside the scan's own projection: no shuffle, no user function.

Defined results: a null or empty text has zero words and fails ``base``; a
ratio whose denominator is zero counts as zero; other columns of the input are
kept, and a clash of their names with a measure's is avoided because measures
travel in one struct column named by the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import let, words

# ---- fixed values ---------------------------------------------------------
SYMBOLS = "#*$%&|<>"
WINDOW = 5                 # words in a repetition window
MIN_WORDS = 10             # base rule: fewer words fail
MAX_REPEAT_PERCENT = 20    # base rule: a larger share of repeated words fails
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "on", "with", "as", "was", "be", "by",
           "are", "this", "at", "an", "or", "from", "he", "not", "but"],
    "de": ["der", "die", "und", "in", "das", "zu", "den", "ist", "mit", "von", "ein", "eine", "nicht", "sich", "auf",
           "für", "es", "im", "dem", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "dans", "qui", "par",
           "sur", "pas", "au", "avec", "il"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "las", "un", "por", "con", "no", "una", "su", "para",
           "es", "al", "lo", "como", "se"],
}
# ---------------------------------------------------------------------------
MEASURES = ("n_words", "word_chars", "n_stop_words", "n_repeat_words", "n_lines", "n_dup_lines", "n_shout_lines",
            "n_bar_lines", "n_symbols")


@dataclass(frozen=True)
class Rule:
    """``num / den`` must lie in [lo, hi] for documents of at least ``min_words`` words."""
    name: str
    num: str
    den: str
    lo: float = 0.0
    hi: float = float("inf")
    min_words: int = 0


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", lo=2.0, hi=15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", hi=0.5),
    Rule("stop_word_ratio", "n_stop_words", "n_words", lo=0.05, min_words=50),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", hi=0.7),
    Rule("shouting_line_ratio", "n_shout_lines", "n_lines", hi=0.5),
    Rule("table_line_ratio", "n_bar_lines", "n_lines", hi=0.5),
)


def _repeat_words(ws: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that occur at least twice in the document.

    Window hashes are sorted with their positions; equal neighbours mark
    repeated windows, and the union of [p, p + k) over the marked positions is
    counted from the gaps between them. Hashes only order the windows: should
    two neighbours with one hash differ in words, the document's windows are
    sorted by their words instead, so the count is exact."""
    starts = F.sequence(F.lit(0), F.size(ws) - k)

    def covered(ordered: Column) -> Column:
        marked = F.filter(
            F.transform(ordered, lambda x, j: F.when(
                (x["w"] == F.get(ordered, j - 1)["w"]) | (x["w"] == F.get(ordered, j + 1)["w"]), x["p"])),
            lambda p: p.isNotNull())
        return let(F.sort_array(marked), lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))),
            F.lit(0), lambda a, b: a + b))

    def by(window) -> Column:
        return F.sort_array(F.transform(starts, lambda i: F.struct(window(i).alias("w"), i.alias("p"))))

    def collides(ordered: Column) -> Column:
        return F.exists(F.transform(ordered, lambda x, j: (j > 0) & (x["w"] == F.get(ordered, j - 1)["w"]) & (
            F.slice(ws, x["p"] + 1, k) != F.slice(ws, F.get(ordered, j - 1)["p"] + 1, k))), lambda x: x)

    hashed = lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)])
    return F.when(F.size(ws) < k, 0).otherwise(
        F.when(let(F.transform(starts, hashed), lambda h: F.size(F.array_distinct(h)) == F.size(h)), 0).otherwise(
            let(by(hashed), lambda o: F.when(
                collides(o), let(by(lambda i: F.slice(ws, i + 1, k)), covered)).otherwise(covered(o)))))


def measure(text: Column) -> Column:
    """Struct of every measure the rules use, from one whole text (null: empty)."""
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    t = F.coalesce(text, F.lit(""))
    total = lambda arr: F.aggregate(arr, F.lit(0).cast("long"), lambda a, b: a + b)
    count = lambda arr, f: F.size(F.filter(arr, f)).cast("long")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    of_words = lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        total(F.transform(ws, lambda w: F.length(w).cast("long"))).alias("word_chars"),
        count(ws, lambda w: F.lower(w).isin(stop)).alias("n_stop_words"),
        _repeat_words(ws).cast("long").alias("n_repeat_words"))
    of_lines = lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        count(ls, lambda x: ~x.rlike("\\p{Ll}") & x.rlike("\\p{Lu}")).alias("n_shout_lines"),
        count(ls, lambda x: x.contains("|") & x.rlike("\\|[^|]*\\|[^|]*\\|")).alias("n_bar_lines"))
    symbols = F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long")
    return let(let(words(t), of_words), lambda a: let(let(lines, of_lines), lambda b: F.struct(
        *[a[c].alias(c) for c in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")],
        *[b[c].alias(c) for c in ("n_lines", "n_dup_lines", "n_shout_lines", "n_bar_lines")],
        symbols.alias("n_symbols"))))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def broken(m: Column, rules=RULES) -> Column:
    """Array of the names of the rules a measured document breaks."""
    def fails(r: Rule) -> Column:
        ratio = F.when(m[r.den] == 0, F.lit(0.0)).otherwise(m[r.num] / m[r.den])
        out = F.lit(False)
        if r.lo > 0:
            out = out | (ratio < r.lo)
        if r.hi != float("inf"):
            out = out | (ratio > r.hi)
        return out & (m["n_words"] >= r.min_words)
    return F.filter(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def verdict(text: Column, rules=RULES) -> Column:
    """Struct of all measures, ``base_failed``, ``broken`` (names of broken rules)
    and ``kept``. The measures are bound once inside the one expression, so it
    stays cheap wherever the optimizer moves it, a filter included."""
    def of(m: Column) -> Column:
        failed, names = base_failed(m), broken(m, rules)
        return F.struct(*[m[c].alias(c) for c in MEASURES], failed.alias("base_failed"), names.alias("broken"),
                        (~failed & (F.size(names) == 0)).alias("kept"))
    return let(measure(text), of)


def judge(docs: DataFrame, text: str = "text", out: str = "quality", rules=RULES) -> DataFrame:
    """``docs`` with a struct column ``out``, the verdict on each text; a column
    of that name is replaced."""
    return docs.withColumn(out, verdict(F.col(text), rules))


def passing(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` whose text breaks no rule."""
    return docs.where(verdict(F.col(text), rules)["kept"])
