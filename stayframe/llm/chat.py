"""Chat formatting by event-sourced reconstruction, in native expressions only.

A log holds one row per event: ``conv_id, seq, msg, kind, role, text``. The
messages of a conversation are ordered by ``msg``; events apply in the order of
``seq``:

* ``start`` opens the message with its role (and optional first text),
* ``delta`` appends text,
* ``edit`` replaces the text so far,
* ``regenerate`` drops the text of the message and every later message of the
  conversation as they stood; only events after it count.

``fold`` states the fold as data flow instead of a loop: the last resetting
event of a message bounds the deltas that count, and a running maximum over
earlier messages tells which messages a regeneration has dropped. A message is
one group and a conversation is one group, because each of them is one string
of the result; messages are assembled under (conversation, message) first.

``render`` writes messages with a template whose control strings cannot occur
inside a text: they are escaped reversibly. The output carries the string and
its segments with the loss mask (true for texts of ``assistant``).

Defined results: null text and null role are empty; null ``seq`` sorts first;
events with equal ``seq`` apply in the order start, regenerate, edit, delta,
then by text; null ``conv_id`` is one conversation of its own; an empty log
gives an empty result; columns other than the log's are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayframe.llm.common import let

# ---- fixed values: the template -------------------------------------------
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
# control strings that may not stay in a text: <|...  <s> </s> <<SYS>> <</SYS>> [INST] [/INST]
CONTROL_ANGLE = "<(?=\\||/?s>|</?SYS>>)"
CONTROL_SQUARE = "\\[(?=/?INST\\])"
# ---------------------------------------------------------------------------

RESETS = ("start", "edit", "regenerate")
LOG = ("conv_id", "seq", "msg", "kind", "role", "text")


def escape(text: Column) -> Column:
    """Backslash doubled; the first character of a control string becomes \\l or \\b."""
    t = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(t, CONTROL_ANGLE, r"\\l"), CONTROL_SQUARE, r"\\b")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape`` and ``escape_role``: a backslash pair always starts
    at the left of a run, so splitting at pairs leaves single escapes only."""
    def single(p: Column) -> Column:
        for code, char in (("\\l", "<"), ("\\b", "["), ("\\n", "\n")):
            p = F.replace(p, F.lit(code), F.lit(char))
        return p
    return F.when(text.contains("\\"), F.array_join(F.transform(F.split(text, r"\\\\"), single), "\\")).otherwise(text)


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each row
    starts a message and streams its text line by line. Rows of one turn number
    follow each other by role and text; equal rows stay separate messages."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"),
                        F.row_number().over(order).cast("long").alias("msg"))
    lines = F.transform(F.split("text", "(?<=\n)"), lambda x: F.struct(
        F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), x.alias("text")))
    start = F.array(F.struct(F.lit("start").alias("kind"), F.col("role"), F.lit(None).cast("string").alias("text")))
    return rows.select("conv_id", "msg", F.posexplode(F.concat(start, lines)).alias("step", "event")).select(
        "conv_id", F.shiftleft(F.col("msg"), 31).__add__(F.col("step")).alias("seq"), "msg",
        "event.kind", "event.role", "event.text")


def fold(log: DataFrame) -> DataFrame:
    """Final messages of a log: conv_id, msg, role, text."""
    kind = F.col("kind")
    rank = F.when(kind == "start", 0).when(kind == "regenerate", 1).when(kind == "edit", 2).otherwise(3)
    at = F.struct(F.coalesce(F.col("seq"), F.lit(-(1 << 63)).cast("long")).alias("seq"), rank.alias("rank"))
    messages = log.select("conv_id", "msg", "kind", "role", "text", at.alias("at")).groupBy("conv_id", "msg").agg(
        F.max(F.when(kind.isin(*RESETS), F.col("at"))).alias("reset"),
        F.max(F.when(kind == "regenerate", F.col("at"))).alias("again"),
        F.max_by("role", F.when(kind == "start", F.col("at"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("text", F.lit("")).alias("text")))).alias("parts"))
    earlier = W.partitionBy("conv_id").orderBy("msg").rowsBetween(W.unboundedPreceding, -1)
    live = messages.withColumn("dropped", F.max("again").over(earlier)).where(
        F.col("reset").isNotNull() & (F.col("dropped").isNull() | (F.col("reset") > F.col("dropped"))))
    counted = F.filter("parts", lambda p: p["at"] >= F.col("reset"))
    return live.select("conv_id", "msg", F.coalesce("role", F.lit("")).alias("role"),
                       F.array_join(F.transform(counted, lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted (string) and segments, an
    array of (text, loss) whose texts joined are ``formatted``."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    parts = F.array(piece(F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")), F.lit(False)),
                    piece(escape(F.col("text")), F.col("role") == LOSS_ROLE),
                    piece(F.lit(CLOSE), F.lit(False)))
    per_conversation = messages.select("conv_id", F.struct("msg", parts.alias("parts")).alias("m")).groupBy("conv_id") \
        .agg(F.sort_array(F.collect_list("m")).alias("ms"))
    segments = F.flatten(F.transform("ms", lambda m: m["parts"]))
    return per_conversation.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted string."""
    def turn(p: Column) -> Column:
        nl = F.instr(p, F.lit("\n"))
        return F.struct(unescape(F.substring(p, F.lit(len(OPEN) + 1), nl - len(OPEN) - 1)).alias("role"),
                        unescape(F.substring(p, nl + 1, F.length(p))).alias("text"))
    pieces = F.split(formatted, "<\\|im_end\\|>\n")
    return let(pieces, lambda ps: F.transform(F.slice(ps, F.lit(1), F.size(ps) - 1), turn))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, joined in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
