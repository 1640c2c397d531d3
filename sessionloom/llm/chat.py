"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A conversation is a log of events with a sequence number: ``open`` starts a message (role,
text so far), ``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` empties it
(and gives it a role, if it names one) so that deltas fill it anew, ``delete`` removes it. The log is partitioned by conversation
and message, sorted by sequence and folded; the messages of a conversation are then sorted
by turn and rendered.

Template, for every turn, without anything in between:
  assistant: ``<s>`` role newline text ``</s>`` newline
  others:    ``<s>[INST] `` role newline text `` [/INST]</s>`` newline
A control string inside a role or text is escaped by one more backslash behind its first
character (``</s>`` as ``<\\/s>``, ``<\\/s>`` as ``<\\\\/s>``); line ends and backslashes inside a
role are escaped too. So a marker in the output is always a marker, and reading is exact.

The loss mask lists the spans (code points, end exclusive) of the assistants' texts as they
stand in the output.

A message's events meet in one task, spread over a conversation's messages, and then the
conversation's messages: a formatted conversation is one row, and its size is the only
bound. One conversation with very many events is folded by message in many tasks first.

Defined results: null texts are empty; a null role is the empty role; null kinds count as
``delta``; a null sequence number sorts first, ties sort by kind, role and text, and equal
events both count; deltas and edits without an ``open`` make a message with an empty role
unless an event names one; events after a ``delete`` begin the message again; a conversation whose messages are all deleted has no row; a null
conv_id is a conversation of its own. Finished messages (``as_log``) are one message for every
row: rows that share a turn stay apart, sorted by role and text, and equal rows all count. A
null turn comes after all others. An empty log gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sessionloom.llm.common import col

# The control strings, by first character and rest. No rest holds a first character.
CONTROLS = (("<", "s>"), ("<", "/s>"), ("[", "INST]"), ("[", "/INST]"), ("<", "|im_start|>"), ("<", "|im_end|>"))
ASSISTANT = "assistant"
OPEN, CLOSE, ASK, ASKED = "<s>", "</s>\n", "[INST] ", " [/INST]"
#: Code points of a delta when a finished message is turned into a log.
DELTA_CHARS = 512
#: Columns of ``as_log`` that tell the messages of one turn apart: a hash of role and text, and a number of equal ones.
MESSAGE = ("_message", "_copy")


def _each_control(text: Column, pattern: str, replacement: str) -> Column:
    """Rewrite every control string, whatever number of backslashes it has."""
    for first, rest in CONTROLS:
        quoted = "".join("\\" + c if not c.isalnum() and c not in "<> _" else c for c in rest)
        head = "\\[" if first == "[" else first
        text = F.regexp_replace(text, F.lit(pattern.format(head=head, rest=quoted)), F.lit(replacement.format(head=first, rest=rest)))
    return text


def escape(text: Column) -> Column:
    """Text in which no control string occurs; ``unescape`` gives the text back."""
    return _each_control(text, "{head}(\\\\*){rest}", "{head}$1\\\\{rest}")


def unescape(text: Column) -> Column:
    return _each_control(text, "{head}(\\\\*)\\\\{rest}", "{head}$1{rest}")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    mark = F.lit("\x00")  # stands for an escaped backslash while line ends are restored; \0 itself is doubled before
    plain = F.replace(unescape(role), F.lit("\x00"), F.lit("\x00\x01"))
    plain = F.replace(F.replace(plain, F.lit("\\\\"), F.concat(mark, F.lit("\x02"))), F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(plain, F.concat(mark, F.lit("\x02")), F.lit("\\")), F.lit("\x00\x01"), F.lit("\x00"))


def as_log(turns: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log of finished messages ``conv_id, turn, role, text``: an ``open`` and streamed deltas.

    Every row is a message of its own, whatever other rows have its turn.
    """
    rows = turns.select(
        col("conv_id").alias("conv_id"), col("turn").alias("turn"), col("role").cast("string").alias("role"),
        F.coalesce(col("text").cast("string"), F.lit("")).alias("text"))
    message, copy = MESSAGE
    # only rows that agree in all are numbered together; the fold needs no other shuffle than theirs
    equal = Window.partitionBy("conv_id", "turn", message).orderBy(message)
    rows = rows.withColumn(message, F.xxhash64("role", "text")).withColumn(copy, F.row_number().over(equal))
    pieces = F.ceil(F.char_length("text") / delta_chars).cast("int")
    numbers = F.when(pieces > 0, F.sequence(F.lit(0), pieces)).otherwise(F.array(F.lit(0)))
    events = rows.select("conv_id", "turn", *MESSAGE, "role", "text", F.explode(numbers).alias("seq"))
    piece = F.substring(F.col("text"), (F.col("seq") - 1) * delta_chars + 1, F.lit(delta_chars))
    return events.select(
        "conv_id", "turn", *MESSAGE, F.col("seq").cast("long").alias("seq"),
        F.when(F.col("seq") == 0, F.lit("open")).otherwise(F.lit("delta")).alias("kind"),
        F.when(F.col("seq") == 0, F.col("role")).alias("role"), F.when(F.col("seq") > 0, piece).alias("text"),
    )


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of every message that is left, from events in any order.

    The events of a conversation's turn are one message, unless the log is one of ``as_log``.
    """
    event = F.struct(
        col("seq").cast("long").alias("seq"), F.coalesce(F.col("kind"), F.lit("delta")).alias("kind"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = ["conv_id", "turn", *(MESSAGE if set(MESSAGE) <= set(log.columns) else ())]
    folded = log.groupBy(*key).agg(F.array_sort(F.collect_list(event)).alias("events"))
    # what stands before the last event that sets the text anew plays no part in it
    anew = lambda e: e["kind"].isin("open", "edit", "regenerate", "delete")
    numbered = F.transform("events", lambda e, i: F.when(anew(e), i).otherwise(F.lit(-1)))
    last = F.array_max(numbered)
    kept = F.slice("events", F.greatest(last + 1, F.lit(1)), F.size("events"))
    words = F.transform(
        F.filter("kept", lambda e: ~e["kind"].isin("regenerate", "delete")), lambda e: e["text"])
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return (
        folded.withColumns({"kept": kept, "roles": roles})
        .filter((F.size("kept") > 1) | (F.get("kept", F.lit(0))["kind"] != "delete"))
        .select("conv_id", "turn", F.coalesce(F.try_element_at("roles", F.lit(-1)), F.lit("")).alias("role"),
                F.array_join(words, "").alias("text"))
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask`` of messages ``conv_id, turn, role, text``."""
    asks = F.col("role") != ASSISTANT
    head = F.concat(F.lit(OPEN), F.when(asks, F.lit(ASK)).otherwise(F.lit("")), _escape_role(F.col("role")), F.lit("\n"))
    tail = F.concat(F.when(asks, F.lit(ASKED)).otherwise(F.lit("")), F.lit(CLOSE))
    parts = messages.select("conv_id", "turn", "role", asks.alias("asks"), head.alias("head"), escape(F.col("text")).alias("body"), tail.alias("tail"))
    piece = F.struct(
        F.col("turn").isNull().alias("last"), "turn", "role", "body", "asks", F.concat("head", "body", "tail").alias("out"),
        F.char_length("head").alias("before"), F.char_length("body").alias("chars"), F.char_length("tail").alias("after"))
    talks = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("turns"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, t):
        start = state["at"] + t["before"]
        end = start + t["chars"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["asks"], state["spans"]).otherwise(F.concat(state["spans"], span))
        return F.struct((end + t["after"]).alias("at"), spans.alias("spans"))

    return talks.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
        F.aggregate("turns", begin, step, lambda s: s["spans"]).alias("loss_mask"))


def format_log(log: DataFrame) -> DataFrame:
    """Fold a log of events and render its conversations."""
    return render(fold(log))


def parse(formatted: Column) -> Column:
    """The turns (array of role, text) that a formatted conversation was made from."""
    pieces = F.split(formatted, "</s>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        inner = F.substring(p, len(OPEN) + 1, 1 << 30)
        asks = inner.startswith(ASK)
        inner = F.when(asks, F.substring(inner, F.lit(len(ASK) + 1), F.char_length(inner) - (len(ASK) + len(ASKED)))).otherwise(inner)
        cut = F.instr(inner, "\n")
        role, text = F.substring(inner, F.lit(1), cut - 1), F.substring(inner, cut + 1, F.char_length(inner))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def under_mask(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
