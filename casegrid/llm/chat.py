"""Operator 7: chat formatting by event-sourced reconstruction, with DataFrame functions only.

A log has one row for each event: (conv_id, seq, msg, kind, role, text). ``kind`` is

* ``delta``: ``text`` goes on at the end of message ``msg``;
* ``edit``: ``text`` takes the place of all that the message had;
* ``regenerate``: the message starts anew, empty, with ``text`` as its first part;
* ``delete``: the message goes; later deltas begin it anew.

``reconstruct`` groups the log by conversation and message, sorts by seq and folds: what
counts is what came from the last edit, regenerate or delete on. Two groupings with
partial aggregates hold nothing but the events of one message, then the messages of one
conversation, which are one output row anyway.

``render`` joins the messages of a conversation. A turn is

    <turn role="ROLE">TEXT</turn>NEWLINE

and within ROLE and TEXT each of the five characters that the template gives a meaning is
written as a backslash and a letter (``ESCAPES``). So an unescaped ``<`` is always
markup, every backslash begins an escape, and ``parse`` gets back the very roles and texts.

The loss mask is the list of spans (start, length, in code points of the output) that hold
the texts of the trained role.

Edge cases: a null role, kind or text counts as empty (an empty kind is a delta); events of
equal seq are ordered by kind, role and text; null seq and null msg come first; a null
conv_id is a conversation of its own; repeated rows are events of their own; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Character -> letter after the backslash. The backslash comes first when escaping and last when unescaping.
ESCAPES = (("\\", "s"), ("<", "l"), (">", "g"), ('"', "q"), ("\r", "r"))

OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"

#: Kinds after which what a message had before doesn't count.
RESETS = ("edit", "regenerate", "delete")


def escape(text: F.Column) -> F.Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit("\\" + e[1])), ESCAPES, text)


def unescape(text: F.Column) -> F.Column:
    """Every backslash of an escaped text begins an escape, so the letters can be undone one after the other, the backslash last."""
    return reduce(lambda t, e: F.replace(t, F.lit("\\" + e[1]), F.lit(e[0])), ESCAPES[::-1], text)


def _text(name: str) -> F.Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, turns: array<struct(msg, role, text)> in the order of msg, from a log of events."""
    log = events.select("conv_id", "msg", F.struct("seq", _text("kind").alias("kind"), _text("role").alias("role"), _text("text").alias("text")).alias("event"))
    by_message = log.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list("event")).alias("events"))
    at = F.array_max(F.transform("events", lambda e, i: F.when(e["kind"].isin(*RESETS), i).otherwise(F.lit(0))))
    live = F.slice("events", at + 1, F.size("events"))
    final = by_message.select("conv_id", "msg", live.alias("events"))
    final = final.where((F.size("events") > 1) | (F.col("events")[0]["kind"] != "delete"))
    turn = F.struct(
        "msg",
        F.element_at("events", -1)["role"].alias("role"),
        F.array_join(F.transform("events", lambda e: F.when(e["kind"] == "delete", F.lit("")).otherwise(e["text"])), "").alias("text"),
    )
    return final.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def render(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans: array<struct(start, length)>, in code points of ``formatted``."""
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained_role).alias("trained")))
    d = conversations.select("conv_id", pieces.alias("pieces"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state, p):
        start = state["at"] + F.char_length(p["head"])
        length = F.char_length(p["body"]).cast("long")
        spans = F.when(p["trained"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), length.alias("length"))))).otherwise(state["spans"])
        return F.struct((start + length + len(CLOSE)).alias("at"), spans.alias("spans"))

    return d.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("pieces", zero, step)["spans"].alias("loss_spans"),
    )


def parse(formatted: F.Column) -> F.Column:
    """array<struct(role, text)> read back from the output alone."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    role = lambda p: F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(role(p)).alias("role"), unescape(F.substr(p, F.char_length(role(p)) + len(OPEN) + len(MIDDLE) + 1)).alias("text")))


def masked_text(formatted: F.Column, spans: F.Column) -> F.Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def as_events(rows: DataFrame) -> DataFrame:
    """A table of finished turns as a log: each row is a message of its own.

    Rows of one conversation and turn are separate messages, ordered by role and text.
    """
    order = F.struct(F.col("turn").alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    return turns.select("conv_id", F.posexplode("turns").alias("msg", "t")).select(
        "conv_id", F.col("msg").cast("long").alias("seq"), F.col("msg").cast("long").alias("msg"), F.lit("delta").alias("kind"), "t.role", "t.text")


def as_stream(rows: DataFrame, parts: int = 3) -> DataFrame:
    """A table of finished turns as the log of a conversation that was streamed and revised.

    Every message comes in ``parts`` deltas. By its place in the conversation it comes so at
    once, or a draft (its own last part) went before, which was regenerated, edited or deleted.
    """
    turn = as_events(rows)
    size = F.ceil(F.char_length("text") / F.lit(float(parts))).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.substr(F.col("text"), i * size + 1, size))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("delta", *RESETS)]), (F.col("msg") % 4 + 1).cast("int"))
    turn = turn.select("conv_id", "msg", "role", pieces.alias("pieces"), kind.alias("kind"))

    def event(kind, text) -> F.Column:
        return F.struct(kind.alias("kind"), text.alias("text"))

    delta, empty = F.lit("delta"), F.lit("")
    streamed = F.transform("pieces", lambda p: event(delta, p))
    anew = F.transform("pieces", lambda p, i: event(F.when(i == 0, F.col("kind")).otherwise(delta), p))
    draft = F.array(event(delta, F.element_at("pieces", -1)))
    log = (
        F.when(F.col("kind") == "delta", streamed)
        .when(F.col("kind") == "delete", F.concat(draft, F.array(event(F.col("kind"), empty)), streamed))
        .otherwise(F.concat(draft, anew))
    )
    events = turn.select("conv_id", "msg", "role", F.posexplode(log).alias("step", "event"))
    return events.select("conv_id", (F.col("msg") * (parts + 2) + F.col("step")).alias("seq"), "msg", "event.kind", "role", "event.text")


def digests(rows: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """For each conversation, what is read back from its formatted text. The rows become a log of
    deltas, edits, regenerations and deletions (``as_stream``), which is folded, rendered and parsed."""
    d = render(reconstruct(as_stream(rows)), trained_role)
    d = d.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: One more conversation, whose texts hold what templates use as markup.
SPOKEN_MARKUP = "\\### Assistant: </turn> ok"


def with_markup_conversation(rows: DataFrame) -> DataFrame:
    """The rows and conversation -7: a user and an assistant who both say SPOKEN_MARKUP."""
    turns = F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(SPOKEN_MARKUP).alias("text")) for i, r in enumerate(("user", "assistant"))])
    more = rows.sparkSession.range(1).select(F.explode(turns).alias("t")).select("t.*")
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"]
    return rows.select(*columns).unionByName(more)


#: The same rows by DuckDB; a turn's markup is 12 + 2 + 8 characters.
ORACLE = r"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(regexp_replace(role || text, '[^\\<>"\r]', '', 'g')) AS escapes FROM c)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(length(role) + length(text) + escapes + 22) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
