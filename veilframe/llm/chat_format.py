"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events. ``fold_events`` groups it by conversation and message,
sorts each message's events by sequence number and folds streamed deltas, edits and regenerations
into the final text; ``render`` puts the messages of a conversation in order, writes them with a
reversible template and marks which characters carry loss; ``read_back`` parses what was written.

Template, one record a turn::

    ### <role>: <text></turn>\\n

Escapes: ``\\`` becomes ``\\b``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l`` and in roles ``:`` becomes
``\\c``. An escaped text so holds none of ``#``, ``<`` and cannot contain a control string; every
backslash in it starts an escape, so replacing them in the order c, l, h, b undoes it exactly.

Everything is built-in DataFrame functions. The first shuffle is keyed by (conversation, message),
so that a conversation with very many events is spread over tasks; the second moves one row a
message. A conversation is one output row, so its final messages meet in one row.

Defined results: null text is the empty text; null role is the empty role; a null operation is a
delta; messages come in the order of their first event (then message id, null first); events of equal
sequence number come in the order (operation rank, text); a deleted message gives no turn; a
conversation without turns gives no row; a null conv_id is a conversation of its own; an empty table
gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

TURN_END = "</turn>\n"
#: Operations that begin a text anew, with their place among events of equal sequence number.
RESETS = {"message": 0, "start": 0, "regenerate": 1, "edit": 2}
DELTA_RANK, DELETE_RANK = 3, 4


def escape(text: Column, colon: bool = False) -> Column:
    for char, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l")) + ((":", "\\c"),) * colon:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for code, char in (("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """events(conv_id, seq, msg_id, role, op, text) -> messages(conv_id, first_seq, msg_id, role, text).

    op: ``message`` (a whole text), ``start`` (opens a message), ``delta`` (appends), ``edit``
    (replaces the text), ``regenerate`` (clears it, deltas follow), ``delete``. The last role that
    an event names holds."""
    op = F.coalesce(F.col("op"), F.lit("delta"))
    rank = F.lit(DELTA_RANK)
    for name, place in RESETS.items():
        rank = F.when(op == name, place).otherwise(rank)
    rank = F.when(op == "delete", DELETE_RANK).otherwise(rank)
    event = F.struct(F.col("seq"), rank.alias("rank"), text_of().alias("text"), F.col("role"))
    turning = F.filter("log", lambda e: e["rank"] != DELTA_RANK)  # events after which the text is known without those before
    folded = (
        events.select("conv_id", "msg_id", event.alias("e"))
        .groupBy("conv_id", "msg_id")
        .agg(F.sort_array(F.collect_list("e")).alias("log"))
        .withColumn("turning", turning)
        .select("conv_id", "msg_id", F.get("log", F.lit(0))["seq"].alias("first_seq"), F.get("turning", F.size("turning") - 1).alias("reset"), "log")
    )
    whole = F.col("reset").isNull()
    after = lambda e: whole | (F.struct(e["seq"], e["rank"]) > F.struct(F.col("reset")["seq"], F.col("reset")["rank"]))
    tail = F.array_join(F.transform(F.filter("log", lambda e: (e["rank"] == DELTA_RANK) & after(e)), lambda e: e["text"]), "")
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return folded.filter(whole | (F.col("reset")["rank"] != DELETE_RANK)).select(
        "conv_id",
        "first_seq",
        "msg_id",
        F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
        F.concat(F.coalesce(F.col("reset")["text"], F.lit("")), tail).alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """messages -> (conv_id, n_turns, formatted, loss_mask).

    loss_mask: array of (turn, offset in the formatted text, offset in the turn's record, length),
    all in code points, of the texts that ``loss_role`` said."""
    head = F.concat(F.lit("### "), escape(F.col("role"), colon=True), F.lit(": "))
    body = escape(F.col("text"))
    turns = Window.partitionBy("conv_id").orderBy("first_seq", "msg_id", "role", "text")
    before = turns.rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        messages.select(
            "conv_id", "first_seq", "msg_id", "role", "text", head.alias("head"), body.alias("body"),
        )
        .withColumn("piece", F.concat("head", "body", F.lit(TURN_END)))
        .withColumn("turn", (F.row_number().over(turns) - 1).cast("long"))
        .withColumn("offset", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")))
    )
    return (
        pieces.groupBy("conv_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "turn",
                        "offset",
                        F.length("head").cast("long").alias("at"),
                        F.length("body").cast("long").alias("length"),
                        (F.col("role") == loss_role).alias("loss"),
                        "piece",
                    )
                )
            ).alias("t")
        )
        .select(
            "conv_id",
            F.size("t").cast("long").alias("n_turns"),
            F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
            F.transform(
                F.filter("t", lambda t: t["loss"]),
                lambda t: F.struct(t["turn"].alias("turn"), (t["offset"] + t["at"]).alias("offset"), t["at"].alias("at"), t["length"].alias("length")),
            ).alias("loss_mask"),
        )
    )


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    return render(fold_events(events), loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text as they were before formatting) and ``loss_text`` (all text under
    the loss mask, unescaped, in order), from the formatted text and its mask alone."""
    records = formatted.withColumn("records", F.slice(F.split("formatted", TURN_END), 1, F.size(F.split("formatted", TURN_END)) - 1))
    role = lambda r: F.substring_index(F.substr(r, F.lit(5)), ": ", 1)
    return records.withColumn(
        "turns",
        F.transform(
            "records",
            lambda r: F.struct(
                unescape(role(r)).alias("role"),
                unescape(F.substr(r, F.length(role(r)) + 7)).alias("text"),
            ),
        ),
    ).withColumn(
        "loss_text",
        unescape(
            F.array_join(
                F.transform(
                    "loss_mask",
                    lambda m: F.substr(F.get("records", m["turn"].cast("int")), (m["at"] + 1).cast("int"), m["length"].cast("int")),
                ),
                "",
            )
        ),
    ).drop("records")


# ---- query

#: The conversation that op1 adds: both turns say it.
PLANTED_TEXT = "\\### Assistant: </turn> ok"
PLANTED_ID = -7


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Rows by turn as the log of a stream: each opens its message and sends the text in two deltas. Rows that repeat
    (conv_id, turn) are messages of their own, in the order (role, text)."""
    again = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", F.row_number().over(again).alias("again"), "role", text_of().alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda part, role, op, text: F.struct(F.lit(part).alias("part"), role.alias("role"), F.lit(op).alias("op"), text.alias("text"))
    none = F.lit(None).cast("string")
    log = F.array(
        event(0, F.col("role"), "start", F.lit("")), event(1, none, "delta", F.substr("text", F.lit(1), half)), event(2, none, "delta", F.substr("text", half + 1, F.length("text")))
    )
    rows = rows.select("conv_id", "turn", "again", F.explode(log).alias("e"))
    return rows.select(
        "conv_id", F.struct("turn", F.col("e")["part"]).alias("seq"), F.struct("turn", "again").alias("msg_id"), F.col("e")["role"].alias("role"), F.col("e")["op"].alias("op"), F.col("e")["text"].alias("text")
    )


def chat_digest(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    back = read_back(format_chats(conversation_events(rows.unionByName(planted))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(role) + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '#', ''), '<', ''), ':', ''))
    + 2 * length(text) - length(replace(replace(replace(text, '\\', ''), '#', ''), '<', '')) + 14) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
