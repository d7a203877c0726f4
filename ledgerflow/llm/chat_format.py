"""Chat formatting from event logs, with DataFrame functions alone.

A log holds events of conversations: ``open`` starts a message of a role,
``delta`` appends a streamed piece, ``edit`` puts a new text in its place,
``regenerate`` clears it for the deltas that follow. The log is partitioned by
conversation, sorted by sequence and folded into final messages, which a
template renders with a loss mask over the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn's text by role. Other roles: [ROLE] role [AS] text [/ROLE].
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[AS]", "[/ROLE]")

# After "<" or "[" and any backslashes, what would complete a mark.
_AHEAD = r"(?:<(?=\\*(?:/?s>|</?SYS>>))|\[(?=\\*(?:/?INST|/?ROLE|AS)\]))"
_OPEN = r"(?=<s>|<<SYS>>|\[INST\]|\[ROLE\])"


def escape(text: Column) -> Column:
    """A text in which no mark occurs: one backslash more after the first character of each mark, escaped marks included."""
    return F.regexp_replace(text, f"({_AHEAD})", r"$1\\")


def unescape(text: Column) -> Column:
    """Undoes ``escape``: takes the backslash that it put in."""
    return F.regexp_replace(text, r"(?:(<)\\(?=\\*(?:/?s>|</?SYS>>))|(\[)\\(?=\\*(?:/?INST|/?ROLE|AS)\]))", "$1$2")


def messages(log: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """``conversation, at, role, text``: the final messages of a log ``conversation, message, seq, kind, role, text``.

    ``message`` names a message within its conversation, ``seq`` (any type
    that can be ordered) the place of an event. Events before a message's last
    edit or regeneration are superseded: they go in a window over the message,
    which spills, before a text is put together. ``at`` is the least sequence of the message.
    Null texts are empty. A message without ``open`` has a null role; of two
    opens the later role counts. Of events of one place, edits and regenerations come first, deltas by their texts. Events of other kinds do nothing.
    """
    reset = F.col("kind").isin("edit", "regenerate")
    own = Window.partitionBy(conversation, "message")
    live = (log.select(conversation, "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("at", F.min("seq").over(own)).withColumn("since", F.max(F.when(reset, F.col("seq"))).over(own))
            .where((F.col("kind") == "open") | F.col("since").isNull() | (F.col("seq") >= F.col("since"))))
    piece = F.when(F.col("kind").isin("edit", "delta"), F.struct("seq", (F.col("kind") == "delta").alias("later"), "text"))
    return (live.groupBy(conversation, "message")
            .agg(F.min("at").alias("at"), F.max(F.when(F.col("kind") == "open", F.struct("seq", "role"))).alias("open"), F.sort_array(F.collect_list(piece)).alias("pieces"))
            .select(conversation, "message", "at", F.col("open.role").alias("role"), F.array_join("pieces.text", "").alias("text")))


def render(final: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row a message: ``conversation, n, role, text, rendered, start, loss_start, loss_length``.

    ``n`` counts from 0 by ``at``, then role, text (nulls first, as empty). ``start`` is the
    place of the rendered turn in its conversation's formatted text, in code
    points; ``loss_start, loss_length`` are the span of the assistant's escaped text in it,
    null for other roles. Concatenated by ``n`` the rendered turns are the formatted conversation.
    """
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    plain = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (a, z) in MARKS.items():
        plain = F.when(role == name, F.concat(F.lit(a), text, F.lit(z))).otherwise(plain)
    order = Window.partitionBy(conversation).orderBy("at", "role", "text", "message")
    a, z = MARKS["assistant"]
    spoken = F.col("role") == "assistant"
    length = F.char_length("rendered").cast("long")
    return (final.withColumn("role", role).withColumn("rendered", plain)
            .withColumn("n", F.row_number().over(order) - 1).withColumn("start", F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)) - length)
            .select(conversation, "n", "role", F.coalesce("text", F.lit("")).alias("text"), "rendered", "start",
                    F.when(spoken, F.col("start") + len(a)).alias("loss_start"), F.when(spoken, length - len(a) - len(z)).alias("loss_length")))


def formatted(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row a conversation: ``conversation, formatted, spans``, spans the ``start, loss_start, loss_length`` of its turns in order."""
    row = F.struct("n", "rendered", "start", "loss_start", "loss_length")
    return (turns.groupBy(conversation).agg(F.sort_array(F.collect_list(row)).alias("r"))
            .select(conversation, F.array_join("r.rendered", "").alias("formatted"),
                    F.transform("r", lambda x: F.struct(x["start"].alias("start"), x["loss_start"].alias("loss_start"), x["loss_length"].alias("loss_length"))).alias("spans")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role, text`` as they were before."""
    return F.transform(F.split(formatted, _OPEN, -1), _turn)


def _turn(piece: Column) -> Column:
    body = lambda a, z: F.substring(piece, len(a) + 1, F.char_length(piece) - len(a) - len(z))
    split = F.split(body(OTHER[0], OTHER[2]), r"\[AS\]", 2)
    role, text = unescape(split[0]), unescape(split[1])
    for name, (a, z) in MARKS.items():
        own = F.startswith(piece, F.lit(a))
        role, text = F.when(own, F.lit(name)).otherwise(role), F.when(own, unescape(body(a, z))).otherwise(text)
    return F.struct(role.alias("role"), text.alias("text"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order: read from the formatted turns by the mask's spans."""
    return F.array_join(F.zip_with(F.split(formatted, _OPEN, -1), spans, lambda p, s: unescape(
        F.substring(p, (s["loss_start"] - s["start"] + 1).cast("int"), s["loss_length"].cast("int")))), "")


def log_of(rows: DataFrame) -> DataFrame:
    """An event log of ``conv_id, turn, role, text`` rows, each row a message.

    Every row is opened and streamed in three deltas. By the crc32 of
    ``conv_id:turn`` modulo 8 it was first streamed backwards and then
    regenerated (0), or streamed without its last third and then edited (1).
    Sequences are ``turn, step``; rows of one turn are messages of their own.
    """
    third = F.ceil(F.char_length("text") / 3).cast("int")
    parts = [F.substring("text", F.lit(1), third), F.substring("text", third + 1, third), F.substring("text", 2 * third + 1, F.greatest(F.char_length("text") - 2 * third, F.lit(0)))]
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.coalesce(F.col("turn").cast("string"), F.lit("")))) % 8
    event = lambda step, kind, text, role=F.lit(None): F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), role.cast("string").alias("role"), text.cast("string").alias("text"))
    none = F.lit(None)
    opened = event(0, "open", none, F.col("role"))
    plain = F.array(opened, *[event(4 + k, "delta", p) for k, p in enumerate(parts)])
    again = F.array(opened, event(1, "delta", F.reverse("text")), event(2, "regenerate", none), *[event(4 + k, "delta", p) for k, p in enumerate(parts)])
    edited = F.array(opened, event(1, "delta", parts[0]), event(2, "delta", parts[1]), event(3, "edit", F.col("text")))
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumn("message", F.monotonically_increasing_id())
            .withColumn("e", F.explode(F.when(kind == 0, again).when(kind == 1, edited).otherwise(plain)))
            .select("conv_id", "message", F.struct("turn", "e.step").alias("seq"), "e.kind", "e.role", "e.text"))


def chat_digest(log: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from the formatted conversations.

    One shuffle, by conversation: messages, places and the formatted text follow in it. A
    digest needs its conversation's text in one cell, at most 2 GB; ``render`` gives
    the same turns as rows, without that bound. An empty log gives an empty result.
    """
    whole = formatted(render(messages(log.repartition("conv_id"))))
    said = whole.select("conv_id", F.col("formatted"), read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return said.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def with_control_strings(rows: DataFrame) -> DataFrame:
    """The rows and conversation -1, whose two messages both look like marks."""
    told = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
                     for k, r in enumerate(["user", "assistant"])])
    return rows.select("conv_id", "turn", "role", "text").unionByName(rows.sparkSession.range(1).select(F.explode(told).alias("r")).select("r.*"))


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (SELECT *, length(text) + len(regexp_extract_all(text, '(<\\*(/?s>|</?SYS>>)|\[\\*(/?INST|/?ROLE|AS)\])'))
  + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 17 + length(role) + len(regexp_extract_all(role, '(<\\*(/?s>|</?SYS>>)|\[\\*(/?INST|/?ROLE|AS)\])')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
