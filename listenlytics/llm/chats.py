"""Chats with typed content parts in one template, with a loss mask, and back again.

A message is a list of parts: text, image, audio, document. A visitor flattens them in order:
text is escaped, any other part becomes a placeholder of its kind, and its reference and the
number of tokens that it expands to are recorded as an attachment; the n-th placeholder of a
chat stands for its n-th attachment.

A turn is ``<|turn|>role<|say|>content<|end|>``. Control strings, the template's own and those of
other common templates, are escaped inside roles and texts: one backslash is put behind
their first character, in front of those that stand there already, so taking one away gives
the text back, whatever it held. After that no text holds a control string.

All work is DataFrame functions. Messages are shuffled once, by chat. Chats of more than
``LONG_TURNS`` messages are put together from segments of ``SEGMENT_TURNS`` turns, so that no
task sorts and escapes all messages of a huge one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written

TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"
TEXT = "text"
ATTACHED = ("image", "audio", "document")
OTHER = "file"  # the placeholder of parts of any other kind
PART = (
    "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
)
ATTACHMENTS = "array<struct<kind: string, ref: string, tokens: bigint>>"
# The ends of control strings, behind their first character.
_TAILS = r"(\||/?s>|/?INST\]|/?SYS>|start_of_turn>|end_of_turn>)"
CONTROL = rf"([<\[])(\\*){_TAILS}"
ESCAPED = rf"([<\[])\\(\\*){_TAILS}"
PLACEHOLDER = rf"<\|({'|'.join([*ATTACHED, OTHER])})\|>"

LONG_TURNS = 1024
SEGMENT_TURNS = 64
BROADCAST_BYTES = 32 << 20


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


@dataclass(frozen=True)
class PartVisitor:
    """What each kind of part becomes, and how many tokens an attachment expands to.

    Images take one token for each patch of ``image_patch`` pixels a side, audio
    ``audio_rate`` tokens a second, documents ``page_tokens`` a page; what is not known counts
    as nothing.
    """

    image_patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 512

    def kind(self, part: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit(TEXT))
        return F.when(kind.isin(TEXT, *ATTACHED), kind).otherwise(OTHER)

    def content(self, part: Column) -> Column:
        kind = self.kind(part)
        placeholder = F.concat(F.lit("<|"), kind, F.lit("|>"))
        return F.when(kind == TEXT, escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)

    def tokens(self, part: Column) -> Column:
        def patches(side: str) -> Column:
            return F.ceil(F.greatest(part[side], F.lit(0)) / self.image_patch)

        counts = {
            "image": patches("width") * patches("height"),
            "audio": F.ceil(F.greatest(part["seconds"], F.lit(0.0)) * self.audio_rate),
            "document": F.greatest(part["pages"], F.lit(0)).cast("bigint") * self.page_tokens,
        }
        count = F.lit(0).cast("bigint")
        for kind, tokens in counts.items():
            count = F.when(self.kind(part) == kind, tokens.cast("bigint")).otherwise(count)
        return F.coalesce(count, F.lit(0).cast("bigint"))

    def flatten(self, parts: Column) -> tuple[Column, Column]:
        """The content of a message, and its attachments in the order of their placeholders."""
        present = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
        content = F.array_join(F.transform(present, self.content), "")
        attached = F.transform(
            F.filter(present, lambda p: self.kind(p) != TEXT),
            lambda p: F.struct(
                self.kind(p).alias("kind"), p["ref"].alias("ref"), self.tokens(p).alias("tokens")
            ),
        )
        return content, attached.cast(ATTACHMENTS)


def text_part(text: Column) -> Column:
    """The parts of a message that is only a text; a null text is an empty one."""
    names = ("ref", "width", "height", "seconds", "pages")
    part = F.struct(F.lit(TEXT).alias("type"), text.alias("text"), *[F.lit(None).alias(n) for n in names])
    return F.array(part.cast(PART))


def _put_together(rows: DataFrame, keys: Sequence[str], loss_roles: Sequence[str]) -> DataFrame:
    """(*keys, formatted, n_turns, loss_spans, attachments) from the messages of each group."""
    fields = ("turn", "role", "content", "attachments")
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
    head = len(TURN) + len(SAY)

    def line(r: Column) -> Column:
        return F.concat(F.lit(TURN), r["role"], F.lit(SAY), r["content"], F.lit(END))

    def add(done: Column, text: Column) -> Column:
        return F.struct(
            F.concat(done["starts"], F.array(done["total"])).alias("starts"),
            (done["total"] + F.char_length(text)).alias("total"),
        )

    def span(r: Column, i: Column) -> Column:
        start = F.get("starts", i)
        content = start + head + F.char_length(r["role"])
        return F.struct(
            i.cast("bigint").alias("turn"),
            start.alias("turn_start"),
            content.alias("start"),
            (content + F.char_length(r["content"])).alias("end"),
            F.array_contains(F.lit(list(loss_roles)), r["role"]).alias("loss"),
        )

    nothing = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("bigint").alias("total"))
    spans = F.filter(F.transform("rows", span), lambda s: s["loss"])
    attached = F.transform(
        "rows",
        lambda r, i: F.transform(
            r["attachments"], lambda a: F.struct(i.cast("bigint").alias("turn"), a["kind"], a["ref"], a["tokens"])
        ),
    )
    return (
        grouped.withColumn("lines", F.transform("rows", line))
        .withColumn("starts", F.aggregate("lines", nothing, add, lambda done: done["starts"]))
        .select(
            *keys,
            F.array_join("lines", "").alias("formatted"),
            F.size("rows").cast("bigint").alias("n_turns"),
            F.transform(spans, lambda s: s.dropFields("loss")).alias("loss_spans"),
            F.flatten(attached).alias("attachments"),
        )
    )


def _joined_segments(segments: DataFrame) -> DataFrame:
    """Whole chats from their segments, with places counted from the start of the chat."""
    before = Window.partitionBy("chat").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.coalesce(F.sum(F.char_length("formatted")).over(before), F.lit(0))
    turns = F.coalesce(F.sum("n_turns").over(before), F.lit(0))
    placed = segments.withColumns({"chars": chars, "turns": turns})

    def moved(s: Column) -> Column:
        return F.struct(
            (s["turn"] + F.col("turns")).alias("turn"),
            *[(s[name] + F.col("chars")).alias(name) for name in ("turn_start", "start", "end")],
        )

    moved_spans = F.transform("loss_spans", moved)
    moved_attachments = F.transform(
        "attachments",
        lambda a: F.struct((a["turn"] + F.col("turns")).alias("turn"), a["kind"], a["ref"], a["tokens"]),
    )
    row = F.struct(
        "turns", "formatted", "n_turns", moved_spans.alias("loss_spans"), moved_attachments.alias("attachments")
    )  # every segment has turns, so their numbers before it order the segments
    ordered = placed.groupBy("chat").agg(F.sort_array(F.collect_list(row)).alias("parts"))
    return ordered.select(
        "chat",
        F.array_join("parts.formatted", "").alias("formatted"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["n_turns"]).alias("n_turns"),
        F.flatten("parts.loss_spans").alias("loss_spans"),
        F.flatten("parts.attachments").alias("attachments"),
    )


def format_chats(
    messages: DataFrame,
    chat_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    visitor: PartVisitor | None = None,
    loss_roles: Sequence[str] = ("assistant",),
    long_turns: int = LONG_TURNS,
) -> DataFrame:
    """(``chat_col``, formatted, n_turns, loss_spans, attachments) of every chat.

    ``parts_col`` holds arrays of ``PART``. Messages stand by turn, a null turn first, messages
    of one turn by role and content; repeated rows are turns of their own. ``loss_spans`` are
    the contents of the turns of ``loss_roles``: turn, turn_start, start and end in code points
    of ``formatted``, ends exclusive. ``attachments`` give turn, kind, ref and tokens. Null
    parts and arrays are nothing, null texts and roles empty, parts of unknown kind a ``file``
    without tokens; messages with a null chat are one chat.
    """
    content, attached = (visitor or PartVisitor()).flatten(F.col(parts_col))
    role = escape(F.coalesce(F.col(role_col).cast("string"), F.lit("")))
    rows = messages.select(
        F.col(chat_col).alias("chat"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        content.alias("content"),
        attached.alias("attachments"),
    )
    counts = messages.groupBy(F.col(chat_col).alias("chat")).count().where(F.col("count") > long_turns)
    long = written(counts.select("chat"), new_work_folder(messages.sparkSession, "long"))
    n_bytes = long.agg(F.sum(F.octet_length(F.coalesce(F.col("chat").cast("string"), F.lit(""))) + 16)).first()[0]
    if n_bytes is None:
        chats = _put_together(rows, ["chat"], loss_roles)
    else:
        known = F.broadcast(long) if n_bytes <= BROADCAST_BYTES else long
        known = known.withColumnRenamed("chat", "long_chat")
        same = F.col("chat").eqNullSafe(F.col("long_chat"))
        segment = F.floor(F.col("turn") / SEGMENT_TURNS)
        short = _put_together(rows.join(known, same, "left_anti"), ["chat"], loss_roles)
        segments = rows.join(known, same, "left_semi").withColumn("segment", segment)
        segments = _put_together(segments, ["chat", "segment"], loss_roles)
        chats = short.unionByName(_joined_segments(segments))
    return chats.withColumnRenamed("chat", chat_col)


def read_chats(chats: DataFrame, keep: Sequence[str] = ("conv_id",)) -> DataFrame:
    """(*``keep``, turns, loss_text) read back from ``formatted`` and ``loss_spans``.

    A turn has its role, its kinds of attachments in order, and its segments: the texts before,
    between and behind its placeholders, one more than attachments. ``loss_text`` is all text
    under the mask, in order, without placeholders.
    """

    def segments(content: Column) -> Column:
        return F.transform(F.split(content, PLACEHOLDER, -1), unescape)

    def turn(line: Column) -> Column:
        fields = F.split(line, r"<\|say\|>|<\|end\|>", -1)
        return F.struct(
            unescape(fields[0]).alias("role"),
            segments(fields[1]).alias("segments"),
            F.regexp_extract_all(fields[1], F.lit(PLACEHOLDER), F.lit(1)).alias("kinds"),
        )

    def masked(lines: Column) -> Column:
        def one(s: Column) -> Column:
            text = F.substr(F.get(lines, s["turn"].cast("int")), s["start"] - s["turn_start"] + 1, s["end"] - s["start"])
            return F.array_join(segments(text), "")

        return F.array_join(F.transform("loss_spans", one), "")

    # the marker that opens a turn is put back, so that places count from it
    lines = F.transform(F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, 1 << 30), lambda t: F.concat(F.lit(TURN), t))
    both = F.transform(
        F.array(lines),  # bound once, for both uses
        lambda ls: F.struct(
            F.transform(ls, lambda t: turn(F.substr(t, F.lit(len(TURN) + 1)))).alias("turns"),
            masked(ls).alias("loss_text"),
        ),
    )[0]
    return chats.select(*keep, both.alias("both")).select(*keep, "both.turns", "both.loss_text")


def chat_digests(
    conversations: DataFrame, chat_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Digests of every chat of texts, read back from its formatted form."""
    messages = conversations.select(
        F.col(chat_col).alias("chat"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        text_part(F.col(text_col).cast("string")).alias("parts"),
    )
    size = F.char_length("formatted").cast("bigint")
    whole = format_chats(messages, "chat").withColumn("formatted_chars", size)
    line = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), F.array_join(t["segments"], ""), F.lit("\n"))
    )
    return read_chats(whole, ["chat", "n_turns", "formatted_chars"]).select(
        F.col("chat").alias(chat_col),
        "n_turns",
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


CHATS_SQL = r"""
WITH messages AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length('<|turn|><|say|><|end|>') + length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>|start_of_turn>|end_of_turn>)', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>|start_of_turn>|end_of_turn>)', '\1\\\2\3', 'g')) AS chars
  FROM messages)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
