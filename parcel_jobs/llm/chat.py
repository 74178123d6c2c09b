"""Chat formatting: typed content parts flattened to text with ordered placeholders. DataFrame functions only.

A turn is ``<turn>role<body>body</turn>`` and a newline. Texts and roles are escaped, backslash to ``\\b`` and ``<`` to
``\\l``, so a bare ``<`` in the output always belongs to the template or to a placeholder, and nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of parts that become placeholders, with the tokens that one expands to where the part doesn't say.
MEDIA = {"image": 256, "audio": 128, "document": 512}
PART = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"
ATTACHMENT = "array<array<struct<type:string,text:string,ref:string,tokens:bigint>>>"
TURN, BODY, END = "<turn>", "<body>", "</turn>\n"
#: A reference to an attachment within plain text: ![name](place). What the place ends with tells audio and documents from images.
REFERENCE = r"!\[[^\]\\<\n]*\]\([^)\\<\s]*\)"
AUDIO, DOCUMENT = r"\.(mp3|wav|ogg|flac)\)$", r"\.(pdf|doc|docx|txt)\)$"
PLACEHOLDER = "<(?:" + "|".join(MEDIA) + ")>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _part(kind: Column, text: Column, ref: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(kind.alias("type"), text.alias("text"), (none if ref is None else ref).alias("ref"), F.lit(None).cast("bigint").alias("tokens"))


def parts_of(text: Column) -> Column:
    """The typed parts of plain text: references to attachments, and the texts between them. A part's text is what stood there."""
    between, found = F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    kind = lambda s: F.when(s.rlike(AUDIO), "audio").when(s.rlike(DOCUMENT), "document").otherwise("image")
    media = F.transform(found, lambda s: _part(kind(s), s, F.regexp_extract(s, r"\((.*)\)$", 1)))
    texts = F.transform(between, lambda t: _part(F.lit("text"), t))
    return F.flatten(F.zip_with(texts, media, lambda t, m: F.when(m.isNull(), F.array(t)).otherwise(F.array(t, m))))


def _is_media(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*MEDIA), F.lit(False))


def _visit(part: Column) -> Column:
    """A part's rendering: a placeholder for an attachment, else its escaped text."""
    return F.when(_is_media(part), F.concat(F.lit("<"), part["type"], F.lit(">"))).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def _attachments(parts: Column) -> Column:
    """Type, text, reference and expanded tokens of each placeholder, in order."""
    tokens = lambda p: F.coalesce(p["tokens"], *[F.when(p["type"] == k, F.lit(n)) for k, n in MEDIA.items()]).cast("bigint")
    return F.transform(F.filter(parts, _is_media), lambda p: F.struct(p["type"].alias("type"), p["text"].alias("text"), p["ref"].alias("ref"), tokens(p).alias("tokens")))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conv_id of turns (conv_id, turn, role, parts): conv_id, formatted, spans, attachments, expanded_tokens.

    Turns are in order of turn (nulls first), then role, then the text of their parts, then rendering; repeated rows are
    turns of their own. spans are (turn, start, length), turns from 0 and code points, of the bodies under the loss mask,
    those of loss_role. attachments is an array for each turn: its k-th is what the turn's k-th placeholder stands for;
    expanded_tokens is the sum over all. Null parts and texts are empty, null roles too; a null conv_id is a
    conversation. A part of a kind not in MEDIA, null too, is its text. Other columns are ignored. An empty table gives no rows.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PART))
    role = F.coalesce(F.col("role"), F.lit(""))
    lines = turns.select(
        "conv_id", "turn", role.alias("role"), _attachments(parts).alias("attachments"), F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("said"),
        F.concat(F.lit(TURN), escape(role), F.lit(BODY)).alias("head"), F.array_join(F.transform(parts, _visit), "").alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said", "body")
    length = F.length("head") + F.length("body") + len(END)
    placed = lines.withColumns({"n": F.row_number().over(order) - 1, "start": F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")})
    span = F.struct(F.col("n").alias("turn"), F.col("start"), F.length("body").cast("long").alias("length"))
    rows = F.array_sort(F.collect_list(F.struct("n", F.concat("head", "body", F.lit(END)).alias("line"), span.alias("span"), (F.col("role") == loss_role).alias("loss"), "attachments")))
    return placed.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", F.array_join("rows.line", "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["loss"]), lambda r: r["span"]).alias("spans"),
        F.col("rows.attachments").alias("attachments"),
        F.aggregate(F.flatten("rows.attachments"), F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def _read_body(body: Column, attachments: Column) -> Column:
    """The parts of a body: text between placeholders, unescaped, and what the placeholders stand for."""
    texts = F.transform(F.split(body, PLACEHOLDER, -1), lambda t: _part(F.lit("text"), unescape(t)))
    both = F.flatten(F.zip_with(texts, attachments, lambda t, m: F.when(m.isNull(), F.array(t)).otherwise(F.array(t, m))))
    return F.filter(both, lambda p: (p["type"] != "text") | (p["text"] != ""))


def read_turns(formatted: Column, attachments: Column) -> Column:
    """The turns of a formatted text: an array of (role, parts).

    A placeholder is told from a text that looks like one, and comes back as its attachment. Neighbouring texts come back as one part, empty texts not at all.
    """
    lines = F.filter(F.split(formatted, END), lambda x: x != "")
    role = lambda x: unescape(F.substring_index(F.substr(x, F.lit(len(TURN) + 1)), BODY, 1))
    return F.zip_with(lines, attachments, lambda x, a: F.struct(role(x).alias("role"), _read_body(F.substring_index(x, BODY, -1), a).alias("parts")))


def said(parts: Column) -> Column:
    """The text of parts, that of attachments being what stood for them in plain text."""
    return F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")


def loss_text(formatted: Column, spans: Column, attachments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    body = lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    return F.array_join(F.transform(spans, lambda s: said(_read_body(body(s), F.get(attachments, s["turn"])))), "")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations (conv_id, turn, role, text), read back from their formatted texts.

    References to attachments in the texts become typed parts on the way; n_attachments and expanded_tokens count them.
    """
    turns = conversations.select("conv_id", "turn", "role", parts_of(F.coalesce("text", F.lit(""))).alias("parts"))
    out = format_conversations(turns).withColumns({"turns": read_turns(F.col("formatted"), F.col("attachments")), "loss": loss_text(F.col("formatted"), F.col("spans"), F.col("attachments"))})
    line = lambda t: F.concat(t["role"], F.lit("\n"), said(t["parts"]), F.lit("\n"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        F.size(F.flatten("attachments")).cast("long").alias("n_attachments"), "expanded_tokens",
    )
