"""Chat formatting with typed content parts, in DataFrame operations only.

A turn's content is a list of parts: text, image, audio or document (``PART_TYPE``). ``flatten_parts`` visits
them in order. Text is escaped and kept; every other part leaves a placeholder, a reference to its attachment
and the number of tokens the placeholder expands to. ``format_chats`` puts the turns of a conversation into the
template and marks what assistants said as the loss mask. ``read_back`` restores roles and texts from the
output alone.

Template of a turn: ``<|im_start|>`` role, newline, content, ``<|im_end|>``, newline. Inside texts and roles a
backslash goes between ``<`` and ``|`` (and one more where there are some), so no text can hold a control
string, and taking one away restores it. Newlines of a role are written as ``<\\n>`` in the same manner.

Defined cases: null text, role or part counts as empty; a null turn number comes first; rows with the same turn
number are ordered by role, then text; repeated rows are turns of their own; an empty table gives an empty
result; further columns do not matter, and those named like results give way. A conversation is one row and has to
fit in memory; conversations themselves are spread by their ids. Work grows in proportion to a conversation, however
many turns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Pixels of a side of an image patch; one patch is one token.
PATCH = 28
TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 1024
#: Code points of a formatted text that are read at a time.
CHUNK = 4096


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Escaped, and without newlines: ``<\\n>`` stands for one, and a text like that gets one more backslash."""
    marked = F.regexp_replace(escape(role), r"<(\\+)n>", r"<\\$1n>")
    return F.replace(marked, F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    lines = F.replace(role, F.lit("<\\n>"), F.lit("\n"))
    return unescape(F.regexp_replace(lines, r"<\\(\\+)n>", r"<$1n>"))


def _visit(part: Column) -> Column:
    """A part as (piece of content, attachment or null)."""
    kind = part["type"]
    expanded = (
        F.when(kind == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
        .when(kind == "audio", F.ceil(part["seconds"] * TOKENS_PER_SECOND))
        .when(kind == "document", part["pages"].cast("long") * TOKENS_PER_PAGE)
    )
    attachment = F.struct(kind.alias("type"), part["ref"].alias("ref"), F.coalesce(expanded, F.lit(0)).alias("tokens"))
    is_text = F.coalesce(kind == "text", F.lit(True))
    return F.struct(
        F.when(is_text, escape(part["text"])).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>"))).alias("content"),
        F.when(~is_text, attachment).alias("attachment"),
    )


def flatten_parts(turns: DataFrame, parts_column: str = "parts") -> DataFrame:
    """Replace the parts by ``content``, ``attachments`` (in order of their placeholders) and ``expanded_tokens``.

    A type other than image, audio, document or text has no placeholder of its own and raises an error.
    """
    known = F.coalesce(F.col(parts_column), F.array().cast(PART_TYPE))
    bad = F.exists(known, lambda p: ~F.coalesce(p["type"], F.lit("text")).isin("text", "image", "audio", "document"))
    known = F.when(bad, F.raise_error("unknown part type").cast(PART_TYPE)).otherwise(known)
    own = [F.col(f"`{c}`") for c in turns.columns if c not in (parts_column, "__seen", "attachments", "content", "expanded_tokens")]
    out = turns.select(*own, F.transform(known, _visit).alias("__seen"))
    out = out.withColumn("attachments", F.array_compact(F.transform("__seen", lambda v: v["attachment"])))
    return out.withColumns(
        {
            "content": F.array_join(F.transform("__seen", lambda v: v["content"]), ""),
            "expanded_tokens": F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]),
        }
    ).drop("__seen")


def text_parts(text: Column) -> Column:
    """A single text part."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")])
    return F.array(part).cast(PART_TYPE)


def format_chats(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role") -> DataFrame:
    """One row per conversation of flattened turns.

    ``formatted`` is the text, ``loss_spans`` the (start, length) in code points of each assistant's content,
    ``attachments`` and ``expanded_tokens`` those of all turns in order.
    """
    said = F.concat(F.lit(START), escape_role(F.coalesce(F.col(role_column), F.lit(""))), F.lit("\n"))
    rows = turns.select(
        F.col(conv_column).alias("conv"),
        F.struct(
            F.col(turn_column).alias("turn"), F.col(role_column).alias("role"), F.col("content").alias("content"),
            said.alias("head"), F.col("attachments").alias("attachments"), F.col("expanded_tokens").alias("expanded"),
        ).alias("t"),
    )
    tail = F.lit(END + "\n")
    before = Window.partitionBy("conv").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    long = F.length("t.head") + F.length("t.content") + len(END) + 1
    rows = rows.withColumn("before", F.coalesce(F.sum(long).over(before), F.lit(0)))
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("t", "before"))).alias("ts"))

    def span(x: Column) -> Column:
        start = x["before"] + F.length(x["t"]["head"])
        return F.struct(start.cast("int").alias("start"), F.length(x["t"]["content"]).alias("length"))

    said_by_assistant = F.filter("ts", lambda x: F.coalesce(x["t"]["role"] == "assistant", F.lit(False)))
    return chats.select(
        F.col("conv").alias(conv_column),
        F.array_join(F.transform("ts", lambda x: F.concat(x["t"]["head"], x["t"]["content"], tail)), "").alias("formatted"),
        F.transform(said_by_assistant, span).alias("loss_spans"),
        F.flatten(F.transform("ts", lambda x: x["t"]["attachments"])).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda n, x: n + x["t"]["expanded"]).alias("expanded_tokens"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_text``, read from ``formatted`` and ``loss_spans`` alone."""
    split = F.split("formatted", r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        rest = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(rest).alias("text"))

    def marked(span: Column) -> Column:
        """What a span holds, from the chunks that it touches: a text is not walked from its start for every span."""
        first = F.floor(span["start"] / CHUNK).cast("int")
        last = F.floor((span["start"] + span["length"]) / CHUNK).cast("int")
        near = F.array_join(F.slice("__chunks", first + 1, last - first + 1), "")
        return unescape(F.substr(near, span["start"] - first * CHUNK + 1, span["length"]))

    pieces = F.slice("__split", F.lit(2), F.size("__split"))
    chunks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))
    out = chats.withColumns({"__split": split, "__chunks": chunks})
    out = out.withColumn("loss_text", F.array_join(F.transform("loss_spans", marked), ""))
    return out.withColumn("turns", F.transform(pieces, turn)).drop("__split", "__chunks")


def round_trip(conversations: DataFrame) -> DataFrame:
    """The digests of formatted conversations, read back from the output."""
    turns = conversations.select("conv_id", "turn", "role", text_parts(F.coalesce(F.col("text"), F.lit(""))).alias("parts"))
    chats = read_back(format_chats(flatten_parts(turns)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
