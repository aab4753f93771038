"""Chat formatting with typed content parts, in Spark functions.

A conversation becomes one string of marked turns. A turn's content is a list of parts; a
visitor flattens them in order: text is escaped, images, audio and documents become
placeholders `<|part:place:kind|>` that carry the part's place in its turn, and whose
references and expanded token counts are recorded beside the string. No kind can give a
mark of the template, as those have no colon. Control strings inside texts are escaped by a
backslash after their first character; backslashes that stand there already get one more,
so that unescaping is exact. Texts next to each other are escaped as one, as a control
string may begin in one part and end in the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
LOSS_ROLE = "assistant"

#: What control strings begin and go on with: this template's marks, and the bracket marks of others.
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"

#: A placeholder; escaped texts hold none, as their `<|` is broken up.
_PLACEHOLDER = r"<\|part:[0-9]+:[A-Za-z0-9_]*\|>"

PARTS = "array<struct<kind:string,text:string,ref:string,units:long>>"
#: Tokens that a part stands for in place of its placeholder, by kind: a fixed number and one for each `units` (patches, frames, pages).
EXPANSION = {"image": (2, 1), "audio": (2, 1), "document": (1, 512)}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """A message that is plain text, as its list of parts."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("units"))
    return F.array(part)


def expanded(part: Column) -> Column:
    """Tokens that an attachment takes up; unknown kinds count as their units alone."""
    units = F.coalesce(part["units"], F.lit(0))
    count = units
    for kind, (fixed, each) in EXPANSION.items():
        count = F.when(part["kind"] == kind, units * each + fixed).otherwise(count)
    return count


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def placeholder(part: Column) -> Column:
    return F.format_string("<|part:%d:%s|>", part["place"], F.regexp_replace(part["kind"], r"[^A-Za-z0-9_]", "_"))


def visit(parts: Column) -> Column:
    """What stands in the turn for its parts, in their order: a fold whose state is what is done and the text still open."""
    placed = F.transform(parts, lambda p, k: p.withField("place", k))
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))

    def step(state: Column, part: Column) -> Column:
        more = F.struct(state["done"].alias("done"), F.concat(state["open"], F.coalesce(part["text"], F.lit(""))).alias("open"))
        closed = F.struct(F.concat(state["done"], escape(state["open"]), placeholder(part)).alias("done"), F.lit("").alias("open"))
        return F.when(is_text(part), more).otherwise(closed)

    return F.aggregate(placed, start, step, lambda state: F.concat(state["done"], escape(state["open"])))


def attached(role: Column, turn: Column, text: Column) -> Column:
    """The parts of a message in a table without attachments: each user turn gets one, derived from its columns.

    Turns 0, 1 have an image before the text, turns 2, 3 a sound after it, turns 4, 5 a
    document between the first line and the rest, and so on again; `units` are the text's
    lines. Other roles and null turns have the text alone; a null text is empty.
    """
    text = F.coalesce(text, F.lit(""))
    first = F.regexp_extract(text, r"(?s)^[^\n]*\n?", 0)
    lines = (F.regexp_count(text, F.lit("\n")) + 1).cast("long")

    def part(kind: str, said: Column) -> Column:
        ref = F.lit(None).cast("string") if kind == "text" else F.concat(F.lit("turn/"), turn.cast("string"))
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"), ref.alias("ref"), (F.lit(0).cast("long") if kind == "text" else lines).alias("units"))

    none = F.lit(None).cast("string")
    which = F.when(role == "user", F.pmod(F.floor(turn / 2), F.lit(3)))
    return (
        F.when(which == 0, F.array(part("image", none), part("text", text)))
        .when(which == 1, F.array(part("text", text), part("audio", none)))
        .when(which == 2, F.array(part("text", first), part("document", none), part("text", F.substr(text, F.length(first) + 1))))
        .otherwise(F.array(part("text", text)))
    )


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", stretch_bits: int = 8) -> DataFrame:
    """conv_id, formatted, attachments, placeholder_tokens: a row for each conversation.

    `parts_col` is an array of (kind, text, ref, units); kind null is text. Turns are sorted
    by their number, null first, ties by role and content. A null role is the empty one, a
    null or empty list of parts an empty message; rows with a null conversation form one. An
    empty table gives no rows; other columns are neither read nor returned. attachments:
    array of (turn, place, kind, ref, tokens) in that order.

    Turns are formatted before any shuffle, and joined first by stretches of turn numbers
    and then by conversation, so that a conversation with very many turns is put together by
    several tasks and only its few stretches meet in one.
    """
    parts = F.coalesce(F.col(parts_col).cast(PARTS), F.array().cast(PARTS))
    role = F.coalesce(F.col(role_col), F.lit(""))
    placed = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), parts.alias("parts"))
    content = visit(F.col("parts"))
    found = F.filter(F.transform("parts", lambda p, k: F.struct(F.col("turn").alias("turn"), k.cast("long").alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded(p).cast("long").alias("tokens"), is_text(p).alias("plain"))), lambda a: ~a["plain"])
    shown = F.transform(found, lambda a: a.dropFields("plain"))
    turns = placed.select("conv_id", "turn", "role", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY), content, F.lit(END + "\n")).alias("piece"), shown.alias("found"))
    part = F.shiftright("turn", stretch_bits)
    first = turns.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "piece", "found"))).alias("rows"))
    joined = first.select("conv_id", "part", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("piece"), F.flatten(F.transform("rows", lambda r: r["found"])).alias("found"))
    whole = joined.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "found"))).alias("rows"))
    attachments = F.flatten(F.transform("rows", lambda r: r["found"]))
    done = whole.select("conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"), attachments.alias("attachments"))
    return done.withColumn("placeholder_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["tokens"]))


def read_back(formatted: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted, turns (array of role, text, n_attachments): the string taken apart again, texts unescaped.

    Neither marks nor placeholders can stand in an escaped text, so splitting at them is
    exact. The text of a turn is that of its text parts; placeholders are counted. The token
    count of `format_conversations` is handed on where it is there.
    """
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), F.lit(2), F.greatest(F.size(F.split("formatted", r"<\|turn\|>")) - 1, F.lit(0)))
    split = formatted.withColumn("_pieces", pieces)
    role = lambda p: unescape(F.substring_index(p, BODY, 1))
    body = lambda p: F.split(F.regexp_replace(F.regexp_replace(p, r"(?s)^.*?<\|body\|>", ""), r"<\|end\|>\n$", ""), _PLACEHOLDER)
    text = lambda p: F.array_join(F.transform(body(p), unescape), "")
    turn = lambda p: F.struct(role(p).alias("role"), text(p).alias("text"), F.regexp_count(p, F.lit(_PLACEHOLDER)).alias("n_attachments"))
    more = [name for name in ("placeholder_tokens",) if name in formatted.columns]
    return split.select("conv_id", "formatted", F.transform("_pieces", turn).alias("turns"), *more)


def digests(read: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Counts and digests of the turns read back; the loss mask covers the texts of `loss_role`, without placeholders."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"])
    seen = F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + t["n_attachments"])
    more = [name for name in ("placeholder_tokens",) if name in read.columns]
    cut = read.select("conv_id", "formatted", seen.alias("n_attachments"), *more, F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"), F.array_join(loss, "").alias("_loss"))
    return cut.select("conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "n_attachments", *more)
