"""Chat formatting with typed content parts, in DataFrame expressions only.

A message has a role and ordered content parts ``struct<kind, text, ref, units>``; kind is text,
image, audio or document. A visitor (one ``transform`` with a branch for each kind) flattens the
parts into the message's text: text parts are escaped, attachments become a placeholder, and
the attachment's reference and expanded token count are recorded beside the text.

The template is::

    <|turn|>role<|text|>content<|end|>

Escaping makes it reversible. In roles and texts every backslash is doubled, and a backslash is put
after the first character of every control string (the template's own and those of other common
chat templates), so none of them occurs inside a text. Unescaping removes the backslash that
begins each such pair.

Defined cases: a null text, part list or role is empty; turns with equal numbers are ordered by role
and content, null turns first; a conversation is one output row, as it is one training
example, so it must fit a task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that end a turn or open a role in common chat templates.
CONTROL = (
    "<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<start_of_turn>", "<end_of_turn>",
)
_CONTROL_PATTERN = "([<\\[])(?=" + "|".join(
    sorted({c[1:].replace("[", "\\[").replace("]", "\\]").replace("|", "\\|") for c in CONTROL})
) + ")"

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
#: Tokens that one unit of an attachment expands to, and what a unit is.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}  # a tile; a second; a page
_WORD = r"[^\x20\x09-\x0D]+"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL_PATTERN, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The content parts of a plain text message."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), null.cast("string").alias("ref"), null.cast("bigint").alias("units")))


def _visit(part: Column) -> Column:
    """Placeholder or escaped text of one part, with its tokens: words, or what it expands to."""
    kind, text, units = part["kind"], F.coalesce(part["text"], F.lit("")), F.coalesce(part["units"], F.lit(1))
    shown, tokens = escape(text), F.regexp_count(text, F.lit(_WORD)).cast("bigint")
    for name, each in TOKENS_PER_UNIT.items():
        shown = F.when(kind == name, F.lit(f"<|{name}|>")).otherwise(shown)
        tokens = F.when(kind == name, F.lit(each) * units).otherwise(tokens)
    return F.struct(shown.alias("shown"), tokens.alias("tokens"), kind.alias("kind"), part["ref"].alias("ref"))


def flatten_parts(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """Add content (string), tokens (bigint) and attachments (array of position, kind, ref,
    tokens, in the order of their placeholders). Kinds that are not known count as text."""
    empty = F.from_json(F.lit("[]"), f"array<{PART}>")
    known = F.coalesce(F.filter(F.col(parts), lambda p: p.isNotNull()), empty)
    seen = messages.withColumn("_seen", F.transform(known, _visit))
    kept = F.filter(F.col("_seen"), lambda p: p["kind"].isin(*TOKENS_PER_UNIT))
    return seen.select(
        *[c for c in messages.columns if c not in ("content", "tokens", "attachments")],
        F.array_join(F.transform("_seen", lambda p: p["shown"]), "").alias("content"),
        F.aggregate("_seen", F.lit(0).cast("bigint"), lambda n, p: n + p["tokens"]).alias("tokens"),
        F.transform(
            kept, lambda p, i: F.struct(i.alias("position"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))
        ).alias("attachments"),
    )


def format_conversations(messages: DataFrame, parts: str = "parts", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conv_id of (conv_id, turn, role, parts).

    formatted, n_turns, expanded_tokens, attachments (array of turn order, position, kind, ref,
    tokens) and loss_spans: (start, length) in code points of `formatted`, from 0, of the content
    of every message whose role is in `learn`.
    """
    role = F.coalesce("role", F.lit("")).alias("role")
    flat = flatten_parts(messages.select("conv_id", "turn", role, F.col(parts).alias("parts")))
    turn = F.struct(
        "turn", "role", "content", "tokens", "attachments",
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
    )
    whole = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    size = F.length(F.lit(END))
    nothing = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))

    def span(state: Column, t: Column) -> Column:
        start, length = state["at"] + F.length(t["head"]), F.length(t["content"])
        own = F.array(F.struct(start.alias("start"), length.alias("length")))
        spans = F.when(t["role"].isin(*learn), F.concat(state["spans"], own)).otherwise(state["spans"])
        return F.struct((start + length + size).alias("at"), spans.alias("spans"))

    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["content"], F.lit(END))), "").alias("formatted"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"]).alias("expanded_tokens"),
        F.flatten(
            F.transform(
                "turns",
                lambda t, i: F.transform(
                    t["attachments"],
                    lambda a: F.struct(i.alias("turn"), a["position"].alias("position"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
                ),
            )
        ).alias("attachments"),
        F.aggregate("turns", nothing, span, lambda s: s["spans"]).alias("loss_spans"),
    )


def parse_formatted(formatted: Column) -> Column:
    """Back to array<struct<role, content>>; content has its text parts unescaped and shows
    attachments as placeholders."""
    pieces = F.split(formatted, TURN.replace("|", "\\|"))
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))
    closed = F.transform(pieces, lambda p: F.substring_index(p, END, 1))
    return F.transform(
        closed,
        lambda p: F.struct(
            unescape(F.substring_index(p, TEXT, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, TEXT) + F.lit(len(TEXT)))).alias("content"),
        ),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")
