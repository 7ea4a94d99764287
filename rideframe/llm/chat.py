"""Chat formatting: a finite-state machine over roles and segments with loss flags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "start", "end"


@dataclass(frozen=True)
class ChatTemplate:
    """What stands around a turn, which roles are trained on, and which role may follow which.

    ``turns`` maps a state, ``start`` or the role of the turn before, to the roles that may
    follow; ``end`` among them means that a conversation may end there.
    """

    begin: str = "<|im_start|>"
    finish: str = "<|im_end|>"
    trained: tuple[str, ...] = ("assistant",)
    turns: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", END),
        }
    )


CHATML = ChatTemplate()
NEW_LINE = "<|nl|>"


def escape(text: Column) -> Column:
    """One more backslash between ``<`` and ``|``: no control string, which all begin with ``<|``, is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEW_LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEW_LINE), F.lit("\n")))


def format_turns(turns: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Format each turn and check that its role may stand where it stands.

    Returns conv_id, position (from 1, in the order of turn, role, text), state (the role
    before, or ``start``), valid, segments (text and loss flag each) and formatted, which is
    the segments put together. A turn is valid if the template allows its role after the
    state, and if the conversation ends there, that it may end. Null roles and texts count as
    empty; conversations with a null id are one conversation; repeated turns all stay;
    further columns are ignored; an empty table gives no rows. Rows stay one per turn, so no
    conversation has to fit into memory.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    placed = rows.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("position"),
        F.lag("role", 1, START).over(order).alias("state"),
        F.lead(F.lit(False), 1, True).over(order).alias("last"),
        "role",
        "text",
    )
    allowed = F.lit(False)
    may_end = F.lit(False)
    for state, followers in template.turns.items():
        roles = [r for r in followers if r != END]
        # A role that is called like the first state must not pass for it.
        here = F.col("position") == 1 if state == START else (F.col("position") > 1) & (F.col("state") == state)
        if roles:
            allowed = allowed | (here & F.col("role").isin(*roles))
        if END in followers:
            may_end = may_end | (F.col("role") == state)
    segments = F.array(
        _segment(F.concat(F.lit(template.begin), escape_role(F.col("role")), F.lit("\n")), F.lit(False)),
        _segment(escape(F.col("text")), F.col("role").isin(*template.trained)),
        _segment(F.lit(template.finish + "\n"), F.lit(False)),
    )
    out = placed.withColumn("valid", allowed & (~F.col("last") | may_end)).withColumn("segments", segments)
    return out.select("conv_id", "position", "state", "valid", "segments", F.concat_ws("", F.col("segments.text")).alias("formatted"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(turns: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """The turns of each conversation put together: conv_id, valid, segments, formatted.

    A conversation becomes one row and must fit into one; ``format_turns`` has no such bound.
    """
    ordered = F.sort_array(F.collect_list(F.struct("position", "segments", "formatted")))
    whole = format_turns(turns, template).groupBy("conv_id").agg(ordered.alias("parts"), F.min("valid").alias("valid"))
    return whole.select("conv_id", "valid", F.flatten("parts.segments").alias("segments"), F.concat_ws("", "parts.formatted").alias("formatted"))


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The turns of a formatted conversation, as an array of role and text, unescaped."""
    pieces = F.split(formatted, F.lit(_quoted(template.finish + "\n")))
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    body = F.transform(turns, lambda t: F.substr(t, F.lit(len(template.begin) + 1)))
    return F.transform(
        body,
        lambda t: F.struct(
            unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            unescape(F.substr(t, F.instr(t, "\n") + 1)).alias("text"),
        ),
    )


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.concat_ws("", F.transform(kept, lambda s: unescape(s["text"])))


def _quoted(text: str) -> str:
    """A pattern that matches the text itself; ``\\Q`` would leave a control string to the reader."""
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|&#~" else c for c in text)
