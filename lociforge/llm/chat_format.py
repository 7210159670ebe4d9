"""Chat formatting: a finite-state machine over roles and a declarative template, all in DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written.

    A turn is ``### <mark>: <text></turn>\\n``.  ``marks`` names the roles of the machine; any other role is written as
    ``@`` and its escaped name.  In texts (and names) a backslash, ``###``, ``</turn>`` and ``: `` are written as two
    characters each, so that no control string can come from a text and the writing can be undone exactly.
    ``moves`` lists, for each state (the last role), the roles that may follow; ``trained`` are the roles under the loss.
    """

    marks: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)
    trained: tuple[str, ...] = ("assistant",)
    open: str = "### "
    colon: str = ": "
    close: str = "</turn>"
    end: str = "\n"

    @property
    def escapes(self) -> tuple[tuple[str, str], ...]:
        return ((self.open.strip(), "\\#"), (self.close, "\\/"), (self.colon, "\\;"))


def escape(text: Column, template: Template) -> Column:
    """Backslashes double first; then each control string becomes a backslash and one letter."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, coded in template.escapes:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column, template: Template) -> Column:
    """Undoes ``escape``: the pieces between doubled backslashes hold whole codes only."""

    def plain(piece: Column) -> Column:
        for was, coded in reversed(template.escapes):
            piece = F.replace(piece, F.lit(coded), F.lit(was))
        return piece

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def _step(state: Column, role: Column, template: Template) -> Column:
    """The machine's next state: the role if it may follow, else the dead state ``!``."""
    out = F.lit("!")
    for at, roles in template.moves.items():
        out = F.when((state == at) & role.isin(*roles), role).otherwise(out)
    return out


def format_chats(turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted string, segments with loss flags, and whether the turn order is valid.

    Rows are put in order by turn (nulls first), equal turns by role, then text.  Null texts and roles are empty strings; a null
    conv_id is a conversation of its own.  Conversations that the machine refuses are formatted all the same, with ``valid``
    false.  ``segments`` are the formatted string's pieces in order, each ``(text, loss)``: only the texts of
    trained roles are under the loss.  A conversation is one string by definition, so one conversation's turns meet in
    one row; turns of different conversations never do.
    """
    read = turns.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    chats = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    chats = chats.withColumn("turns", F.sort_array("turns"))

    def mark(name: Column) -> Column:
        out = F.concat(F.lit("@"), escape(name, template))
        for known, shown in template.marks.items():
            out = F.when(name == known, shown).otherwise(out)
        return out

    def pieces(t: Column) -> Column:
        head = F.concat(F.lit(template.open), mark(t["role"]), F.lit(template.colon))
        tail = F.lit(template.close + template.end)
        flat = lambda s, loss: F.struct(s.alias("text"), loss.alias("loss"))
        return F.array(flat(head, F.lit(False)), flat(escape(t["text"], template), t["role"].isin(*template.trained)), flat(tail, F.lit(False)))

    state = F.aggregate("turns", F.lit(""), lambda s, t: _step(s, t["role"], template))
    return chats.select(
        "conv_id",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        state.isin(*template.final).alias("valid"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """Parses a formatted string into its turns: ``array<struct<role, text>>``, unescaped."""
    body = F.filter(F.split(formatted, rf"\Q{template.close}{template.end}\E", -1), lambda s: s != "")

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(template.open) + 1, 2**31 - 1)
        shown = F.substring_index(inner, template.colon, 1)
        name = unescape(F.substring(shown, 2, 2**31 - 1), template)
        for known, mark in template.marks.items():
            name = F.when(shown == mark, known).otherwise(name)
        text = unescape(F.right(inner, F.length(inner) - F.length(shown) - len(template.colon)), template)
        return F.struct(name.alias("role"), text.alias("text"))

    return F.transform(body, turn)


def chat_digest(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of what the formatted strings hold, read back from them, per conversation."""
    back = chats.withColumn("back", read_back(F.col("formatted"), template))
    under = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
