"""Chat formatting from a declarative template, in DataFrame functions only.

Turns of a conversation are put in order of ``turn`` (ties: role, then text; null turns first) and become
text segments, each with a flag that says whether it counts for the loss. A finite-state machine over the
roles checks the turn order; conversations that break it are formatted all the same and marked.

Null texts and roles are written as empty ones. Rows with a null conversation id form one conversation.
Repeated rows are repeated turns. Columns other than the four named are not read. An empty table gives an
empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written. ``transitions`` has, for each state, the roles that may follow; a role is the next state.

    ``foreign`` lists control strings of other formats that must not appear inside texts either. No control
    string may start with a character that occurs later in one of them, or hold the escape character.
    """

    begin: str = "<|im_start|>"
    header_end: str = "\n"
    end: str = "<|im_end|>\n"
    end_mark: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    final: tuple[str, ...] = ("assistant",)
    foreign: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
    escape: str = "␛"

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.end_mark, *self.foreign)

    def __post_init__(self) -> None:
        for c in self.controls:
            if self.escape in c or any(c[0] in other[1:] for other in self.controls):
                raise ValueError(f"control string {c!r} overlaps another or the escape character")


CHATML = Template()


def escaped(x: Column, t: Template, more: tuple[str, ...] = ()) -> Column:
    """Doubles the escape character as ``escape 0`` and puts ``escape 1`` behind the first character of a control string."""
    x = F.replace(x, F.lit(t.escape), F.lit(t.escape + "0"))
    for c in t.controls:
        x = F.replace(x, F.lit(c), F.lit(c[0] + t.escape + "1" + c[1:]))
    for i, c in enumerate(more):
        x = F.replace(x, F.lit(c), F.lit(t.escape + str(2 + i)))
    return x


def unescaped(x: Column, t: Template, more: tuple[str, ...] = ()) -> Column:
    for i, c in enumerate(more):
        x = F.replace(x, F.lit(t.escape + str(2 + i)), F.lit(c))
    x = F.replace(x, F.lit(t.escape + "1"), F.lit(""))
    return F.replace(x, F.lit(t.escape + "0"), F.lit(t.escape))


def format_chats(df: DataFrame, template: Template = CHATML, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text and loss flag, in order), ``formatted`` (all
    segments together) and ``valid`` (the roles obey the template's transitions and end in a final state).

    A conversation is one row of the result, so its turns meet in one task.
    """
    t = template
    rows = df.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("row"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    steps = F.create_map(*[F.lit(x) for state, roles in t.transitions.items() for r in roles for x in (state + "\n" + r, r)])
    # A state that no role leads on from stays the state of the rest.
    state = F.aggregate("turns", F.lit(""), lambda s, r: F.coalesce(F.try_element_at(steps, F.concat(s, F.lit("\n"), r["role"])), F.lit("\nbroken")))

    def segments(r: Column) -> Column:
        piece = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(t.begin), escaped(r["role"], t, (t.header_end,)), F.lit(t.header_end)), F.lit(False)),
            piece(escaped(r["text"], t), r["role"].isin(*t.loss_roles)),
            piece(F.lit(t.end), F.lit(False)),
        )

    return turns.select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), state.isin(*t.final).alias("valid")
    ).select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "valid")


def read_chats(df: DataFrame, template: Template = CHATML) -> DataFrame:
    """The turns (role and text) that the ``formatted`` texts of ``format_chats`` hold, and the loss texts of the
    ``segments``, unescaped: added columns ``turns`` and ``loss_texts``."""
    t = template
    parts = F.split("formatted", re.escape(t.end).replace("\\\n", "\n"))
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def read(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(t.begin) + 1))
        head = F.substring_index(inner, t.header_end, 1)
        return F.struct(
            unescaped(head, t, (t.header_end,)).alias("role"), unescaped(F.substr(inner, F.length(head) + len(t.header_end) + 1), t).alias("text")
        )

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], t))
    return df.withColumns({"turns": F.transform(parts, read), "loss_texts": loss})
