"""Chat formatting by a declarative template and a finite-state machine over roles.

``format_chats`` turns the rows of a conversation into text segments, each with a loss
flag, and the formatted string they make; the machine counts turns out of order.
``read_chats`` reads turns back from the formatted string alone, ``loss_text`` the text
under the loss mask. All of it is DataFrame functions.

Control strings inside texts are escaped by one backslash after their first character
(after those already there), which is undone on reading; other text stays as it is.

Defined cases: a null text or role counts as empty, a role the template doesn't know
gets the generic turn, rows of a null conversation form one conversation, rows with equal
turn numbers are ordered by role and text, repeated rows are repeated turns; an empty
table gives no rows; other columns are ignored. A conversation is one output row, so its
turns have to meet in one row whatever their number: that is the result's own shape.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """What a conversation looks like: where turns begin and end, which texts are learnt
    from, and which role may follow which (``moves``: state -> roles; a state is the role
    last seen, or ``start``; ``final``: roles that may come last)."""

    begin: str = "<s>"
    roles: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS] ", " [/SYS]"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("[ANS] ", " </s>", loss=True),
    })
    other: Turn = Turn("[TURN] ", " [/TURN]")
    named: str = " [:] "  # between the name of an other role and its text
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        if any(h in c[1:] for c in self.controls for h in heads) or any("\\" in c for c in self.controls):
            raise ValueError("a control string must not hold a backslash or another one's first character")

    @property
    def turns(self) -> list[Turn]:
        return [*self.roles.values(), self.other]

    @property
    def controls(self) -> list[str]:
        every = [self.begin, self.named, *(x for t in self.turns for x in (t.open, t.close))]
        return sorted({x.strip() for x in every})

    @property
    def _control_pattern(self) -> tuple[str, str]:
        heads = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        tails = "|".join(re.escape(c[1:]) for c in self.controls)
        return f"([{heads}])", f"({tails})"

    def escape(self, text: Column) -> Column:
        head, tail = self._control_pattern
        return F.regexp_replace(text, F.lit(rf"{head}(\\*){tail}"), F.lit(r"$1$2\\$3"))

    def unescape(self, text: Column) -> Column:
        head, tail = self._control_pattern
        return F.regexp_replace(text, F.lit(rf"{head}(\\*)\\{tail}"), F.lit("$1$2$3"))


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _turn_segments(t: Template, role: Column, text: Column) -> Column:
    def parts(turn: Turn, *middle: Column) -> Column:
        return F.array(_segment(F.lit(turn.open), False), *middle, _segment(t.escape(text), turn.loss),
                       _segment(F.lit(turn.close), False))

    out = None
    for name, turn in t.roles.items():
        out = F.when(role == name, parts(turn)) if out is None else out.when(role == name, parts(turn))
    return out.otherwise(parts(t.other, _segment(F.concat(t.escape(role), F.lit(t.named)), False)))


def format_chats(rows: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id, segments (text, loss), formatted, bad_moves, valid."""
    t = template
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chats = rows.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    moves = F.create_map(*[F.lit(x) for a, after in t.moves.items() for b in after for x in (f"{a}>{b}", True)])

    def step(acc: Column, x: Column) -> Column:
        known = F.try_element_at(moves, F.concat(acc["state"], F.lit(">"), x["role"]))
        return F.struct(x["role"].alias("state"),
                        (acc["bad"] + F.when(known, F.lit(0)).otherwise(F.lit(1))).alias("bad"))

    run = F.aggregate("_turns", F.struct(F.lit("start").alias("state"), F.lit(0).alias("bad")), step)
    segments = F.concat(
        F.array(_segment(F.lit(t.begin), False)),
        F.flatten(F.transform("_turns", lambda x: _turn_segments(t, x["role"], x["text"]))))
    return (chats.select(F.col("_id").alias(id_col), segments.alias("segments"), run.alias("_run"))
            .select(id_col, "segments", F.array_join(F.col("segments.text"), "").alias("formatted"),
                    F.col("_run.bad").alias("bad_moves"),
                    ((F.col("_run.bad") == 0) & F.col("_run.state").isin(*t.final)).alias("valid")))


def read_chats(formatted: Column, template: Template = Template()) -> Column:
    """The turns, array of (role, text), that a formatted string holds."""
    t = template
    one = "|".join(f"{re.escape(x.open)}.*?{re.escape(x.close)}" for x in t.turns)

    def inner(m: Column, turn: Turn) -> Column:
        return F.substring(m, F.lit(len(turn.open) + 1), F.length(m) - F.lit(len(turn.open) + len(turn.close)))

    def turn_of(m: Column) -> Column:
        out = None
        for name, turn in t.roles.items():
            got = F.struct(F.lit(name).alias("role"), t.unescape(inner(m, turn)).alias("text"))
            out = F.when(m.startswith(turn.open), got) if out is None else out.when(m.startswith(turn.open), got)
        body = inner(m, t.other)
        at = F.instr(body, t.named)
        return out.otherwise(F.struct(
            t.unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
            t.unescape(F.substring(body, at + F.lit(len(t.named)), F.length(body))).alias("text")))

    return F.transform(F.regexp_extract_all(formatted, F.lit(f"(?s){one}"), F.lit(0)), turn_of)


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
