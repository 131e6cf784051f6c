"""Chat formatting: conversations to marked-up text with a loss flag per segment.

Everything is DataFrame functions. A declarative template gives the marks, the roles that
are learned from, and a finite-state machine over roles. Texts cannot forge a mark:
the characters all marks begin with are escaped, and the escape is reversible.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"
ERROR = "error"


@dataclass(frozen=True)
class ChatTemplate:
    """``{turn_start}{role}{role_end}{text}{turn_end}`` per turn."""

    turn_start: str = "<|im_start|>"
    role_end: str = "\n"
    turn_end: str = "<|im_end|>\n"
    mark: str = "<|"  # what every mark but ``role_end`` begins with
    loss_roles: tuple[str, ...] = ("assistant",)
    # State before a turn, then role of the turn: state after it.
    transitions: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            START: {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    accepting: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if not (self.turn_start.startswith(self.mark) and self.turn_end.startswith(self.mark)):
            raise ValueError("turn_start and turn_end must begin with mark")
        if len(self.mark) < 2 or "\\" in self.mark + self.role_end or not self.role_end:
            raise ValueError("mark needs two characters, role_end one, and neither a backslash")


CHATML = ChatTemplate()


def _escapes(template: ChatTemplate) -> list[tuple[str, str]]:
    """Replacements in order; every backslash they make is followed by b, p or n."""
    split_mark = template.mark[0] + "\\p" + template.mark[1:]
    return [("\\", "\\b"), (template.mark, split_mark)]


def escaped(text: Column, template: ChatTemplate = CHATML) -> Column:
    for plain, coded in _escapes(template):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column, template: ChatTemplate = CHATML) -> Column:
    for plain, coded in reversed(_escapes(template)):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _escaped_role(role: Column, template: ChatTemplate) -> Column:
    return F.replace(escaped(role, template), F.lit(template.role_end), F.lit("\\n"))


def _unescaped_role(role: Column, template: ChatTemplate) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit(template.role_end)), template)


def final_state(roles: Column, template: ChatTemplate = CHATML) -> Column:
    """The state after all roles; once a turn has no transition, ``error``."""
    moves = [
        F.lit(x)
        for state, by_role in template.transitions.items()
        for role, after in by_role.items()
        for x in (f"{state}>{role}", after)
    ]
    table = F.create_map(*moves)
    return F.aggregate(
        roles,
        F.lit(START),
        lambda state, role: F.coalesce(
            F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit(ERROR)
        ),
    )


def format_chats(
    conversations: DataFrame,
    template: ChatTemplate = CHATML,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Every conversation as segments and as one text.

    Returns (conv_id, segments array of (text, loss), formatted, end_state, valid): the
    segments joined are ``formatted``; ``valid`` says that the roles' order is accepted by the
    state machine; conversations out of order are formatted all the same. Null roles
    and texts are empty. Turns go by number, null first; equal numbers by role and
    text. Repeated rows are repeated turns, rows with a null id are one conversation.
    Other columns play no part; an empty table gives an empty result. A conversation is one
    row of the result, so its turns meet in one task.
    """
    turn = F.struct(
        F.col(turn_column).alias("turn"),
        F.coalesce(role_column, F.lit("")).alias("role"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    turns = conversations.groupBy(F.col(id_column).alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.turn_start), _escaped_role(t["role"], template),
                        F.lit(template.role_end))
        return F.array(
            segment(head, F.lit(False)),
            segment(escaped(t["text"], template), t["role"].isin(*template.loss_roles)),
            segment(F.lit(template.turn_end), F.lit(False)),
        )

    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    return (
        turns.withColumn("segments", F.flatten(F.transform("turns", segments)))
        .withColumn("end_state", state)
        .select(
            "conv_id",
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            "end_state",
            F.col("end_state").isin(*template.accepting).alias("valid"),
        )
    )


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The (role, text) turns a formatted text holds."""
    quoted = "\\Q" + template.turn_start + "\\E"
    parts = F.filter(F.split(formatted, quoted), lambda p: p != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.role_end, 1)
        body = F.substr(part, F.length(role) + F.lit(len(template.role_end) + 1))
        text = F.substr(body, F.lit(1), F.length(body) - F.lit(len(template.turn_end)))
        return F.struct(
            _unescaped_role(role, template).alias("role"), unescaped(text, template).alias("text")
        )

    return F.transform(parts, turn)


def loss_text(segments: Column, template: ChatTemplate = CHATML) -> Column:
    """All text under the loss flags, unescaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"], template)), "")


def chat_digests(chats: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Counts and digests read back from the output of :func:`format_chats`."""
    read = chats.select(
        "conv_id", "valid", "formatted",
        read_turns(F.col("formatted"), template).alias("read"),
        loss_text(F.col("segments"), template).alias("learned"),
    )
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
