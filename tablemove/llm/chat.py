"""Chat formatting: a finite-state machine over roles, segments with loss flags, and the way back."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """How one role is written: the marks around its text and whether the text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """A declarative chat template.

    ``other`` writes a role that ``parts`` doesn't name: its own name goes between the two
    strings of ``open`` and its text before ``close``. ``steps`` maps a state and a role to
    the next state, ``final`` names the states in which a conversation may end.
    """

    parts: dict[str, Part]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    steps: dict[tuple[str, str], str]
    final: tuple[str, ...]
    start: str = "start"


DEFAULT = Template(
    parts={
        "system": Part("[SYS]", "[/SYS]"),
        "user": Part("[INST] ", " [/INST]"),
        "assistant": Part("<s>", "</s>", loss=True),
    },
    other=("[ROLE]", "[BODY]", "[/ROLE]"),
    controls=("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[BODY]", "[/ROLE]"),
    steps={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
    final=("assistant",),
)


def _controls_pattern(template: Template) -> tuple[str, str]:
    """First characters and remainders of the control strings, as regular expressions."""
    first = "[" + "".join(sorted({re.escape(c[0]) for c in template.controls})) + "]"
    rest = "|".join(re.escape(c[1:]) for c in template.controls)
    return first, rest


def escape(text: Column, template: Template = DEFAULT) -> Column:
    r"""Put a backslash after the first character of each control string, and one more where some stand.

    No control string holds a first character or a backslash in its remainder, so matches
    never overlap and ``unescape`` undoes exactly this.
    """
    first, rest = _controls_pattern(template)
    return F.regexp_replace(text, rf"({first})(\\*)({rest})", r"$1\\$2$3")


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    first, rest = _controls_pattern(template)
    return F.regexp_replace(text, rf"({first})\\(\\*)({rest})", "$1$2$3")


def _joined(array: Column) -> Column:
    return F.concat_ws("", array)


def _segment(text: Column | str, loss: Column | bool) -> Column:
    as_column = F.lit(text) if isinstance(text, str) else text
    return F.struct(as_column.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _segments_of(turn: Column, template: Template) -> Column:
    """The three segments of a turn: opening mark, escaped text, closing mark."""
    role, text = turn["role"], escape(turn["text"], template)
    opening, naming, closing = template.other
    named = F.concat(F.lit(opening), escape(role, template), F.lit(naming))
    result = F.array(_segment(named, False), _segment(text, False), _segment(closing, False))
    for name, part in template.parts.items():
        own = F.array(_segment(part.open, False), _segment(text, part.loss), _segment(part.close, False))
        result = F.when(role == name, own).otherwise(result)
    return result


def _end_state(turns: Column, template: Template) -> Column:
    steps = F.create_map(*[F.lit(x) for (s, r), to in template.steps.items() for x in (f"{s}\n{r}", to)])
    return F.aggregate(
        turns,
        F.lit(template.start),
        lambda state, turn: F.coalesce(F.element_at(steps, F.concat_ws("\n", state, turn["role"])), F.lit("error")),
    )


def format_chats(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_id, valid, segments (text, loss), formatted``.

    Turns are ordered by ``turn``, then role, then text, NULLs first; repeated rows are turns
    of their own. NULL texts and roles are empty. Rows without ``conv_id`` form one
    conversation. A conversation that the state machine refuses is still written, with
    ``valid`` false, so that nothing gets lost; extra columns are ignored. A conversation is
    one training example and hence one row, however long.
    """
    empty = F.lit("")
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce(F.col("role"), empty).alias("role"),
            F.coalesce(F.col("text"), empty).alias("text"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = grouped.select(
        "conv_id",
        _end_state(F.col("turns"), template).isin(*template.final).alias("valid"),
        F.flatten(F.transform("turns", lambda t: _segments_of(t, template))).alias("segments"),
    )
    return written.withColumn("formatted", _joined(F.transform("segments", lambda s: s["text"])))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns in a formatted text, as an array of ``role, text``: the inverse of formatting."""
    opening, naming, closing = template.other
    marks = [(p.open, p.close) for p in template.parts.values()] + [(opening, closing)]
    pattern = "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in marks)
    pieces = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0))

    def inner(piece: Column, a: str, b: str) -> Column:
        return F.substring(piece, F.lit(len(a) + 1), F.char_length(piece) - len(a) - len(b))

    def turn(piece: Column) -> Column:
        body = inner(piece, opening, closing)
        role = F.substring_index(body, naming, 1)
        text = F.substring(body, F.char_length(role) + len(naming) + 1, F.char_length(body))
        result = F.struct(unescape(role, template).alias("role"), unescape(text, template).alias("text"))
        for name, part in template.parts.items():
            own = F.struct(
                F.lit(name).alias("role"), unescape(inner(piece, part.open, part.close), template).alias("text")
            )
            result = F.when(piece.startswith(part.open), own).otherwise(result)
        return result

    return F.transform(pieces, turn)


def loss_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return _joined(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)))


def digest_chats(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation, lengths and digests of what reads back from its formatted text."""
    parsed = chats.select(
        "conv_id",
        "valid",
        "formatted",
        read_turns(F.col("formatted"), template).alias("turns"),
        loss_text(F.col("segments"), template).alias("trained"),
    )
    plain = _joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
