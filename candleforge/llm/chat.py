"""Chat formatting: turns to one text by a declarative template, with a loss mask.

A template has what stands before and after a turn, and a finite-state machine over roles: a move
says which turn may follow and whether its text counts for the loss. The machine walks over the
turns and emits the conversation as segments, each with its loss flag; the text and the mask
follow from them. A turn without a move (and all after it) is formatted as well and counts by its
role. Control strings inside texts and role names are broken up by a backslash after their first character, and
backslashes are doubled, so the output can be taken apart again without loss.

All is DataFrame code: rows are formatted in generated code, placed by a running sum of lengths
within their conversation, and joined in order of turn (then role and text, so ties have one
order). Null texts and roles are empty. Every conversation is formatted; whether its turns follow
the machine is told in valid_order, and first_invalid is the number of the first turn that does not.
A null conv_id is one conversation. Extra columns do not matter; an empty table gives no rows.
The result has one text for each conversation, so a conversation must fit one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Move:
    """The state that a turn leads to, and whether its text counts for the loss."""

    to: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Each turn is ``open role close text stop``.

    ``controls`` are the strings that must not occur in a text as they are; the first characters
    of controls must not occur later in any of them. ``moves`` maps state to role to move; ``loss``
    are the roles that count for the loss where there is no move.
    """

    open: str = "<|"
    close: str = "|>\n"
    stop: str = "</s>\n"
    loss: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]",
    )
    start: str = "start"
    accepting: tuple[str, ...] = ("answered",)
    moves: dict[str, dict[str, Move]] = field(
        default_factory=lambda: {
            "start": {"system": Move("instructed"), "user": Move("asked")},
            "instructed": {"user": Move("asked")},
            "asked": {"assistant": Move("answered", loss=True)},
            "answered": {"user": Move("asked")},
        }
    )


TEMPLATE = Template()

_REJECTED = "rejected"


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for first in dict.fromkeys(c[0] for c in template.controls):
        rest = "|".join(re.escape(c[1:]) for c in template.controls if c[0] == first)
        # Looking ahead leaves overlapping controls to be found as well.
        text = F.regexp_replace(text, f"{re.escape(first)}(?={rest})", rf"{re.escape(first)}\\")
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _walk(roles: Column, template: Template) -> Column:
    """What the machine says of the turns: the last state, the first turn without a move, and
    ``flags``, a character for each turn, 1 if its text counts for the loss."""
    moves = {f"{s}\n{r}": m for s, by in template.moves.items() for r, m in by.items()}
    table = F.create_map(*[F.lit(x) for key, m in moves.items() for x in (key, m.to)])
    counts = F.create_map(*[F.lit(x) for key, m in moves.items() for x in (key, "1" if m.loss else "0")])

    def step(seen: Column, role: Column) -> Column:
        key = F.concat(seen["state"], F.lit("\n"), role)
        target = F.coalesce(table[key], F.lit(_REJECTED))
        stuck = (seen["state"] != _REJECTED) & (target == _REJECTED)
        flag = F.coalesce(counts[key], F.when(role.isin(*template.loss), "1").otherwise("0"))
        return F.struct(
            target.alias("state"),
            (seen["turn"] + 1).alias("turn"),
            F.when(stuck, seen["turn"]).otherwise(seen["bad"]).alias("bad"),
            F.concat(seen["flags"], flag).alias("flags"),
        )

    begin = F.struct(
        F.lit(template.start).alias("state"),
        F.lit(0).alias("turn"),
        F.lit(None).cast("int").alias("bad"),
        F.lit("").alias("flags"),
    )
    return F.aggregate(roles, begin, step)


def render(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, segments (text, loss), formatted, loss_spans, valid_order, first_invalid.

    ``formatted`` is the segments' text in a row; ``loss_spans`` are start and length, in code
    points, of the segments that count for the loss.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = turns.select(
        "*",
        F.concat(F.lit(template.open), escape(F.col("role"), template), F.lit(template.close)).alias(
            "head"
        ),
        escape(F.col("text"), template).alias("body"),
    ).withColumn("size", F.char_length("head") + F.char_length("body") + len(template.stop))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        "role",
        "head",
        "body",
        (
            F.sum(F.col("size").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
        ).alias("before"),
        F.char_length("head").alias("ahead"),
        F.char_length("body").cast("long").alias("length"),
    )
    start = F.coalesce("before", F.lit(0).cast("long")) + F.col("ahead")
    row = F.struct("n", "role", "head", "body", start.alias("start"), "length")
    joined = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    walked = joined.withColumn("walk", _walk(F.col("rows.role"), template))
    flagged = walked.withColumn(
        "rows",
        F.transform(
            "rows",
            lambda r: F.struct(
                r["head"].alias("head"), r["body"].alias("body"), r["start"].alias("start"),
                r["length"].alias("length"),
                (F.substring(F.col("walk.flags"), r["n"], F.lit(1)) == "1").alias("loss"),
            ),
        ),
    )
    stop, plain = F.lit(template.stop).alias("text"), F.lit(False).alias("loss")
    segments = F.flatten(
        F.transform(
            "rows",
            lambda r: F.array(
                F.struct(r["head"].alias("text"), plain),
                F.struct(r["body"].alias("text"), r["loss"].alias("loss")),
                F.struct(stop, plain),
            ),
        )
    )
    counted = F.filter("rows", lambda r: r["loss"])
    return flagged.select(
        "conv_id",
        segments.alias("segments"),
        F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["body"], F.lit(template.stop))), "").alias("formatted"),
        F.transform(counted, lambda r: F.struct(r["start"], r["length"])).alias("loss_spans"),
        F.col("walk.state").isin(*template.accepting).alias("valid_order"),
        F.col("walk.bad").alias("first_invalid"),
    )


def parse(rendered: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turns (role, text) and loss_texts, taken from the formatted text and its mask."""
    pieces = F.split("formatted", re.escape(template.stop))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    whole = f"(?s)^{re.escape(template.open)}(.*?){re.escape(template.close)}(.*)$"
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, whole, 1)).alias("role"),
            unescape(F.regexp_extract(p, whole, 2)).alias("text"),
        ),
    )
    formatted = F.col("formatted")
    under = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))),
    )
    return rendered.select("*", turns.alias("turns"), under.alias("loss_texts"))
