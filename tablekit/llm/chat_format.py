"""Chat formatting: turns of a conversation become text segments with loss flags.

A template declares the marks around a turn, the roles whose texts are learned
and a finite-state machine over roles. The machine walks each conversation's
turns; the output holds the state it ends in and the first turn that it does not
allow. All conversations are formatted, valid or not; filter by ``valid``.

Inside roles and texts a backslash comes before each backslash and before a bar
that follows ``<``, so ``<|``, with which every mark begins, never stands in a
text. Dropping one backslash from each pair reverses that.

All work is DataFrame expressions. One output row is one conversation, so a
conversation has to fit in a row, as a training example has to anyway.

Defined results: turns are ordered by (turn, role, text), nulls first; null roles
and texts are empty; rows without a conversation id form one conversation with a
null id; repeated rows are turns of their own; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands between a state and a role in the machine's keys.
_UNIT = "\x1f"
#: What every mark begins with, and nothing else holds.
GUARD = "<|"


@dataclass(frozen=True)
class Template:
    """Marks of a turn (``begin role sep text end``), learned roles, and the machine:
    moves (state, role) -> state from ``start``, and the states it may end in."""

    begin: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "instructed", ("start", "user"): "asked", ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked"})
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        for mark in (self.begin, self.sep, self.end):
            if not mark.startswith(GUARD) or GUARD in mark[1:] or "\\" in mark:
                raise ValueError(f"a mark begins with {GUARD}, once, and has no backslash: {mark}")


CHATML = Template()


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\|(?<=<)\|", r"\\$0")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_conversations(rows: DataFrame, template: Template = CHATML, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, n_turns, state, bad_turn, valid, segments)``, one row per conversation.

    ``segments`` are ``(text, loss)`` in order; joined they are the formatted text.
    ``bad_turn`` counts from 0 and is null if every turn is allowed.
    """
    empty = F.lit("")
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), empty).alias("text"))
    talks = (rows.select(F.col(conv_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list("t")).alias("turns")))
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items()
                           for x in (state + _UNIT + role, to)])

    def step(walk: Column, t: Column) -> Column:
        to = F.try_element_at(moves, F.concat(walk["state"], F.lit(_UNIT), t["role"]))
        stuck = walk["bad"].isNotNull()
        return F.struct(F.when(stuck, walk["state"]).otherwise(F.coalesce(to, walk["state"])).alias("state"),
                        F.when(stuck, walk["bad"]).when(to.isNull(), walk["n"]).alias("bad"),
                        (walk["n"] + 1).alias("n"))
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(None).cast("int").alias("bad"), F.lit(0).alias("n"))

    def segments(t: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))
        no = F.lit(False)
        return F.array(segment(F.concat(F.lit(template.begin), escape(t["role"]), F.lit(template.sep)), no),
                       segment(escape(t["text"]), t["role"].isin(*template.learned)),
                       segment(F.lit(template.end), no))
    walked = talks.withColumn("walk", F.aggregate("turns", begin, step))
    return walked.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.col("walk.state").alias("state"),
        F.col("walk.bad").cast("long").alias("bad_turn"),
        (F.col("walk.bad").isNull() & F.col("walk.state").isin(*template.final)).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"))


def formatted_text(segments: str = "segments") -> Column:
    return F.array_join(F.col(segments)["text"], "")


def learned_text(segments: str = "segments") -> Column:
    """All text under the loss flags, as it was before formatting."""
    return unescape(F.array_join(F.filter(segments, lambda s: s["loss"])["text"], ""))


def parse_turns(text: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text, as an array of ``(role, text)``."""
    def turn(part: Column) -> Column:
        body = F.substring_index(part, template.end, 1)
        return F.struct(unescape(F.substring_index(body, template.sep, 1)).alias("role"),
                        unescape(F.substring_index(body, template.sep, -1)).alias("text"))
    parts = F.split(text, "\\Q" + template.begin + "\\E")
    return F.transform(F.slice(parts, 2, F.size(parts)), turn)
