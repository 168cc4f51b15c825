"""Chat formatting: a finite-state machine over roles and a declarative template, all in SQL functions.

A conversation is the rows of one id in the order of their turn. The template puts a mark before each role, before each text
and after each turn; inside texts and roles, whatever could be read as a mark (of this template or of the other listed chat
formats) gets a backslash after its first character, which reading takes away again. Segments carry a loss flag, true for
the texts of the template's loss roles only. The state machine starts in `start`, moves by role, and tells whether the turns
are in a permitted order, and if not, where they first break it; conversations in another order are formatted all the same.

Defined results: a null text or role is empty; rows of one turn are ordered by role and text; repeated rows are repeated turns; a null
conversation id is a conversation of its own; turns without a number come first; only the four named columns are read, so others never
clash; an empty table gives no rows. A conversation is one output row, so its rows meet in one task; very long texts are kept whole there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>\n"
    #: Regular expressions: first characters of marks, and what may follow them after any number of backslashes.
    mark_first: str = r"[<\[]"
    mark_rest: str = r"\||/?s>|/?INST\]"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: (state, role) -> next state; any other role is an error, and an error stays.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)


def escape(c: Column, t: Template) -> Column:
    return F.regexp_replace(c, rf"({t.mark_first})(\\*)(?={t.mark_rest})", r"$1\\$2")


def unescape(c: Column, t: Template) -> Column:
    return F.regexp_replace(c, rf"({t.mark_first})\\(\\*)(?={t.mark_rest})", "$1$2")


def validate(roles: Column, t: Template) -> Column:
    """Struct of the state after all roles and the place (from 0) of the first role out of order, null if there is none."""
    step = F.create_map(*[F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}>{role}", to)])
    first = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("broken_at"))

    def move(acc: Column, role: Column) -> Column:
        to = F.coalesce(F.element_at(step, F.concat(acc["state"], F.lit(">"), role)), F.lit("error"))
        return F.struct(to.alias("state"), (acc["n"] + 1).alias("n"), F.coalesce(acc["broken_at"], F.when(to == "error", acc["n"])).alias("broken_at"))

    return F.aggregate(roles, first, move)


def format_chats(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id, n_turns, segments (array of text and loss), formatted (their texts), valid and broken_at."""
    t = template or Template()
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(F.col(conv_col).alias("_conv"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), escape(text, t).alias("body")).alias("_row"))
    whole = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    segment = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))

    def three(r: Column) -> Column:
        head = F.concat(F.lit(t.turn), escape(r["role"], t), F.lit(t.text))
        return F.array(segment(head, F.lit(False)), segment(r["body"], r["role"].isin(*t.loss_roles)), segment(F.lit(t.end), F.lit(False)))

    whole = whole.withColumn("segments", F.flatten(F.transform("_rows", three))).withColumn("_end", validate(F.transform("_rows", lambda r: r["role"]), t))
    valid = F.col("_end.broken_at").isNull() & F.col("_end.state").isin(*t.final)
    return whole.select(
        F.col("_conv").alias(conv_col),
        F.size("_rows").cast("long").alias("n_turns"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        valid.alias("valid"),
        F.col("_end.broken_at").alias("broken_at"),
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    t = template or Template()
    parts = F.split(formatted, "\\Q" + t.end + "\\E")
    parts = F.slice(parts, 1, F.size(parts) - 1)  # nothing follows the last end mark

    def turn(part: Column) -> Column:
        both = F.split(F.substring(part, F.lit(len(t.turn) + 1), F.length(part)), "\\Q" + t.text + "\\E", 2)
        return F.struct(unescape(both[0], t).alias("role"), unescape(both[1], t).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    t = template or Template()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t)), "")
