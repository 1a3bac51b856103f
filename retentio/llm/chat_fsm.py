"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says how a turn begins and ends, which roles carry loss, and which
role may follow which.  A conversation becomes a list of segments (text, loss):
for each turn its opening, its escaped text and its closing; only the text of
a loss role carries loss.

The machine starts at ``start``; ``moves`` lists the allowed (state, role)
pairs, and a role is the next state.  A conversation is valid if every turn is
an allowed move and it stops in one of ``accepts``.  Invalid conversations are
formatted as well; ``valid`` and ``bad_turn`` (number of the first bad move
from 0, null if there is none) tell them apart.

Escaping is reversible: in texts and roles every ``<``, backslashes, ``|`` gets
one more backslash before the bar, so no control string can stand in a text;
in roles backslashes and line breaks are escaped first.

Rows of one turn number keep an order by (turn, role, text).  Only DataFrame
functions are used; a conversation is one row, as its text is one value, and
turns meet in one grouping shuffle.

Defined cases: null text and null role are empty; null turns come first; a null
conv_id is a conversation of its own; repeated rows are repeated turns; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "^"
    moves: tuple[tuple[str, str], ...] = (
        ("^", "system"), ("^", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))
    accepts: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    """Undoes ``escape_role``: between escaped backslashes only line breaks are left to undo."""
    parts = F.split(unescape(c), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): turns of each conversation in order, with empty for null."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>)."""
    allowed = F.array(*[F.lit(f"{a}\u0000{b}") for a, b in template.moves])
    accepts = F.array(*[F.lit(x) for x in template.accepts])
    loss = F.array(*[F.lit(x) for x in template.loss_roles])
    roles = F.transform("turns", lambda t: t["role"])
    states = F.concat(F.array(F.lit(template.start)), roles)
    moves = F.zip_with(F.slice(states, 1, F.size(roles)), roles, lambda a, b: F.concat(a, F.lit("\u0000"), b))
    bad = F.filter(F.transform(moves, lambda m, i: F.when(~F.array_contains(allowed, m), i)), lambda i: i.isNotNull())
    pieces = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(template.opening), escape_role(t["role"]), F.lit("\n")).alias("text"),
                 F.lit(False).alias("loss")),
        F.struct(escape(t["text"]).alias("text"), F.array_contains(loss, t["role"]).alias("loss")),
        F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")))))
    return (turns(rows)
            .select("conv_id", F.size("turns").alias("n_turns"),
                    (F.size(bad) == 0) & F.array_contains(accepts, F.element_at(states, -1)),
                    F.get(bad, F.lit(0)).alias("bad_turn"), pieces.alias("segments"))
            .toDF("conv_id", "n_turns", "valid", "bad_turn", "segments"))


def formatted_text(segments: Column) -> Column:
    return F.concat_ws("", F.transform(segments, lambda s: s["text"]))


def parse_text(formatted: Column, template: Template = CHATML) -> Column:
    """Turns array<struct<role, text>> read back from a formatted conversation."""
    literal = lambda s: r"\Q" + s + r"\E"
    parts = F.split(formatted, literal(template.closing))
    turn = lambda p: F.struct(
        unescape_role(F.substr(F.substring_index(p, "\n", 1), F.lit(len(template.opening) + 1))).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"))
    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))
