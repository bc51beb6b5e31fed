"""Chat formatting: a state machine over roles and a declarative template.

A template names, per role, the text before and after a turn and whether its text counts
for the loss, and lists which role may follow which. Control strings inside texts are
escaped reversibly, so the output can be read back exactly. All steps are DataFrame
functions: one shuffle by conversation, then expressions on its array of turns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, INVALID = "start", "end", "invalid"


@dataclass(frozen=True)
class Template:
    """``{role}`` in ``before`` stands for the escaped role name.

    ``moves`` maps (state, role) to the next state; a role without a move makes the
    conversation invalid. ``final`` lists the states a complete conversation ends in.
    """

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    # Strings that mean something to the template or to common tokenizers.
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            (START, "system"): "system", (START, "user"): "user", ("system", "user"): "user",
            ("user", "assistant"): "assistant", ("assistant", "user"): "user",
            ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant",
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def control_tail(self) -> str:
        """Pattern of what follows the first character of a control string."""
        return "|".join(re.escape(c[1:]).replace("/", r"\/") for c in sorted(self.control, key=len, reverse=True))

    def control_head(self) -> str:
        return "[" + "".join(re.escape(c) for c in sorted({c[0] for c in self.control})) + "]"


CHATML = Template()


def escaped(text: Column, template: Template = CHATML) -> Column:
    r"""Backslashes doubled, and one put behind the first character of each control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({template.control_head()})(?={template.control_tail()})", "$1\\\\")


def unescaped(text: Column, template: Template = CHATML) -> Column:
    single = F.regexp_replace(text, rf"({template.control_head()})\\(?={template.control_tail()})", "$1")
    return F.replace(single, F.lit("\\\\"), F.lit("\\"))


def _escaped_role(role: Column, template: Template) -> Column:
    return F.replace(escaped(role, template), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column, template: Template) -> Column:
    # A backslash of the role is doubled, so "\n" after an even number of them is the escape.
    broken = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescaped(broken, template)


def turn_lists(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conversation, turns): its turns by number, ties by role and text.

    Null turn numbers come first, null roles and texts are empty strings. A conversation is
    one output text, so its turns are gathered; only those, not conversations of a key range.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy(F.col(conversation)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def state_after(turns: Column, template: Template = CHATML) -> Column:
    """The machine's state after all turns; once invalid it stays so."""
    moves = F.create_map(*[
        x for (state, role), to in template.moves.items() for x in (F.lit(f"{state}\n{role}"), F.lit(to))
    ])
    return F.aggregate(
        turns, F.lit(START),
        lambda state, t: F.when(state == INVALID, F.lit(INVALID)).otherwise(
            F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("\n"), t["role"])), F.lit(INVALID))
        ),
    )


def segments(turns: Column, template: Template = CHATML) -> Column:
    """Array of (text, loss): each turn's opening, escaped text and closing."""
    head, tail = template.before.split("{role}")

    def of_turn(t: Column) -> Column:
        opening = F.concat(F.lit(head), _escaped_role(t["role"], template), F.lit(tail))
        pieces = [
            (opening, F.lit(False)), (escaped(t["text"], template), t["role"].isin(*template.loss_roles)),
            (F.lit(template.after), F.lit(False)),
        ]
        return F.array(*[F.struct(p.alias("text"), loss.alias("loss")) for p, loss in pieces])

    return F.flatten(F.transform(turns, of_turn))


def formatted(turns: DataFrame, template: Template = CHATML, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation: ``segments`` (text, loss), ``valid`` and ``complete``.

    Every conversation is formatted, also one whose turn order the machine rejects; ``valid``
    says whether all its moves are allowed, ``complete`` whether it also ends as it should.
    Rows with a null conversation id form one conversation. Repeated rows are turns of their
    own. An empty table gives no rows; columns beside turn, role and text are ignored.
    """
    lists = turn_lists(turns, conversation).withColumn("_state", state_after(F.col("turns"), template))
    return lists.select(
        conversation, segments(F.col("turns"), template).alias("segments"),
        (F.col("_state") != INVALID).alias("valid"), F.col("_state").isin(*template.final).alias("complete"),
    )


def text_of(segments_column: str = "segments") -> Column:
    """The formatted text: all segments in order."""
    return F.array_join(F.transform(segments_column, lambda s: s["text"]), "")


def read_back(text: Column, template: Template = CHATML) -> Column:
    """Array of (role, text), parsed from the formatted text alone."""
    head, tail = template.before.split("{role}")
    literal = lambda s: r"\Q" + s + r"\E"
    blocks = F.split(text, literal(template.after))
    turn_blocks = F.slice(blocks, F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(0)))  # nothing behind the last mark

    def parsed(block: Column) -> Column:
        body = F.substr(block, F.lit(len(head) + 1))
        role = F.substring_index(body, tail, 1)
        return F.struct(
            _unescaped_role(role, template).alias("role"),
            unescaped(F.substr(body, F.char_length(role) + F.lit(len(tail) + 1)), template).alias("text"),
        )

    return F.transform(turn_blocks, parsed)


def digests(conversations: DataFrame, template: Template = CHATML, conversation: str = "conv_id") -> DataFrame:
    """Counts and digests of what the output says, read back from it."""
    joined = lambda a, f: F.array_join(F.transform(a, f), "")
    masked = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), ""
    )
    back = conversations.withColumn("_text", text_of()).withColumn("_turns", read_back(F.col("_text"), template))
    return back.withColumn("_masked", masked).select(
        conversation,
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(
            joined(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))).cast("binary"), 256
        ).alias("turns_sha256"),
        F.char_length("_masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("_masked").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("_text").cast("long").alias("formatted_chars"),
        "valid", "complete",
    )
