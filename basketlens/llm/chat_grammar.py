"""Chat formatting that is proved by parsing it back.

A conversation is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.
A parser with a fixed grammar reads the rendered text; where a turn does not
come back as it went in, its text is escaped and tried again, until it does.

The grammar: a turn starts at ``<|im_start|>``, its role reaches to the first
line break, its text to ``<|im_end|>`` and a line break. In a text, ``<|`` +
n + 1 backslashes + ``im_`` stands for ``<|`` + n backslashes + ``im_``.
Escaping adds one backslash to each such place, so escaped content never holds
a control string and unescaping gives it back: one escape is always enough. A
role is escaped with two backslashes, and its line breaks as ``<|\\im_n|>``.

Defined cases: a null text is empty; a null role is empty; a null turn sorts
first, equal turns by role and text; a null conversation id is a conversation
of its own; an empty table gives no rows; other columns are not read. A
conversation is one output row, because its digest covers all of it; only
rendering and escaping are done per turn, before rows are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
_START_PATTERN, _PLACE, _ESCAPED = r"<\|im_start\|>", r"<\|(\\*)im_", r"<\|\\(\\*)im_"
#: Roles whose text is under the loss mask.
TRAINED = ("assistant",)


def _escape(content: Column) -> Column:
    return F.regexp_replace(content, _PLACE, r"<|$1\\im_")


def _unescape(content: Column) -> Column:
    return F.regexp_replace(content, _ESCAPED, r"<|$1im_")


_BREAK = "<|\\im_n|>"


def _escape_role(role: Column) -> Column:
    # First the places, then line breaks: the mark for a break stays unique,
    # since an escaped place "im_n|>" has two backslashes or more.
    doubled = F.regexp_replace(role, r"<\|(\\*)im_", r"<|$1\\\\im_")
    return F.replace(doubled, F.lit("\n"), F.lit(_BREAK))


def _unescape_role(role: Column) -> Column:
    broken = F.regexp_replace(role, r"<\|\\im_n\|>", "\n")
    return F.regexp_replace(broken, r"<\|\\\\(\\*)im_", r"<|$1im_")


def render(role: Column, text: Column) -> Column:
    """One turn from content that is already escaped or needs none."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(rendered: Column) -> Column:
    """Turns (role, text) of a rendered conversation, or null if the grammar is broken."""

    def turn(block: Column) -> Column:
        body = F.substring_index(block, "\n", 1)
        text = F.substr(block, F.length(body) + 2)
        inner = F.substring_index(text, END, 1)
        good = (
            F.contains(block, F.lit("\n")) & (F.concat(inner, F.lit(END + "\n")) == text)
        )
        return F.when(
            good, F.struct(_unescape_role(body).alias("role"), _unescape(inner).alias("text"))
        )

    def turns(blocks: Column) -> Column:
        rest = F.slice(blocks, 2, F.size(blocks))
        return F.when(
            F.element_at(blocks, 1) == "",
            let(F.transform(rest, turn), lambda t: F.when(F.forall(t, lambda x: x.isNotNull()), t)),
        )

    return let(F.split(rendered, _START_PATTERN, -1), turns)


def _segments(rows: DataFrame, role: Column, text: Column) -> DataFrame:
    """Each turn's escaped role and text: as they are if they parse back, else escaped."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    choice = None
    # The plain form first, then each part escaped; the last form always parses back.
    forms = [(_escape_role(role), text), (_escape_role(role), _escape(text))]
    for r, t in [(role, text), *forms]:
        parsed = parse(render(r, t)).cast("array<struct<role:string,text:string>>")
        good = F.coalesce(parsed == source, F.lit(False))
        form = F.struct(r.alias("role"), t.alias("text"))
        choice = F.when(good, form) if choice is None else choice.when(good, form)
    return rows.withColumn("form", choice)


def formatted(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row per conversation: key, ``formatted`` and ``segments`` (text, loss).

    The segments joined are ``formatted``; those with ``loss`` are the escaped
    texts of the trained roles, the rest is template, roles and other texts.
    """
    turns = conversations.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    escaped = _segments(turns, F.col("role"), F.col("text"))
    item = F.struct("turn", "role", "text", "form")
    grouped = escaped.groupBy("key").agg(F.array_sort(F.collect_list(item)).alias("turns"))

    def pieces(t: Column) -> Column:
        head = F.concat(F.lit(START), t["form"]["role"], F.lit("\n"))
        trained = t["role"].isin(*TRAINED)
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(t["form"]["text"].alias("text"), trained.alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    whole = grouped.select(
        F.col("key").alias(key),
        F.flatten(F.transform("turns", pieces)).alias("segments"),
    )
    return whole.select(
        key, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_back(output: DataFrame, key: str = "conv_id") -> DataFrame:
    """Turns and trained text as a reader of ``formatted`` recovers them."""
    trained = F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: _unescape(s["text"])
    )
    return output.select(
        key, "formatted", parse(F.col("formatted")).alias("turns"),
        F.array_join(trained, "").alias("loss_text"),
    )
