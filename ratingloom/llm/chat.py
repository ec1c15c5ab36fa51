"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. A deterministic parser
reads the rendered conversation back and its turns are compared to the source. What conflicts
is escaped and the conversation rendered again until both are identical: first nothing is
escaped, then the turns that do not survive alone, then all.

Escapes: in ``<``, backslashes, ``|`` one backslash is added, so no control string is left and taking
one away gives the text back; in a role, also a backslash becomes ``\\b`` and a line end ``\\n``.

A conversation is one output row, so its turns meet in one task; its text must fit there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
START_PATTERN, END_PATTERN = r"<\|im_start\|>", r"<\|im_end\|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def render(turns: Column) -> Column:
    """One string of an array of (role, text) as they are to be written."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")


def bodies(formatted: Column) -> Column:
    """What follows each start mark."""
    parts = F.split(formatted, START_PATTERN, -1)
    return F.slice(parts, F.lit(2), F.size(parts) - 1)


def parse(formatted: Column) -> Column:
    """Array of (role, text); a part that breaks the grammar reads as a turn with null fields."""

    def turn(body: Column) -> Column:
        cut = F.split(body, END_PATTERN, -1)
        whole = (F.size(cut) == 2) & (F.get(cut, F.lit(1)) == "\n") & F.contains(F.get(cut, F.lit(0)), F.lit("\n"))
        role = F.substring_index(F.get(cut, F.lit(0)), "\n", 1)
        text = F.substring(F.get(cut, F.lit(0)), F.char_length(role) + 2, F.char_length(body))
        return _turn(F.when(whole, unescape_role(role)), F.when(whole, unescape(text)))

    return F.transform(bodies(formatted), turn)


def _escaped(turn: Column) -> Column:
    return _turn(escape_role(turn["role"]), escape(turn["text"]))


def _if_needed(turn: Column) -> Column:
    """The turn as it is if it survives alone, else escaped."""
    back = parse(render(F.array(turn)))
    return F.when(back == F.array(turn), turn).otherwise(_escaped(turn))


def format_conversations(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``segments``, which cut ``formatted`` into runs of
    characters with a loss flag: before, in and after each turn's text; an assistant's text bears loss.

    Turns are ordered by ``turn`` (nulls first), then role and text; repeated rows are turns of their own.
    Null roles and texts are empty. A null id is a conversation of its own. Other columns are not read,
    so none can clash. An empty table gives no rows. A conversation that cannot be read back identically
    stops the job.
    """
    empty = F.lit("")
    rows = df.select(
        df[f"`{conversation}`"].alias("conv"),
        df[f"`{turn}`"].alias("turn"),
        F.coalesce(df[f"`{role}`"].cast("string"), empty).alias("role"),
        F.coalesce(df[f"`{text}`"].cast("string"), empty).alias("text"),
    )
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("ordered"))
    source = grouped.select("conv", F.transform("ordered", lambda t: _turn(t["role"], t["text"])).alias("source"))
    attempts = {
        "source": F.col("source"),
        "needed": F.transform("source", _if_needed),
        "whole": F.transform("source", _escaped),
    }
    written = F.lit(None)
    for turns in reversed(list(attempts.values())):
        written = F.when(parse(render(turns)) == F.col("source"), turns).otherwise(written)
    chosen = source.select("conv", "source", written.alias("written"))
    checked = F.when(F.col("written").isNull(), F.raise_error(F.lit("a conversation does not survive its format"))).otherwise(
        render(F.col("written"))
    )
    return chosen.select(F.col("conv").alias(conversation), checked.alias("formatted"), _segments(F.col("written")).alias("segments"))


def _segments(written: Column) -> Column:
    def run(chars: Column | int, loss: Column) -> Column:
        return F.struct((chars if isinstance(chars, Column) else F.lit(chars)).cast("int").alias("chars"), loss.alias("loss"))

    def of(turn: Column) -> Column:
        no = F.lit(False)
        head = F.char_length(turn["role"]) + len(START) + 1
        return F.array(run(head, no), run(F.char_length(turn["text"]), turn["role"] == LEARNED), run(len(END) + 1, no))

    return F.flatten(F.transform(written, of))


def masked_texts(formatted: Column, segments: Column) -> Column:
    """The texts under the loss mask, unescaped, in order. Each part of ``formatted`` from one start mark to
    the next is cut by its own three segments, so the work is linear in the length."""

    def text(body: Column, i: Column) -> Column:
        head, own = F.get(segments, 3 * i), F.get(segments, 3 * i + 1)
        inside = F.substring(F.concat(F.lit(START), body), head["chars"] + 1, own["chars"])
        return F.when(own["loss"], unescape(inside)).otherwise(F.lit(""))

    return F.transform(bodies(formatted), text)
