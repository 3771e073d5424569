"""Chat formatting: a finite-state machine over roles checks the turn order; a declarative template
turns every conversation into text segments with a loss flag each.

Everything is a Spark expression: the machine is a fold over a conversation's turns, the template a
table of literals.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = ""
OTHER = None  # any role without marks of its own


@dataclass(frozen=True)
class Template:
    """Marks before and after a turn by role, the roles whose text counts for the loss, and the allowed order.

    A role without marks of its own goes between ``other`` marks with its name in front.
    ``order`` lists (state, role) pairs; the state is the last role, ``START`` at first. ``ends`` are
    the states in which a conversation may stop. A mark's first character must not be ``escape``.
    """

    marks: tuple[tuple[str, str, str], ...] = (
        ("system", "<<SYS>>\n", "\n<</SYS>>\n"),
        ("user", "[INST] ", " [/INST]\n"),
        ("assistant", "<s>", "</s>\n"),
    )
    other: tuple[str, str, str] = ("<<ROLE>>", "<<:>>\n", "\n<</ROLE>>\n")  # name follows the first, text the second
    loss: tuple[str, ...] = ("assistant",)
    order: tuple[tuple[str, str], ...] = ((START, "system"), (START, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))
    ends: tuple[str, ...] = ("assistant",)
    escape: str = "\\"

    def controls(self) -> list[str]:
        """Control strings, without the white space around them, longest first."""
        found = {m.strip() for row in self.marks for m in row[1:]} | {m.strip() for m in self.other}
        return sorted(found, key=lambda m: (-len(m), m))


DEFAULT = Template()


def escaped(text: Column, t: Template) -> Column:
    """The text with the escape character doubled and every control string broken after its first character.

    The result holds no control string, and ``unescaped`` gives the text back."""
    doubled = F.replace(text, F.lit(t.escape), F.lit(2 * t.escape))
    starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in t.controls())
    return F.regexp_replace(doubled, F.lit(starts), F.lit("$0" + re.escape(t.escape)))


def unescaped(text: Column, t: Template) -> Column:
    return F.regexp_replace(text, F.lit(f"(?s){re.escape(t.escape)}(.)"), F.lit("$1"))


def _turns(rows: DataFrame) -> DataFrame:
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def _segments(turn: Column, t: Template) -> Column:
    """One turn as segments (text, loss): opening mark, text, closing mark."""
    seg = lambda text, loss=False: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    body = escaped(turn["text"], t)
    open_, name, close = t.other
    out = F.array(seg(F.concat(F.lit(open_), escaped(turn["role"], t), F.lit(name))), seg(body), seg(F.lit(close)))
    for role, before, after in reversed(t.marks):
        out = F.when(turn["role"] == role, F.array(seg(F.lit(before)), seg(body, role in t.loss), seg(F.lit(after)))).otherwise(out)
    return out


def _machine(turns: Column, t: Template) -> Column:
    """Whether the roles follow the template's order: a fold whose state is the last role, null after a wrong one."""
    step = lambda state, turn: F.when(
        F.array_contains(F.array(*(F.lit(f"{s}\n{r}") for s, r in t.order)), F.concat(state, F.lit("\n"), turn["role"])), turn["role"]
    )
    return F.aggregate(turns, F.lit(START), step, lambda state: F.coalesce(state.isin(*t.ends), F.lit(False)))


def format_chats(rows: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """(conv_id, valid, segments, formatted) per conversation of ``rows`` (conv_id, turn, role, text).

    segments are (text, loss) in order; formatted joins their texts. A conversation whose roles break the
    order is formatted too, with valid false. Null roles and texts count as empty; turns that tie, or lack
    a number (first), follow by role and text; repeated rows are turns of their own; a null conv_id is a
    conversation. Extra columns are ignored; an empty table gives an empty result.

    A conversation is one training example and one row: its turns meet in one group by nature.
    """
    turns = _turns(rows)
    segments = F.flatten(F.transform("turns", lambda x: _segments(x, t)))
    out = turns.select("conv_id", _machine(F.col("turns"), t).alias("valid"), segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    quoted = [(role, re.escape(before), re.escape(after)) for role, before, after in t.marks]
    open_, name, close = map(re.escape, t.other)
    one = "|".join([f"{b}.*?{a}" for _, b, a in quoted] + [f"{open_}.*?{name}.*?{close}"])
    parts = F.regexp_extract_all(formatted, F.lit(f"(?s)({one})"), F.lit(1))

    def turn(part):
        row = lambda role, text: F.struct(role.alias("role"), unescaped(text, t).alias("text"))
        out = row(unescaped(F.regexp_extract(part, f"(?s)^{open_}(.*?){name}", 1), t), F.regexp_extract(part, f"(?s){name}(.*){close}$", 1))
        for (role, before, after), (_, b, _) in reversed(list(zip(t.marks, quoted, strict=True))):
            inner = F.substring(part, F.lit(len(before) + 1), F.length(part) - F.lit(len(before) + len(after)))
            out = F.when(part.startswith(before), row(F.lit(role), inner)).otherwise(out)
        return out

    return F.transform(parts, turn)


def digests(chats: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """What the formatted output holds, read back from it: turns and loss text as digests and lengths."""
    loss = F.filter("segments", lambda s: s["loss"])
    loss = F.array_join(F.transform(loss, lambda s: unescaped(s["text"], t)), "")
    out = chats.select("conv_id", "valid", read_back(F.col("formatted"), t).alias("turns"), loss.alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
