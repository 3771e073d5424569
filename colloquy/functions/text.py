"""Column functions over transcript text.

All of these are JVM expressions except the fold inside ``normalize_text``:
Spark has no NFKC/NFKD, so the values go through one Arrow-batched pandas UDF
(``colloquy.functions.fold``). Every value takes that one trip: in Python an
ASCII value costs one C-level ``isascii`` and one regex search, which measured
2.4x faster on mostly-ASCII text than stripping control characters with a
JVM ``regexp_replace`` (Java regex over long strings is slow).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.fold import CHAR_MAP, CONTROL_CHARS, fold_series, fold_to_ascii, fold_value

__all__ = ["CHAR_MAP", "CONTROL_CHARS", "fold_to_ascii", "fold_value"]

_fold_udf = F.pandas_udf(fold_series, T.StringType())


def normalize_text(c: Column | str, ascii_normalize: bool = True) -> Column:
    """FN-1: null -> ''; optionally NFKC, char map, NFKD, drop non-ASCII, drop controls."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")
    if not ascii_normalize:
        return c
    return _fold_udf(c)


def normalize_dataset_name(c: Column | str) -> Column:
    """FN-2: null -> '', strip surrounding whitespace, lower case."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.lower(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def unify_newlines(c: Column | str) -> Column:
    """CRLF and lone CR become LF (what a text-mode CSV read does)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "\r\n?", "\n")


def split_lines(c: Column | str) -> Column:
    """Lines of a dialogue; trailing empty lines are kept."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, "\n", -1)


def number_lines(c: Column | str, sep: str = " ") -> Column:
    """FN-3 (sep ' ') and FN-4 (sep ': '): prefix each line with its 1-based number."""
    return F.array_join(
        F.transform(split_lines(c), lambda x, i: F.concat((i + 1).cast("string"), F.lit(sep), x)),
        "\n",
    )


def enumerate_dialogue(c: Column | str) -> Column:
    return number_lines(c, " ")


def prepare_transcript(c: Column | str) -> Column:
    return number_lines(c, ": ")


def line_count(c: Column | str) -> Column:
    return F.size(split_lines(c))


SPEAKER_LINE = r"(?s)^\[([^\]]+)\] ?(.*)$"


def speaker_tag(line: Column) -> Column:
    """FN-16: the tag of a '[tag] text' line, '' when there is none."""
    return F.regexp_extract(line, SPEAKER_LINE, 1)


def utterance(line: Column) -> Column:
    """FN-16: the text after the tag; the whole line when there is no tag."""
    return F.when(line.rlike(SPEAKER_LINE), F.regexp_extract(line, SPEAKER_LINE, 2)).otherwise(line)


def resolve_end(end: Column, n_lines: Column) -> Column:
    """-1 as a range end means the last line."""
    return F.when(end == -1, n_lines).otherwise(end)


def range_length(start: Column, end: Column, n_lines: Column) -> Column:
    """FN-17: lines covered by [start, end] (1-based, inclusive), clamped to the transcript."""
    s = F.greatest(start, F.lit(1))
    e = F.least(resolve_end(end, n_lines), n_lines)
    return F.greatest(e - s + 1, F.lit(0))
