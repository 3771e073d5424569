"""The ASCII fold (FN-1) in plain Python: the code Spark ships to its Python workers.

This module holds no Spark objects. It is registered for pickling by value, so
the workers receive these functions and tables inside the task and need only
the standard library and pandas, whether or not the package is installed on
the executors.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle

# ---------------------------------------------------------------------------
# The character map applied between NFKC and NFKD. It must equal
# the published build's map for the same output text.
# ---------------------------------------------------------------------------
CHAR_MAP = {
    "\u2018": "'",
    "\u2019": "'",
    "\u201b": "'",
    "\u2032": "'",
    "\u2035": "'",
    "\u201c": '"',
    "\u201d": '"',
    "\u201f": '"',
    "\u2033": '"',
    "\u2036": '"',
    "\u2010": "-",
    "\u2011": "-",
    "\u2012": "-",
    "\u2013": "-",
    "\u2014": "-",
    "\u2212": "-",
    "\u00a0": " ",
    "\u2007": " ",
    "\u202f": " ",
    "\u2009": " ",
    "\u200a": " ",
    "\u200b": "",
    "\ufeff": "",
    "\u2026": "...",
}
# Control characters removed after folding (tab, LF, CR and DEL are kept).
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
# ---------------------------------------------------------------------------

# The map as one character class: a C-level scan finds the (rare) mapped
# characters; str.translate with a dict would visit every character in Python.
_MAPPED_RE = re.compile("[" + "".join(re.escape(k) for k in CHAR_MAP) + "]")
_CONTROL_RE = re.compile(CONTROL_CHARS)
_DROPPED_RE = re.compile(r"[^\x00-\x7f]|" + CONTROL_CHARS)


def _mapped(m: re.Match) -> str:
    return CHAR_MAP[m.group()]


def fold_to_ascii(text: str) -> str:
    """The fold on one string: compatibility composition and the character map, then decomposition, of which
    plain ASCII stays: accents, other scripts and control characters go."""
    composed = unicodedata.normalize("NFKC", text)
    plain = _MAPPED_RE.sub(_mapped, composed)
    return _DROPPED_RE.sub("", unicodedata.normalize("NFKD", plain))


def fold_value(value: str | None) -> str:
    """FN-1 on one value: null -> ''; ASCII text only loses control characters
    (NFKC/NFKD and the map leave ASCII unchanged); other text gets the full fold."""
    if value is None:
        return ""
    if value.isascii():
        return _CONTROL_RE.sub("", value) if _CONTROL_RE.search(value) else value
    return fold_to_ascii(value)


def fold_series(values: pd.Series) -> pd.Series:
    return values.map(fold_value)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
