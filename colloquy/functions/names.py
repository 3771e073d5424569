"""File-name and layout path functions (FN-5, FN-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def parse_variant_name(file_name: Column | str) -> Column:
    """FN-5: ``{split}_{subset}_{version}.csv`` -> struct(split, subset, transcript_version).

    The extension check ignores case; the version keeps any further ``_``.
    Every part is trimmed and lower-cased; a missing or empty part gives null.
    """
    name = base_name(file_name)
    stem = F.when(F.lower(name).endswith(".csv"), name.substr(F.lit(1), F.length(name) - 4))
    parts = F.split(stem, "_", -1)

    def clean(x: Column) -> Column:
        return F.lower(F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))

    split = clean(F.get(parts, 0))
    subset = clean(F.get(parts, 1))
    version = clean(F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(1))), "_"))
    ok = (F.size(parts) >= 3) & (F.length(split) > 0) & (F.length(subset) > 0) & (F.length(version) > 0)
    return F.when(
        stem.isNotNull() & ok,
        F.struct(split.alias("split"), subset.alias("subset"), version.alias("transcript_version")),
    )


def layout_path(subset: Column | str, split: Column | str) -> Column:
    """FN-15: ``{config}/{split}.parquet``."""
    return F.concat(_c(subset), F.lit("/"), _c(split), F.lit(".parquet"))
