"""Findings and metrics kept up to date by differences (SNK-3, SNK-4, INC-2).

A run changes what is known of the transcripts that it judged, and of no others. Its difference has two parts, both
computed from the verdicts of those transcripts alone:

* per cell, the counts after the run less the counts before it. A transcript judged for the first time adds itself; one that was judged
  again first takes back its old contribution. Differences are summed in any order, so tables of them merge.
* per transcript, the finding as it now is, where it is another one than before (a finding may also be withdrawn).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT
from colloquy.functions import verdict as vd
from colloquy.operators import audit as au
from colloquy.operators.resolve import key_join

CELL = ("subset", "split", "transcript_version")
MEASURES = ("notes", "with_errors", "unanimous", "majority")


def states(verdicts: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, models_with_errors, errors, flagged): what a verdict table says of each of its transcripts."""
    return au.findings(au.gather_verdicts(verdicts, key), key, keep_all=True)


def changed_states(new: DataFrame, prior: DataFrame | None, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, before, after): the states of the transcripts in ``new`` without and with it; ``before`` is null for those never judged before."""
    key = list(key)
    state = F.struct("models_with_errors", "errors", "flagged")
    if prior is None:
        after = states(new, key)
        return after.select(*key, F.lit(None).cast(after.select(state.alias("s")).schema["s"].dataType).alias("before"), state.alias("after"))
    old = key_join(prior, new.select(*key).distinct(), key, "left_semi")
    both = old.unionByName(new, allowMissingColumns=True)
    before = states(old, key).select(*key, state.alias("before"))
    return key_join(states(both, key).select(*key, state.alias("after")), before, key, "left").select(*key, "before", "after")


def cell_changes(changed: DataFrame, n_models: int) -> DataFrame:
    """(cell, measures): the sums of contributions after less those before, cells without a change left out."""

    def counted(name: str, sign: int):
        s = F.col(name)
        flagged = F.coalesce(s["flagged"], F.lit(False))
        n = F.size(s["models_with_errors"])
        there = s.isNotNull()
        unanimous, majority = flagged & vd.unanimous(s["models_with_errors"], n_models), flagged & vd.majority(n, n_models)
        return F.struct(*[F.when(F.coalesce(c, F.lit(False)), sign).otherwise(0).cast("long").alias(m) for m, c in zip(MEASURES, (there, there & flagged, unanimous, majority), strict=True)])

    rows = changed.select(*CELL, F.explode(F.array(counted("before", -1), counted("after", 1))).alias("c"))
    sums = rows.groupBy(*CELL).agg(*[F.sum(F.col("c")[m]).alias(m) for m in MEASURES])
    return sums.where(" or ".join(f"{m} <> 0" for m in MEASURES))


def merged_cells(changes: DataFrame) -> DataFrame:
    """Counts per cell from any number of differences."""
    return changes.groupBy(*CELL).agg(*[F.sum(m).alias(m) for m in MEASURES])


def finding_changes(changed: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, models_with_errors, errors, flagged) of transcripts whose finding is new, another or withdrawn.

    Findings are compared as JSON text, as maps have no equality.
    """
    text = lambda name: F.when(F.coalesce(F.col(name)["flagged"], F.lit(False)), F.to_json(F.struct(F.col(name)["models_with_errors"], F.col(name)["errors"])))
    moved = changed.where(~text("before").eqNullSafe(text("after")))
    return moved.select(*key, "after.models_with_errors", "after.errors", "after.flagged")


def latest_findings(changes: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key, order: str = "run_id") -> DataFrame:
    """The findings that stand after all changes: each transcript's last one, unless it was withdrawn."""
    last = changes.groupBy(*key).agg(F.max_by(F.struct("models_with_errors", "errors", "flagged"), order).alias("s"))
    return last.where("s.flagged").select(*key, "s.models_with_errors", "s.errors")
