"""Audit metrics over six groupings in one grouping-sets pass (AGG-9 .. AGG-15, JOIN-5/6).

One grouping-sets aggregation over the findings (expanded and partially
aggregated in the map tasks, one small shuffle) gives all six groupings; the
zero-filled totals spine comes from the per-cell corpus counts; both are
vocabulary-sized when they meet in one null-safe full join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.config import MISSING_LABEL, SPLITS
from colloquy.functions import verdict as vd

GROUPINGS = (
    "summary",
    "by_subset",
    "by_split",
    "by_subset_and_split",
    "by_transcript_version",
    "by_subset_and_transcript_version",
)

# grouping_id() bits for grouping sets over (subset, split, transcript_version):
# a bit is 1 when that column is aggregated away.
_GID = {
    7: "summary",
    3: "by_subset",
    5: "by_split",
    1: "by_subset_and_split",
    6: "by_transcript_version",
    2: "by_subset_and_transcript_version",
}

_SETS = [
    [],
    ["subset"],
    ["split"],
    ["subset", "split"],
    ["transcript_version"],
    ["subset", "transcript_version"],
]

METRIC_COLUMNS = (
    "grouping",
    "subset",
    "split",
    "transcript_version",
    "total_notes",
    "notes_with_errors",
    "error_percentage",
    "all_models_found_errors",
    "majority_consensus_errors",
)


def metrics(
    findings: DataFrame,
    totals: DataFrame,
    n_models: int,
    splits: Sequence[str] = SPLITS,
) -> DataFrame:
    """The six groupings as one long table (columns ``METRIC_COLUMNS``).

    ``totals`` has (subset, split, n_rows): notes processed per cell. Subsets
    are those in ``totals`` (processed); split groupings are zero-filled over
    ``splits``; version groupings list observed versions only and carry no
    totals or percentages (quirk Q14); the summary has no unanimity count.
    """
    n_flag = F.size("models_with_errors")
    # Grouping sets straight over the findings: each row is expanded six ways and
    # partially aggregated in the map task, so one small shuffle yields all groupings.
    agg = findings.groupingSets(_SETS, "subset", "split", "transcript_version").agg(
        F.count(F.lit(1)).cast("long").alias("notes_with_errors"),
        F.count_if(vd.unanimous("models_with_errors", n_models)).cast("long").alias("all_models_found_errors"),
        F.count_if(vd.majority(n_flag, n_models)).cast("long").alias("majority_consensus_errors"),
        F.grouping_id().alias("_gid"),
    )
    return _report(agg, totals, splits)


def metrics_of_cells(cells: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """The same table from counts per (subset, split, transcript_version): notes, with_errors, unanimous, majority."""
    agg = cells.where("with_errors > 0").groupingSets(_SETS, "subset", "split", "transcript_version").agg(
        F.sum("with_errors").cast("long").alias("notes_with_errors"),
        F.sum("unanimous").cast("long").alias("all_models_found_errors"),
        F.sum("majority").cast("long").alias("majority_consensus_errors"),
        F.grouping_id().alias("_gid"),
    )
    totals = cells.where("notes > 0").groupBy("subset", "split").agg(F.sum("notes").cast("long").alias("n_rows"))
    return _report(agg, totals, splits)


def _report(agg: DataFrame, totals: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Aggregated findings (with ``_gid``) and totals per cell as the long metrics table."""
    gname = F.create_map(*[F.lit(x) for kv in _GID.items() for x in kv])
    agg = agg.withColumn("grouping", F.element_at(gname, F.col("_gid").cast("int"))).drop("_gid")

    # Spine: processed subsets x configured splits, zero-filled (JOIN-5), built by one
    # aggregation per subset (split -> rows) and a generator over the configured splits.
    per_subset = totals.groupBy("subset").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("split").isNotNull(), F.struct("split", "n_rows")))).alias("_m")
    )
    cell_totals = per_subset.select(
        "subset", F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"), "_m"
    ).select("subset", "split", F.coalesce(F.try_element_at("_m", F.col("split")), F.lit(0)).cast("long").alias("total_notes"))
    tot = cell_totals.groupingSets([[], ["subset"], ["split"], ["subset", "split"]], "subset", "split").agg(
        F.sum("total_notes").cast("long").alias("total_notes"), F.grouping_id().alias("_gid")
    )
    tot_name = F.create_map(
        F.lit(3), F.lit("summary"), F.lit(1), F.lit("by_subset"), F.lit(2), F.lit("by_split"),
        F.lit(0), F.lit("by_subset_and_split"),
    )
    tot = tot.withColumn("grouping", F.element_at(tot_name, F.col("_gid").cast("int"))).drop("_gid")

    # One null-safe full join of the two small tables: total-bearing groupings keep
    # every spine row (zero-filled, JOIN-5) with its total (JOIN-6); version
    # groupings have no spine and come through from the findings side alone.
    a = agg.select(*[F.col(c).alias(f"a_{c}") for c in agg.columns])
    cond = (
        (a["a_grouping"] == tot["grouping"])
        & a["a_subset"].eqNullSafe(tot["subset"])
        & a["a_split"].eqNullSafe(tot["split"])
    )
    j = a.join(tot, cond, "full")
    by_version = F.col("a_grouping").isin("by_transcript_version", "by_subset_and_transcript_version")
    # A finding outside the spine (a split not configured) only counts in the summary.
    j = j.where(by_version | F.col("grouping").isNotNull())
    grouping = F.coalesce(F.col("grouping"), F.col("a_grouping"))
    is_summary = grouping == "summary"
    nwe = F.coalesce(F.col("a_notes_with_errors"), F.lit(0)).cast("long")
    out = j.select(
        grouping.alias("grouping"),
        F.when(by_version, F.col("a_subset")).otherwise(F.col("subset")).alias("subset"),
        F.when(by_version, F.lit(None)).otherwise(F.col("split")).cast("string").alias("split"),
        F.when(by_version, F.col("a_transcript_version")).cast("string").alias("transcript_version"),
        F.col("total_notes").cast("long").alias("total_notes"),
        nwe.alias("notes_with_errors"),
        F.when(by_version | is_summary, F.lit(None).cast("double"))
        .otherwise(vd.percentage(nwe, F.col("total_notes")))
        .alias("error_percentage"),
        F.when(is_summary, F.lit(None).cast("long"))
        .otherwise(F.coalesce(F.col("a_all_models_found_errors"), F.lit(0)))
        .cast("long")
        .alias("all_models_found_errors"),
        F.coalesce(F.col("a_majority_consensus_errors"), F.lit(0)).cast("long").alias("majority_consensus_errors"),
    )
    # Vocabulary-sized: ordered inside one partition (groupings in published order, splits canonical).
    g_rank = F.array_position(F.array(*[F.lit(g) for g in GROUPINGS]), F.col("grouping"))
    s_rank = F.array_position(F.array(*[F.lit(x) for x in splits]), F.col("split"))
    ordered = out.coalesce(1).sortWithinPartitions(g_rank, "subset", s_rank, "transcript_version")
    return ordered.select(*METRIC_COLUMNS)


def metrics_document(metrics_long: DataFrame) -> DataFrame:
    """SNK-5: the nested metrics object as one JSON string (input is vocabulary-sized)."""
    m = metrics_long
    cell = F.struct(
        "total_notes", "notes_with_errors", "error_percentage", "all_models_found_errors", "majority_consensus_errors"
    )
    vcell = F.struct("notes_with_errors", "all_models_found_errors", "majority_consensus_errors")

    named = lambda key: F.coalesce(F.col(key), F.lit(MISSING_LABEL)).alias(key)  # noqa: E731  a JSON object has no null key

    def level(name: str, key: str, value):
        return F.map_from_entries(
            F.array_sort(F.collect_list(F.when(F.col("grouping") == name, F.struct(named(key), value))))
        )

    summary = F.first(
        F.when(
            F.col("grouping") == "summary",
            F.struct(
                F.col("notes_with_errors").alias("total_notes_with_errors"),
                F.col("total_notes").alias("total_notes_processed"),
                "majority_consensus_errors",
            ),
        ),
        ignorenulls=True,
    )
    nested_split = m.where(F.col("grouping") == "by_subset_and_split").groupBy("subset").agg(
        F.map_from_entries(F.collect_list(F.struct(named("split"), cell))).alias("v")
    )
    nested_version = m.where(F.col("grouping") == "by_subset_and_transcript_version").groupBy("subset").agg(
        F.map_from_entries(F.collect_list(F.struct(named("transcript_version"), vcell))).alias("v")
    )
    flat = m.agg(
        summary.alias("summary"),
        level("by_subset", "subset", cell).alias("by_subset"),
        level("by_split", "split", cell).alias("by_split"),
        level("by_transcript_version", "transcript_version", vcell).alias("by_transcript_version"),
    )
    ns = nested_split.agg(F.map_from_entries(F.collect_list(F.struct(named("subset"), "v"))).alias("by_subset_and_split"))
    nv = nested_version.agg(
        F.map_from_entries(F.collect_list(F.struct(named("subset"), "v"))).alias("by_subset_and_transcript_version")
    )
    # Three one-row frames side by side: a union and first(ignorenulls), not a join.
    parts = flat.unionByName(ns, allowMissingColumns=True).unionByName(nv, allowMissingColumns=True)
    doc = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    return doc.select(
        F.to_json(
            F.struct(
                "summary",
                "by_subset",
                "by_split",
                "by_subset_and_split",
                "by_transcript_version",
                "by_subset_and_transcript_version",
            )
        ).alias("metrics_json")
    )
