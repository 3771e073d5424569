"""Vocabularies and run parameters.

Everything the jobs branch on lives here as plain data, so a caller can swap
the clinical vocabulary for another corpus (the test-data mapping in
``colloquy.sources.testdata`` does exactly that).
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the published corpus layout and audit setup
# for results to line up with the published counts and metrics.
# ---------------------------------------------------------------------------
SUBSETS = ("virtassist", "aci", "virtscribe")  # build order; the first is the default config
REPORT_SUBSET_ORDER = ("aci", "virtassist", "virtscribe")
SPLITS = ("train", "valid", "test1", "test2", "test3")
VERSION_ORDER = ("asr", "asrcorr", "humantrans")
CHALLENGE_VERSION = (("aci", "asr"), ("virtassist", "humantrans"), ("virtscribe", "humantrans"))
SPLIT_FILES = (
    ("train", "train.csv"),
    ("valid", "valid.csv"),
    ("test1", "test1.csv"),
    ("test2", "test2.csv"),
    ("test3", "test3.csv"),
)
JUDGE_MODELS = ("google/gemini-3-flash-preview", "x-ai/grok-4.1-fast", "openai/gpt-5-mini")
MISSING_LABEL = "<missing>"
TOTAL_LABEL = "ALL"
NO_ERROR_RANGE = (-1, -1)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Subsets, splits and versions of one corpus, plus report orderings."""

    subsets: tuple[str, ...] = SUBSETS
    splits: tuple[str, ...] = SPLITS
    version_order: tuple[str, ...] = VERSION_ORDER
    report_subset_order: tuple[str, ...] = REPORT_SUBSET_ORDER
    challenge_version: tuple[tuple[str, str], ...] = CHALLENGE_VERSION
    split_files: tuple[tuple[str, str], ...] = SPLIT_FILES

    @property
    def default_subset(self) -> str | None:
        return self.subsets[0] if self.subsets else None

    def challenge_version_map(self) -> dict[str, str]:
        return dict(self.challenge_version)


TRANSCRIPT_KEY = "transcript_key"


@dataclass(frozen=True)
class AuditConfig:
    """Judge set and the key that identifies one transcript.

    The default key adds a SHA-256 of the dialogue to the four published key
    columns: variant files without an id column give every row the id '', so
    the published key alone would merge thousands of transcripts into one
    (hot) key. After keep-first dedup, (cell, version, dialogue) is unique.
    """

    judges: tuple[str, ...] = JUDGE_MODELS
    key: tuple[str, ...] = ("subset", "split", "encounter_id", "transcript_version", TRANSCRIPT_KEY)

    @property
    def n_models(self) -> int:
        return len(self.judges)


@dataclass(frozen=True)
class BuildOptions:
    ascii_normalize: bool = True
    # "error": an unknown subset in a challenge file aborts the build (extended build);
    # "drop": rows of unknown subsets are skipped (basic build, ablation files).
    on_unknown_subset: str = "error"
    sample_size: int = 5
    # CSV rows with too few or too many fields or broken quotes: "keep" what they hold (missing fields are ''),
    # "drop" them, or "error". The rejects tables list them in any case.
    on_bad_row: str = "keep"


DEFAULT_VOCAB = Vocabulary()
DEFAULT_AUDIT = AuditConfig()
