"""Record linkage and source reconciliation as Spark jobs."""

from matchwright.plans.matching import (
    LinkColumns,
    apply_crosswalk,
    assemble_matches,
    candidate_report,
    exact_match,
    fuzzy_clean,
    fuzzy_stage,
    match_cascade,
)
from matchwright.plans.reconcile import (
    agreed_rows,
    conflict_report,
    gap_rows_long,
    gap_rows_wide,
    merge_reconciled,
    multi_source_full,
    multi_source_inner,
    value_conflicts,
)
from matchwright.plans.quality import quality_checks, source_profile

__all__ = [
    "LinkColumns",
    "agreed_rows",
    "apply_crosswalk",
    "assemble_matches",
    "candidate_report",
    "conflict_report",
    "exact_match",
    "fuzzy_clean",
    "fuzzy_stage",
    "gap_rows_long",
    "gap_rows_wide",
    "match_cascade",
    "merge_reconciled",
    "multi_source_full",
    "multi_source_inner",
    "quality_checks",
    "source_profile",
    "value_conflicts",
]
