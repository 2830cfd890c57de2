"""The whole job on municipal tables: clean three sources, merge them.

Each function takes and returns DataFrames; reading and writing is the
caller's (``sources.tables``). Results are unordered until written: use
``sort_nulls_last`` with the order named in ``OUTPUT_ORDER``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.fixed_values import (
    CROSSWALK_SOURCE_1,
    CROSSWALK_SOURCE_3,
    GAP_EXCLUSIONS,
    MATCH_DISTANCES,
    REPORT_DISTANCE,
    SOURCE_1_EXCLUSIONS,
)
from matchwright.functions.columns import as_integer, map_columns
from matchwright.operators.filters import apply_exclusions
from matchwright.plans.coded import clean_coded_source
from matchwright.plans.matching import (
    LinkColumns,
    apply_crosswalk,
    assemble_matches,
    candidate_report,
    match_cascade,
)
from matchwright.plans.reconcile import (
    agreed_rows,
    corrected_gaps,
    gap_rows_long,
    merge_reconciled,
)
from matchwright.sources.literals import flatten_literals
from matchwright.sources.tables import drop_trailer, inline_table

COLUMNS = LinkColumns("MUN_NAME", "UF_ABBREV", "MUN_CODE", ("Modulo_fiscal_ha",))
VALUE = "Modulo_fiscal_ha"
OUTPUT_ORDER = {
    "source_1": ["UF_ABBREV", "MUN_NAME"],
    "source_2": ["MUN_CODE"],
    "source_3": ["UF_ABBREV", "MUN_NAME"],
    "final": ["MUN_CODE"],
}

# Headers of the published tables.
SOURCE_1_HEADERS = {
    "Módulo fiscal (ha)": "Modulo_fiscal_ha",
    "UF": "UF_ABBREV",
    "Município": "MUN_NAME",
}
SOURCE_2_HEADERS = {
    "Codigo": "MUN_CODE",
    "UF": "UF_ABBREV",
    "Municipio": "MUN_NAME",
    "MF (há)": "Modulo_fiscal_ha",
}

# Names that got a hit leave the unmatched rows of every state, as published.
BY_NAME = ("MUN_NAME",)


@dataclass(frozen=True)
class Cleaned:
    """A cleaned source, and the unmatched names with their far candidates."""

    rows: DataFrame
    problems: DataFrame | None = None


def clean_source_1(raw: DataFrame, registry: DataFrame, residual_keys=BY_NAME) -> Cleaned:
    """Names as published, no codes: match, correct by hand, report the rest."""
    rows = apply_exclusions(raw.withColumnsRenamed(SOURCE_1_HEADERS), SOURCE_1_EXCLUSIONS)
    cascade = match_cascade(rows, registry, COLUMNS, MATCH_DISTANCES, residual_keys)
    problems = candidate_report(
        cascade.unmatched, registry, cascade.consumed, COLUMNS, REPORT_DISTANCE, BY_NAME
    )
    corrections = inline_table(
        raw.sparkSession, [COLUMNS.name, COLUMNS.corrected], CROSSWALK_SOURCE_1
    )
    manual = apply_crosswalk(corrections, cascade.unmatched, registry, COLUMNS)
    stages = list(cascade.stages.values())
    return Cleaned(assemble_matches(cascade.exact, stages, manual, COLUMNS), problems)


def clean_source_2(raw: DataFrame, ordinal: str, trailer: int = 2) -> Cleaned:
    """Coded rows in capitals; the last rows by ``ordinal`` are not data."""
    rows = drop_trailer(raw, ordinal, trailer).drop(ordinal)
    return Cleaned(clean_coded_source(rows, SOURCE_2_HEADERS, COLUMNS.name, COLUMNS.code))


def clean_source_3(
    literals: DataFrame, text_col: str, registry: DataFrame, residual_keys=BY_NAME
) -> Cleaned:
    """Nested literals with names in capitals; the registry's spelling at the end."""
    rows = flatten_literals(literals, text_col, COLUMNS.block, COLUMNS.name, VALUE)
    rows = rows.withColumn(VALUE, as_integer(VALUE))
    capitals = registry.withColumn(COLUMNS.name, F.upper(COLUMNS.name))
    cascade = match_cascade(rows, capitals, COLUMNS, MATCH_DISTANCES, residual_keys)
    corrections = map_columns(
        inline_table(
            literals.sparkSession, [COLUMNS.name, COLUMNS.corrected], CROSSWALK_SOURCE_3
        ),
        F.upper,
    )
    manual = apply_crosswalk(corrections, cascade.unmatched, capitals, COLUMNS)
    stages = list(cascade.stages.values())
    return Cleaned(
        assemble_matches(cascade.exact, stages, manual, COLUMNS, respell_from=registry)
    )


def merge_sources(
    source_1: DataFrame, source_2: DataFrame, source_3: DataFrame, registry: DataFrame
) -> DataFrame:
    """One row per municipality: agreed values from source 2, gaps filled."""
    sources = {"s1": source_1, "s2": source_2, "s3": source_3}
    gaps = corrected_gaps(
        gap_rows_long(sources, COLUMNS.code, [VALUE, COLUMNS.name]),
        GAP_EXCLUSIONS,
        COLUMNS.code,
        [COLUMNS.name, VALUE],
    )
    agreed = agreed_rows(sources, COLUMNS.code, VALUE, preferred="s2")
    dimension = registry.select(*COLUMNS.registry)
    return merge_reconciled(agreed, gaps, dimension, COLUMNS.code, VALUE)
