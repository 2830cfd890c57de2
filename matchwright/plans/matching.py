"""Attach codes to name-keyed rows: exact, then approximate, then by hand."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.fixed_values import MATCH_DISTANCES, REPORT_DISTANCE
from matchwright.operators.counts import add_group_count, group_sizes
from matchwright.operators.far_names import LEAST_FAR, Space, space_of
from matchwright.operators.filters import split_by_null
from matchwright.operators.joins import lookup, null_safe_join, quoted, within, without
from matchwright.operators.reshape import stack_rows
from matchwright.operators.similarity import (
    MAX_DELETION_ONLY,
    alike,
    distinct_names,
    has_long_names,
    similar_names,
)
from matchwright.sources.staging import stage_table


@dataclass(frozen=True)
class LinkColumns:
    """Column names of a name-keyed source and of the registry."""

    name: str = "name"
    block: str = "block"
    code: str = "code"
    values: tuple[str, ...] = ("value",)

    @property
    def corrected(self) -> str:
        return f"{self.name}_corr"

    @property
    def original(self) -> str:
        return f"{self.name}_data_orig"

    @property
    def matched(self) -> str:
        return f"{self.name}_match"

    @property
    def source(self) -> list[str]:
        return [self.name, self.block, *self.values]

    @property
    def registry(self) -> list[str]:
        return [self.code, self.name, self.block]

    @property
    def exact_key(self) -> list[str]:
        return [self.name, self.block]


DEFAULT = LinkColumns()


def exact_match(src: DataFrame, registry: DataFrame, cols: LinkColumns = DEFAULT) -> DataFrame:
    """Left join on (name, block); the code is null where nothing matched."""
    return null_safe_join(src, registry.select(*cols.registry), cols.exact_key, "left")


def exact_match_fanout(
    src: DataFrame, registry: DataFrame, cols: LinkColumns = DEFAULT
) -> DataFrame:
    """Exact matches of source rows that meet several registry rows, with ``n``.

    A row fans out exactly when its key repeats in the registry, so the
    registry's own key counts answer it without numbering the source rows.
    """
    reg = registry.select(*cols.registry)
    repeated = group_sizes(reg, cols.exact_key).filter(F.col("n") > 1)
    several = null_safe_join(reg, repeated, cols.exact_key)
    return null_safe_join(src, several, cols.exact_key)


def _hits(
    unmatched: DataFrame,
    registry: DataFrame,
    consumed: DataFrame | None,
    cols: LinkColumns,
    k: int,
    refine_above: int | None,
    long_names: bool,
    space: Space | None = None,
) -> DataFrame:
    """Stage table (block, left_name, right_name, distance, code) of one distance.

    It is the costly part of a stage and small next to the rows it comes from,
    so it is written once; rows, counts, residual and pool all read it.
    """
    official = registry.select(*cols.registry)
    pool = official if consumed is None else without(official, consumed, cols.code)
    pairs = similar_names(
        distinct_names(unmatched, cols.name, cols.block),
        distinct_names(pool, cols.name, cols.block),
        k,
        refine_above,
        long_names,
        space,
    )
    name, block = quoted(cols.name), quoted(cols.block)
    coded = (
        pairs.alias("p")
        .join(official.alias("r"), F.expr(f"p.block = r.{block} AND p.right_name = r.{name}"))
        .selectExpr("p.*", f"r.{quoted(cols.code)} AS code")
    )
    if consumed is not None:
        # a free name may also stand on a taken row
        coded = without(coded, consumed, [("code", cols.code)])
    return stage_table(coded, f"fuzzy-k{k}")


def _stage_rows(unmatched: DataFrame, hits: DataFrame, cols: LinkColumns) -> DataFrame:
    name, block = quoted(cols.name), quoted(cols.block)
    rows = (
        unmatched.select(*cols.source)
        .alias("l")
        .join(hits.alias("h"), F.expr(f"l.{name} = h.left_name AND l.{block} = h.block"))
        .selectExpr(
            "l.*",
            f"h.code AS {quoted(cols.code)}",
            f"h.right_name AS {quoted(cols.matched)}",
            "h.distance",
        )
    )
    return add_group_count(rows, cols.exact_key, "n_matches")


def fuzzy_stage(
    unmatched: DataFrame,
    registry: DataFrame,
    consumed: DataFrame | None = None,
    cols: LinkColumns = DEFAULT,
    k: int = 1,
    refine_above: int | None = None,
) -> DataFrame:
    """Match names within distance ``k`` in the same block.

    Registry rows whose code is in ``consumed`` are out of the pool. One row
    per hit: source columns, code, matched name, distance and ``n_matches``,
    the hits of that (name, block). Blocks of different types are compared, and
    come out, in their common type.
    """
    unmatched, registry = alike(unmatched, registry, [cols.name, cols.block])
    long_names = k <= MAX_DELETION_ONLY and has_long_names(registry, cols.name)
    hits = _hits(unmatched, registry, consumed, cols, k, refine_above, long_names)
    return _stage_rows(unmatched, hits, cols)


def has_ambiguous(stage: DataFrame) -> DataFrame:
    """One row: whether any (name, block) of the stage has several hits."""
    return stage.agg(
        F.coalesce(F.bool_or(F.col("n_matches") > 1), F.lit(False)).alias("ambiguous"),
        F.count_if(F.col("n_matches") > 1).alias("ambiguous_rows"),
    )


def fuzzy_clean(
    stage: DataFrame, cols: LinkColumns = DEFAULT, warn: bool = False, ambiguous: str = "keep"
) -> DataFrame:
    """Standard columns of a stage; ambiguous hits stay unless ``"drop"``.

    ``warn`` runs a job and warns if there are any.
    """
    if ambiguous not in ("keep", "drop"):
        raise ValueError("ambiguous must be 'keep' or 'drop'")
    if warn and has_ambiguous(stage).first()["ambiguous"]:
        warnings.warn("some names have several matches; clean them first", stacklevel=2)
    if ambiguous == "drop":
        stage = stage.filter(F.col("n_matches") == 1)
    return stage.select(cols.name, cols.block, cols.code, cols.matched, *cols.values)


@dataclass(frozen=True)
class Cascade:
    """What a cascade produced; every frame reads written stage tables."""

    exact: DataFrame
    stages: dict[int, DataFrame]
    unmatched: DataFrame
    consumed: DataFrame
    cols: LinkColumns

    def matched(self) -> DataFrame:
        """All rows matched so far, in the standard columns."""
        return stack_rows(
            [
                self.exact.select(self.cols.name, self.cols.block, self.cols.code, *self.cols.values),
                *[fuzzy_clean(s, self.cols) for s in self.stages.values()],
            ]
        )


def match_cascade(
    src: DataFrame,
    registry: DataFrame,
    cols: LinkColumns = DEFAULT,
    dists: Sequence[int] = MATCH_DISTANCES,
    residual_keys: Sequence[str] | None = None,
    ambiguous: str = "keep",
    refine_above: int | None = None,
) -> Cascade:
    """Exact match, then one fuzzy stage per distance on what is left.

    A stage takes its hits' names out of the unmatched rows (by
    ``residual_keys``, default name and block; name alone removes a hit name in
    every block) and its codes out of the pool of the next stages. Blocks of
    different types are compared, and come out, in their common type.
    """
    src, registry = alike(src, registry, [cols.name, cols.block])
    residual = list(residual_keys or cols.exact_key)
    to_hit = {cols.name: "left_name", cols.block: "block"}
    joined = stage_table(exact_match(src.select(*cols.source), registry, cols), "exact")
    exact, rest = split_by_null(joined, cols.code)
    unmatched = rest.select(*cols.source)
    consumed = exact.select(cols.code)
    long_names = has_long_names(registry, cols.name)
    stages: dict[int, DataFrame] = {}
    for k in dists:
        hits = _hits(unmatched, registry, consumed, cols, k, refine_above, long_names)
        rows = _stage_rows(unmatched, hits, cols)
        if ambiguous == "drop":
            rows = stage_table(rows.filter(F.col("n_matches") == 1), f"unique-k{k}")
            hits = rows.withColumnsRenamed(
                {cols.name: "left_name", cols.block: "block", cols.code: "code"}
            )
        stages[k] = rows
        unmatched = without(unmatched, hits, [(c, to_hit[c]) for c in residual])
        consumed = consumed.union(hits.select("code"))
    return Cascade(exact, stages, unmatched, consumed, cols)


def candidate_report(
    unmatched: DataFrame,
    registry: DataFrame,
    consumed: DataFrame | None,
    cols: LinkColumns = DEFAULT,
    k: int = REPORT_DISTANCE,
    keys: Sequence[str] | None = None,
    refine_above: int | None = None,
) -> DataFrame:
    """All unmatched names with their only far candidate, null if none or many.

    Names are sought in two rings, within ``LEAST_FAR`` and within ``k``: a name
    with two candidates in the first has many, and leaves the search.
    Candidates are joined back by ``keys``, by default name and block, as the
    cascade's own residual is.
    """
    keys = list(keys or cols.exact_key)
    unmatched, registry = alike(unmatched, registry, [cols.name, cols.block])
    long_names = k <= MAX_DELETION_ONLY and has_long_names(registry, cols.name)
    # a name on several rows has as many hits for each candidate
    seeking = stage_table(
        group_sizes(unmatched, cols.exact_key).where("n = 1").drop("n"), "seeking"
    )
    pool = registry.select(*cols.registry)
    if consumed is not None:
        pool = without(pool, consumed, cols.code)
    pool, space = stage_table(pool, "pool"), None
    if k >= LEAST_FAR and refine_above is None:
        sides = (distinct_names(df, cols.name, cols.block).select("name") for df in (seeking, pool))
        space = space_of(stack_rows(list(sides), strict=True))
    to_hit = [(cols.name, "left_name"), (cols.block, "block")]
    for ring in sorted({min(LEAST_FAR, k), k}):
        hits = _hits(seeking, pool, None, cols, ring, refine_above, long_names, space)
        found = hits.groupBy("block", "left_name").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("right_name").alias(f"{cols.name}_candidate"),
            F.min("code").alias(f"{cols.code}_candidate"),
        )
        if ring < k:
            seeking = stage_table(without(seeking, found.where("n > 1"), to_hit), "seeking")
    far = (
        found.where("n = 1")
        .withColumnsRenamed({"left_name": cols.name, "block": cols.block})
        .select(*keys, f"{cols.name}_candidate", f"{cols.code}_candidate")
    )
    return null_safe_join(unmatched.select(*cols.exact_key), far, keys, "left")


def apply_crosswalk(
    corrections: DataFrame,
    unmatched: DataFrame,
    registry: DataFrame,
    cols: LinkColumns = DEFAULT,
    drop_unhit: bool = False,
) -> DataFrame:
    """Hand-kept corrections (name, corrected name) met with unmatched rows by
    name, then with the registry by corrected name and block.

    Both big sides are first reduced by a semi join to the names the
    corrections mention, so the outer joins see only those. A correction that
    meets no unmatched row stays, with nulls, unless ``drop_unhit``.
    """
    named = within(unmatched.select(*cols.source), corrections, cols.name)
    targets = within(
        registry.select(*cols.registry), corrections, [(cols.name, cols.corrected)]
    )
    first = null_safe_join(
        corrections.select(cols.name, cols.corrected),
        named,
        cols.name,
        "inner" if drop_unhit else "left",
    )
    return null_safe_join(
        first, targets, [(cols.corrected, cols.name), (cols.block, cols.block)], "left"
    )


def provenance(
    exact: DataFrame,
    stages: Sequence[DataFrame],
    manual: DataFrame | None = None,
    cols: LinkColumns = DEFAULT,
) -> DataFrame:
    """All matched rows with ``is_direct_match`` and the corrected name."""
    parts = [
        exact.select(cols.name, cols.block, cols.code, *cols.values).withColumn(
            "is_direct_match", F.lit(True)
        ),
        *[fuzzy_clean(s, cols) for s in stages],
    ]
    if manual is not None:
        parts.append(manual.withColumnRenamed(cols.corrected, cols.matched))
    rows = stack_rows(parts)
    if cols.matched not in rows.columns:
        rows = rows.withColumn(cols.matched, F.lit(None).cast("string"))
    return rows.withColumnRenamed(cols.matched, f"{cols.name}_corrected").withColumn(
        "is_direct_match", F.coalesce("is_direct_match", F.lit(False))
    )


def match_summary(rows: DataFrame, cols: LinkColumns = DEFAULT) -> DataFrame:
    """Number of rows by direct match and by absence of a corrected name."""
    return rows.groupBy(
        "is_direct_match", F.col(f"{cols.name}_corrected").isNull().alias("no_correction")
    ).agg(F.count(F.lit(1)).alias("n"))


def settle_names(
    rows: DataFrame, cols: LinkColumns = DEFAULT, respell_from: DataFrame | None = None
) -> DataFrame:
    """Final columns: the corrected name if any, else the original; the original kept.

    With ``respell_from`` the name is instead the registry's spelling, by code.
    """
    corrected = f"{cols.name}_corrected"
    out = rows.select(
        F.coalesce(corrected, cols.name).alias(cols.name),
        F.col(cols.name).alias(cols.original),
        cols.code,
        cols.block,
        *cols.values,
    )
    if respell_from is None:
        return out
    out = lookup(out.drop(cols.name), respell_from.select(cols.code, cols.name), cols.code)
    return out.select(cols.name, cols.original, cols.code, cols.block, *cols.values)


def assemble_matches(
    exact: DataFrame,
    stages: Sequence[DataFrame],
    manual: DataFrame | None = None,
    cols: LinkColumns = DEFAULT,
    respell_from: DataFrame | None = None,
) -> DataFrame:
    """One table from all stages: name, original name, code, block, values."""
    return settle_names(provenance(exact, stages, manual, cols), cols, respell_from)
