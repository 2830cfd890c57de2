"""Name normalisation, all of it JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchwright.fixed_values import CONNECTOR_RULES


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_case(col: Column | str) -> Column:
    """Title case on Unicode word boundaries: a hyphen starts a word, an
    apostrophe between letters does not."""
    return F.collate(F.initcap(F.collate(_col(col), "UNICODE")), "UTF8_BINARY")


def replace_in_order(col: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Replace every occurrence of each rule's text, rule after rule."""
    out = _col(col)
    for old, new in rules:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def normalize_names(
    col: Column | str, rules: Sequence[tuple[str, str]] = CONNECTOR_RULES
) -> Column:
    """Title case, then the connector rules."""
    return replace_in_order(title_case(col), rules)


def squish(col: Column | str) -> Column:
    """Trim, and turn inner runs of blanks into one blank."""
    return F.trim(F.regexp_replace(_col(col), r"\s+", " "))
